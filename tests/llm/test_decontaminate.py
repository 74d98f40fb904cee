"""Decontamination against brute force over all windows."""

import random
import re
import time
from collections import Counter

import numpy as np

from rivulet.llm import decontaminate as D


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def bag(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def brute(docs, items, threshold=0.8):
    """(id, item) pairs with a window of the item's size at any place."""
    out = set()
    for i, t in docs:
        w = words(t)
        for k, x in items:
            iw = words(x)
            if not iw:
                continue
            b = bag(iw)
            for s in range(max(0, len(w) - len(iw)) + 1):
                a = bag(w[s:s + len(iw)])
                if a and sum((a & b).values()) >= threshold * sum((a | b).values()):
                    out.add((i, k))
                    break
    return out


def fixture():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(40)] + ["été", "A1"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(rng.randint(14, 60)))) for k in range(25)]
    items += [(90, "one two three"), (91, None), (92, ""), (93, " ".join(["x"] * 20)), (5, items[3][1]), (None, items[4][1])]
    docs = []
    for i in range(150):
        w = text(rng.randint(0, 80))
        if rng.random() < 0.7:
            p = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                if p:
                    at = rng.randrange(len(p))
                    rng.choice([lambda: p.__setitem__(at, "zzz"), lambda: p.insert(at, "new"), lambda: p.pop(at)])()
            cut = rng.randint(0, len(w))
            w = w[:cut] + [x.upper() if rng.random() < 0.1 else x + rng.choice(["", ",", "."]) for x in p] + w[cut:]
        docs.append((i, rng.choice([" ", "\n"]).join(w)))
    docs += [(500, None), (501, ""), (None, items[0][1]), (7, docs[9][1]), (502, "x " * 19), (503, "x " * 400)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "h", 1) for i, t in docs], "doc_id bigint, text string, id string, item int"),
            spark.createDataFrame([(k, t, "z") for k, t in items], "item_id bigint, text string, g string"))


def test_against_brute_force(spark):
    docs, items = fixture()
    a, b = frames(spark, docs, items)
    want = brute(docs, items)
    assert len(want) > 40
    for kw in ({}, {"part_chars": 2000}):
        got = {(r.doc_id, r.item_id) for r in D.matches(a, b, **kw).collect()}
        assert got == want, (got - want, want - got)


def test_clean_keeps_the_rest_whole(spark):
    docs, items = fixture()
    a, b = frames(spark, docs, items)
    bad = {(i, t) for i, t in docs for k, _ in items if (i, k) in brute([(i, t)], items)}
    left = D.clean(a, b)
    assert left.columns == a.columns
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=key) == \
        sorted((d for d in docs if d not in bad), key=key)


def test_empty_tables(spark):
    docs, items = fixture()
    a, b = frames(spark, docs, items)
    assert D.matches(a.limit(0), b).collect() == []
    assert D.matches(a, b.limit(0)).collect() == []
    assert D.clean(a, b.limit(0)).count() == len(docs)


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    read = lambda t, k: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(k, "text").collect()]
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    shingles = {s for _, t in items for s in bag(words(t))}
    near = [(i, t) for i, t in docs if shingles & set(bag(words(t)))]  # others have similarity zero
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, SF_SMALL).collect()}
    assert got == brute(near, items) and got


def test_rolling_fingerprints_equal_single_ones():
    rng = random.Random(2)
    w = [f"v{rng.randint(0, 30)}" for _ in range(700)]
    counts = D.Counts(w, D.Hashes())
    for size in (1, 2, 3, 17, 60, 256, 257, 400):
        got = counts.windows(0, len(w) - size + 1, size)
        assert got.tolist() == [D.fingerprint(w[s:s + size]) for s in range(len(w) - size + 1)]
        assert counts.windows(3, 90, size, 2).tolist() == got.tolist()[3:90:2]


def test_index_finds_all_within_the_radius():
    """Block tables against comparing every pair, with planted distances."""
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    windows = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for k in range(2000):
        flips = rng.choice(64, rng.integers(0, 22), replace=False)
        windows[k] = items[k % 40] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
    for some in (items[:1], items[:9], items[:20], items):
        at, js = D.near(D.block_tables(some, 15), some, windows, 15)
        got = set(zip(at.tolist(), js.tolist()))
        assert len(got) == len(at)
        dist = np.bitwise_count(windows[:, None] ^ some[None, :])
        assert got == {(int(a), int(j)) for a, j in zip(*np.nonzero(dist <= 15))} and got


def planted(rng, n_items, low, high):
    vocab = [f"t{i}" for i in range(3000)]
    items = [(k, [rng.choice(vocab) for _ in range(rng.randint(low, high))]) for k in range(n_items)]
    rows, keys = [], []
    for k, w in items:
        for edit in ("put", "add", "drop"):
            p, at = list(w), rng.randrange(len(w))
            p[at:at + (edit != "add")] = [] if edit == "drop" else ["edited"]
            cut = rng.randint(0, 60)
            noise = [rng.choice(vocab) for _ in range(60)]
            rows.append(" ".join(noise[:cut] + p + noise[cut:]))
            keys.append(k)
    clean = [" ".join(rng.choice(vocab) for _ in range(200)) for _ in range(100)]
    return [(k, " ".join(w)) for k, w in items], rows, keys, clean


def test_recall_on_planted_edits():
    """One word put, added or dropped: with five-word shingles wherever 0.8 is
    reached, with one-word shingles in items of 15 to 59 words."""
    rng = random.Random(8)
    items, rows, keys, clean = planted(rng, 60, 15, 59)
    for shingle in (5, 1):
        index = D.Index(items, shingle, D.RADIUS)
        got = D.search(index, rows, 0.8)
        found = {(r, k) for r, k in enumerate(keys) if (r, k) in got}
        texts = dict(items)
        due = {(r, k) for r, k in enumerate(keys) if any(
            D.similarity(D.shingles_of(w[s:s + n], shingle), D.shingles_of(texts[k].split(), shingle)) >= 0.8
            for w, n in [(rows[r].split(), len(texts[k].split()))] for s in range(len(w) - n + 1))}
        assert found <= due and len(found) >= 0.95 * len(due), (shingle, len(found), len(due))
        if shingle == 1:
            assert len(due) == len(keys)
        assert not D.search(index, clean, 0.8)


def test_long_texts_pass_in_chunks(monkeypatch):
    rng = random.Random(6)
    items, _, _, _ = planted(rng, 5, 15, 59)
    long = [f"u{rng.randint(0, 10 ** 6)}" for _ in range(1000)]
    for at, (_, t) in zip((0, 180, 395, 640, 1000), items):
        long[at:at] = t.split()
    rows = [" ".join(long), None, items[0][1], "", items[1][1] + " end"]
    index = D.Index(items, 5, D.RADIUS)
    whole = D.search(index, rows, 0.8)
    assert {k for r, k in whole if r == 0} == {0, 1, 2, 3, 4} and (2, 0) in whole and (4, 1) in whole
    monkeypatch.setattr(D, "CHUNK", 100)
    monkeypatch.setattr(D, "TABLE_BYTES", 0)  # tables built anew
    assert D.search(index, rows, 0.8) == whole == D.search(D.Index(items, 5, D.RADIUS), rows, 0.8)
    monkeypatch.undo()
    big = " ".join(long) * 150  # about 1 MB
    t0 = time.perf_counter()
    assert {k for _, k in D.search(index, [big], 0.8)} >= {1, 2, 3}
    assert time.perf_counter() - t0 < 30


def test_short_items_and_clashing_columns(spark):
    docs = [(1, "see Alpha, beta now"), (2, "alpha x beta"), (3, "gamma"), (4, "x gamma y"), (None, "alpha beta")]
    a = spark.createDataFrame([(i, t, 1, 2, 3.0) for i, t in docs], "doc_id bigint, text string, __id int, __H int, ikey double")
    b = spark.createDataFrame([(10, "alpha beta", 1), (11, "gamma", 2)], "item_id int, text string, id int")
    got = sorted(((r.doc_id or 0), r.item_id, r.start, r.similarity) for r in D.matches(a, b).collect())
    assert got == [(0, 10, 0, 1.0), (1, 10, 1, 1.0), (3, 11, 0, 1.0), (4, 11, 1, 1.0)]
    left = D.clean(a, b)
    assert left.columns == a.columns and [r.doc_id for r in left.collect()] == [2]


def test_every_start_is_looked_up():
    """A window that alone is within the radius is found at any start."""
    rng = random.Random(11)
    items, _, _, _ = planted(rng, 40, 24, 59)
    seen = 0
    for _, text in items:
        item = text.split()
        p, at = list(item), rng.randrange(2, len(item) - 2)
        p[at] = "edited"
        for cut in (40, 41):
            w = [f"n{rng.randint(0, 10 ** 6)}" for _ in range(cut)] + p + [f"n{rng.randint(0, 10 ** 6)}" for _ in range(40)]
            left, mid, right = ((D.fingerprint(item) ^ D.fingerprint(w[s:s + len(item)])).bit_count()
                                for s in (cut - 1, cut, cut + 1))
            if mid < min(left, right):
                seen += 1
                assert D.search(D.Index([(0, text)], 1, mid), [" ".join(w)], 0.8)[0, 0][1] == -cut
    assert seen > 20
