"""Packing: every id once, sequences without gaps or needless padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from rivulet.llm import packing
from rivulet.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PATH = P.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [1]


def check(pieces, docs, window):
    """``pieces``: (id, start, length, ids, doc_tokens, sequence, offset)."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_seq[p[5]].append((p[6], p[2]))
        by_doc[p[0], p[4]].append(p)
    filled = []
    for s in by_seq.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        filled.append(at)
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert all(n == window or n & (n - 1) == 0 and n < window for n in filled)
    assert sum(n < window for n in filled) <= window.bit_length()
    want = Counter(docs)
    got = Counter()
    for (doc, size), ps in by_doc.items():
        ids = {}
        for p in sorted(ps, key=lambda p: p[1]):
            ids.setdefault(p[1], []).append(p)
        copies = sum(p[2] for p in ps) / size
        assert copies == int(copies)
        got[doc, size] += int(copies)
    assert got == Counter({(d, len(x)): 0 for d, x in want} ) + Counter([(d, len(x)) for d, x in docs])


def unpacked(pieces):
    """Ids of each document, its pieces in order."""
    out = defaultdict(list)
    for doc, start, length, ids, size, *_ in pieces:
        assert len(ids) == 4 * length
        out[doc, size].append((start, ids))
    return out


@pytest.mark.parametrize("window", [16, 64, 2048])
def test_every_id_lies_in_one_piece(spark, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choice(["river", "a", "of stones", "<|endoftext|>", "naïve 😀"]) for _ in range(rng.randint(0, 60)))
             for _ in range(150)]
    texts += [None, "", "x", "word " * 30_000]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id bigint, text string, ids int, rest string")
    got = [tuple(r) for r in packing.pack(df.repartition(3), PATH, window=window).collect()]
    enc = library()
    docs = [(i, tuple(enc(t))) for i, t in rows]
    check(got, docs, window)
    held = unpacked(got)
    for i, ids in docs:
        parts = sorted(held[i, len(ids)])
        assert b"".join(p for _, p in parts) == np.array(ids, "<u4").tobytes()
        assert [s for s, _ in parts] == list(np.cumsum([0] + [len(p) // 4 for _, p in parts])[:-1])


def test_words_are_encoded_as_in_their_text():
    """Distinct pre-tokens one by one give what the library gives for the
    whole text, for every 37th code point and those unassigned here."""
    rng = random.Random(5)
    points = [c for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000] + [0x1C89, 0xA7CB, 0x105C0, 0x1E5F6]
    texts = [f"it's{chr(c)}a 1{chr(c)}2  {chr(c)}'ll \n{chr(c)}{chr(c)} " for c in points]
    texts += ["".join(rng.choice(["ab", " ", "'s", "'", "\n", "12", "é", "!?", "\t", "<|endoftext|>"])
                      for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    coder, enc = packing.Coder(PATH), library()
    for at in range(0, len(texts), 5000):
        part = texts[at:at + 5000]
        assert [x.tolist() for x in coder(part)] == [enc(t)[:-1] for t in part]


def test_words_reach_the_library_in_lines(monkeypatch):
    """Distinct pre-tokens are encoded many at a time, with the ids that each
    has alone; should a line's tokens not fit them, one by one."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeéß'17.") for _ in range(rng.randint(3, 9)))
    texts = ["".join(rng.choice(["", " ", " ", "  ", "\n", "\t", "\u2003", "\x85"]) + word() for _ in range(200)) for _ in range(40)]
    enc = library()
    want = [enc(t)[:-1] for t in texts]
    coder, given = packing.Coder(PATH), []
    plain = coder._batch
    monkeypatch.setattr(coder, "_batch", lambda part: given.extend(part) or plain(part))
    assert [x.tolist() for x in coder(texts)] == want
    assert len(coder.known) > 2000 and len(given) < len(coder.known) / 20
    assert [x.tolist() for x in coder(texts[::-1])] == want[::-1]
    for spoil in (lambda c: c.wide.fill(1), lambda c: setattr(c, "joins", False)):
        coder = packing.Coder(PATH)
        spoil(coder)
        assert [x.tolist() for x in coder(texts)] == want


def test_places_of_many_remainders_at_once():
    """Pieces of a batch's remainders against the plan read row by row."""
    rng = np.random.default_rng(3)
    h = rng.integers(0, 60, 64) * (rng.random(64) < 0.4)
    rows, _ = packing.plan(h, 64)
    assert (rows[:, 6] > 0).any()
    length, rank = np.concatenate([[(n, k) for n, c in enumerate(h.tolist()) if n for k in range(c)], [(0, 5)]]).T
    want = []
    for i, (n, k) in enumerate(zip(length.tolist(), rank.tolist())):
        while n:
            _, start, _, sequence, offset, take, rest, rest_start = next(
                r for r in rows.tolist() if r[0] == n and r[1] <= k < r[2])
            want.append((i, sequence + k - start, offset, take))
            n, k = rest, rest_start + k - start
    got = list(zip(*(x.tolist() for x in packing.Places(rows).pieces(length, rank))))
    assert sorted(got, key=lambda p: p[0]) == want
    with pytest.raises(RuntimeError):
        packing.Places(rows).pieces(np.array([1]), np.array([10 ** 6]))


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "the same text"), (1, "the same text"), (None, None), (None, "b c"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    out = packing.pack(df, PATH, window=8)
    assert dict(out.dtypes)["doc_id"] == "int"
    enc = library()
    check([tuple(r) for r in out.collect()], [(i, tuple(enc(t))) for i, t in rows], 8)
    assert packing.pack(df.where("doc_id > 5"), PATH).collect() == []


def test_ids_of_other_types_in_small_cuts(spark, monkeypatch):
    monkeypatch.setattr(packing, "CUT_TOKENS", 50)
    enc = library()
    rows = [(k, f"word {k} " * (k * 7 % 40)) for k in range(30)] + [(None, "no id")]
    for kind, ids in (("string", [None if k is None else f"d{k}" for k, _ in rows]),
                      ("struct<a:bigint,b:string>", [None if k is None else (k, "b") for k, _ in rows])):
        docs = [(i, t) for i, (_, t) in zip(ids, rows)]
        out = packing.pack(spark.createDataFrame(docs, f"doc_id {kind}, text string"), PATH, window=32)
        assert dict(out.dtypes)["doc_id"] == kind
        check([tuple(r) for r in out.collect()], [(i, tuple(enc(t))) for i, t in docs], 32)


@pytest.mark.parametrize("histogram", ["even", "one length", "short", "hot", "none"])
def test_plan_places_every_rank_once(histogram):
    window = 128
    rng = np.random.default_rng(2)
    h = {"even": rng.integers(0, 400, window), "one length": np.where(np.arange(window) == 93, 100_003, 0),
         "short": np.where(np.arange(window) < 4, 999, 0),
         "hot": rng.integers(0, 40, window) + np.where(np.arange(window) == 50, 1_000_000, 0),
         "none": np.zeros(window, int)}[histogram].astype(np.int64)
    h[0] = 17  # documents of whole windows
    rows, sequences = packing.plan(h, window)
    assert len(rows) < 20_000
    tokens = int((h * np.arange(window)).sum())
    assert sequences <= tokens // window + window.bit_length()
    # lengths and ranks: what the histogram has, and what cuts leave, once each
    ranks = defaultdict(list)
    for length, start, stop, seq, offset, take, rest, rest_start in rows.tolist():
        ranks[length].append((start, stop))
        assert 0 < take <= length and rest == length - take
    made = {n: int(c) for n, c in enumerate(h) if n and c}
    for *_, start, stop, seq, offset, take, rest, rest_start in [r for r in rows.tolist() if r[6]]:
        made[rest] = max(made.get(rest, 0), rest_start + stop - start)
    for n, parts in ranks.items():
        at = 0
        for a, b in sorted(parts):
            assert a == at
            at = b
        assert at == made[n]


def test_least_squares_fills_most_windows():
    """Combinations, not the greedy rest, place most remainders whole."""
    rng = np.random.default_rng(8)
    h = np.bincount(np.clip(rng.gamma(2, 60, 50_000).astype(int), 1, 255), minlength=256)
    combos = packing.combinations(np.flatnonzero(h), 256)
    assert (combos.sum(axis=1) == 256).all() and len({tuple(c) for c in combos.tolist()}) == len(combos)
    x = packing.repeats(combos, h.astype(float))
    used = np.bincount(combos.ravel(), np.repeat(packing.rounded(combos, x, h), 3), 256)[1:]
    assert (used <= h[1:]).all()
    rows, _ = packing.plan(h, 256)
    cut = sum(stop - start for _, start, stop, *_, rest, _ in rows.tolist() if rest)
    assert used @ np.arange(1, 256) > 0.75 * (h[1:] @ np.arange(1, 256)) and cut < 0.2 * h.sum()


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    enc = library()
    ids = {i: np.array(enc(t), "<u4") for i, t in docs}
    got = QUERIES["op11_nnls_packing"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = [tuple(r) for r in got.collect()]
    for i, start, length, crc, size, *_ in got:
        assert size == len(ids[i]) and crc == zlib.crc32(ids[i][start:start + length].tobytes())
    check(got, [(i, tuple(x)) for i, x in ids.items()], 2048)
