"""Every stage of the corpus pipeline against its brute-force version."""

import hashlib
import random
from collections import Counter

import numpy as np

from rivulet.llm import decontaminate as D
from tests.llm import test_bpe, test_decontaminate, test_host_quality, test_pii, test_simhash

COLS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark):
    item = "benchmark passage of some twenty words that a model must not see in training at all because it is a test item"
    words = [f"w{i}" for i in range(83)]
    plain = lambda k: " ".join(words[(i * (k + 3)) % 83] + str(k) for i in range(70))
    rows = [(i, plain(i), "en", f"s{i % 2}", 0) for i in range(12)]
    rows += [(20, plain(3), "en", "s0", 0), (21, plain(4) + " tail", "en", "s0", 0), (22, plain(30) + " " + item, "en", "s1", 0),
             (23, plain(31) + " mail me a@b.co now", "en", "s1", 0), (24, "short", "en", "s1", 0), (25, None, "en", None, None),
             (26, "", None, "s1", 0), (None, plain(40), "de", "s0", 0), (5, plain(5), "en", "s1", 0)]
    rows = [(*r[:4], None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(rows, COLS), rows, [(1, item)]


def test_stages(spark, tmp_path):
    import corpus_pipeline as P
    df, rows, items = docs(spark)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    steps = dict(P.STAGES)
    out = steps["quality"](spark, df, str(tmp_path))
    assert out.columns == df.columns
    want = [r for r in rows if not test_host_quality.brute(r[1])[-1]]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)

    out = steps["near_dedup"](spark, spark.createDataFrame(want, COLS), str(tmp_path))
    assert out.columns == df.columns
    comp = test_simhash.brute([test_simhash.slow(r[1]) for r in want])
    groups = {}
    for r, c in zip(want, comp):
        groups.setdefault(c, []).append(r)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(groups) < len(want)
    assert all(any(g in m and key(g)[0] == min(key(x)[0] for x in m) for m in groups.values()) for g in got)

    out = steps["decontaminate"](spark, spark.createDataFrame(got, COLS), str(tmp_path))
    bad = test_decontaminate.brute([r[:2] for r in got], items)
    want = [r for r in got if (r[0], 1) not in bad]
    assert out.columns == df.columns and len(want) == len(got) - 1
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)

    out = steps["pii"](spark, spark.createDataFrame(want, COLS), str(tmp_path))
    assert out.columns == df.columns
    masked = [(r[0], r[1].replace("a@b.co", "<EMAIL>"), *r[2:4], len(r[1].replace("a@b.co", "<EMAIL>"))) for r in want]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(masked, key=key)

    out = steps["bpe"](spark, spark.createDataFrame(masked, COLS), str(tmp_path))
    enc = test_bpe.library()
    ids = [(r[0], np.array(enc.encode_ordinary(r[1]), "<u4").tobytes(), hashlib.sha256(r[1].encode()).hexdigest()) for r in masked]
    final = [(r.doc_id, bytes(r.ids), r.decoded_sha256) for r in out.collect()]
    assert sorted(final, key=key) == sorted(ids, key=key)
    whole = [(r.doc_id, bytes(r.ids), r.decoded_sha256) for r in P.run(spark, str(tmp_path)).collect()]
    assert sorted(whole, key=key) == sorted(ids, key=key)


def test_empty_table(spark, tmp_path):
    import corpus_pipeline as P
    df, _, items = docs(spark)
    df.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_decontamination_looks_every_start_up(spark, tmp_path):
    """Passages that are near a benchmark item at one start alone, by the
    fingerprints of ``search``, at even and odd starts: stage decontaminate
    drops all rows that brute force over all windows does, and no others."""
    import corpus_pipeline as P
    rng = random.Random(12)
    vocab = [f"t{i}" for i in range(3000)]
    items, rows, parity = [], [], Counter()
    for _ in range(20_000):
        item = [rng.choice(vocab) for _ in range(24)]
        noise, cut = [rng.choice(vocab) for _ in range(60)], rng.choice([20, 21])
        w = noise[:cut] + item[:-2] + ["edited", "here"] + noise[cut:]
        left, mid, right = ((D.fingerprint(item) ^ D.fingerprint(w[s:s + 24])).bit_count() for s in (cut - 1, cut, cut + 1))
        if mid <= D.RADIUS < min(left, right) and parity[cut] < 10:
            items.append((len(items), " ".join(item)))
            rows.append((len(rows), " ".join(w)))
            parity[cut] += 1
    assert min(parity[20], parity[21]) >= 5
    rows += [(1000 + k, " ".join(rng.choice(vocab) for _ in range(140))) for k in range(20)]
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bad = {i for i, _ in test_decontaminate.brute(rows, items)}
    assert len(bad) == len(items)
    out = P.decontaminated(spark, docs, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == {i for i, _ in rows} - bad
