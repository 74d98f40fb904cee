"""Names, types and lengths that operators must take: clashing columns, int
ids, texts with very many matches."""

import re
import time

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from rivulet.llm import bpe, hard_negatives, host_quality, packing, pii, simhash, whitening

NAMES = ["__pii", "__spans", "__base", "__loose", "__n", "__id", "__h", "__base_failed", "__host", "row", "key", "id", "h",
         "x", "count", "salt", "ids", "z"]
LONG = " ".join(f"word{i % 90} goes on with {i} more things to say about the river" for i in range(30))


def docs(spark, rows):
    df = spark.createDataFrame([(i, t, s, len(t or "")) for i, t, s in rows],
                               "doc_id int, text string, source string, n_chars int")
    return df.select("*", *[F.concat(F.lit(f"{k}:"), F.col("doc_id").cast("string")).alias(c) for k, c in enumerate(NAMES)])


ROWS = [(1, LONG, "w"), (2, LONG, "w"), (3, "short", None), (4, None, "w"), (5, "", "v"), (6, LONG + " mail me@here.org now", "v")]


def test_clashing_columns_come_through(spark):
    df = docs(spark, ROWS)
    for out in (pii.redact(df), simhash.keep_one(df), host_quality.keep(df)):
        assert out.columns == df.columns and out.dtypes == df.dtypes
        for r in out.collect():
            assert [r[c] for c in NAMES] == [f"{k}:{r.doc_id}" for k in range(len(NAMES))]
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    assert got[6].text == LONG + " mail <EMAIL> now" and got[6].n_chars == len(got[6].text)
    assert got[4].text is None and got[3].n_chars == 5
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect())[:3] == [1, 3, 4]
    found = pii.find(df)
    assert set(found.columns) == set(df.columns) - {"__loose"} and dict(found.dtypes)["__spans"].startswith("array")
    assert [r["__pii"] for r in found.where("doc_id = 1").collect()] == ["0:1"]


def test_int_ids(spark):
    df = docs(spark, ROWS).select("doc_id", "text")
    out = bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), decoded=True)
    assert dict(out.dtypes)["doc_id"] == "int"
    assert {r.doc_id: bytes(r.bytes).decode() for r in out.collect()} == {i: t or "" for i, t, _ in ROWS}
    assert {r.doc_id for r in packing.pack(df, P.path("byte_bpe_50k.json")).collect()} == {1, 2, 3, 4, 5, 6}


def test_vector_operators_ignore_other_columns(spark):
    v = np.random.default_rng(0).normal(size=(30, 4)) / 4
    df = spark.createDataFrame([(i, x.tolist(), i % 2) for i, x in enumerate(v)], "vec_id int, embedding array<double>, label int")
    plain = [sorted(map(tuple, f(df).collect())) for f in (lambda d: whitening.whiten(d), lambda d: hard_negatives.mine(d, F.col("vec_id") % 5 == 0))]
    more = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(
        ["id", "v", "x", "count", "salt", "ids", "z", "component", "n", "anchor", "part", "seq", "dims", "labels"])])
    again = [sorted(map(tuple, f(more).collect())) for f in (lambda d: whitening.whiten(d), lambda d: hard_negatives.mine(d, F.col("vec_id") % 5 == 0))]
    assert plain[1] == again[1] and len(plain[0]) == len(again[0]) > 0


def test_very_many_spans_in_one_text(spark):
    """Places of thousands of matches, in time that grows with the text."""
    took = {}
    for n in (700, 6000):
        text = " ".join(f"user{i}@host{i % 7}.org" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        t = time.time()
        [r] = pii.find(df).collect()
        took[n] = time.time() - t
        assert [(s.s, s.e) for s in r["__base"]] == [m.span() for m in re.finditer(r"\S+", text)]
    assert took[6000] < 8 * took[700] + 10
