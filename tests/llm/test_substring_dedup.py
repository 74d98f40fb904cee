"""Repeated-passage removal against a brute-force version."""

import random

import pytest

from rivulet.llm import substring_dedup as S


def brute(rows, k):
    """Per row: (id, kept, words, removed), by comparing every window."""
    order = lambda i: (i is not None, i or 0)
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - k + 1):
            key = tuple(w[s:s + k])
            first[key] = min(first.get(key, (order(i), s)), (order(i), s))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s:s + k])] < (order(i), s):
                gone.update(range(s, s + k))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        out.append((i, kept, len(w), len(gone)))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, id string, h int")
    return [tuple(r) for r in S.remove_repeats(df, **kw).collect()]


KEY = lambda r: tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("kw", [{}, {"chunk_chars": 200}, {"bucket_bytes": 400}, {"chunk_chars": 300, "bucket_bytes": 40}])
def test_random_texts(spark, kw):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["é", " x", "a\x1cb"]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 14))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 9))]
        rows.append((rng.randint(0, 1000) * 7 + i % 7, rng.choice([" ", "\n", "\t \x0b"]).join(w)))
    rows += [(rows[0][0], rows[0][1]), (rows[1][0], rows[2][1]), (None, rows[3][1]), (None, None), (2000, ""),
             (2001, " \n"), (2002, "z " * 300), (2003, "y " * 7)]
    got = run(spark, rows, k=6, m=2, **kw)
    assert sorted(got, key=KEY) == sorted(brute(rows, 6), key=KEY)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_table_matches_brute_force(spark):
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    import hashlib
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, k, n, r in brute(rows, 20)]
    got = QUERIES["op1_superkmer_dedup"](spark, SF_SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_window_ranks():
    import numpy as np
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2, 400)
    for k in (1, 2, 3, 5, 7, 20):
        r = S.window_ranks(codes, k)
        seqs = [tuple(codes[i:i + k]) for i in range(len(codes) - k + 1)]
        assert len(r) == len(seqs)
        assert len(set(zip(r, seqs))) == len(set(r)) == len(set(seqs))
