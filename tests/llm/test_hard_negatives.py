"""Hard negatives against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import hard_negatives
from rivulet.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, label string, p int, score string, ids string"


def brute(rows, anchor, k=5, window=(80, 100), scale=256):
    ok = [(i, [math.floor(scale * float(np.float32(c))) for c in v], lab) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q, lab) in enumerate(ok):
        if not anchor(i):
            continue
        score = lambda x: sum(a * b for a, b in zip(q, x))
        same = sorted((-score(x), j) for n, (j, x, m) in enumerate(ok) if n != at and m == lab)[:k]
        other = sorted((-score(x), j) for j, x, m in ok if m != lab)
        for nth, (p, pid) in enumerate(same, 1):
            hits = [(s, j) for s, j in other if window[0] * -p <= 100 * -s <= window[1] * -p][:k]
            out += [(i, pid, r, j, -p, -s, nth) for r, (s, j) in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "s", "i") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives.mine(df.repartition(3), F.col("vec_id") % 10 == 0, **kw).collect())


@pytest.mark.parametrize("block,group,band,cell", [(4096, 256, 128, 16), (7, 2, 2, 3)])
def test_against_all_scores(spark, monkeypatch, block, group, band, cell):
    for name, v in (("BLOCK", block), ("GROUP", group), ("BAND_GROUPS", band), ("CELL_BLOCKS", cell)):
        monkeypatch.setattr(hard_negatives, name, v)
    rng = np.random.default_rng(3)
    mid = rng.normal(size=16) / 4
    v = (rng.normal(size=(150, 16)) / 5 + mid).round(1)  # few values: ties
    rows = [(i, v[i].tolist(), "abc"[i % 3]) for i in range(150)]
    rows += [(200 + i, v[10].tolist(), "a") for i in range(40)]  # copies of an anchor
    rows += [(10, v[10].tolist(), "b"), (10, v[10].tolist(), "b"), (20, v[20].tolist(), "c")]  # repeated rows
    rows += [(None, v[1].tolist(), "a"), (1, None, "a"), (30, [1.0, None], "a"), (40, [float("nan")], "b"),
             (50, v[3].tolist(), None), (60, [], "a"), (70, [0.5, 0.25], "b"), (80, (-v[5]).tolist(), "alone")]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 100


def test_large_scores_are_exact_or_an_error(spark):
    rows = [(0, [9e5, 1e6], "a"), (1, [9e5 - 1, 1e6 - 3], "a"), (2, [9e5 - 2, 1e6 - 4], "b"), (3, [1.0, 1.0], "b")]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="do(es)? not fit 64 bits"):
        mined(spark, [(0, [1e9, 1.0], "a"), (1, [1e9, 1.0], "a"), (2, [1e9, 1.0], "b")])


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], "a"), (2, [1.0], "a")]) == []  # no anchors
    assert mined(spark, [(10, [1.0], "a"), (2, [1.0], "b")]) == []  # no positive


def test_pruning_leaves_few_rows():
    """The scan drops candidates before their columns are read."""
    rng = np.random.default_rng(4)
    x = rng.integers(-60, 60, (3000, 64))
    x[:40] = x[0] + rng.integers(-3, 4, (40, 64))
    block = hard_negatives.Block(64, 2, np.arange(3000).tobytes(), x.T.astype("<i2").tobytes(), x.min(axis=0).tobytes(),
                                 x.max(axis=0).tobytes(), ["a"] * 3000)
    seen = []
    keep = hard_negatives.best(6, None)
    rows, score = hard_negatives.scan(block, x[0], block.rows_of("a"), lambda lo, hi: (seen.append(len(lo)), keep(lo, hi))[1])
    want = x @ x[0]
    assert set(np.argsort(-want, kind="stable")[:6]) <= set(rows) and (score == want[rows]).all()
    assert seen[-1] < 200


def test_query(spark):
    rows = [(r.vec_id, r.embedding, str((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label))
            for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op12_bond_negatives"](spark, SF_SMALL)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 100 == 0)
