"""Whitening against numpy on exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from rivulet.llm import whitening
from rivulet.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, n int, x string, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", "c") for i, v in rows], SCHEMA)


def brute(rows, weights="one", k=16):
    """(id, component) -> n, deviation, whitened (either sign), explained."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in [*v, *[0.0] * (d - len(v))])) for i, v in kept]
    fit = {}
    for _, x in xs:
        fit[x] = fit.get(x, 0) + 1 if weights == "count" else 1
    n = sum(fit.values())
    sums = [sum(x[j] * w for x, w in fit.items()) for j in range(d)]
    far = {x: [n * a - s for a, s in zip(x, sums)] for x in fit}
    cov = np.array([[float(Fraction(sum(w * far[x][i] * far[x][j] for x, w in fit.items()), n ** 3)) for j in range(d)]
                    for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    out = []
    for i, x in xs:
        z = (np.array(far[x]) / n) @ vector
        out.append((i, n, sum(u * u for u in far[x]), [(z[c] / math.sqrt(value[c]), value[c] / np.trace(cov))
                                                       for c in range(min(k, d)) if value[c] > value[0] * d * 2.3e-16]))
    return out


def check(got, want):
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation, r.n), []).append(r)
    expect = {}
    for i, n, dev, comps in want:
        expect.setdefault((i, dev, n), []).append(comps)
    expect = {k: v for k, v in expect.items() if any(v)}
    assert set(by) == set(expect)
    signs = {}
    for key, rows in by.items():
        comps = expect[key][0]
        assert len(rows) == sum(len(c) for c in expect[key])
        for r in rows:
            z, share = comps[r.component - 1]
            assert abs(abs(r.whitened) - abs(z)) < 1e-8 * max(1, abs(z))
            if abs(z) > 1e-6:
                assert signs.setdefault(r.component, r.whitened * z > 0) == (r.whitened * z > 0)
            assert math.isclose(r.explained, share, rel_tol=1e-9)
            assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_exact_sums(spark, weights):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5))
    rows = [(i, base[i % 60].tolist()) for i in range(90)]
    rows += [(1000 + i, base[3].tolist()) for i in range(700)]  # a hot vector: salted
    rows += [(None, base[4].tolist()), (5, None), (6, [1.0, None, 0.0, 0.0, 0.0]), (7, [float("nan")] * 5), (8, [float("inf")] * 5),
             (9, []), (10, [0.0, 0.0]), (11, [2.5, -3.0]), (1, base[1].tolist())]
    got = whitening.whiten(table(spark, rows).repartition(3), weights=weights).collect()
    check(got, brute(rows, weights))


def test_values_of_any_size_stay_exact(spark):
    """Beyond doubles' 53 bits: wide keys, long sums, decimal deviations."""
    rows = [(0, [1e12, 3.0]), (1, [-1e12, 4.0]), (2, [5e11, -1.0]), (3, [1.0, 2.0])]
    got = whitening.whiten(table(spark, rows), scale=64.0)
    assert dict(got.dtypes)["deviation"] == "decimal(38,0)"
    want = {i: dev for i, _, dev, _ in brute(rows)}
    assert {r.vec_id: int(r.deviation) for r in got.collect()} == want


def test_without_variance_there_are_no_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whitening.whiten(table(spark, [(1, [1.0, 5.0, 2.0]), (2, [2.0, 5.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9))) for r in got) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_gram_is_exact_at_every_size():
    rng = np.random.default_rng(1)
    for top in (10, 2 ** 30, 2 ** 55):
        x = rng.integers(-top, top, (7, 3))
        w = rng.integers(1, 9, 7)
        want = [[sum(int(w[r]) * int(x[r, i]) * int(x[r, j]) for r in range(7)) for j in range(3)] for i in range(3)]
        assert whitening.gram(x, w, top).tolist() == want


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op13_multiplicity_whitening"](spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), brute(rows))
