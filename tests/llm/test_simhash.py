"""SimHash components against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from rivulet.llm import simhash as S


def slow(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(fps, radius=3):
    """Component number of each fingerprint."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= radius):
            x, y = find(i), find(i + 1 + int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def least(ids, comp):
    low = {}
    for i, c in zip(ids, comp):
        if i is not None and (low.get(c) is None or i < low[c]):
            low[c] = i
    return [low.get(c) for c in comp]


def fixture():
    rng = random.Random(9)
    base = [" ".join(rng.choice("alpha BETA gamma dé eps zeta eta theta".split()) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    rows = []
    for i in range(300):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice(["new", "word"])
        rows.append((i * 3 % 1009, " ".join(w)))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (rows[5][0], rows[6][1]), rows[7], (2003, "one"), (2004, "ONE")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id bigint, text string, fp int, rep string")


@pytest.mark.parametrize("shard", [32_768, 40])
def test_components(spark, shard):
    rows = fixture()
    fps = [slow(t) for _, t in rows]
    want = least([i for i, _ in rows], brute(fps))
    got = S.near_duplicates(frame(spark, rows), shard=shard).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == \
        sorted(((i, f, c) for (i, _), f, c in zip(rows, fps, want)), key=key)


def test_trees_find_every_pair():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    near = points[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    ball = np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    points = np.unique(np.concatenate([points, near, ball]))
    for radius in (0, 1, 3, 6):
        want = brute(points.tolist(), radius)
        assert S.shard_forest(points, radius).tolist() == want
        tree = S.build_tree(points, len(points), 200, radius)
        who, where = S.shards_of(points, tree, radius)
        assert len(tree) > 3
        shards = {}
        for w, s in zip(who.tolist(), where.tolist()):
            shards.setdefault(s, set()).add(w)
        d = np.bitwise_count(points[:, None] ^ points[None, :]) <= radius
        homes = [{s for s, m in shards.items() if i in m} for i in range(len(points))]
        assert all(homes[i] & homes[j] for i, j in zip(*np.nonzero(d)))


def test_long_chains(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1001 + k) for k in range(300)] + [(5000, 5001), (5001, 5002), (7, 7)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(1, 201)) and all(got[1001 + k] == 1000 for k in range(300))
    assert got[5001] == got[5002] == 5000


def test_keep_one(spark):
    rows = fixture()
    df = frame(spark, rows)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    fps = [slow(t) for _, t in rows]
    comp = brute(fps)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    of = {(i, t): c for (i, t), c in zip(rows, comp)}
    assert sorted(of[g] for g in got) == sorted(set(comp))
    order = lambda i: (i is not None, i or 0)
    for g in got:
        assert order(g[0]) == min(order(i) for (i, _), c in zip(rows, comp) if c == of[g])


def test_empty_table(spark):
    df = frame(spark, fixture()).limit(0)
    assert S.near_duplicates(df).collect() == [] and S.keep_one(df).collect() == []
