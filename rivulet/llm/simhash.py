"""SimHash near-duplicates with vantage-point trees over the fingerprints.

A 64-bit fingerprint per text (3-word shingles, XXH64); two fingerprints link
when they differ in at most ``radius`` bits; a component is what links reach.

Distinct fingerprints are partitioned by their Hamming distance to vantage
points: a node keeps ``d <= t + radius // 2`` inside and ``d >= t + 1 -
(radius - radius // 2)`` outside.  By the triangle bound two fingerprints
within the radius have distances to the vantage point that differ by at most
the radius, so they are together on at least one side; the shards overlap by
``radius`` distance values and every pair is found exactly.  The upper tree is
built from a bounded sample and is small; a task searches its shard with the
same rule down to small blocks.  A shard that stays large (fingerprints in one
dense ball cannot be told apart by distances) is split into tiles: pairs of
chunks, so no task holds more than two chunks whatever the group's size.
Shards return a spanning forest, never all pairs.

Defined cases: a null or empty text, or one of white space, has fingerprint
zero and links like any other; repeated rows and copies share one fingerprint;
a null id keeps its row and takes no part in ``component_id`` unless its
whole component has none (then null); other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.util import by_value, drop, free, stage, stage_at

RADIUS = 3
SHINGLE = 3
#: Fingerprints of one shard chunk; a task holds two chunks at most.
SHARD = 32_768
#: Fingerprints that the upper tree is built from, at most (in expectation),
#: and never more than one in SAMPLE_EVERY.
SAMPLE = 262_144
SAMPLE_EVERY = 16
#: Below this many, a task compares all with all.
BLOCK = 512


# -- fingerprints ---------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text: bits set in over half of its shingles' hashes."""
    import xxhash
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end + 1 - size
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[a:b], 42) for a, b in zip(start[: len(words) - k + 1].tolist(), end[k - 1:].tolist())],
                      np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * ones > len(hashes)).tolist()
    return sum(1 << b for b in bits)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, fp bigint)``, the fingerprint's bits as a signed number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], [id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {id_type}, fp bigint")


# -- vantage-point trees ----------------------------------------------------------

def _sides(points: np.ndarray, vantage: int, threshold: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.bitwise_count(points ^ np.uint64(vantage)).astype(np.int16)
    near = radius // 2
    return np.flatnonzero(d <= threshold + near), np.flatnonzero(d >= threshold + 1 - (radius - near))


def _choose(points: np.ndarray, rng: np.random.Generator, radius: int, tries: int = 8):
    """The vantage point and median distance that leave the least overlap."""
    best = None
    probe = points if len(points) <= 2048 else rng.choice(points, 2048, replace=False)
    for v in rng.choice(probe, min(tries, len(probe)), replace=False):
        d = np.sort(np.bitwise_count(probe ^ v))
        t = int(d[(len(d) - 1) // 2])
        a, b = _sides(probe, int(v), t, radius)
        worst = max(len(a), len(b)) / len(probe)
        if best is None or worst < best[0]:
            best = (worst, int(v), t)
    return best


def build_tree(sample: np.ndarray, total: int, shard: int, radius: int) -> list[tuple]:
    """Nodes ``(vantage, threshold, inside, outside)``; a child below zero is
    the shard ``-1 - child``.  Splits a region while its share of ``total`` is
    over ``shard`` and a split still shrinks it."""
    rng = np.random.default_rng(7)
    nodes: list[tuple] = []
    shards = 0
    scale = total / max(1, len(sample))

    def grow(points: np.ndarray, depth: int) -> int:
        nonlocal shards
        best = _choose(points, rng, radius) if len(points) * scale > shard and len(points) >= 32 and depth < 48 else None
        if best is None or best[0] > 0.92:
            shards += 1
            return -shards
        _, v, t = best
        at = len(nodes)
        nodes.append(())
        a, b = _sides(points, v, t, radius)
        nodes[at] = (v, t, grow(points[a], depth + 1), grow(points[b], depth + 1))
        return at

    if grow(sample, 0) < 0:
        return []
    return nodes


def shards_of(points: np.ndarray, nodes: list[tuple], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of points and the shards they belong to."""
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), np.int32)
    who, where = [], []
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, idx = todo.pop()
        if not len(idx):
            continue
        if at < 0:
            who.append(idx)
            where.append(np.full(len(idx), -1 - at, np.int32))
            continue
        v, t, a, b = nodes[at]
        x, y = _sides(points[idx], v, t, radius)
        todo += [(a, idx[x]), (b, idx[y])]
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(who), np.concatenate(where)


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while len(a):
        parent = _find(parent)
        x, y = parent[a], parent[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
    return parent


def shard_forest(points: np.ndarray, radius: int) -> np.ndarray:
    """For each point of a shard, the index of its component's first point:
    a vantage-point tree with overlapping sides down to small blocks, whose
    pairs are compared exactly."""
    rng = np.random.default_rng(11)
    parent = np.arange(len(points))
    todo = [np.arange(len(points))]
    while todo:
        idx = todo.pop()
        best = _choose(points[idx], rng, radius, 3) if len(idx) > BLOCK else None
        if best is not None and best[0] <= 0.85:
            a, b = _sides(points[idx], best[1], best[2], radius)
            todo += [idx[a], idx[b]]
            continue
        own = points[idx]
        for i in range(0, len(idx), BLOCK):
            for j in range(i, len(idx), 8 * BLOCK):
                x, y = np.nonzero(np.bitwise_count(own[i:i + BLOCK, None] ^ own[None, j:j + 8 * BLOCK]) <= radius)
                keep = x + i < y + j
                parent = _union(parent, idx[x[keep] + i], idx[y[keep] + j])
    return _find(parent)


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges ``(a, b)`` between fingerprints of one component, enough to span
    it.  ``distinct``: one row per fingerprint, column ``fp``, stored."""
    n = distinct.count()
    nodes = []
    if n > shard:
        every = max(SAMPLE_EVERY, n // sample)
        picked = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").toArrow()["fp"].to_numpy()
        nodes = build_tree(np.sort(picked.view(np.uint64)), n, shard, radius)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 65_536):
                points = b.column(0).slice(at, 65_536).to_numpy().view(np.uint64)
                who, where = shards_of(points, nodes, radius)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(points[who].view(np.int64))],
                                                 ["shard", "fp"])

    def search(key, t):
        points = np.unique(t["fp"].to_numpy().view(np.uint64))
        root = shard_forest(points, radius)
        far = np.flatnonzero(root != np.arange(len(points)))
        return pa.table({"a": points[root[far]].view(np.int64), "b": points[far].view(np.int64)})

    placed, path = stage_at(distinct.select("fp").mapInArrow(assign, "shard int, fp bigint"), "vp-shards")
    # one row for each dense shard; shards are bounded by the sample, not by the input
    dense = (placed.groupBy(F.col("shard").alias("s")).count().where(F.col("count") > 2 * shard)
             .select("s", F.ceil(F.col("count") / shard).cast("int").alias("k")))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = (placed.join(F.broadcast(dense), F.col("shard") == F.col("s"), "left")
             .select("shard", "fp", F.coalesce("k", F.lit(1)).alias("chunks"))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
                 F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("own")))))
             .select("shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    return tiles.groupBy("shard", "i", "j").applyInArrow(search, "a bigint, b bigint")


# -- components -----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: alternating large
    and small stars, each a partial-aggregate minimum and an equi-join (a hub
    is one row per task in the minimum, and a skewed join splits)."""
    spark = edges.sparkSession
    cur, path = stage_at(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .distinct(), "cc")
    while True:
        # large star: a node's larger neighbours go to the least of its neighbourhood
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mid, mid_path = stage_at(large, "cc")
        # small star: a node and its smaller neighbours go to the least of them
        low = mid.groupBy("u").agg(F.min("v").alias("m"))
        small = (mid.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        nxt, nxt_path = stage_at(small, "cc")
        # all stars: no centre is also a leaf, and each leaf has one centre
        roots = nxt.select(F.col("v").alias("u")).distinct()
        done = nxt.join(roots, "u", "left_semi").isEmpty() and \
            nxt.groupBy("u").count().where("count > 1").isEmpty()
        drop(spark, path)
        drop(spark, mid_path)
        cur, path = nxt, nxt_path
        if done:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """``(id_col, fp bigint, component_id)``: one row per input row;
    ``component_id`` is the smallest id that links reach, itself included."""
    fp = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = stage(fp.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-distinct")
    comp = components(links(nodes, radius, shard))
    linked = comp.union(comp.select(F.col("root").alias("node"), "root").distinct())
    linked = linked.withColumnRenamed("node", "fp")
    # one row per linked fingerprint with the least id of its component
    least = linked.join(nodes, "fp").groupBy("root").agg(F.min("rep").alias("low"))
    low = linked.join(least, "root").select("fp", "low")
    # stored: the last join then has nothing else in its stage, and its skewed side can be split
    ids = stage(nodes.join(low, "fp", "left").select("fp", F.coalesce("low", "rep").alias("component_id")), "simhash-ids")
    return fp.join(ids, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (a
    null id first; of rows that repeat an id, the least hash of the text, then
    of the other columns)."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"))
    comp = near_duplicates(docs.select(key.alias("key"), F.col(text_col)), "key", text_col, shingle, radius, shard)
    first = comp.where(F.col("key").eqNullSafe(F.col("component_id"))).select("key.*").distinct()
    own_id, own_hash, nth = free(docs, "__id", "__h", "__n")  # a caller's columns may have any name
    first = first.withColumnsRenamed({"id": own_id, "h": own_hash})
    own = docs.join(first, docs[id_col].eqNullSafe(first[own_id]) & (F.xxhash64(docs[text_col]) == first[own_hash]))
    rest = [c for c in docs.columns if c != text_col]
    order = Window.partitionBy(own_id, own_hash).orderBy(F.xxhash64(F.to_json(F.struct(*[docs[c] for c in rest]))))
    return own.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*[docs[c] for c in docs.columns])


by_value(__name__)
