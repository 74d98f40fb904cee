"""Embedding whitening by a weighted multiplicity covariance.

Vectors are quantised (``x = floor(scale * c) + shift``) and grouped: each
distinct x vector is one row with its count.  The fit works on that list,
weighted by the counts or by one; every distinct vector is whitened once and
joined back to the rows that hold it.

* Keys: an x vector is packed into bytes (16, 32 or 64 bits an entry, whatever
  it needs), so grouping and joining compare short binaries.  Rows of one
  Arrow batch that share a vector travel as one row with up to ``PACK`` ids.
* Covariance: entries are centred on the integer next to the mean before they
  are multiplied (``X' W X``); the sums are exact integers, in double-precision
  GEMM while they stay below 2^53 and in longer integers beyond.  Tasks send
  ``dims`` rows of sums, which Spark adds; the driver gets one covariance
  matrix (dims x dims, whatever the number of rows), takes off what the rounded
  centre left, exactly, and rounds each entry to a double once.  The matrix so
  does not depend on partitions or order.
* Hot vectors: a vector that fills a batch's ``PACK`` is salted there, and only
  vectors with at least that count are copied to all salts.

Defined cases: a null vector, or one with a null or non-finite entry, drops
its row; a null id stays an id; repeated rows are whitened each; vectors of
different lengths are filled up with zeros; other columns are ignored (join
them back on the id).  Components without variance (constant dimensions, fewer
vectors than dimensions) are not returned, so an empty table, or one with a
single distinct vector, gives no rows.  An entry whose quantised value does not
fit 62 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.util import by_value, drop, stage, stage_at
from rivulet.llm.vectors import finite, floors, vector_column

#: Ids of one vector that travel as one row, and the count from which a
#: vector's rows are spread over salts.
PACK = 256
SALTS = 64
#: Sums below this are exact in doubles.
EXACT = 2 ** 53


def _keys(x: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Packed bytes of each row (order of rows, keys): a width, then the
    entries without trailing zeros."""
    n, d = x.shape
    used = d - np.argmax(x[:, ::-1] != 0, axis=1) if d else np.zeros(n, np.int64)
    if d:
        used[~x.any(axis=1)] = 0
    top = np.maximum(x.max(axis=1, initial=0), ~x.min(axis=1, initial=0))
    width = np.where(top < 2 ** 15, 2, np.where(top < 2 ** 31, 4, 8))
    rows, keys = [], []
    for w, u in sorted(set(zip(width.tolist(), used.tolist()))):
        at = np.flatnonzero((width == w) & (used == u))
        packed = np.empty((len(at), 1 + w * u), np.uint8)
        packed[:, 0] = w
        packed[:, 1:] = np.ascontiguousarray(x[at, :u].astype(f"<i{w}")).view(np.uint8).reshape(len(at), w * u)
        kind = pa.binary(1 + w * u)
        keys.append(pa.FixedSizeBinaryArray.from_buffers(kind, len(at), [None, pa.py_buffer(packed.tobytes())])
                    .cast(pa.binary()))
        rows.append(at)
    return np.concatenate(rows), pa.concat_arrays(keys)


def _matrix(keys: pa.Array, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, entries)`` of packed keys: filled up to ``dims``
    columns, or as long as they are."""
    if not len(keys):
        return
    _, offsets, data = keys.buffers()
    off = np.frombuffer(offsets, np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    raw, size = np.frombuffer(data, np.uint8), np.diff(off)
    width = raw[off[:-1]]
    for w, s in sorted(set(zip(width.tolist(), size.tolist()))):
        at = np.flatnonzero((width == w) & (size == s))
        x = raw[off[at][:, None] + np.arange(1, s)].reshape(len(at), s - 1)
        x = np.ascontiguousarray(x).view(f"<i{w}").astype(np.int64) if s > 1 else np.zeros((len(at), 0), np.int64)
        if dims is not None:
            x = np.pad(x, ((0, 0), (0, dims - x.shape[1])))
        yield at, x


def _added(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Exact column sums of ``w * x``."""
    if not x.size:
        return [0] * x.shape[1]
    if int(np.abs(x).max()) * int(w.sum()) < 2 ** 62:
        return (x * w[:, None]).sum(axis=0).tolist()
    return (x.astype(object) * w.astype(object)[:, None]).sum(axis=0).tolist()


def gram(x: np.ndarray, w: np.ndarray, top: int) -> np.ndarray:
    """``x' diag(w) x`` in exact integers; ``top`` bounds the entries of x."""
    total = int(w.sum()) * top * top
    if total < EXACT:
        f = x.astype(np.float64)
        return (f.T @ (f * w[:, None])).astype(np.int64)
    if len(x) > 1:
        half = len(x) // 2
        a, b = gram(x[:half], w[:half], top), gram(x[half:], w[half:], top)
        if total >= 2 ** 62:
            a, b = a.astype(object), b.astype(object)
        return a + b
    o = x[0].astype(object)
    return np.outer(o, o) * int(w[0])


def _pack(scale: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for b in batches:
            for rows, m in finite(b.column(1)):
                order, keys = _keys(floors(m, scale))
                ids = b.column(0).take(pa.array(rows[order]))
                code = keys.dictionary_encode()
                which = code.indices.to_numpy()
                by = np.argsort(which, kind="stable")
                bound = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(code.dictionary)))])
                start, owner, salt = [], [], []
                for k, (lo, hi) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist())):
                    for at in range(lo, hi, PACK):
                        start.append(at)
                        owner.append(k)
                        salt.append(turn % SALTS if hi - lo >= PACK else 0)
                        turn += hi - lo >= PACK
                lists = pa.ListArray.from_arrays(pa.array([*start, len(by)], pa.int32()), ids.take(pa.array(by)))
                yield pa.RecordBatch.from_arrays(
                    [code.dictionary.take(pa.array(owner, pa.int32())), pa.array(salt, pa.int32()), lists],
                    ["x", "salt", "ids"])
    return run


def _sums(weighted: bool):
    """Per task: one row a dimension (sum, least, greatest, vectors that reach
    it) and one row -1 with the weight and the number of vectors."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        low: list[int] = []
        high: list[int] = []
        reach: list[int] = []
        n = rows = 0
        for b in batches:
            count = b.column(1).to_numpy()
            for at, x in _matrix(b.column(0)):
                w = count[at] if weighted else np.ones(len(at), np.int64)
                n += int(w.sum())
                rows += len(at)
                d = x.shape[1]
                for part in (total, low, high, reach):
                    part += [0] * (d - len(part))
                for j, (s, lo, hi) in enumerate(zip(_added(x, w), x.min(axis=0).tolist(), x.max(axis=0).tolist())):
                    low[j] = min(low[j], lo) if reach[j] else lo
                    high[j] = max(high[j], hi) if reach[j] else hi
                    total[j] += s
                    reach[j] += len(at)
        yield pa.RecordBatch.from_arrays([
            pa.array([-1, *range(len(total))], pa.int32()),
            pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0)),
            pa.array([0, *low], pa.int64()), pa.array([0, *high], pa.int64()),
            pa.array([rows, *reach], pa.int64())], ["j", "s", "lo", "hi", "reach"])
    return run


def _grams(weighted: bool, centre: list[int], top: int):
    d, mid = len(centre), np.array(centre, np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.zeros((d, d), object)
        held, bound = np.zeros((d, d), np.int64), 0
        for b in batches:
            count = b.column(1).to_numpy()
            for at, x in _matrix(b.column(0), d):
                w = count[at] if weighted else np.ones(len(at), np.int64)
                g, most = gram(x - mid, w, top), int(w.sum()) * top * top
                if g.dtype == object:
                    exact = exact + g
                    continue
                if bound + most >= 2 ** 62:
                    exact, held, bound = exact + held.astype(object), np.zeros((d, d), np.int64), 0
                held, bound = held + g, bound + most
        exact = exact + held.astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()),
             pa.array([[Decimal(int(v)) for v in exact[i, i:]] for i in range(d)], pa.list_(pa.decimal128(38, 0)))],
            ["i", "m"])
    return run


@dataclass
class Whitening:
    """A fitted whitening: exact sums of the fit list and its components."""
    n: int                  #: weight of the fit list
    sums: list[int]         #: per-dimension sums of ``floor(scale * c)``
    centre: list[int]       #: integers next to the means
    spread: list[int]       #: largest distance from the centre, per dimension
    variance: np.ndarray    #: eigenvalues, falling
    vectors: np.ndarray     #: unit eigenvectors, one a column
    trace: float


def fit(distinct: DataFrame, components: int = 16, weights: str = "one") -> Whitening | None:
    """Fit on ``distinct`` (``x`` packed, ``count``); None without variance."""
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    weighted = weights == "count"
    got = {r.j: r for r in distinct.select("x", "count").mapInArrow(
        _sums(weighted), "j int, s decimal(38,0), lo bigint, hi bigint, reach bigint")
        .groupBy("j").agg(F.sum("s").alias("s"), F.min(F.when(F.col("reach") > 0, F.col("lo"))).alias("lo"),
                          F.max(F.when(F.col("reach") > 0, F.col("hi"))).alias("hi"), F.sum("reach").alias("reach"))
        .collect()}  # one row a dimension
    d = len(got) - 1
    if d < 1 or not got[-1].reach:
        return None
    n, rows = int(got[-1].s), got[-1].reach
    sums = [int(got[j].s) for j in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    short = [() if got[j].reach == rows else (0,) for j in range(d)]  # entries that keys leave out
    spread = [max(abs(v - c) for v in (got[j].lo, got[j].hi, *short[j])) for j, c in enumerate(centre)]
    if not any(spread):
        return None
    left = [s - n * c for s, c in zip(sums, centre)]
    cov = np.zeros((d, d))
    table = (distinct.select("x", "count").mapInArrow(_grams(weighted, centre, max(spread)),
                                                      "i int, m array<decimal(38,0)>")
             .select("i", F.posexplode("m").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")))
    for i, j, v in table.collect():  # dims x dims, whatever the rows
        cov[i, i + j] = cov[i + j, i] = (n * int(v) - left[i] * left[i + j]) / (n * n)
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, int((value > value[0] * d * np.finfo(float).eps).sum()))
    vector = vector[:, :k]
    vector = vector * np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(k)])
    return Whitening(n, sums, centre, spread, value[:k], vector, float(np.trace(cov)))


def _whitened(model: Whitening, wide: bool):
    d, mid = len(model.centre), np.array(model.centre, np.int64)
    left = [s - model.n * c for s, c in zip(model.sums, model.centre)]
    rest = np.array([v / model.n for v in left])
    turn = model.vectors / np.sqrt(model.variance)
    n = model.n
    off = np.array(left, object if wide else np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _matrix(b.column(0), d):
                x = x - mid
                u = (x.astype(object) if wide else x) * n - off
                far = (u * u).sum(axis=1)
                far = pa.array([Decimal(int(v)) for v in far], pa.decimal128(38, 0)) if wide else pa.array(far, pa.int64())
                z = (x - rest) @ turn
                k = z.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), far,
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(at) * k + 1, k), pa.int32()), pa.array(z.ravel()))],
                    ["x", "count", "deviation", "z"])
    return run


def _moments(weighted: bool, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            z = b.column(1).values.to_numpy(zero_copy_only=False).reshape(-1, k)
            w = b.column(0).to_numpy()[:, None] if weighted else 1
            first, second = first + (z * w).sum(axis=0), second + z.T @ (z * w)
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array([*second.tolist(), first.tolist()])],
                                         ["i", "m"])
    return run


def _identity_error(white: DataFrame, n: int, k: int, weighted: bool) -> float:
    """Largest absolute entry of the whitened list's covariance less the
    identity, measured."""
    got = np.zeros((k + 1, k))
    for i, j, v in (white.select("count", "z").mapInArrow(_moments(weighted, k), "i int, m array<double>")
                    .select("i", F.posexplode("m").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
                    .collect()):
        got[i, j] = v
    mean = got[k] / n
    return float(np.abs(got[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 16, weights: str = "one", id_col: str = "vec_id",
           vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """One row per row and component: ``id_col``, ``component`` (from 1), ``n``
    (weight of the fit list), ``deviation`` (sum over dimensions of
    ``(n x - S)^2``; a decimal where 64 bits might not hold it), ``whitened``,
    ``explained`` (share of the trace) and ``identity_error``.

    ``weights``: ``one`` or ``count``.  A shift of all entries by the same
    integer changes none of the results, so keys hold ``floor(scale * c)``.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col(f"`{id_col}`").alias("id"), vector_column(vectors, vector_col).alias("v"))
    id_type = src.schema["id"].dataType.simpleString()
    packed = stage(src.mapInArrow(_pack(scale), f"x binary, salt int, ids array<{id_type}>"), "whiten-rows")
    distinct, path = stage_at(packed.groupBy("x").agg(F.sum(F.size("ids")).alias("count")), "whiten-distinct")
    model = fit(distinct, components, weights)
    if model is None:
        drop(spark, path)
        return spark.createDataFrame([], f"`{id_col}` {id_type}, component int, n bigint, deviation bigint, "
                                         "whitened double, explained double, identity_error double")
    left = [s - model.n * c for s, c in zip(model.sums, model.centre)]
    bound = sum((model.n * s + abs(v)) ** 2 for s, v in zip(model.spread, left))
    if bound >= 10 ** 38:
        raise OverflowError("deviations do not fit 38 digits")
    wide = bound >= 2 ** 63
    white = stage(distinct.mapInArrow(_whitened(model, wide), "x binary, count bigint, deviation "
                                      f"{'decimal(38,0)' if wide else 'bigint'}, z array<double>"), "whiten-white")
    drop(spark, path)
    error = _identity_error(white, model.n, len(model.variance), weights == "count")
    salts = F.when(F.col("count") >= PACK, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = white.select("x", F.explode(salts).alias("salt"), "deviation", "z")
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.variance])
    rows = packed.join(copies, ["x", "salt"]).select(F.explode("ids").alias("id"), "deviation", "z")
    return rows.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))


by_value(__name__)
