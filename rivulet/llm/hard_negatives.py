"""Hard negatives by a vertical (BOND) scan.

Rows are stored as blocks: at most ``BLOCK`` quantised vectors
(``floor(scale * c)``) of one length, column by column, with the least and
greatest entry of every column.  An anchor reads a block's columns in the order
of its own falling magnitudes.  After some columns every candidate has a partial
score, and the columns not read yet add at least / at most the sum of their
minimum / maximum contributions; candidates whose interval cannot reach a result
leave the bitmap, until the columns are used up and the scores of what is left
are exact.

1. *Positives*: the best rows of the anchor's label.  A candidate stays while
   its upper bound reaches the k-th best lower bound (of this block, or of what
   the task has already found for the anchor).
2. *Negatives*: rows of other labels in the window that each positive's score
   gives.  A candidate stays while its interval meets a window and, where a
   window already holds enough certain rows, while it reaches the k-th of them.

Anchors are a query set against all rows: anchors are packed in groups of
``GROUP``, and groups and blocks meet in a grid (groups in bands, blocks in
cells; each side is copied to the cells of the other), an equi-join whose tasks
hold a bounded part of both sides, whatever the number of anchors, rows or
labels.  Each block returns at most k rows an anchor and window; they meet by
anchor in a ``row_number() <= k``.

Defined cases: rows with a null id, null label, null vector or an entry that is
null or not finite take no part; vectors of different lengths count as filled
up with zeros; rows equal in everything are rows of their own (an anchor leaves
out one row equal to itself, and repeated anchors give repeated results); ties
go to the smaller id; an empty table, or one without anchors, gives no rows;
other columns are ignored.  Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.util import by_value, stage
from rivulet.llm.vectors import finite, floors, vector_column

#: Rows of a block, anchors of a group; groups of a band and blocks of a cell.
BLOCK = 4096
GROUP = 256
BAND_GROUPS = 128
CELL_BLOCKS = 16
#: Columns read between two prunings (the last step repeats).
STEPS = (6, 6, 8, 12, 16, 16)

_GROUP = ("part int, seq int, dims int, x binary, labels array<{}>, ids array<bigint>, counts array<bigint>, "
          "selves array<bigint>")
_BLOCK = "part int, seq int, dims int, width int, ids binary, x binary, low binary, high binary, labels array<{}>"


def _ints(b: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b, kind)


def _chunks(batches: Iterable[pa.RecordBatch], limit: int, scale: float) -> Iterator[tuple]:
    """``(ids, labels, quantised vectors)`` of one length, at most ``limit``
    rows each; columns of a batch: id, label, vector and maybe a count."""
    held: dict[int, list] = {}
    size: dict[int, int] = {}

    def take(d: int) -> tuple:
        parts = held.pop(d)
        size.pop(d)
        return (np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts]),
                np.concatenate([p[2] for p in parts]))

    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for rows, m in finite(b.column(2)):
            x, d = floors(m, scale), m.shape[1]
            for at in range(0, len(rows), limit):
                part = rows[at:at + limit]
                if size.get(d, 0) + len(part) > limit:
                    yield take(d)
                held.setdefault(d, []).append((ids[part].astype(np.int64), b.column(1).take(pa.array(part)), x[at:at + limit]))
                size[d] = size.get(d, 0) + len(part)
    for d in sorted(held):
        yield take(d)


def _blocks(scale: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for seq, (ids, labels, x) in enumerate(_chunks(batches, BLOCK, scale)):
            low, high = x.min(axis=0), x.max(axis=0)
            top = max(int(high.max(initial=0)), -int(low.min(initial=0)))
            width = 2 if top < 2 ** 15 else 4 if top < 2 ** 31 else 8
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([x.shape[1]], pa.int32()),
                 pa.array([width], pa.int32()), pa.array([ids.tobytes()]), pa.array([x.T.astype(f"<i{width}").tobytes()]),
                 pa.array([low.tobytes()]), pa.array([high.tobytes()]),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), labels)],
                ["part", "seq", "dims", "width", "ids", "x", "low", "high", "labels"])
    return run


def _groups(scale: float):
    """Anchors of one length; equal rows next to each other become one anchor
    with a count."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for seq, (ids, labels, x) in enumerate(_chunks(batches, GROUP, scale)):
            seen: dict[tuple, int] = {}
            for i, key in enumerate(zip(ids.tolist(), labels.to_pylist(), map(bytes, x))):
                seen.setdefault(key, i)
            first = np.array([seen[k] for k in zip(ids.tolist(), labels.to_pylist(), map(bytes, x))])
            keep, counts = np.unique(first, return_counts=True)
            x = x[keep]
            selves = [_fits(sum(v * v for v in row)) for row in x.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([x.shape[1]], pa.int32()),
                 pa.array([x.tobytes()]),
                 pa.ListArray.from_arrays(pa.array([0, len(keep)], pa.int32()), labels.take(pa.array(keep))),
                 pa.array([ids[keep]]), pa.array([counts]), pa.array([selves], pa.list_(pa.int64()))],
                ["part", "seq", "dims", "x", "labels", "ids", "counts", "selves"])
    return run


def _fits(score: int) -> int:
    if abs(score) >= 2 ** 63:
        raise OverflowError("a score does not fit 64 bits")
    return score


class Block:
    """A block's columns as the scan reads them."""

    def __init__(self, dims: int, width: int, ids: bytes, x: bytes, low: bytes, high: bytes, labels: list):
        self.ids = _ints(ids)
        self.labels = np.array(labels, object)
        self.of: dict = {}  # label: its rows, as a bitmap
        self.whole = np.frombuffer(x, f"<i{width}").reshape(dims, len(self.ids))
        self.real: np.ndarray | None = None
        self.low, self.high = _ints(low), _ints(high)
        self.top = np.maximum(np.abs(self.low.astype(float)), np.abs(self.high.astype(float)))

    def rows_of(self, label) -> np.ndarray:
        got = self.of.get(label)
        if got is None:
            got = self.of[label] = self.labels == label
        return got

    def columns(self, q: np.ndarray) -> np.ndarray:
        """Doubles where every partial score is exact in them."""
        most = float(np.abs(q.astype(float)) @ self.top[:len(q)])
        if most < 2.0 ** 53:
            if self.real is None:
                self.real = self.whole.astype(np.float64)
            return self.real
        if most >= 2.0 ** 62:
            raise OverflowError("scores do not fit 64 bits")
        return self.whole.astype(np.int64)


def scan(block: Block, q: np.ndarray, bitmap: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Rows (positions) that ``keep(lower, upper)`` leaves, and their exact
    scores."""
    q = q[:len(block.low)]  # a longer vector's other entries meet zeros
    x = block.columns(q)
    q = q.astype(x.dtype)
    order = np.argsort(-np.abs(q), kind="stable")
    a, b = q * block.low[:len(q)].astype(x.dtype), q * block.high[:len(q)].astype(x.dtype)
    least, most = np.minimum(a, b)[order], np.maximum(a, b)[order]
    least = np.append(np.cumsum(least[::-1])[::-1], 0)
    most = np.append(np.cumsum(most[::-1])[::-1], 0)
    rows = np.flatnonzero(bitmap)
    score = np.zeros(len(rows), x.dtype)
    at, turn = 0, 0
    while at < len(order) and len(rows):
        to = at + STEPS[min(turn, len(STEPS) - 1)]
        dims = order[at:to]
        part = x[dims] if len(rows) == x.shape[1] else x[dims[:, None], rows]
        score = score + q[dims] @ part
        at, turn = min(to, len(order)), turn + 1
        stay = keep(score + least[at], score + most[at])
        rows, score = rows[stay], score[stay]
    return rows, score.astype(np.int64)


def best(k: int, floor: int | None) -> Callable:
    """Keep what may be among the k best, or reach ``floor``."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        bar = floor
        if len(lower) > k:
            kth = np.partition(lower, len(lower) - k)[len(lower) - k]
            bar = kth if bar is None else max(bar, kth)
        return np.ones(len(lower), bool) if bar is None else upper >= bar
    return keep


def in_windows(windows: list[tuple[int, int, int | None]], k: int) -> Callable:
    """Keep what may be among the k best of a window ``(low, high, floor)``."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for lo, hi, floor in windows:
            may = (upper >= lo) & (lower <= hi)
            if floor is not None:
                may &= upper >= floor
            sure = lower[(lower >= lo) & (upper <= hi)]
            if len(sure) > k:
                may &= upper >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stay |= may
        return stay
    return keep


def _first(k: int, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    """Rows of the grid join; a block's columns are unpacked once while it
    stays the same."""
    last, block = None, None
    for b in batches:
        for i in range(b.num_rows):  # one pair at a time is unpacked
            r = {name: b.column(k)[i] for k, name in enumerate(b.schema.names)}
            at = (r["part"].as_py(), r["seq"].as_py())
            if at != last:
                block = Block(*(r[c].as_py() for c in ("dims", "width", "ids", "x", "low", "high", "labels")))
                last = at
            yield {c: r[c].as_py() for c in r if c.startswith("g_")}, block


def _rows(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32()] + [pa.int64()] * (len(names) - 3)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def _kept(held: list[int], new: list[int], k: int) -> list[int]:
    return sorted(held + new, reverse=True)[:k]


def _positives(k: int):
    """At most k rows ``(group, anchor, score, id)`` a block."""
    names = ["g_part", "g_seq", "anchor", "score", "id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, dict] = {}  # what the task has found for a band's groups
        for g, block in _pairs(batches):
            group = (g["g_part"], g["g_seq"])
            if group not in known and len(known) == BAND_GROUPS:
                known.clear()
            found = known.setdefault(group, {})
            x = _ints(g["g_x"]).reshape(len(g["g_labels"]), g["g_dims"])
            out = []
            for i, label in enumerate(g["g_labels"]):
                held = found.get(i, [])
                rows, score = scan(block, x[i], block.rows_of(label), best(k, held[-1] if len(held) == k else None))
                top = _first(k, score, block.ids[rows])
                found[i] = _kept(held, score[top].tolist(), k)
                out += [(*group, i, s, d) for s, d in zip(score[top].tolist(), block.ids[rows[top]].tolist())]
            if out:
                yield _rows(out, names)
    return run


def _negatives(k: int, window: tuple[int, int]):
    """At most k rows ``(group, anchor, positive score, score, id)`` a block
    and window."""
    names = ["g_part", "g_seq", "anchor", "p", "score", "id"]
    low, high = window

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, dict] = {}  # what the task has found for a band's groups
        for g, block in _pairs(batches):
            group = (g["g_part"], g["g_seq"])
            if group not in known and len(known) == BAND_GROUPS:
                known.clear()
            found = known.setdefault(group, {})
            x = _ints(g["g_x"]).reshape(len(g["g_labels"]), g["g_dims"])
            out = []
            for w in g["g_windows"]:
                i = w["anchor"]
                # low p <= 100 s <= high p, in integers
                reach = {p: (-(-low * p // 100), high * p // 100) for p in w["scores"]}
                floors_ = {p: f[-1] if len(f := found.get((i, p), [])) == k else None for p in reach}
                open_ = [(lo, hi, floors_[p]) for p, (lo, hi) in reach.items() if lo <= hi]
                if not open_:
                    continue
                rows, score = scan(block, x[i], ~block.rows_of(g["g_labels"][i]), in_windows(open_, k))
                for p, (lo, hi) in reach.items():
                    at = np.flatnonzero((score >= lo) & (score <= hi))
                    at = at[_first(k, score[at], block.ids[rows[at]])]
                    found[i, p] = _kept(found.get((i, p), []), score[at].tolist(), k)
                    out += [(*group, i, p, s, d) for s, d in zip(score[at].tolist(), block.ids[rows[at]].tolist())]
            if out:
                yield _rows(out, names)
    return run


def _grid(blocks: DataFrame, groups: DataFrame, n_blocks: int, n_groups: int) -> DataFrame:
    """Every block with every group: blocks are copied to the bands of groups,
    groups to the cells of blocks, and they meet on (band, cell)."""
    bands, cells = max(1, -(-n_groups // BAND_GROUPS)), max(1, -(-n_blocks // CELL_BLOCKS))
    of = lambda a, b, n: F.pmod(F.xxhash64(a, b), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("cell", of("part", "seq", cells)).withColumn("band", every(bands))
    right = groups.select(*[F.col(c).alias(c if c.startswith("g_") else f"g_{c}") for c in groups.columns])
    right = right.withColumn("band", of("g_part", "g_seq", bands)).withColumn("cell", every(cells))
    return left.join(right, ["band", "cell"]).drop("band", "cell")


def mine(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 5,
         window: tuple[int, int] = (80, 100), scale: float = 256.0, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank)``.

    ``anchors``: condition that an anchor meets.  A positive is one of the
    first ``n_positives`` other rows of the anchor's label, a negative one of
    the first ``n_negatives`` rows of another label with ``window[0] *
    positive_score <= 100 * negative_score <= window[1] * positive_score``;
    first by falling integer inner product, then by id.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("label"),
                         vector_column(vectors, vector_col).alias("v"), anchors.alias("anchor"))
    src = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    kind = src.schema["label"].dataType.simpleString()
    blocks = stage(src.select("id", "label", "v").mapInArrow(_blocks(scale), _BLOCK.format(kind)), "negatives-blocks")
    groups = stage(src.where("anchor").select("id", "label", "v").mapInArrow(_groups(scale), _GROUP.format(kind)),
                   "negatives-groups")
    n_blocks, n_groups = blocks.count(), groups.count()

    key = ["g_part", "g_seq", "anchor"]
    first = lambda df, by, k: (df.withColumn("nth", F.row_number().over(
        Window.partitionBy(*by).orderBy(F.desc("score"), "id"))).where(F.col("nth") <= k))
    query = groups.select("part", "seq", "dims", "x", "labels")
    found = _grid(blocks, query, n_blocks, n_groups).mapInArrow(
        _positives(n_positives + 1), "g_part int, g_seq int, anchor int, score bigint, id bigint")
    found = first(found, key, n_positives + 1)
    # one of the rows is the anchor itself, if it is among the first
    who = groups.select(F.col("part").alias("g_part"), F.col("seq").alias("g_seq"),
                        F.posexplode(F.arrays_zip("ids", "selves", "counts")).alias("anchor", "a"))
    near = (found.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("nth", "score", "id"))).alias("near"))
            .join(who, key))
    self_at = F.array_position(F.transform("near", lambda r: F.struct(r["score"].alias("s"), r["id"].alias("i"))),
                               F.struct(F.col("a.selves").alias("s"), F.col("a.ids").alias("i")))
    others = F.slice(F.filter("near", lambda r, i: i + 1 != F.col("own")), 1, n_positives)
    positives = stage(
        near.withColumn("own", self_at).select(*key, F.col("a.ids").alias("anchor_id"), F.col("a.counts").alias("times"),
                                               F.transform(others, lambda r: F.struct(r["score"].alias("score"),
                                                                                      r["id"].alias("id"))).alias("pos"))
        .where(F.size("pos") > 0), "negatives-positives")

    windows = positives.groupBy("g_part", "g_seq").agg(F.collect_list(  # at most GROUP anchors
        F.struct("anchor", F.array_distinct("pos.score").alias("scores"))).alias("windows"))
    query = query.join(windows, (F.col("part") == F.col("g_part")) & (F.col("seq") == F.col("g_seq"))).drop("g_part", "g_seq")
    hits = _grid(blocks, query, n_blocks, n_groups).mapInArrow(
        _negatives(n_negatives, window), "g_part int, g_seq int, anchor int, p bigint, score bigint, id bigint")
    hits = first(hits, [*key, "p"], n_negatives).select(*key, "p", F.col("nth").alias("rank"), F.col("id").alias("negative_id"),
                                                       F.col("score").alias("negative_score"))
    hits = stage(hits, "negatives-hits")
    spread = positives.select(*key, "anchor_id", "times", F.posexplode("pos").alias("nth", "pos"))
    out = (spread.withColumn("p", F.col("pos.score")).join(hits, [*key, "p"])
           .withColumn("t", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))))
    return out.select("anchor_id", F.col("pos.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      "negative_id", F.col("p").alias("positive_score"), "negative_score",
                      (F.col("nth") + 1).alias("positive_rank"))


by_value(__name__)
