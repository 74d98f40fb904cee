"""Arrival-order windows that never put a whole key (or the whole stream) in one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to a
single task; with no ``partitionBy`` the whole input goes to one task.  When
one key holds a third of all rows that is the bottleneck.  The operators
here split each key's history into *buckets* of the order column (a time
range, an offset range, or a dense sequence range) and combine a window
inside each ``(key, bucket)`` with a tiny per-bucket table:

* :func:`running_sum` / :func:`sequence_number` - two-pass prefix sums;
* :func:`previous_in_order` - ``lag`` of the order column across buckets;
* :func:`sliding_frame` - ``ROWS BETWEEN n PRECEDING AND CURRENT ROW``
  aggregates, with the previous bucket's last rows copied in as a halo.

The bucket expression must be non-decreasing in the order; any width is
correct, the width only sets the task size.  The per-bucket table has one
row per ``(key, bucket)`` and is joined back on exactly the hash
partitioning the big side already has, so only that small table moves;
adaptive execution turns the join into a broadcast when its measured size
allows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.util import as_col

_K = "__okey"   # struct of the partition columns (struct equality is null-safe)
_B = "__obkt"   # bucket id


# ---------------------------------------------------------------- buckets

_FIXED_ZONES = {"UTC", "GMT", "Z", "ETC/UTC", "ETC/GMT", "ETC/UCT", "UCT", "ETC/ZULU", "ZULU"}


def _fixed_offset_zone(tz: str | None) -> bool:
    """True for session time zones without daylight saving (UTC and explicit
    offsets), where casting timestamp_ntz to timestamp is monotone."""
    if not tz:
        return False
    t = tz.strip().upper()
    return t in _FIXED_ZONES or bool(re.fullmatch(r"(UTC|GMT)?[+-]\d{1,2}(:\d{2})?", t))


def _epoch_seconds(col, ntz: bool = True, fixed_zone: bool = False) -> Column:
    """Whole seconds since 1970-01-01 as a non-decreasing function of the
    column (bucket widths are whole seconds, so the fraction is not needed).

    ``timestamp`` is an instant: ``unix_seconds``.  ``timestamp_ntz`` is a
    wall clock: built from its own integer fields, because any conversion to
    an instant goes through the session time zone, which is not monotone
    across a daylight-saving gap."""
    c = as_col(col)
    if not ntz:
        return F.unix_seconds(c)
    if fixed_zone:  # no daylight saving: the cheaper cast is monotone
        return F.unix_seconds(c.cast("timestamp"))
    return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400)
            + F.hour(c) * F.lit(3_600) + F.minute(c) * F.lit(60) + F.second(c))


def time_bucket(col, seconds: int, ntz: bool = True, fixed_zone: bool = False) -> Column:
    """Bucket id of a timestamp_ntz (``ntz``) or timestamp column, ``seconds`` wide;
    ``fixed_zone``: the session time zone has no daylight saving."""
    return F.floor(_epoch_seconds(col, ntz, fixed_zone) / F.lit(int(seconds)))


def _is_ntz(df: DataFrame, col: str) -> bool:
    try:
        return df.schema[col].dataType.typeName() == "timestamp_ntz"
    except (KeyError, AttributeError):
        return True


def number_bucket(col, width: int) -> Column:
    """Bucket id of a numeric column (offsets, sequence numbers), ``width`` wide."""
    return F.floor(as_col(col) / F.lit(int(width)))


def auto_time_seconds(df: DataFrame, col: str, target_rows: int = 1_000_000,
                      min_seconds: int = 1) -> int:
    """Bucket width so that a bucket of uniformly spread rows holds about
    ``target_rows`` rows.  One aggregate job; three scalars reach the driver."""
    secs = _epoch_seconds(col, _is_ntz(df, col))
    r = df.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if r is None or r["n"] == 0 or r["lo"] is None:
        return max(min_seconds, 3600)
    span = r["hi"] - r["lo"] + 1
    buckets = max(1, r["n"] // max(1, target_rows))
    return max(min_seconds, -(-span // buckets))


def auto_number_width(df: DataFrame, col: str, target_rows: int = 1_000_000) -> int:
    """Numeric twin of :func:`auto_time_seconds` (offsets, ids)."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if r is None or r["n"] == 0 or r["lo"] is None:
        return 1 << 20
    buckets = max(1, r["n"] // max(1, target_rows))
    return max(1, -(-(int(r["hi"]) - int(r["lo"]) + 1) // buckets))


# Session settings: the bucket width of time orders (seconds) and of
# numeric orders (offsets, ids), or ``auto`` to derive it from the data with
# one narrow aggregate job so that a bucket holds about ``bucketRows`` rows.
# The defaults are fine enough that a key holding a third of 100 TB a year
# still gives window tasks of a few hundred MB, and coarse enough that the
# per-bucket table stays far smaller than the data.
CONF_SECONDS = "rivulet.order.bucketSeconds"
CONF_WIDTH = "rivulet.order.bucketWidth"
CONF_ROWS = "rivulet.order.bucketRows"
DEFAULT_SECONDS = 600
DEFAULT_WIDTH = 1 << 16
DEFAULT_BUCKET_ROWS = 2_000_000


@dataclass(frozen=True)
class Order:
    """How a stream is ordered and bucketed.

    ``by``: order columns (ties must be broken, e.g. ``ts, partition, offset``);
    ``bucket``: a non-decreasing function of that order, or ``None`` to size
    the buckets at run time: from the session setting
    ``rivulet.order.bucketSeconds`` / ``bucketWidth`` (defaults below), or from
    the data so that a bucket holds about ``rivulet.order.bucketRows`` rows
    when that setting is ``auto``.
    """
    by: tuple
    bucket: Column | None = None
    kind: str = "time"
    width: int | None = None

    @staticmethod
    def by_time(ts: str, *tie_breakers: str, seconds: int | None = None) -> "Order":
        return Order(tuple([ts, *tie_breakers]), None, "time", seconds)

    @staticmethod
    def by_number(col: str, *tie_breakers: str, width: int | None = None) -> "Order":
        return Order(tuple([col, *tie_breakers]), None, "number", width)

    def bucket_for(self, df: DataFrame) -> Column:
        if self.bucket is not None:
            return self.bucket
        return F.coalesce(self._bucket_of_first(df).cast("bigint"), self._bucket_of_rest(df))

    def _bucket_of_rest(self, df: DataFrame) -> Column:
        """Bucket of rows whose first order column is NULL: they sort first, so
        it lies below every real one; among themselves they are in the order
        of the next columns (a topic without timestamps: partition, offset)."""
        types = {f.name: f.dataType.typeName() for f in df.schema.fields}
        rest = []
        for c in self.by[1:]:
            if types.get(c) not in ("integer", "long", "short", "byte"):
                break
            rest.append(c)
        w = self.width if self.kind == "number" else None
        w = w or df.sparkSession.conf.get(CONF_WIDTH, None) or DEFAULT_WIDTH
        width = DEFAULT_WIDTH if w == "auto" else int(w)
        sub = F.lit(None).cast("bigint")
        if rest and types[rest[0]] != "long" and len(rest) > 1:  # a topic partition, then its offset
            high, low = F.col(rest[0]).cast("bigint"), number_bucket(rest[1], width)
            sub = high * F.lit(1 << 40) + F.coalesce(low, F.lit(-1))
        elif rest:
            sub = number_bucket(rest[0], width)
        return F.coalesce(F.lit(_NULL_BUCKET) + sub, F.lit(_NULL_BUCKET - (1 << 61)))

    def _bucket_of_first(self, df: DataFrame) -> Column:
        conf = df.sparkSession.conf
        first = self.by[0]
        rows = int(conf.get(CONF_ROWS, None) or DEFAULT_BUCKET_ROWS)
        if self.kind == "time":
            w = self.width or conf.get(CONF_SECONDS, None) or DEFAULT_SECONDS
            secs = auto_time_seconds(df, first, rows) if w == "auto" else int(w)
            fixed = _fixed_offset_zone(conf.get("spark.sql.session.timeZone", None))
            return time_bucket(first, secs, _is_ntz(df, first), fixed)
        w = self.width or conf.get(CONF_WIDTH, None) or DEFAULT_WIDTH
        return number_bucket(first, auto_number_width(df, first, rows) if w == "auto" else int(w))


# Middle of the buckets of rows whose first order column is NULL: they sort
# first (ASC NULLS FIRST), so they go below every real bucket instead of being
# lost in the join.
_NULL_BUCKET = -(1 << 62)


def _keyed(df: DataFrame, partition_by, order: Order) -> DataFrame:
    keys = [as_col(c) for c in partition_by]
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("k"))
    bucket = F.coalesce(order.bucket_for(df).cast("bigint"), F.lit(_NULL_BUCKET))
    return df.withColumn(_K, key).withColumn(_B, bucket)


# ------------------------------------------------------------ prefix sums

def running_sums(df: DataFrame, values: dict, order: Order, partition_by=(), seeds: dict | None = None) -> DataFrame:
    """Several prefix sums in one pass: for each ``out: value`` in ``values``,
    ``[seed +] sum(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED
    PRECEDING)``, with SQL null semantics (NULL until the first non-null
    value).  One bucketed window, one per-bucket table and one join serve
    all of them."""
    seeds = seeds or {}
    names = list(values)
    d = _keyed(df, partition_by, order).withColumns(
        {f"__v{i}": as_col(values[n]) for i, n in enumerate(names)})
    w_in = Window.partitionBy(_K, _B).orderBy(*order.by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = d.withColumns({f"__l{i}": F.sum(f"__v{i}").over(w_in) for i in range(len(names))})

    totals = d.groupBy(_K, _B).agg(*[F.sum(f"__v{i}").alias(f"__t{i}") for i in range(len(names))])
    w_prev = Window.partitionBy(_K).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col(_K).alias("__k2"), F.col(_B).alias("__b2"),
                          *[F.sum(f"__t{i}").over(w_prev).alias(f"__p{i}") for i in range(len(names))])

    j = local.join(bases, (F.col(_K) == F.col("__k2")) & (F.col(_B) == F.col("__b2")), "inner")
    outs = {}
    for i, n in enumerate(names):
        lc, pc = F.col(f"__l{i}"), F.col(f"__p{i}")
        total = F.when(lc.isNull() & pc.isNull(), F.lit(None)).otherwise(
            F.coalesce(pc, F.lit(0)) + F.coalesce(lc, F.lit(0)))
        if seeds.get(n) is not None:
            total = F.lit(seeds[n]) + F.coalesce(total, F.lit(0))
        outs[n] = total
    tmp = [c for i in range(len(names)) for c in (f"__v{i}", f"__l{i}", f"__p{i}")]
    return j.withColumns(outs).drop(_K, _B, "__k2", "__b2", *tmp)


def running_sum(df: DataFrame, value, order: Order, partition_by=(), out: str = "running",
                seed=None) -> DataFrame:
    """``[seed +] sum(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED
    PRECEDING)`` computed in two passes (see :func:`running_sums`)."""
    return running_sums(df, {out: value}, order, partition_by, {out: seed})


def sequence_number(df: DataFrame, order: Order, partition_by=(), out: str = "seq") -> DataFrame:
    """1-based ``row_number()`` in arrival order, without a one-task window."""
    return running_sum(df, F.lit(1).cast("bigint"), order, partition_by, out)


# ------------------------------------------------------------------- lag

def previous_in_order(df: DataFrame, col: str, partition_by=(), width: int | None = None,
                      out: str = "previous") -> DataFrame:
    """``lag(col) OVER (PARTITION BY keys ORDER BY col)`` for a numeric column.

    Inside a bucket a plain ``lag``; the first row of a bucket takes the
    largest value of the nearest earlier non-empty bucket.  Equal values
    (duplicates) see each other, as ``lag`` does.
    """
    d = _keyed(df, partition_by, Order.by_number(col, width=width))
    w_in = Window.partitionBy(_K, _B).orderBy(col)
    local = d.withColumn("__lag", F.lag(col).over(w_in))
    tops = d.groupBy(_K, _B).agg(F.max(col).alias("__top"))
    w_prev = Window.partitionBy(_K).orderBy(_B)
    prevs = tops.select(F.col(_K).alias("__k2"), F.col(_B).alias("__b2"),
                        F.lag("__top").over(w_prev).alias("__ptop"))
    j = local.join(prevs, (F.col(_K) == F.col("__k2")) & (F.col(_B) == F.col("__b2")), "inner")
    return j.withColumn(out, F.coalesce("__lag", "__ptop")).drop(
        _K, _B, "__lag", "__k2", "__b2", "__ptop")


# --------------------------------------------------------- sliding frame

def sliding_frame(df: DataFrame, seq: str, size: int, aggs: dict, partition_by=(),
                  bucket_rows: int = 1 << 16) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN size-1 PRECEDING AND CURRENT ROW``.

    ``seq`` must be a dense 1-based position per partition (see
    :func:`sequence_number`).  Positions are bucketed ``bucket_rows`` at a
    time, so every task gets the same number of rows however skewed the
    keys; the last ``size - 1`` rows of each bucket are copied into the next
    one as a halo and dropped after the window.  ``aggs`` maps output names
    to aggregate Columns (``F.min("y")`` ...) evaluated over the frame.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    width = max(bucket_rows, size)
    halo = size - 1
    base = df.withColumn(_K, F.struct(*[as_col(c) for c in partition_by]) if partition_by
                         else F.struct(F.lit(0).alias("k")))
    pos = F.col(seq) - 1
    own = base.withColumn(_B, F.floor(pos / width)).withColumn("__halo", F.lit(False))
    copies = (base.where(F.pmod(pos, F.lit(width)) >= width - halo)
              .withColumn(_B, F.floor(pos / width) + 1).withColumn("__halo", F.lit(True))
              if halo > 0 else None)
    both = own.unionByName(copies) if copies is not None else own
    w = Window.partitionBy(_K, _B).orderBy(seq).rowsBetween(-halo, Window.currentRow)
    cols = [agg.over(w).alias(name) for name, agg in aggs.items()]
    return both.select("*", *cols).where(~F.col("__halo")).drop(_K, _B, "__halo")


def sliding_extremes(df: DataFrame, seq: str, size: int, value: str, partition_by=()) -> DataFrame:
    """``n``, ``lo``, ``hi`` and ``total`` of ``value`` over ``ROWS BETWEEN
    size-1 PRECEDING AND CURRENT ROW``, at a cost per row that does not grow
    with ``size``.

    Positions are cut into blocks of ``size``.  A frame is the tail of one block
    and the head of the next: what runs up to each row from its block's start,
    and what runs down to it from the block's end, are two running aggregates
    within a block; the row meets the tail that begins ``size - 1`` rows before
    it in an equi-join on (keys, position).  A window or join task holds blocks,
    never a whole key.  ``seq``: a dense 1-based position.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    d = df.withColumn(_K, F.struct(*[as_col(c) for c in partition_by]) if partition_by
                      else F.struct(F.lit(0).alias("k"))).withColumn(_B, F.floor((F.col(seq) - 1) / size))
    up = Window.partitionBy(_K, _B).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(_K, _B).orderBy(F.col(seq).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of = lambda w, tag: {f"__n{tag}": F.count(value).over(w), f"__lo{tag}": F.min(value).over(w),
                         f"__hi{tag}": F.max(value).over(w), f"__t{tag}": F.sum(value).over(w)}
    tails = d.select(_K, _B, seq, value).withColumns(of(down, "2")).where((F.col(seq) - 1) % size != 0)
    tails = tails.select(F.col(_K).alias("__k2"), (F.col(seq) + (size - 1)).alias("__at"), "__n2", "__lo2", "__hi2", "__t2")
    j = d.withColumns(of(up, "1")).join(tails, F.col(_K).eqNullSafe(F.col("__k2")) & (F.col(seq) == F.col("__at")), "left")
    both = lambda c: F.when(F.col(f"__{c}1").isNull() & F.col(f"__{c}2").isNull(), F.lit(None)).otherwise(
        F.coalesce(f"__{c}1", F.lit(0)) + F.coalesce(f"__{c}2", F.lit(0)))
    out = j.withColumns({"n": both("n"), "lo": F.least("__lo1", "__lo2"), "hi": F.greatest("__hi1", "__hi2"), "total": both("t")})
    return out.drop(_K, _B, "__k2", "__at", *[f"__{c}{t}" for c in ("n", "lo", "hi", "t") for t in (1, 2)])
