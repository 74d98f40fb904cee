"""Topic maintenance jobs (OPS3-OPS9) as batch DataFrame operators.

All work on the envelope ``(key, value, partition, offset, timestamp)``.
Per-partition quantities are declarative aggregates (partial + final), and
the only joins are against tables with one row per topic partition
(salted, :mod:`rivulet.operators.joins`) or
equi-joins on ``(partition, offset)``, whose keys are spread evenly however
skewed the record keys are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.joins import join_small
from rivulet.operators.ordered import previous_in_order
from rivulet.operators.tables import newest_record_by

RETENTION_HOURS = 168  # fixed value: log.retention.hours of the broker config


def retention(df: DataFrame, hours: int = RETENTION_HOURS, ts: str = "timestamp") -> DataFrame:
    """OPS3: keep records newer than ``max(ts) - hours``.

    The newest timestamp is a scalar subquery - one value, computed once and
    inlined into the filter."""
    newest = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(hours)} HOURS"))


def committed_offsets(df: DataFrame, processed: Column) -> DataFrame:
    """Offsets a consumer group would have committed after processing the
    records matching ``processed``: ``(partition, committed)``, the next
    offset to read, one row per partition it consumed."""
    return (df.where(processed).groupBy("partition")
            .agg((F.max("offset") + 1).cast("bigint").alias("committed")))


def delete_before(df: DataFrame, low_watermarks, col: str = "committed") -> DataFrame:
    """OPS3 (delete-records): drop records below each partition's low
    watermark; partitions without one keep everything.

    ``low_watermarks``: a ``{partition: offset}`` map (as the delete-records
    tool takes it) becomes a pushable filter; a DataFrame
    ``(partition, committed)`` is joined with salts."""
    if isinstance(low_watermarks, dict):
        from rivulet.sources.readers import EARLIEST, offsets_predicate
        return df.where(offsets_predicate(low_watermarks, default=EARLIEST))
    lw = low_watermarks.select(F.col("partition").alias("__p"), F.col(col).alias("__low"))
    j = join_small(df, lw, "partition", "__p", ["offset"])
    return j.where(F.col("__low").isNull() | (F.col("offset") >= F.col("__low"))).drop("__p", "__low")


def compact(df: DataFrame) -> DataFrame:
    """OPS4: log compaction - the newest record per key within each partition
    (a partition is one log), tombstones included.  Records without a key
    have nothing to be compacted by: all are kept."""
    keyed = newest_record_by(df.where(F.col("key").isNotNull()), ["partition", "key"], order_cols=("offset",))
    return keyed.unionByName(df.where(F.col("key").isNull()))


def topic_summary(df: DataFrame) -> DataFrame:
    """OPS6: per partition first/last offset, record count and time range."""
    return df.groupBy("partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))


def lag(df: DataFrame, committed: DataFrame) -> DataFrame:
    """OPS5: consumer lag per partition: end offset - committed offset; a
    partition without a commit lags by its whole record count."""
    ends = df.groupBy("partition").agg((F.max("offset") + 1).cast("bigint").alias("end_offset"),
                                       F.count(F.lit(1)).cast("bigint").alias("__n"))
    c = committed.select(F.col("partition").alias("__p"), F.col("committed"))
    j = ends.join(c, F.col("partition") == F.col("__p"), "left")  # one row per partition on both sides
    return j.select("partition", "end_offset", "committed",
                    F.coalesce(F.col("end_offset") - F.col("committed"), F.col("__n")).alias("lag"))


def reconcile(left: DataFrame, right: DataFrame, only_differences: bool = True) -> DataFrame:
    """OPS7: compare two replicas record by record on ``(partition, offset)``.

    ``status``: ``same``, ``differs`` (key, value or timestamp differ,
    null-safe), ``missing_left`` or ``missing_right``."""
    l = left.select("partition", "offset", F.col("key").alias("left_key"), F.col("value").alias("left_value"),
                    F.col("timestamp").alias("left_ts"), F.lit(True).alias("__l"))
    r = right.select("partition", "offset", F.col("key").alias("right_key"),
                     F.col("value").alias("right_value"), F.col("timestamp").alias("right_ts"),
                     F.lit(True).alias("__r"))
    j = l.join(r, ["partition", "offset"], "full_outer")
    same = (F.col("left_key").eqNullSafe(F.col("right_key")) & F.col("left_value").eqNullSafe(F.col("right_value"))
            & F.col("left_ts").eqNullSafe(F.col("right_ts")))
    status = (F.when(F.col("__l").isNull(), "missing_left").when(F.col("__r").isNull(), "missing_right")
              .when(same, "same").otherwise("differs"))
    out = j.withColumn("status", status).select("partition", "offset", "status", "left_value", "right_value")
    return out.where(F.col("status") != "same") if only_differences else out


#: Offsets of a range, and ranges of one range above it.
RANGE = 4096
CHILDREN = 64


def digests(df: DataFrame, width: int = RANGE) -> DataFrame:
    """One row per range of ``width`` offsets of a partition: record count and
    two order-free sums of record hashes (a hash aggregate: a replica sends one
    row a range and task, whatever its payloads).  Digests of wider ranges are
    sums of narrower ones (:func:`widened`), so they form a tree."""
    record = [F.col(c) for c in ("offset", "key", "value", "timestamp")]
    # nulls are skipped by the hash: say which fields have them
    nulls = F.concat_ws(",", *[c.isNull().cast("string") for c in record])
    part = lambda salt: F.xxhash64(F.lit(salt), nulls, *record).cast("decimal(38,0)")
    placed = df.where(F.col("partition").isNotNull() & F.col("offset").isNotNull())
    return (placed.groupBy("partition", F.expr(f"floor(offset / {width})").alias("range"))
            .agg(F.count("*").alias("n"), F.sum(part(1)).alias("h1"), F.sum(part(2)).alias("h2")))


def widened(ranges: DataFrame, children: int = CHILDREN) -> DataFrame:
    """The digests one level up."""
    return (ranges.groupBy("partition", F.expr(f"floor(range / {children})").alias("range"))
            .agg(F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2")))


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges whose digests differ, or that one side lacks."""
    cols = ("n", "h1", "h2")
    r = right.withColumnsRenamed({c: f"r_{c}" for c in cols})
    j = left.join(r, ["partition", "range"], "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return j.where(~same).select("partition", "range")


def differing_ranges(left: DataFrame, right: DataFrame, levels: int = 3, children: int = CHILDREN) -> DataFrame:
    """``(partition, range)`` of the narrow ranges that differ, from the top of
    the two digest trees down: below a range that is equal nothing is compared."""
    trees = [(left, right)]
    for _ in range(levels - 1):
        trees.append(tuple(widened(t, children) for t in trees[-1]))
    differ = None
    for l, r in reversed(trees):
        if differ is not None:
            above = differ.select(F.col("partition").alias("__p"), F.col("range").alias("__r"))
            on = (F.col("partition") == F.col("__p")) & (F.expr(f"floor(range / {children})") == F.col("__r"))
            l, r = (t.join(above, on, "left_semi") for t in (l, r))
        differ = _unequal(l, r)
    return differ


def reconcile_by_digest(left: DataFrame, right: DataFrame, width: int = RANGE, levels: int = 3,
                        stored: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """OPS7 between replicas that hardly differ: the differences of
    :func:`reconcile`, but only records of ranges whose digests differ meet.

    Each side's digests are made once (``stored(df, name)`` keeps them, for the
    levels of the tree); what is shuffled of equal replicas is one row a range
    and task.  Records of differing ranges are picked by a join with the list of
    those ranges, which is broadcast where adaptive execution measures it small.
    Two replicas whose records differ, but whose 64-bit hashes add up alike
    twice, would pass as equal (chance below 2^-100).
    """
    l, r = digests(left, width), digests(right, width)
    if stored:
        l, r = stored(l, "left"), stored(r, "right")
    differ = differing_ranges(l, r, levels)
    if stored:
        differ = stored(differ, "differing")
    differ = differ.select(F.col("partition").alias("__p"), F.col("range").alias("__r"))
    on = (F.col("partition") == F.col("__p")) & (F.expr(f"floor(offset / {width})") == F.col("__r"))
    nowhere = F.col("partition").isNull() | F.col("offset").isNull()  # in no range; equal to none, as in reconcile
    return reconcile(*(df.join(differ, on, "left_semi").unionByName(df.where(nowhere)) for df in (left, right)))


def throughput(df: DataFrame, bucket: str = "hour", exact: bool = True,
               accuracy: int = 10_000) -> DataFrame:
    """OPS8: records, bytes, average size, size percentiles and record rate
    per ``date_trunc`` bucket.

    ``exact`` uses ``percentile`` (a frequency map of distinct sizes per
    group, partially aggregated); ``exact=False`` uses the bounded-memory
    ``percentile_approx`` sketch for very wide buckets.
    """
    size = F.octet_length("value")
    pct = ((lambda p: F.percentile(size, p)) if exact
           else (lambda p: F.percentile_approx(size, p, accuracy).cast("double")))
    out = df.groupBy(truncate_time(df, "timestamp", bucket).alias("bucket")).agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.sum(size).cast("bigint").alias("bytes"),
        F.avg(size).alias("avg_bytes"),
        pct(0.5).alias("p50_bytes"), pct(0.95).alias("p95_bytes"))
    return out.withColumn("records_per_sec", F.col("records") / F.lit(float(BUCKET_SECONDS[bucket])))


#: Size parameter of the quantile sketches: the rank error is about 1.3 / k at
#: 99 % confidence, and a sketch is exact up to k values.
SKETCH_K = 2000


def size_sketches(df: DataFrame, bucket: str = "minute", k: int = SKETCH_K) -> DataFrame:
    """OPS8, mergeable: per bucket the record count, bytes and a KLL sketch of
    the value sizes (some kilobytes, however many records).  Rows of several
    batches may share a bucket: :func:`throughput_of_sketches` merges them."""
    size = F.octet_length("value")
    return df.groupBy(truncate_time(df, "timestamp", bucket).alias("bucket")).agg(
        F.count(F.lit(1)).cast("bigint").alias("records"), F.sum(size).cast("bigint").alias("bytes"),
        F.count(size).alias("sized"), F.kll_sketch_agg_bigint(size.cast("bigint"), F.lit(k)).alias("sketch"))


def throughput_of_sketches(sketches: DataFrame, bucket: str = "hour", k: int = SKETCH_K) -> DataFrame:
    """The columns of :func:`throughput` from stored sketches, for buckets as
    wide as theirs or wider.  Percentiles are sizes that occur (the least one
    that reaches the rank)."""
    merged = sketches.groupBy(truncate_time(sketches, "bucket", bucket).alias("bucket")).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.sum("sized").alias("sized"),
        F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
    pct = lambda p: F.when(F.col("sized") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)))
    return merged.select("bucket", "records", "bytes", (F.col("bytes") / F.nullif("sized", F.lit(0))).alias("avg_bytes"),
                         pct(0.5).alias("p50_bytes"), pct(0.95).alias("p95_bytes"),
                         (F.col("records") / F.lit(float(BUCKET_SECONDS[bucket]))).alias("records_per_sec"))


# Length of each date_trunc unit used as a throughput bucket.
BUCKET_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def truncate_time(df: DataFrame, col: str, unit: str) -> Column:
    """``date_trunc(unit, col)`` keeping the column's type.

    For ``timestamp_ntz`` the bucket is rebuilt from the wall-clock fields:
    ``date_trunc`` would return a ``timestamp`` through the session time
    zone and shift the buckets."""
    c = F.col(col)
    if df.schema[col].dataType.typeName() != "timestamp_ntz":
        return F.date_trunc(unit, c)
    zero = F.lit(0)
    parts = {"day": (zero, zero, zero), "hour": (F.hour(c), zero, zero),
             "minute": (F.hour(c), F.minute(c), zero), "second": (F.hour(c), F.minute(c), F.second(c))}
    h, m, sec = parts[unit]
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), h, m, sec)


def offset_counts(df: DataFrame) -> DataFrame:
    """``(partition, offset, n)``, dealt by ranges of (partition, offset): the
    only exchange of records in :func:`offset_gaps`."""
    cut = df.where(F.col("offset").isNotNull()).select("partition", "offset").repartitionByRange("partition", "offset")
    return cut.groupBy("partition", "offset").agg(F.count("*").alias("n"))


def offset_runs(counts: DataFrame) -> DataFrame:
    """Contiguous runs ``(partition, first, last)`` of a task's distinct
    offsets: offset less row number is constant along a run and rises at a gap,
    so a run is one group of a map-side aggregate, and a gap-free partition
    costs one row a task."""
    cut = counts.sortWithinPartitions("partition", "offset").withColumn("__id", F.monotonically_increasing_id())
    run = (F.col("offset") - F.col("__id")).alias("__run")
    return (cut.groupBy("partition", F.shiftright("__id", 33).alias("__task"), run)
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).select("partition", "first", "last"))


def offset_gaps(df: DataFrame, width: int = 1 << 20) -> DataFrame:
    """OPS9: sequence verification - duplicates and gaps in each partition's
    offsets.  ``kind`` is ``duplicate`` (same offset again) or ``gap``
    (offsets missing between ``prev_offset`` and ``offset``).

    Records are dealt by ranges once and become runs there; gaps are found
    between the ends of runs by the bucketed lag (buckets of ``width`` offsets,
    so a partition full of gaps is not one task).
    """
    counts = offset_counts(df)
    again = counts.where("n > 1").select(
        "partition", F.lit("duplicate").alias("kind"), F.col("offset").alias("prev_offset"),
        F.explode(F.array_repeat("offset", (F.col("n") - 1).cast("int"))).alias("offset"))
    first = F.struct(F.col("first").alias("offset"), F.lit(True).alias("begins"))
    last = F.struct(F.col("last").alias("offset"), F.lit(False).alias("begins"))
    ends = offset_runs(counts).select("partition", F.inline(
        F.when(F.col("first") == F.col("last"), F.array(first)).otherwise(F.array(first, last))))
    gaps = previous_in_order(ends, "offset", ["partition"], width, out="prev_offset")
    gaps = gaps.where("begins AND offset - prev_offset > 1").select(
        "partition", F.lit("gap").alias("kind"), "prev_offset", "offset")
    return gaps.unionByName(again)
