"""Live-table operators (LIVE1-LIVE12), batch form.

The reference keeps small column buffers behind live charts: a message
counter, a parse-or-reject step, a ring buffer of the newest N points, a
running total, per-category gauges, a fixed category domain and a
four-panel snapshot.  Here each is a DataFrame operator over an ordered
input, optionally per ``series``.  Everything that is a running quantity
goes through :mod:`rivulet.operators.ordered`, so neither a hot series nor
an ungrouped stream is ever processed by one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.numbers import py_int
from rivulet.operators.joins import join_small
from rivulet.operators.ordered import Order, running_sum, running_sums, sequence_number, sliding_extremes, sliding_frame
from rivulet.operators.tables import newest_record_by

# Fixed value: what the live chart prints for a message it cannot parse.
REJECT_REASON = "Wrong Input"


def _keys(series) -> list:
    if series is None:
        return []
    return [series] if isinstance(series, str) else list(series)


# LIVE1 -----------------------------------------------------------------------

def sequence(df: DataFrame, order: Order, series=None, out: str = "seq") -> DataFrame:
    """Message counter ``ct += 1`` for every message, rejected ones included."""
    return sequence_number(df, order, _keys(series), out)


# LIVE2 / LIVE3 ---------------------------------------------------------------

def parse_points(df: DataFrame, text: str = "text", out: str = "y") -> DataFrame:
    """``int(text)`` with Python's grammar; ``out`` is NULL for a reject."""
    return df.withColumn(out, py_int(F.col(text)))


def accepted(df: DataFrame, y: str = "y") -> DataFrame:
    return df.where(F.col(y).isNotNull())


def rejected(df: DataFrame, y: str = "y", reason: str = "reason") -> DataFrame:
    """The ``Wrong Input`` side, with its own sink."""
    return df.where(F.col(y).isNull()).withColumn(reason, F.lit(REJECT_REASON)).drop(y)


# LIVE4 -----------------------------------------------------------------------

def last_n(df: DataFrame, n: int, order_cols: Sequence[str], series=None,
           out: str | None = None) -> DataFrame:
    """Ring buffer: the newest ``n`` rows (per series).

    Per series: ``row_number() <= n`` over the descending order, which Spark
    plans as a partial ``WindowGroupLimit`` before the exchange, so at most
    ``n`` rows per series and task are shuffled.  Ungrouped:
    ``orderBy(desc).limit(n)``, a ``TakeOrderedAndProject`` (per-task top-n,
    then a merge of n rows per task).  ``out`` optionally keeps the rank
    (1 = newest).
    """
    keys = _keys(series)
    desc = [F.col(c).desc() for c in order_cols]
    if not keys:
        res = df.orderBy(*desc).limit(n)
        return res.withColumn(out, F.row_number().over(Window.orderBy(*desc))) if out else res
    w = Window.partitionBy(*keys).orderBy(*desc)
    ranked = df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n)
    return ranked.withColumnRenamed("__rank", out) if out else ranked.drop("__rank")


def last_n_numbered(df: DataFrame, n: int, order_cols: Sequence[str], y: str = "y", series=None,
                    seq: str = "seq") -> DataFrame:
    """The newest ``n`` accepted points (``y`` not null) with the message
    numbers that :func:`sequence` gives them, without numbering every message.

    A kept point's number is the count of all messages less those after it:
    the kept points after it, and the rejects, which one filtered aggregate
    counts between the kept points (at most ``n`` numbers per series)."""
    keys = _keys(series)
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]

    def meet(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return left.join(right, on, how).drop(*[f"__k{i}" for i in range(len(keys))])

    at = F.struct(*[F.col(c) for c in order_cols])
    kept = last_n(accepted(df, y), n, order_cols, series)
    points = kept.groupBy(*named).agg(F.sort_array(F.collect_list(at)).alias("__points"))
    rest = df.where(F.col(y).isNull()).select(*keys, at.alias("__at"))
    if keys:
        rest = rest.withColumn("__ks", F.struct(*[F.col(k) for k in keys]))
        by_key = points.select(F.struct(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]).alias("__kp"), "__points")
        rest = join_small(rest, by_key, "__ks", "__kp", ["__at"], "inner").drop("__ks", "__kp")
    else:
        rest = rest.withColumn("__points", points.scalar())
    # only rejects newer than the oldest kept point are placed among them
    rest = rest.where(F.col("__at") > F.get("__points", F.lit(0)))
    rest = rest.withColumn("__older", F.size(F.filter("__points", lambda p: p < F.col("__at"))))
    between = rest.groupBy(*keys, "__older").agg(F.count(F.lit(1)).alias("__c"))
    between = between.groupBy(*named).agg(F.collect_list(F.struct("__older", "__c")).alias("__between"))
    total = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__total"))

    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    kept = kept.withColumn("__r", F.row_number().over(newest)).withColumn(
        "__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if keys:
        kept = meet(meet(kept, total), between)
    else:
        kept = kept.withColumns({"__total": total.scalar(), "__between": between.scalar()})
    nth = F.col("__n") - F.col("__r") + 1  # 1: the oldest kept
    later = F.aggregate(F.filter("__between", lambda x: x["__older"] >= nth), F.lit(0).cast("bigint"),
                        lambda acc, x: acc + x["__c"])
    number = F.col("__total") - (F.col("__r") - 1) - F.coalesce(later, F.lit(0))
    return kept.withColumn(seq, number).drop("__r", "__n", "__total", "__between")


# LIVE5 -----------------------------------------------------------------------

#: Points from which a buffer is kept as block heads and tails.
WIDE = 64


def sliding(df: DataFrame, order: Order, size: int, y: str = "y", series=None,
            bucket_rows: int = 1 << 16, position: str | None = None) -> DataFrame:
    """What the buffer of the newest ``size`` points held after each point:
    ``n``, ``lo``, ``hi``, ``total`` over ``ROWS size-1 PRECEDING``.

    ``position``: an existing dense 1-based position of the points per
    series (e.g. from :func:`sequence_with_accepted`); computed if absent.
    Buffers of ``WIDE`` points or more take the form whose cost per row does
    not grow with ``size`` (:func:`rivulet.operators.ordered.sliding_extremes`),
    with equal results."""
    keys = _keys(series)
    pos = position or "__pos"
    if position is None:
        df = sequence_number(df, order, keys, out=pos)
    if size >= WIDE:
        out = sliding_extremes(df, pos, size, y, keys)
    else:
        aggs = {"n": F.count(y), "lo": F.min(y), "hi": F.max(y), "total": F.sum(y)}
        out = sliding_frame(df, pos, size, aggs, keys, bucket_rows)
    out = out.drop("__pos") if position is None else out
    return out.withColumn("n", F.col("n").cast("bigint"))


def sequence_with_accepted(df: DataFrame, order: Order, series=None, y: str = "y",
                           seq: str = "seq", accepted_pos: str = "apos") -> DataFrame:
    """LIVE1 + LIVE2 in one bucketed pass: the message counter over all rows
    and the dense position among accepted rows (NULL-free ``y``)."""
    ones = {seq: F.lit(1).cast("bigint"),
            accepted_pos: F.when(F.col(y).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")}
    return running_sums(df, ones, order, _keys(series))


# LIVE6-LIVE8 -----------------------------------------------------------------

def running_total(df: DataFrame, inc: str, order: Order, series=None, seed=0,
                  out: str = "total") -> DataFrame:
    """``append(last + increment)`` from ``seed``: a seeded prefix sum."""
    return running_sum(df, F.col(inc), order, _keys(series), out=out, seed=seed)


def history(df: DataFrame, inc: str, order: Order, n: int, series=None, seed=0,
            out: str = "total") -> DataFrame:
    """Bounded history: the running total over *all* rows, of the newest n.

    The newest n rows are taken first and the grand total is one aggregate;
    the total at a kept row is the grand total less what came after it, so
    no other row moves."""
    keys = _keys(series)
    kept = last_n(df, n, list(order.by), series)
    grand = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.sum(inc).alias("__grand"))
    newer = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order.by]).rowsBetween(
        Window.unboundedPreceding, -1)
    kept = kept.withColumn("__after", F.coalesce(F.sum(inc).over(newer), F.lit(0)))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    if keys:
        kept = kept.join(grand, on)
    else:  # one value
        kept = kept.withColumn("__grand", grand.scalar())
    total = F.lit(seed) + F.coalesce("__grand", F.lit(0)) - F.col("__after")
    return kept.withColumn(out, total).drop("__after", "__grand", *[f"__k{i}" for i in range(len(keys))])


def padded_history(df: DataFrame, inc: str, order: Order, time_col: str, n: int, series=None,
                   seed=0, out: str = "total", slot: str = "slot") -> DataFrame:
    """History that always has ``n`` rows: a series with fewer rows begins with
    ``(start_time, seed)`` pad rows, as the chart's pre-filled buffer does.
    ``slot`` numbers the buffer 1..n, oldest first."""
    return pad_history(history(df, inc, order, n, series, seed, out), n, time_col, list(order.by),
                       series, seed, out, slot)


def pad_history(hist: DataFrame, n: int, time_col: str, order_cols: Sequence[str], series=None,
                seed=0, out: str = "total", slot: str = "slot") -> DataFrame:
    """Slots and pads for a bounded history table (at most ``n`` rows per
    series, e.g. :func:`history` or its streaming snapshot).

    A series with fewer than ``n`` rows has never dropped one, so its oldest
    row is its start time.  Pads come from a one-row-per-series table by
    ``explode(sequence(...))`` - at most ``n`` per series, no cross join.
    """
    keys = _keys(series)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols]) if keys else \
        Window.orderBy(*[F.col(c).desc() for c in order_cols])
    ranked = hist.withColumn("__rd", F.row_number().over(w))
    real = ranked.select(*keys, (F.lit(n) - F.col("__rd") + 1).cast("bigint").alias(slot),
                         F.col(time_col), F.col(out))
    stats = hist.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(time_col).alias(time_col))
    pad = F.lit(n) - F.col("__n")
    pads = stats.select(*keys, F.col(time_col),
                        F.explode(F.when(pad >= 1, F.sequence(F.lit(1).cast("bigint"), pad.cast("bigint")))
                                  .otherwise(F.array().cast("array<bigint>"))).alias(slot))
    seed_col = F.lit(seed).cast(hist.schema[out].dataType)
    return real.unionByName(pads.select(*keys, slot, time_col, seed_col.alias(out)))


# LIVE9-LIVE11 ----------------------------------------------------------------

def category_total(df: DataFrame, category: str = "category", value: str = "value",
                   start: int = 10) -> DataFrame:
    """Accumulating gauge: ``value[i] += inc`` from ``start``."""
    return df.groupBy(category).agg((F.lit(start) + F.sum(value)).cast("bigint").alias(value))


def category_latest(df: DataFrame, order_cols: Sequence[str], category: str = "category",
                    value: str = "value") -> DataFrame:
    """Replacing gauge: the newest reading per category overwrites the older."""
    cols = list(dict.fromkeys([category, *order_cols, value]))
    return newest_record_by(df.select(*cols), [category], order_cols).select(category, value)


def category_domain(values: DataFrame, domain: Sequence[str], category: str = "category",
                    value: str = "value", start: int = 10, ord_col: str = "ord") -> DataFrame:
    """Fixed ordered domain: only the domain's categories, in its order;
    a category without readings keeps the start value.

    The domain is a literal list - a proven size bound: the value table is
    first cut to it with an ``isin`` filter, then reduced to one row per
    category (of several values the largest), and only those at most
    ``len(domain)`` rows meet the domain.
    """
    spark = values.sparkSession
    entries = [F.struct(F.lit(i).cast("bigint").alias(ord_col), F.lit(c).alias("__cat"))
               for i, c in enumerate(domain)]
    dom = spark.range(1).select(F.inline(F.array(*entries)))
    shown = (values.where(F.col(category).isin(list(domain))).groupBy(category)
             .agg(F.max(value).alias(value)))
    joined = F.broadcast(dom).join(F.broadcast(shown), F.col("__cat") == F.col(category), "left")
    return joined.select(F.col(ord_col), F.col("__cat").alias(category),
                         F.coalesce(F.col(value), F.lit(start).cast(values.schema[value].dataType)).alias(value))


# LIVE12 ----------------------------------------------------------------------

DASHBOARD_COLUMNS = ("panel", "series", "x_time", "x_cat", "y")


def panel(df: DataFrame, name: str, series: str, y: str, x_time: str | None = None,
          x_cat: str | None = None) -> DataFrame:
    """Normalise one panel's table to ``(panel, series, x_time, x_cat, y)``."""
    return df.select(F.lit(name).alias("panel"), F.lit(series).alias("series"),
                     (F.col(x_time) if x_time else F.lit(None)).cast("timestamp_ntz").alias("x_time"),
                     (F.col(x_cat) if x_cat else F.lit(None)).cast("string").alias("x_cat"),
                     F.col(y).cast("bigint").alias("y"))


def dashboard(*panels: DataFrame) -> DataFrame:
    """Multi-panel snapshot: all panels of one tick in one table."""
    out = panels[0]
    for p in panels[1:]:
        out = out.unionByName(p)
    return out
