"""Keyed tables (AGG1-AGG5): counts, the word count, changelog and latest value.

Counts and latest-value are declarative aggregates, so Spark runs them as a
partial (map-side) aggregate, one exchange on the key, and a final
aggregate: a key holding a third of all rows reaches the exchange as one
partial row per task.  The same expressions are legal in a streaming
aggregate (``update`` mode = the table's changelog, ``complete`` = its
snapshot).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import NON_WORD
from rivulet.operators.ordered import Order, sequence_number
from rivulet.operators.records import flat_map_values_split


def _present(df: DataFrame, key: Column) -> DataFrame:
    # count() ignores records whose key or value is null
    return df.where(key.isNotNull() & F.col("value").isNotNull())


def count_by_key(df: DataFrame) -> DataFrame:
    """AGG1 ``groupByKey().count()``: ``(key, count)``."""
    return (_present(df, F.col("key")).groupBy("key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def count_by(df: DataFrame, key_fn: Callable[[Column, Column], Column]) -> DataFrame:
    """AGG2 ``groupBy((k, v) -> k').count()``: a computed key, one exchange on it."""
    k = key_fn(F.col("key"), F.col("value")).cast("string")
    keyed = df.select(k.alias("key"), "value")
    return (_present(keyed, F.col("key")).groupBy("key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def upper_value(k: Column, v: Column) -> Column:
    """The reference grouping key ``value.toUpperCase()``."""
    return F.upper(v)


def word_count(df: DataFrame, pattern: str = NON_WORD) -> DataFrame:
    """AGG3: lower-case, split on ``\\W+`` (Java rules), ``(word, count)``."""
    words = flat_map_values_split(df.select("key", "value"), pattern, lower=True)
    return (words.where(F.col("value").isNotNull()).groupBy(F.col("value").alias("word"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def changelog(df: DataFrame, order: Order, out: str = "count") -> DataFrame:
    """AGG4: every update of a per-key count, one row per record.

    The count after each record is a running count per key in arrival
    order, computed with the bucketed two-pass prefix so a hot key is
    spread over many tasks.
    """
    return sequence_number(_present(df, F.col("key")), order, partition_by=["key"], out=out)


def latest_by_key(df: DataFrame, order_cols=("timestamp", "partition", "offset"),
                  keep_tombstones: bool = False) -> DataFrame:
    """AGG5: the table view - newest value per key.

    The newest record wins even when its value is null; a newest null is a
    delete (dropped unless ``keep_tombstones``).  See :func:`newest_record_by`.
    """
    cols = list(dict.fromkeys([*order_cols, "key", "value"]))
    out = newest_record_by(df.where(F.col("key").isNotNull()).select(*cols), ["key"], order_cols).select("key", "value")
    return out if keep_tombstones else out.where(F.col("value").isNotNull())


def newest_record_by(df: DataFrame, keys, order_cols=("timestamp", "partition", "offset")) -> DataFrame:
    """Row form of :func:`latest_by_key`: the whole newest record per key, one
    row a key.

    Late materialisation: the order is reduced in steps (see :func:`_steps`),
    each a hash aggregate of one fixed-width maximum per key that reads no
    payload (a hot key is one row a task), and the rows that have it go on, by
    a join with one row a key - broadcast where adaptive execution measures it
    small, so that payloads are not shuffled.  Nulls come first in the order;
    of records equal in the whole order the greatest stays.

    A streaming table, which cannot be joined with itself, takes one aggregate
    ``max(struct(order, record))``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if df.isStreaming:
        newest = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)],
                                *[F.col(c) for c in rest]))
        out = df.groupBy(*keys).agg(newest.alias("__r"))
    else:
        left = df
        for step in _steps(df, order_cols):
            top = (left.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(step).alias("__top")))
            on = step.eqNullSafe(F.col("__top"))
            for i, k in enumerate(keys):
                on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
            left = left.join(top, on, "left_semi")
        # one record, but for copies of it
        out = left.groupBy(*keys).agg(F.array_max(F.collect_set(F.struct(*rest))).alias("__r"))
    return out.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


# Digits of a whole number above its type's least one, null below: fixed values.
_WHOLE = {"tinyint": (4, 2 ** 7 + 1), "smallint": (6, 2 ** 15 + 1), "int": (11, 2 ** 31 + 1), "bigint": (20, 2 ** 63 + 1)}


def _steps(df: DataFrame, order_cols) -> list[Column]:
    """The order as few fixed-width columns, most significant first: whole
    numbers next to each other become one decimal (at most 38 digits)."""
    steps, held, digits = [], [], 0

    def flush() -> None:
        nonlocal held, digits
        if len(held) == 1:
            steps.append(F.col(held[0][0]))
        elif held:
            packed = None
            for name, size, least in held:
                part = F.coalesce(F.col(name).cast(f"decimal({size},0)") + F.lit(str(least)).cast(f"decimal({size},0)"),
                                  F.lit(0)).cast(f"decimal({size},0)")
                packed = part if packed is None else (packed * F.lit(str(10 ** size)).cast(f"decimal({size + 1},0)")
                                                      ).cast("decimal(38,0)") + part
            steps.append(packed.cast("decimal(38,0)"))
        held, digits = [], 0

    for c in order_cols:
        size, least = _WHOLE.get(df.schema[c].dataType.simpleString(), (None, None))
        if size is None:
            flush()
            steps.append(F.col(c))
            continue
        if digits + size > 37:
            flush()
        held.append((c, size, least))
        digits += size
    flush()
    return steps
