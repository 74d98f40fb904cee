"""Stateless record operators (REC1-REC16): branch, filter, flat-map, map,
re-key, format, route, unpivot.  Each is ``DataFrame -> DataFrame`` built
only from Column expressions, so it runs unchanged on a streaming DataFrame
and stays inside whole-stage codegen.

Predicates and mappers follow the reference's lambda shapes: a predicate is
either a boolean Column or a function ``(key, value) -> Column``; a mapper
returns a Column (or a ``(key, value)`` pair of Columns).
"""

from __future__ import annotations

from typing import Callable, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import explode_run_split, first_field, java_format, java_length

Pred = Union[Column, Callable[[Column, Column], Column]]

# Fixed values of the reference's example operators: the flat-map pair
# values, the filtered first field and numeric bound, the producer's
# constant key, and the two console line formats.
HEY_HI = ("Hey", "Hi")
NULL_TOKEN = "NULL"
NUMERIC_BOUND = 14
CONSTANT_KEY = "1"
FOREACH_FORMAT = "%s===>%s"
RECORD_FORMAT = "Consumer Record:(%s, %s, %d, %d)"


def _pred(p: Pred) -> Column:
    return p(F.col("key"), F.col("value")) if callable(p) else p


# REC1 ----------------------------------------------------------------------

def branch(df: DataFrame, *predicates: Pred, out: str = "branch") -> DataFrame:
    """``branch(p1, p2, ...)``: the first true predicate takes the record.

    Adds ``branch`` = index of that predicate; rows matching none are
    dropped, as in the reference.  A NULL predicate result counts as false
    (the reference would throw).  Select an output with ``branch == i``.
    """
    if not predicates:
        raise ValueError("branch needs at least one predicate")
    idx = None
    for i, p in enumerate(predicates):
        cond = F.coalesce(_pred(p), F.lit(False))
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    return df.withColumn(out, idx).where(F.col(out).isNotNull())


def branch_outputs(df: DataFrame, *predicates: Pred) -> list[DataFrame]:
    """The branch outputs as separate DataFrames (one lazy filter each)."""
    tagged = branch(df, *predicates, out="__branch")
    return [tagged.where(F.col("__branch") == i).drop("__branch") for i in range(len(predicates))]


# REC2-REC4 -----------------------------------------------------------------

def filter_records(df: DataFrame, predicate: Pred) -> DataFrame:
    """``filter(p)``: keep records whose predicate is true (NULL drops)."""
    return df.where(F.coalesce(_pred(predicate), F.lit(False)))


def filter_not(df: DataFrame, predicate: Pred) -> DataFrame:
    """``filterNot(p)``: keep records whose predicate is not true (NULL keeps)."""
    return df.where(~F.coalesce(_pred(predicate), F.lit(False)))


def first_tab_field_is_not(token: str = NULL_TOKEN) -> Callable[[Column, Column], Column]:
    """The reference filter ``!value.split("\\t")[0].equals("NULL")``.

    A null value gives NULL (dropped by :func:`filter_records`)."""
    return lambda k, v: first_field(v, "\t") != F.lit(token)


def first_tab_number_above(bound: int = NUMERIC_BOUND) -> Callable[[Column, Column], Column]:
    """``Integer.parseInt(value.split("\\t")[0]) > bound``; NULL where Java throws."""
    from rivulet.functions.numbers import java_parse_int
    return lambda k, v: java_parse_int(first_field(v, "\t")) > F.lit(bound)


# REC5-REC7 -----------------------------------------------------------------

def flat_map(df: DataFrame, fn: Callable[[Column, Column], Sequence[tuple[Column, Column]]]) -> DataFrame:
    """``flatMap((k, v) -> [pair, ...])``: 0..n records out, key may change.

    ``fn`` returns a list of ``(key, value)`` Column pairs; other envelope
    columns (partition, offset, timestamp) are carried along.
    """
    pairs = fn(F.col("key"), F.col("value"))
    arr = F.array(*[F.struct(k.cast("string").alias("k"), v.cast("string").alias("v")) for k, v in pairs])
    rest = [c for c in df.columns if c not in ("key", "value")]
    return (df.select(*rest, F.explode(arr).alias("__kv"))
              .select(F.col("__kv.k").alias("key"), F.col("__kv.v").alias("value"), *rest))


def flat_map_udtf(df: DataFrame, table_fn) -> DataFrame:
    """``flatMap`` with a Python UDTF (``@udtf`` returning ``key, value``
    rows) called per record through a lateral join - the escape hatch
    for flat mappers that Column expressions cannot state.  Other envelope
    columns are carried along."""
    rest = [c for c in df.columns if c not in ("key", "value")]
    src = df.alias("__t")
    out = src.lateralJoin(table_fn(F.col("__t.key").outer(), F.col("__t.value").outer()).alias("__u"))
    return out.select(F.col("__u.key").cast("string").alias("key"),
                      F.col("__u.value").cast("string").alias("value"),
                      *[F.col(f"__t.{c}").alias(c) for c in rest])


def hey_hi(k: Column, v: Column):
    """The reference flat-mapper: ``[(v, "Hey"), (v, "Hi")]``."""
    return [(v, F.lit(word)) for word in HEY_HI]


def flat_map_values_split(df: DataFrame, pattern: str, lower: bool = False) -> DataFrame:
    """``flatMapValues(v -> asList([v.toLowerCase()].split(pattern)))``: key kept.

    Java's split rules (trailing blanks dropped, one leading blank kept)."""
    cols = df.columns
    out = explode_run_split(df, "value", pattern, out="value", lower=lower)
    return out.select(*cols)


# REC8-REC10 ----------------------------------------------------------------

def map_records(df: DataFrame, fn: Callable[[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """``map((k, v) -> pair(k', v'))``: key and value both change."""
    k, v = fn(F.col("key"), F.col("value"))
    return df.withColumns({"key": k.cast("string"), "value": v.cast("string")})


def lower_and_length(k: Column, v: Column):
    """The reference mapper: ``pair(v.toLowerCase(), toString(v.length()))``
    (Java length: UTF-16 units)."""
    return F.lower(v), java_length(v).cast("string")


def map_values(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """``mapValues(f)``: the key is not touched."""
    return df.withColumn("value", fn(F.col("value")).cast("string"))


def select_key(df: DataFrame, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """``selectKey((k, v) -> k')``: re-key, value kept."""
    return df.withColumn("key", fn(F.col("key"), F.col("value")).cast("string"))


def first_word_key(k: Column, v: Column) -> Column:
    """The reference key selector ``value.split(" ")[0]``."""
    return first_field(v, " ")


def constant_key(df: DataFrame, key: str = CONSTANT_KEY) -> DataFrame:
    """REC12: every record gets the same key.

    Writing such a stream to a keyed sink puts every row in one partition;
    nothing here groups by it, so Spark itself stays parallel."""
    return df.withColumn("key", F.lit(key))


def repartition_by_key(df: DataFrame, partitions: int | None = None, key: str = "key") -> DataFrame:
    """AGG7: explicit hash repartition on the (new) key, as a repartition
    topic does.  ``groupBy`` inserts the same exchange by itself; use this
    only to co-locate several later operators on one key."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)


# REC11 / SNK4 --------------------------------------------------------------

def format_line(df: DataFrame, fmt: str = FOREACH_FORMAT, cols=("key", "value"), out: str = "line") -> DataFrame:
    """Rendered console line per record; nulls print as ``null``."""
    return df.withColumn(out, java_format(fmt, *cols))


# REC13 ---------------------------------------------------------------------

def route(df: DataFrame, routes: dict[str, Callable[[DataFrame], DataFrame]],
          chosen: Sequence[str] | None = None, out: str = "topic") -> DataFrame:
    """Route by configuration: only the chosen outputs are built.

    ``routes`` maps a sink/topic name to an operator; the result is the
    union of the chosen outputs with a ``topic`` column.  Unchosen routes
    are never planned, so they cost nothing.
    """
    names = list(chosen if chosen is not None else routes)
    parts = [routes[n](df).withColumn(out, F.lit(n)) for n in names]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p, allowMissingColumns=True)
    return result


# REC14-REC16 ---------------------------------------------------------------

def unpivot_readings(df: DataFrame, ids: Sequence[str], columns: dict[str, str],
                     name: str = "factor", value: str = "x") -> DataFrame:
    """Wide to long: each ``{label: column}`` becomes a ``(name, value)`` row."""
    renamed = df.select(*ids, *[F.col(c).cast("double").alias(label) for label, c in columns.items()])
    return renamed.unpivot(list(ids), list(columns), name, value)


def segment_rows(df: DataFrame, factor: str = "factor", value: str = "x", keep=()) -> DataFrame:
    """Lollipop segment rows: ``x0=0, y0=f, x1=x, y1=f, x2=x, y2=f``."""
    return df.select(*keep,
                     F.lit(0).alias("x0"), F.col(factor).alias("y0"),
                     F.col(value).alias("x1"), F.col(factor).alias("y1"),
                     F.col(value).alias("x2"), F.col(factor).alias("y2"))


def range_filter(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Fixed axis range: values outside ``[lo, hi]`` are not shown."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))
