"""Reader-side operators: start offsets (SRC2), UTF-8 decode with rejects
(SRC4), stop at a sentinel (SRC7) and the JSON envelope (SRC10)."""

from __future__ import annotations

from typing import Callable, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.codec import decode_utf8, from_json_envelope, parse_typed_envelope, to_json_envelope
from rivulet.operators.joins import join_small

# Kafka's conventions for start positions in a per-partition offsets map.
LATEST = -1
EARLIEST = -2
# Fixed value: the consumer's stop message.
SENTINEL = "exit"


def offsets_predicate(starts: dict[int, int], default: int = EARLIEST) -> Column:
    """The filter of :func:`from_offsets` as an OR of per-partition terms
    ``partition = p AND offset >= s`` - a form the parquet reader can push
    down (partition pruning on a topic stored ``partitionBy('partition')``,
    row-group skipping on offset statistics)."""
    terms = []
    for p, start in sorted(starts.items()):
        if start == LATEST:
            continue
        hit = F.col("partition") == F.lit(int(p))
        terms.append(hit if start == EARLIEST else hit & (F.col("offset") >= F.lit(int(start))))
    if default == EARLIEST:
        listed = [int(p) for p in starts]
        # a record without a partition is unlisted
        terms.append(F.col("partition").isNull() | ~F.col("partition").isin(listed) if listed else F.lit(True))
    if not terms:
        return F.lit(False)
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return out


def from_offsets(df: DataFrame, starts: dict[int, int], default: int = EARLIEST) -> DataFrame:
    """SRC2 (batch): rows at or after the start offset of their partition.

    ``starts`` maps partition -> offset, ``-1`` = latest (nothing that exists
    now), ``-2`` = earliest; unlisted partitions use ``default``.  A plain,
    pushable filter - no join."""
    return df.where(offsets_predicate(starts, default))


def decode_values(df: DataFrame, value: str = "value", out: str = "value",
                  valid: str = "valid") -> DataFrame:
    """SRC4: decode a binary value as UTF-8; ``valid`` is false for bad bytes
    (the decoded value is then NULL), so rejects can be counted or routed."""
    decoded = decode_utf8(F.col(value))
    # withColumns evaluates both against the input, so ``out`` may replace ``value``
    return df.withColumns({valid: F.col(value).isNull() | decoded.isNotNull(), out: decoded})


def take_until(df: DataFrame, sentinel: Union[Column, Callable[[Column, Column], Column]]) -> DataFrame:
    """SRC7: per partition, the records before the first sentinel record.

    The sentinel itself is not output; a partition without one is kept
    whole.  One aggregate gives the first sentinel offset per partition - one
    row per topic partition - which meets the records in a salted join
    (:mod:`rivulet.operators.joins`).
    """
    is_stop = sentinel(F.col("key"), F.col("value")) if callable(sentinel) else sentinel
    stops = (df.where(F.coalesce(is_stop, F.lit(False))).groupBy("partition")
             .agg(F.min("offset").alias("__stop")).withColumnRenamed("partition", "__p"))
    joined = join_small(df, stops, "partition", "__p", ["offset"])
    return joined.where(F.col("__stop").isNull() | (F.col("offset") < F.col("__stop"))).drop("__p", "__stop")


def once(stream: DataFrame, delay: str = "7 days", time: str = "timestamp") -> DataFrame:
    """SRC5: a stream's records without what is delivered again: the first
    record of each (partition, offset).  State is kept for records within
    ``delay`` of the newest event time, so it stays bounded; a record that comes
    again later than that passes.  Records without a time are left out by the
    watermark, so they take the start of time."""
    at = F.coalesce(F.col(time).cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))
    marked = stream.withColumn("__at", at).withWatermark("__at", delay)
    return marked.dropDuplicatesWithinWatermark(["partition", "offset"]).drop("__at")


def value_equals(token: str = SENTINEL):
    """The reference sentinel: ``value == "exit"``."""
    return lambda k, v: v == F.lit(token)


def wrap_json(df: DataFrame, schemas: bool = True, out: str = "json") -> DataFrame:
    """SRC10 (write side): the converter's JSON form of the value."""
    return df.withColumn(out, to_json_envelope(F.col("value"), schemas))


def unwrap_json(df: DataFrame, col: str = "json", schemas: bool = True, out: str = "payload") -> DataFrame:
    """SRC10 (read side): the payload of a JSON envelope (NULL if malformed)."""
    return df.withColumn(out, from_json_envelope(F.col(col), schemas))


def unwrap_typed(df: DataFrame, col: str = "json") -> DataFrame:
    """SRC10 (read side, schema-led): ``type``, ``payload`` (variant) and
    ``valid`` of each record by the schema that it carries itself, so that one
    topic may mix them; bad records can be counted or routed."""
    parsed = df.withColumn("__envelope", parse_typed_envelope(F.col(col)))
    return parsed.select(*df.columns, "__envelope.type", "__envelope.payload", "__envelope.valid")
