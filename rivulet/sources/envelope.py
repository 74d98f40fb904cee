"""The record envelope and topic readers (SRC1, SRC2, SRC3, SRC8, SRC9).

A topic is read either from a Kafka broker (``format='kafka'``: the standard
Spark source, its binary key/value cast to strings) or, where no broker
exists, from a directory of files that already carry the envelope schema.
The same reader returns a batch DataFrame or a streaming one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

RAW_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

FIELDS = ["key", "value", "partition", "offset", "timestamp"]

# Text formats keep the full microsecond precision of the timestamp (the
# JSON/CSV default formats stop at milliseconds).
TEXT_FORMAT_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                       "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def from_kafka(df: DataFrame) -> DataFrame:
    """Cast Spark's Kafka source schema to the string envelope.

    The record timestamp (an instant) becomes a wall clock in the session
    time zone; run with a UTC session (as ``session.CLUSTER_CONF`` does) so
    that the repeated hour of a daylight-saving change cannot reorder
    records."""
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("partition").cast("int").alias("partition"),
                     F.col("offset").cast("bigint").alias("offset"),
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def read_topic(spark: SparkSession, topic: str, *, fmt: str = "parquet", stream: bool = False,
               starting: str = "earliest", raw: bool = False, options: dict | None = None,
               per_trigger: int | None = None, group: str | None = None) -> DataFrame:
    """SRC1 / SRC2: a topic as a DataFrame of envelopes.

    ``fmt='kafka'``: ``topic`` is the topic name, ``options`` carries
    ``kafka.bootstrap.servers`` etc.  ``starting`` is ``earliest`` (a
    Streams application) or ``latest`` (a new consumer group).  Large topic
    partitions are split over at least ``defaultParallelism`` tasks
    (``minPartitions``); operators that need order sort explicitly.
    Other formats: ``topic`` is a directory of envelope files.  ``latest``
    needs one that was appended to with offsets and ``group``, a folder that
    keeps where the consumer group began: its first start takes the topic's
    end offsets, a restart finds the same (a pushed filter on partition and
    offset, :func:`rivulet.sources.readers.from_offsets`).

    ``per_trigger`` bounds a micro-batch (``maxOffsetsPerTrigger`` records
    for Kafka, ``maxFilesPerTrigger`` files otherwise), which also bounds
    what keyed state sees of one key per batch.
    """
    opts = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        opts.setdefault("subscribe", topic)
        opts.setdefault("startingOffsets", starting)
        opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
        if stream and per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(per_trigger))
        df = reader.format("kafka").options(**opts).load()
        if raw:
            return df.select("key", "value", F.col("partition").cast("int").alias("partition"),
                             "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
        return from_kafka(df)
    if stream and per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(per_trigger))
    if fmt in ("json", "csv"):
        opts = {**TEXT_FORMAT_OPTIONS, **opts}
    schema = RAW_ENVELOPE if raw else ENVELOPE
    df = reader.format(fmt).schema(schema).options(**opts).load(topic).select(*FIELDS)
    if starting == "earliest":
        return df
    if starting != "latest" or not group:
        raise ValueError("a stored topic is read from earliest, or from latest by a group")
    from rivulet.sinks.topic_log import group_starts
    from rivulet.sources.readers import from_offsets
    return from_offsets(df, group_starts(spark, topic, group, starting))


def record_fields(df: DataFrame) -> DataFrame:
    """SRC3: ``record.key() value() partition() offset()``."""
    return df.select("key", "value", "partition", "offset")


def read_lines(spark: SparkSession, path: str, *, stream: bool = False, key: str | None = None,
               options: dict | None = None) -> DataFrame:
    """SRC8 / SRC9: one record per text line (console or file source).

    ``key`` gives every line the same key, as the line producer does with
    ``"1"`` (REC12); otherwise the key is null.
    """
    reader = spark.readStream if stream else spark.read
    df = reader.options(**(options or {})).text(path)
    return df.select(F.lit(key).cast("string").alias("key"), F.col("value"))
