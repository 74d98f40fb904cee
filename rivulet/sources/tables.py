"""Topic views over the given test tables (the broker-less stand-in for a topic).

Each view yields the record envelope ``(key, value, partition, offset,
timestamp)``; offsets are numbered per partition in arrival order with the
bucketed sequence operator, so no view ever funnels a partition through one
task.  Views that do not need offsets can skip them (``offsets=False``) and
then cost a plain scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.ordered import Order, sequence_number

# Fixed value from the test-table adaptation: four topic partitions.
PARTITIONS = 4
# Bucket widths of the arrival-order operators: None = the session setting
# (``rivulet.order.bucketSeconds`` / ``bucketWidth``) or, without one,
# sized from the data (see :class:`rivulet.operators.ordered.Order`).
TIME_BUCKET_SECONDS = None
ID_BUCKET_WIDTH = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A test table as a file stream.  A table that is a directory is streamed
    whole; of a single file (the file source needs a directory) its folder is,
    with a glob filter.  Without ``files_per_trigger`` a micro-batch takes all
    files that there are, so that none waits for another or comes late."""
    static = table(spark, sf_dir, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    stream = spark.readStream.schema(static.schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return stream.parquet(path.toString())
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/"))


def events_topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a streaming topic: the envelope without offsets (a stream
    cannot number rows with a window), ordered by ``(timestamp, event_id)``."""
    return _as_records(stream_table(spark, sf_dir, "events"))


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as records that a producer sends: no offsets yet."""
    return _as_records(table(spark, sf_dir, "events"))


def _as_records(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_type").alias("key"),
        F.format_string("%d\t%s %s", "user_id", "event_type", "props").alias("value"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("ts").alias("timestamp"), "event_id")


def _number(df: DataFrame, order: Order) -> DataFrame:
    numbered = sequence_number(df, order, partition_by=["partition"], out="__seq")
    return numbered.withColumn("offset", (F.col("__seq") - 1).cast("bigint")).drop("__seq")


def env_events(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    """``events`` as a topic: key = event_type, value = ``user_id\\tevent_type props``,
    partition = user_id % 4, offsets in ``(ts, event_id)`` order."""
    df = events_table(spark, sf_dir)
    if offsets:
        df = _number(df, Order.by_time("timestamp", "event_id", seconds=TIME_BUCKET_SECONDS))
        return df.select("key", "value", "partition", "offset", "timestamp")
    return df.select("key", "value", "partition", "timestamp")


def env_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``env_events`` with what a real topic has: records without a key,
    tombstones, ``NULL`` first fields, and a key whose newest records are deletes."""
    ev = env_events(spark, sf_dir)
    o, late = F.col("offset"), F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")
    value = (F.when((o % 13 == 5) | ((F.col("key") == "signup") & late), F.lit(None))
             .when(o % 7 == 2, F.concat(F.lit("NULL\t"), F.col("value"))).otherwise(F.col("value")))
    return ev.withColumns({"key": F.when(o % 11 != 3, F.col("key")), "value": value})


def env_docs(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    """``documents`` as a topic: key = lang, value = text, partition = doc_id % 4,
    offsets in doc_id order, no timestamp."""
    docs = table(spark, sf_dir, "documents")
    df = docs.select(F.col("lang").alias("key"), F.col("text").alias("value"),
                     (F.col("doc_id") % PARTITIONS).cast("int").alias("partition"),
                     F.lit(None).cast("timestamp_ntz").alias("timestamp"), "doc_id")
    if offsets:
        df = _number(df, Order.by_number("doc_id", width=ID_BUCKET_WIDTH))
        return df.select("key", "value", "partition", "offset", "timestamp")
    return df.select("key", "value", "partition", "timestamp")


def env_turns(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    """``conversations`` as a topic: key = role, value = text,
    partition = conv_id % 4, offsets in ``(conv_id, turn)`` order."""
    conv = table(spark, sf_dir, "conversations")
    df = conv.select(F.col("role").alias("key"), F.col("text").alias("value"),
                     (F.col("conv_id") % PARTITIONS).cast("int").alias("partition"),
                     F.lit(None).cast("timestamp_ntz").alias("timestamp"), "conv_id", "turn")
    if offsets:
        df = _number(df, Order.by_number("conv_id", "turn", width=ID_BUCKET_WIDTH))
        return df.select("key", "value", "partition", "offset", "timestamp")
    return df.select("key", "value", "partition", "timestamp")


def live_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text points for the live chart: ``(series, ts, event_id, text)``.

    By ``event_id % 10``: 0 = ``bad`` + type, 1 = the double as text,
    2 = `` +1_000 ``, otherwise ``floor(value)`` as text.
    """
    ev = table(spark, sf_dir, "events")
    m = F.col("event_id") % 10
    text = (F.when(m == 0, F.concat(F.lit("bad"), F.col("event_type")))
            .when(m == 1, F.col("value").cast("string"))
            .when(m == 2, F.lit(" +1_000 "))
            .otherwise(F.floor("value").cast("bigint").cast("string")))
    return ev.select(F.col("event_type").alias("series"), "ts", "event_id", text.alias("text"))


def gauge_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category readings: ``(category, ts, event_id, value)`` with value = floor(value)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("category"), "ts", "event_id",
                     F.floor("value").cast("bigint").alias("value"))


def wide_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide readings ``(time, event_id, cpu, memory, disk)``: cpu = user_id,
    memory = value, disk = the ``k`` field of props."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("time"), "event_id",
                     (F.col("user_id") * F.lit(1.0)).cast("double").alias("cpu"),
                     F.col("value").cast("double").alias("memory"),
                     F.get_json_object("props", "$.k").cast("double").alias("disk"))
