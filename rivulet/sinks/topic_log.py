"""Appending to a stored topic with partitions and dense offsets (SNK1, SNK3).

A stored topic is a folder that any reader of envelope files can read::

    topic/batch=<n>/partition=<p>/part-*        records, offsets p's next ones
    topic/batch=<n>/_state.json                 end offsets and producers after it
    topic/_staging/<token>/...                  what has not been committed

*Partition*: the record's own one, else the hash of its key, else (no key) of
its value.  *Offset*: distributed and dense.  The records of a task are put in
partition order and numbered by Spark's own row ids, which are written with
them; a table of (task, partition) counts then gives every run its base - the
end offset of the last commit plus the counts of the tasks before - and the
records meet it in an equi-join.  With ``order`` the records are first dealt by
ranges of (partition, order), so that a hot partition spreads over many tasks
and offsets follow that order.

*Commit*: everything is written under ``_staging`` and renamed to
``batch=<n>`` in one step, which fails where that name exists (another producer
was first: offsets are then given anew after its end).  The state file in the
folder names each producer's last batch, so a batch that is tried again after
its commit is left out, and one that crashed before it is written as if for the
first time: no gap and no duplicate.  The rename is atomic on HDFS and local
file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.sinks import files

#: Fixed value: ``num.partitions`` of a topic that does not say.
PARTITIONS = 1
STATE = "_state.json"
# Spark's row ids: the task's number above, its row's number below.
_TASK_BITS = 33


def commits(spark: SparkSession, topic: str) -> list[int]:
    """Numbers of the committed batches, rising."""
    return sorted(int(n[6:]) for n in files.folders(spark, topic) if n.startswith("batch="))


def state(spark: SparkSession, topic: str) -> dict:
    """The newest commit's state: ``commit`` (-1: none), ``ends`` (next offset
    of each partition: one entry a topic partition) and ``producers`` (last
    batch of each), ``partitions``."""
    done = commits(spark, topic)
    if not done:
        return {"commit": -1, "ends": {}, "producers": {}, "partitions": None}
    got = json.loads(files.read_text(spark, f"{topic}/batch={done[-1]}/{STATE}"))
    got["ends"] = {int(p): n for p, n in got["ends"].items()}
    return got


def end_offsets(spark: SparkSession, topic: str) -> dict[int, int]:
    """Next offset of each partition, without reading the topic."""
    return state(spark, topic)["ends"]


def partition_of(partitions: int, columns: Sequence[str]) -> Column:
    """The record's own partition, else the hash of its key, else of its
    value."""
    hashed = F.xxhash64("value")
    if "key" in columns:
        hashed = F.when(F.col("key").isNotNull(), F.xxhash64("key")).otherwise(hashed)
    hashed = F.pmod(hashed, F.lit(partitions)).cast("int")
    return F.coalesce(F.col("partition").cast("int"), hashed) if "partition" in columns else hashed


def _stage(batch: DataFrame, folder: str, partitions: int, order: Sequence[str]) -> DataFrame:
    """The batch in partition order, numbered by task and row, as written."""
    spark = batch.sparkSession
    out = batch.withColumn("partition", partition_of(partitions, batch.columns))
    if "key" not in out.columns:
        out = out.withColumn("key", F.lit(None).cast("string"))
    if "timestamp" not in out.columns:
        out = out.withColumn("timestamp", F.current_timestamp().cast("timestamp_ntz"))
    if order:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, "partition", *order).sortWithinPartitions("partition", *order)
    else:  # a task's records in the order in which they came
        out = out.withColumn("__came", F.monotonically_increasing_id()).sortWithinPartitions("partition", "__came")
    out = out.select("key", "value", "partition", "timestamp").withColumn("__id", F.monotonically_increasing_id())
    out.write.mode("overwrite").parquet(f"{folder}-rows")
    return spark.read.schema(out.schema).parquet(f"{folder}-rows")


def _with_offsets(rows: DataFrame, ends: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Records with offsets, and the new records of each partition."""
    spark = rows.sparkSession
    task = F.shiftright("__id", _TASK_BITS)
    runs = rows.groupBy("partition", task.alias("__task")).agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    known = spark.createDataFrame(sorted(ends.items()) or [], "partition int, __end bigint")
    before = Window.partitionBy("partition").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce("__end", F.lit(0)) + F.coalesce(F.sum("__n").over(before), F.lit(0))
    shift = (runs.join(known, "partition", "left").withColumn("__shift", base - F.col("__first"))
             .select("partition", "__task", "__shift"))
    out = rows.withColumn("__task", task).join(shift, ["partition", "__task"])
    out = out.select("key", "value", "partition", (F.col("__id") + F.col("__shift")).alias("offset"), "timestamp")
    stamp = [f(F.unix_micros(F.col("timestamp").cast("timestamp"))) for f in (F.min, F.max)]
    return out, rows.groupBy("partition").agg(F.count("*").alias("n"), stamp[0].alias("t0"), stamp[1].alias("t1"))


def append(batch: DataFrame, topic: str, *, partitions: int | None = None, order: Sequence[str] = (),
           producer: str | None = None, batch_id: int = 0, fmt: str = "parquet", options: dict | None = None,
           before_commit: Callable[[], None] | None = None) -> int | None:
    """Append records ``(key?, value, partition?, timestamp?)`` as one commit;
    its number, or None if this producer's batch is there already or empty.

    ``partitions``: of a new topic (a topic keeps its number); ``order``:
    columns of the batch that offsets follow within a partition, without ties.
    ``producer``/``batch_id``: name a batch that may be tried again.
    ``before_commit`` is called between the last write and the commit.
    """
    spark = batch.sparkSession
    topic = topic.rstrip("/")
    token = f"{producer or uuid.uuid4().hex}-{batch_id}"
    folder = f"{topic}/_staging/{token}"
    now = state(spark, topic)
    if producer and now["producers"].get(producer, -1) >= batch_id:
        return None
    held = now["partitions"] or partitions or PARTITIONS
    if partitions and held != partitions:
        raise ValueError(f"the topic has {held} partitions, not {partitions}")
    rows = _stage(batch, folder, held, order)
    try:
        while True:
            out, news = _with_offsets(rows, now["ends"])
            held_by = {r.partition: (r.n, r.t0, r.t1) for r in news.collect()}  # one row a topic partition
            new = {p: n for p, (n, _, _) in held_by.items()}
            if not new:
                return None
            ends = {**now["ends"], **{p: now["ends"].get(p, 0) + n for p, n in new.items()}}
            producers = {**now["producers"], **({producer: batch_id} if producer else {})}
            (out.write.mode("overwrite").format(fmt).options(**(options or {})).partitionBy("partition").save(folder))
            commit = now["commit"] + 1
            files.write_text(spark, f"{folder}/{STATE}", json.dumps(
                {"commit": commit, "ends": ends, "producers": producers, "partitions": held,
                 "batch": {p: [now["ends"].get(p, 0), ends[p], t0, t1] for p, (_, t0, t1) in held_by.items()}}))
            if before_commit:
                before_commit()
            if files.rename_new(spark, folder, f"{topic}/batch={commit}"):
                return commit
            now = state(spark, topic)  # another producer was first
            if producer and now["producers"].get(producer, -1) >= batch_id:
                return None
    finally:
        files.delete(spark, f"{folder}-rows", folder)


def append_batches(topic: str, *, partitions: int | None = None, order: Sequence[str] = (), fmt: str = "parquet",
                   options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` form: the streaming query is the producer."""
    from rivulet.streaming.snapshot import _QUERY_ID

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        append(batch, topic, partitions=partitions, order=order, producer=query, batch_id=batch_id, fmt=fmt, options=options)
    return run


def batches(spark: SparkSession, topic: str) -> list[dict]:
    """What the commits say of their own records: ``commit``, ``partition``,
    ``first_offset``, ``end_offset``, and the least and greatest timestamp in
    microseconds of the session's clock - one entry a commit and partition, read
    from the state files alone."""
    out = []
    for n in commits(spark, topic):
        got = json.loads(files.read_text(spark, f"{topic}/batch={n}/{STATE}"))
        out += [{"commit": n, "partition": int(p), "first_offset": b[0], "end_offset": b[1], "from": b[2], "to": b[3]}
                for p, b in sorted(got["batch"].items())]
    return out


def summary(spark: SparkSession, topic: str) -> DataFrame:
    """OPS6 of a stored topic, the columns of
    :func:`rivulet.operators.topics.topic_summary`, from its commits: no record
    is read."""
    rows = spark.createDataFrame([tuple(b.values()) for b in batches(spark, topic)],
                                 "commit bigint, partition int, first_offset bigint, end_offset bigint, `from` bigint, `to` bigint")
    stamp = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return rows.groupBy("partition").agg(
        F.min("first_offset").alias("first_offset"), (F.max("end_offset") - 1).alias("last_offset"),
        F.sum(F.col("end_offset") - F.col("first_offset")).cast("bigint").alias("records"),
        stamp(F.min("from")).alias("first_timestamp"), stamp(F.max("to")).alias("last_timestamp"))


def lag(spark: SparkSession, topic: str, committed: DataFrame) -> DataFrame:
    """OPS5 of a stored topic, the columns of
    :func:`rivulet.operators.topics.lag`, from its commits."""
    ends = summary(spark, topic).select("partition", (F.col("last_offset") + 1).alias("end_offset"), "records")
    c = committed.select(F.col("partition").alias("__p"), "committed")
    return ends.join(c, F.col("partition") == F.col("__p"), "left").select(
        "partition", "end_offset", "committed", F.coalesce(F.col("end_offset") - F.col("committed"), F.col("records")).alias("lag"))


def retain(spark: SparkSession, topic: str, hours: int) -> list[int]:
    """OPS3 on a stored topic: delete the commits whose records are all older
    than the newest record less ``hours``; their numbers.  Like a broker's log,
    what is deleted are whole files: records that are too old stay while one of
    their commit is young (:func:`rivulet.operators.topics.retention` filters
    those).  The newest commit, which holds the topic's state, stays."""
    held = batches(spark, topic)
    newest = max((b["to"] for b in held if b["to"] is not None), default=None)
    if newest is None:
        return []
    cut = newest - hours * 3_600_000_000
    last = max(b["commit"] for b in held)
    young = {b["commit"] for b in held if b["to"] is None or b["to"] >= cut} | {last}
    old = sorted({b["commit"] for b in held} - young)
    files.delete(spark, *[f"{topic.rstrip('/')}/batch={n}" for n in old])
    return old


def group_starts(spark: SparkSession, topic: str, group: str, starting: str = "latest") -> dict[int, int]:
    """Start offsets of a consumer group on a stored topic, for
    :func:`rivulet.sources.readers.from_offsets`.  A new group gets the topic's
    ends (``latest``) or nothing (``earliest``), written once to the folder
    ``group``: a restart finds the same positions."""
    path = f"{group.rstrip('/')}/starts.json"
    got = files.read_text(spark, path)
    if got is None:
        starts = end_offsets(spark, topic) if starting == "latest" else {}
        files.publish(spark, path, json.dumps(starts))
        got = files.read_text(spark, path)
    return {int(p): n for p, n in json.loads(got).items()}


def has_positions(columns: Sequence[str]) -> bool:
    """Records that carry both partition and offset keep them."""
    return {"partition", "offset"} <= set(columns)

