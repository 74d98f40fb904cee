"""Starting, resuming and draining streaming queries (SRC5, SRC6, LIVE13, AGG6, OPS1, OPS2).

Every query gets its own checkpoint folder under the shared
``spark.checkpoint.dir`` (two applications must never share one, unlike the
reference's two Streams apps that share an application id).  Restarting
on the same checkpoint resumes where the last committed micro-batch ended
(the Spark analogue of ``commitAsync`` after processing).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import scratch_path


def trigger_args(trigger: str | None) -> dict:
    """``'available-now'`` (read what exists, then stop - the bounded drain),
    ``'once'``, or a processing-time cadence such as ``'1 second'`` (the
    chart refresh ticks 20 ms / 1 s / 2 s / 5 s)."""
    if trigger in (None, "available-now"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start(df: DataFrame, *, sink: str = "memory", output_mode: str = "append",
          checkpoint: str | None = None, trigger: str | None = "available-now",
          query_name: str | None = None, path: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          options: dict | None = None, conf: dict | None = None) -> StreamingQuery:
    """Start a streaming query with its own checkpoint.

    ``sink`` is a format (``memory``, ``parquet``, ``json``, ``text``,
    ``console``, ``kafka``) or ``foreachBatch`` with a callable.  ``conf``:
    session settings of this query alone (Spark copies the session's as a
    query starts; they are put back afterwards).
    """
    spark = df.sparkSession
    if conf:
        before = {k: spark.conf.get(k, None) for k in conf}
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            return start(df, sink=sink, output_mode=output_mode, checkpoint=checkpoint, trigger=trigger,
                         query_name=query_name, path=path, foreach_batch=foreach_batch, options=options)
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
    ckpt = checkpoint or scratch_path(spark, "checkpoint")
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
         .trigger(**trigger_args(trigger)))
    if query_name:
        w = w.queryName(query_name)
    if options:
        w = w.options(**options)
    if foreach_batch is not None or sink == "foreachBatch":
        return w.foreachBatch(foreach_batch).start()
    w = w.format(sink)
    return w.start(path) if path else w.start()


def drain(q: StreamingQuery) -> None:
    """Wait for an available-now / once query and surface its failure."""
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def stamp_arrival(df: DataFrame, col: str = "time") -> DataFrame:
    """LIVE14: arrival time of each row (constant within one micro-batch)."""
    return df.withColumn(col, F.current_timestamp().cast("timestamp_ntz"))


def mirror(spark: SparkSession, source: str, target: str, *, fmt: str = "parquet",
           checkpoint: str | None = None, trigger: str | None = "available-now",
           source_options: dict | None = None, target_options: dict | None = None) -> StreamingQuery:
    """OPS1: copy a topic into another, record by record, resumable."""
    from rivulet.sources.envelope import read_topic
    stream = read_topic(spark, source, fmt=fmt, stream=True, options=source_options)
    if fmt == "kafka":
        opts = dict(target_options or {})
        opts.setdefault("topic", target)
        return start(stream.select("key", "value"), sink="kafka", checkpoint=checkpoint,
                     trigger=trigger, options=opts)
    from rivulet.sinks.writers import to_topic
    return to_topic(stream, target, fmt=fmt, checkpoint=checkpoint, trigger=trigger,
                    options=target_options)


def replay(spark: SparkSession, source: str, *, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """OPS2: reprocess a topic from the beginning - a batch read at earliest
    (or, for a streaming app, a start on a fresh checkpoint)."""
    from rivulet.sources.envelope import read_topic
    return read_topic(spark, source, fmt=fmt, stream=False, starting="earliest", options=options)


def run_to_files(df: DataFrame, *, output_mode: str = "append", path: str | None = None,
                 checkpoint: str | None = None, keys=None) -> DataFrame:
    """Drain a streaming DataFrame (available-now) into files under the shared
    checkpoint folder and return them as a batch DataFrame.

    ``append``: the file sink (exactly-once through its metadata log).
    ``update`` (keyed tables, ``keys`` given): each micro-batch writes only
    its changed rows as a segment of a compacted changelog
    (:mod:`rivulet.streaming.changelog`), whose table is the newest row per
    key.  Work per batch is proportional to the changes (a row is merged
    once a level), not to the table.
    ``complete``: each micro-batch overwrites version ``v=<batch_id>``.
    Nothing is collected on the driver, unlike the memory sink.
    """
    from rivulet.streaming.snapshot import maintain, read_latest
    spark = df.sparkSession
    path = path or scratch_path(spark, "stream-out")
    if output_mode == "append":
        drain(start(df, sink="parquet", path=path, checkpoint=checkpoint))
        return spark.read.parquet(path)
    if output_mode == "update":
        if not keys:
            raise ValueError("update mode needs the table's key columns")

        from rivulet.streaming.changelog import changelog_writer, read_changelog
        drain(start(df, output_mode="update", checkpoint=checkpoint, foreach_batch=changelog_writer(path, keys)))
        return read_changelog(spark, path, keys)
    if output_mode != "complete":
        raise ValueError(f"unknown output mode {output_mode}")
    drain(start(df, output_mode="complete", checkpoint=checkpoint,
                foreach_batch=maintain(path, lambda prev, batch: batch)))
    latest = read_latest(spark, path)
    if latest is None:
        raise RuntimeError("the stream produced no micro-batch")
    return latest


def stop_when_idle(q: StreamingQuery, idle_batches: int = 100, poll_seconds: float = 1.0,
                   timeout_seconds: float | None = None) -> int:
    """SRC6: stop a continuously triggered query after more than
    ``idle_batches`` empty polls - polls that find no micro-batch running, no
    data waiting and no batch with records ended since the poll before (Spark
    runs no micro-batch without data, so the polls are counted here; like the
    reference, the count is not reset by data).  Returns the number of empty
    polls.  Only the query's own status and progress reports are read."""
    import time as _time
    seen: set = set()
    empty, started = 0, _time.time()
    while q.isActive:
        _time.sleep(poll_seconds)
        status = q.status
        # a micro-batch reports its rows only when it ends
        new = bool(status["isTriggerActive"] or status["isDataAvailable"])
        for p in q.recentProgress:
            bid = p.get("batchId")
            if bid is not None and bid not in seen and p.get("numInputRows", 0) > 0:
                seen.add(bid)
                new = True
        if not new:
            empty += 1
        if empty > idle_batches or (timeout_seconds and _time.time() - started > timeout_seconds):
            q.stop()
            break
    return empty
