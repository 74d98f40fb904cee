"""Runnable streaming applications: the reference's programs as Spark jobs.

Each app reads a topic (Kafka, or a directory of envelope files), runs the
operators of :mod:`rivulet` and writes to a sink, with its own checkpoint
under ``spark.checkpoint.dir`` (or ``--checkpoint``).  ``--trigger`` is
``available-now`` (drain what exists and stop) or a cadence such as
``1 second``.  The master and the executors are those of the submit command.

    spark-submit -m rivulet.apps wordcount --source DIR --sink DIR
    ... wordcount --fmt kafka --option kafka.bootstrap.servers=h:9092 --source in \\
        --sink out --sink-fmt kafka          (string keys, 8-byte counts)
    ... tour --flag groupby --source DIR --sink DIR
    ... consumer --source DIR --trigger "1 second" --idle 100 --starting latest
    ... viewer --source DIR --sink DIR      (records before the stop message)
    ... livechart | timeseries | gauges | dashboard --source DIR --sink DIR
    ... produce --source TEXT_DIR --sink DIR --key 1
    ... mirror --source DIR --sink DIR
"""

from __future__ import annotations

import argparse
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import live as L
from rivulet.operators import records as R
from rivulet.operators import tables as T
from rivulet.operators.ordered import Order
from rivulet.sinks import writers as W
from rivulet.sources.envelope import read_lines, read_topic
from rivulet.sources.readers import SENTINEL
from rivulet.streaming import changelog as CL
from rivulet.streaming import runner as RN
from rivulet.streaming import snapshot as SN
from rivulet.streaming.dashboard import PanelSpec, dashboard_sink

ORDER = ["timestamp", "partition", "offset"]
LAST_N = 20
HISTORY_N = 3600


def _source(spark: SparkSession, a) -> DataFrame:
    group = {"group": f"{a.checkpoint}-group"} if a.starting == "latest" and a.fmt != "kafka" else {}
    return read_topic(spark, a.source, fmt=a.fmt, stream=True, starting=a.starting, options=a.options,
                      per_trigger=a.per_trigger, **group)


def _records(df: DataFrame, a) -> object:
    """Records into the sink topic."""
    return W.to_topic(df, a.sink, fmt=a.sink_fmt, checkpoint=a.checkpoint, trigger=a.trigger,
                      options=a.options if a.sink_fmt == "kafka" else None)


def _counts(table: DataFrame, a, value: str = "count") -> object:
    """A keyed table's changelog: to a Kafka topic each changed key with its
    8-byte value (the newest record per key is the table), to files as
    segments that :func:`rivulet.streaming.changelog.read_changelog` reads."""
    if a.sink_fmt == "kafka":
        return W.to_topic(W.long_values(table, value), a.sink, fmt="kafka", checkpoint=a.checkpoint,
                          trigger=a.trigger, output_mode="update", options=a.options)
    return RN.start(table, output_mode="update", checkpoint=a.checkpoint, trigger=a.trigger,
                    foreach_batch=CL.changelog_writer(a.sink, ["key"]))


def wordcount(spark: SparkSession, a) -> object:
    """Word count: lower, split on non-word runs, count per word."""
    words = T.word_count(_source(spark, a))
    return _counts(words.withColumnRenamed("word", "key"), a)


TOUR: dict[str, Callable[[DataFrame], DataFrame]] = {
    "branch": lambda df: R.branch_outputs(df, lambda k, v: k.startswith("C"),
                                          lambda k, v: k.startswith("T"), F.lit(True))[0],
    "filter": lambda df: R.filter_records(df, R.first_tab_field_is_not()),
    "flatMap": lambda df: R.flat_map(df, R.hey_hi),
    "map": lambda df: R.map_records(df, R.lower_and_length),
    "selectKey": lambda df: R.select_key(df, R.first_word_key),
    "foreach": lambda df: R.format_line(df, R.FOREACH_FORMAT).select(F.col("line").alias("value")),
}


def tour(spark: SparkSession, a) -> object:
    """The operator tour: only the operator chosen by ``--flag`` runs.
    ``groupbyKey`` / ``groupby`` write count tables; the others write records."""
    src = _source(spark, a)
    if a.flag in ("groupbyKey", "groupby"):
        counts = T.count_by_key(src) if a.flag == "groupbyKey" else T.count_by(src, T.upper_value)
        return _counts(counts, a)
    if a.flag == "map_print":
        return W.to_console(W.console_lines(TOUR["map"](src)), checkpoint=a.checkpoint, trigger=a.trigger,
                            options={"truncate": "false"})
    out = TOUR[a.flag](src)
    if a.flag == "foreach":
        return W.to_text(out, a.sink, checkpoint=a.checkpoint, trigger=a.trigger)
    return _records(out, a)


def consumer(spark: SparkSession, a) -> object:
    """The console consumer: one printed line per record."""
    src = _source(spark, a)
    return RN.start(W.console_lines(src), sink="console", checkpoint=a.checkpoint, trigger=a.trigger,
                    options={"truncate": "false"})


def livechart(spark: SparkSession, a) -> object:
    """The live line chart: number every message, parse it, keep the newest
    20 accepted points (``<sink>/history``, a versioned snapshot table).
    The counter is the distributed running count, not one-task keyed state."""
    src = _source(spark, a)
    parsed = L.parse_points(src, text="value")
    return RN.start(parsed, checkpoint=a.checkpoint, trigger=a.trigger, foreach_batch=SN.running_totals(
        f"{a.sink}/messages", f"{a.sink}/carry", None, Order.by_time(*ORDER),
        history_path=f"{a.sink}/history", history_n=LAST_N, history_where=F.col("y").isNotNull()))


def timeseries(spark: SparkSession, a) -> object:
    """The running-total time series: total of the parsed values over all
    messages, newest 3600 points kept (distributed, no single-task state)."""
    src = _source(spark, a)
    incs = L.accepted(L.parse_points(src, text="value", out="inc"), y="inc")
    return RN.start(incs, checkpoint=a.checkpoint, trigger=a.trigger, foreach_batch=SN.running_totals(
        f"{a.sink}/points", f"{a.sink}/carry", "inc", Order.by_time(*ORDER), seed=0,
        history_path=f"{a.sink}/history", history_n=HISTORY_N))


def gauges(spark: SparkSession, a) -> object:
    """Per-category gauges: start 10 plus the parsed values, per key."""
    src = _source(spark, a)
    readings = L.accepted(L.parse_points(src, text="value")).select(F.col("key").alias("category"),
                                                                    F.col("y").alias("value"))
    return _counts(L.category_total(readings).withColumnRenamed("category", "key"), a, "value")


def viewer(spark: SparkSession, a) -> object:
    """The sentinel consumer: each partition's records before its first stop
    message go to ``<sink>/records``."""
    src = _source(spark, a)
    return RN.start(src, checkpoint=a.checkpoint, trigger=a.trigger, foreach_batch=SN.take_until_batches(
        f"{a.sink}/records", f"{a.sink}/stopped", F.col("value") == SENTINEL))


def dashboard(spark: SparkSession, a) -> object:
    """Gauges per key (newest and accumulated) and a running total, refreshed
    together per micro-batch; the page reads the JSON document that
    :func:`rivulet.streaming.snapshot.json_page` names under ``<sink>/page``."""
    def readings(batch: DataFrame) -> DataFrame:
        points = L.accepted(L.parse_points(batch, text="value"))
        return points.select(F.col("key").alias("category"), F.col("timestamp").alias("ts"),
                             F.col("offset").alias("event_id"), F.col("y").alias("value"))

    panels = [PanelSpec("latest", "value1", "latest", readings, tuple(a.domain)),
              PanelSpec("total", "value2", "total", readings, tuple(a.domain)),
              PanelSpec("history", "value3", "history", readings)]
    return RN.start(_source(spark, a), checkpoint=a.checkpoint, trigger=a.trigger,
                    foreach_batch=dashboard_sink(f"{a.sink}/table", panels, json_path=f"{a.sink}/page"))


def produce(spark: SparkSession, a) -> object:
    """The line producer: each line of a text directory becomes a record."""
    return _records(read_lines(spark, a.source, stream=True, key=a.key), a)


def mirror(spark: SparkSession, a) -> object:
    """Copy a topic into another, resumable."""
    return _records(_source(spark, a), a)


APPS = {"wordcount": wordcount, "tour": tour, "consumer": consumer, "livechart": livechart,
        "timeseries": timeseries, "gauges": gauges, "viewer": viewer, "dashboard": dashboard,
        "produce": produce, "mirror": mirror}


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="rivulet.apps")
    p.add_argument("app", choices=sorted(APPS))
    p.add_argument("--source", required=True, help="topic name (kafka) or envelope directory")
    p.add_argument("--sink", default=None, help="output directory, or topic name (kafka)")
    p.add_argument("--fmt", default="parquet", help="source format: parquet, json or kafka")
    p.add_argument("--sink-fmt", dest="sink_fmt", default="parquet", help="format of sink topics: parquet, json or kafka")
    p.add_argument("--option", dest="options", action="append", default=[], metavar="K=V",
                   help="reader and writer option, e.g. kafka.bootstrap.servers=host:9092 (repeatable)")
    p.add_argument("--starting", default="earliest", choices=["earliest", "latest"],
                   help="where a new checkpoint starts (latest on files: --checkpoint names the group)")
    p.add_argument("--flag", default="groupby", choices=sorted([*TOUR, "groupbyKey", "groupby", "map_print"]))
    p.add_argument("--key", default=None, help="produce: the key of every line")
    p.add_argument("--domain", action="append", default=[], help="dashboard: a shown category (repeatable)")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--trigger", default="available-now")
    p.add_argument("--per-trigger", dest="per_trigger", type=int, default=None,
                   help="bound of a micro-batch: records (kafka) or files; default 10,000,000 records or 1,000 files")
    p.add_argument("--idle", type=int, default=None,
                   help="with a cadence trigger: stop after more than N empty polls")
    a = p.parse_args(argv)
    if a.sink is None and not (a.app == "consumer" or a.app == "tour" and a.flag == "map_print"):
        p.error(f"{a.app} needs --sink")
    if a.starting == "latest" and a.fmt != "kafka" and not a.checkpoint:
        p.error("--starting latest on files needs --checkpoint, which names the group")
    if a.app == "dashboard" and not a.domain:
        p.error("dashboard needs --domain")
    if not all("=" in o for o in a.options):
        p.error("--option takes K=V")
    a.options = dict(o.split("=", 1) for o in a.options)
    if a.per_trigger is None:
        a.per_trigger = 10_000_000 if a.fmt == "kafka" else 1_000
    return a


def run(spark: SparkSession, argv=None):
    a = parse_args(argv)
    return APPS[a.app](spark, a)


def main(argv=None) -> None:
    from rivulet.session import cluster_session
    a = parse_args(argv)
    spark = cluster_session(f"rivulet-{a.app}")
    q = APPS[a.app](spark, a)
    if a.idle is not None and a.trigger != "available-now":
        RN.stop_when_idle(q, idle_batches=a.idle)
    q.awaitTermination()


if __name__ == "__main__":
    main()
