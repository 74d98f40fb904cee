"""LIVE12 / SNK7 streaming form: a multi-panel dashboard refreshed per micro-batch.

One ``foreachBatch`` caches the batch once and refreshes every panel from
it, merging with the previous version of the dashboard table:

* ``latest``  - replacing gauge: newest reading per category wins;
* ``total``   - accumulating gauge: start + all increments so far;
* ``history`` - running total over everything, newest ``n`` points kept.

The table is ``(panel, series, x_time, x_cat, y)`` plus the order key of
the reading behind each row, versioned by batch id (a retried batch
rewrites its own version), and optionally published as JSON for a page.
All merges are small per-panel aggregates or the bucketed running sum.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.live import last_n
from rivulet.operators.ordered import Order, running_sum
from rivulet.streaming.snapshot import _prune, publish_json, read_latest, read_version, run_folder

# Series of the row that carries a history panel's total between batches,
# whatever the order of its readings.
CARRY = "__carry"

STATE_COLUMNS = ("panel", "series", "x_time", "x_cat", "y", "__ots", "__oid")


@dataclass(frozen=True)
class PanelSpec:
    """One panel.  ``prepare(batch)`` yields readings
    ``(category, ts, event_id, value)`` (category may be null for history)."""
    name: str
    series: str
    kind: str  # latest | total | history
    prepare: Callable[[DataFrame], DataFrame]
    domain: Sequence[str] = field(default_factory=tuple)
    start: int = 10
    n: int = 720


def _state(df: DataFrame, spec: PanelSpec, x_time=None, x_cat=None, y="y", ots=None, oid=None) -> DataFrame:
    return df.select(F.lit(spec.name).alias("panel"), F.lit(spec.series).alias("series"),
                     (x_time if x_time is not None else F.lit(None)).cast("timestamp_ntz").alias("x_time"),
                     (x_cat if x_cat is not None else F.lit(None)).cast("string").alias("x_cat"),
                     F.col(y).cast("bigint").alias("y"),
                     (ots if ots is not None else F.lit(None)).cast("timestamp_ntz").alias("__ots"),
                     (oid if oid is not None else F.lit(None)).cast("bigint").alias("__oid"))


def _with_domain(values: DataFrame, spec: PanelSpec) -> DataFrame:
    """Domain order and start values; categories outside the domain dropped."""
    entries = [F.struct(F.lit(i).alias("ord"), F.lit(c).alias("x_cat")) for i, c in enumerate(spec.domain)]
    dom = values.sparkSession.range(1).select(F.inline(F.array(*entries)))
    shown = values.where(F.col("x_cat").isin(list(spec.domain)))
    j = F.broadcast(dom).join(F.broadcast(shown), "x_cat", "left")
    return j.select(F.lit(spec.name).alias("panel"), F.lit(spec.series).alias("series"),
                    F.lit(None).cast("timestamp_ntz").alias("x_time"), "x_cat",
                    F.coalesce("y", F.lit(spec.start).cast("bigint")).alias("y"), "__ots", "__oid")


def _refresh(spec: PanelSpec, prev: DataFrame | None, batch: DataFrame) -> DataFrame:
    r = spec.prepare(batch)
    old = prev.where(F.col("panel") == spec.name) if prev is not None else None
    if spec.kind == "latest":
        newest = F.max(F.struct(F.col("ts").alias("o1"), F.col("event_id").alias("o2"), F.col("value").alias("v")))
        cur = r.groupBy(F.col("category").alias("x_cat")).agg(newest.alias("__m")).select(
            "x_cat", F.col("__m.v").alias("y"), F.col("__m.o1").alias("__ots"), F.col("__m.o2").alias("__oid"))
        if old is not None:
            seen = old.where(F.col("__ots").isNotNull()).select("x_cat", "y", "__ots", "__oid")
            both = cur.unionByName(seen)
            pick = F.max(F.struct("__ots", "__oid", "y"))
            cur = both.groupBy("x_cat").agg(pick.alias("__m")).select(
                "x_cat", F.col("__m.y").alias("y"), F.col("__m.__ots").alias("__ots"),
                F.col("__m.__oid").alias("__oid"))
        return _with_domain(cur, spec)
    if spec.kind == "total":
        cur = r.groupBy(F.col("category").alias("x_cat")).agg(F.sum("value").alias("__inc"),
                                                             F.max("ts").alias("__ots"))
        if old is not None:
            base = old.select("x_cat", (F.col("y") - F.lit(spec.start)).alias("__inc"), "__ots")
            cur = cur.unionByName(base).groupBy("x_cat").agg(F.sum("__inc").alias("__inc"),
                                                             F.max("__ots").alias("__ots"))
        cur = cur.select("x_cat", (F.lit(spec.start) + F.col("__inc")).alias("y"), "__ots",
                         F.lit(None).cast("bigint").alias("__oid"))
        return _with_domain(cur, spec)
    if spec.kind == "history":
        carry = 0
        if old is not None:
            top = old.where(F.col("series") == CARRY).select("y").first()
            carry = int(top["y"]) if top is not None else 0
        totals = running_sum(r, F.col("value"), Order.by_time("ts", "event_id"), out="total", seed=carry)
        cur = _state(totals, spec, x_time=F.col("ts"), y="total", ots=F.col("ts"), oid=F.col("event_id"))
        if old is not None:
            cur = cur.unionByName(old.where(F.col("series") != CARRY))
        done = r.agg((F.coalesce(F.sum("value"), F.lit(0)) + F.lit(carry)).alias("y"))
        return last_n(cur, spec.n, ["__ots", "__oid"]).unionByName(
            _state(done, spec).withColumn("series", F.lit(CARRY)))
    raise ValueError(f"unknown panel kind {spec.kind}")


def dashboard_sink(path: str, panels: Sequence[PanelSpec], json_path: str | None = None,
                   keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function maintaining the dashboard table at ``path``
    (and, if given, its visible columns as one JSON document at ``json_path``)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(spark, path)
        prev = read_version(spark, folder, before=batch_id)
        batch = batch.persist()
        try:
            parts = [_refresh(p, prev, batch).select(*STATE_COLUMNS) for p in panels]
            table = parts[0]
            for p in parts[1:]:
                table = table.unionByName(p)
            table.write.mode("overwrite").parquet(f"{folder}/v={batch_id}")
        finally:
            batch.unpersist()
        _prune(spark, folder, keep_versions)
        if json_path:
            # the panel table is bounded (domains and n points), one JSON file
            publish_json(visible(read_latest(spark, path)), json_path, batch_id, keep_versions)
    return run


def visible(table: DataFrame) -> DataFrame:
    return table.where(F.col("series") != CARRY).select("panel", "series", "x_time", "x_cat", "y")
