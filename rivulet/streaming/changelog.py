"""A keyed table's changelog as compacted segments (AGG4, SNK6).

Each micro-batch of an update-mode table writes its changed rows - one a key -
as a segment of level 0.  When the newest ``FANOUT`` segments have one level
they are merged into a segment of the next: the newest row per key, and where
the oldest segment takes part also without deletes.  A row so is rewritten once
a level, and N batches leave at most ``(FANOUT - 1) * log(N)`` live segments.

A manifest (``_manifest/<n>.json``) lists the live segments; every change is a
new manifest, written whole and renamed into place, so readers find the table
before or after a merge and never between.  Segments that a merge replaced stay
for ``GRACE`` further manifests, for readers that hold an older one, and are
then deleted.

A batch tried again is left out if a manifest has it, and overwrites its own
unlisted segment if it crashed before; the same goes for merges, whose segment
is named by the batches it covers.  Segments lie in the run's folder
(:func:`rivulet.streaming.snapshot.run_folder`), so reprocessing on a fresh
checkpoint starts a new table that replaces the old one when its first batch is
complete.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sinks import files
from rivulet.streaming.snapshot import _drop_older_runs, _runs, run_folder

FANOUT = 8
GRACE = 16


def due(segments: Sequence[dict], fanout: int = FANOUT) -> int:
    """How many of the newest segments are to be merged now (0: none)."""
    if len(segments) < fanout:
        return 0
    newest = segments[-fanout:]
    return fanout if len({s["level"] for s in newest}) == 1 else 0


def merged(segments: Sequence[dict], n: int) -> tuple[list[dict], dict]:
    """The segments after merging the newest ``n``, and the new one."""
    first, last, level = segments[-n]["first"], segments[-1]["last"], segments[-1]["level"] + 1
    new = {"name": f"segment-{first}-{last}-{level}", "first": first, "last": last, "level": level}
    return [*segments[:-n], new], new


def newest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of rows that carry ``__batch``: a hash aggregate
    of the batch number alone, then the rows that have it (a key has one row a
    batch)."""
    last = log.groupBy(*keys).agg(F.max("__batch").alias("__b")).withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)],
                F.col("__batch") == F.col("__b"))
    return log.join(last, on, "left_semi")


def manifest(spark: SparkSession, folder: str) -> dict | None:
    """The newest manifest of a run; None before its first batch."""
    numbers = _numbers(spark, folder)
    return json.loads(files.read_text(spark, f"{folder}/_manifest/{numbers[-1]}.json")) if numbers else None


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(spark, f"{folder}/_manifest") if n.endswith(".json") and n[:-5].isdigit())


def _commit(spark: SparkSession, folder: str, live: dict, segments: list[dict], grace: int) -> dict:
    """Publish the next manifest; delete what the last ``grace`` ones do not
    name."""
    n = live["number"] + 1
    gone = [{"name": s["name"], "at": n} for s in live["segments"] if s["name"] not in {t["name"] for t in segments}]
    retired = [*live["retired"], *gone]
    new = {"number": n, "segments": segments, "retired": [r for r in retired if r["at"] > n - grace]}
    if not files.publish(spark, f"{folder}/_manifest/{n}.json", json.dumps(new)):
        raise RuntimeError(f"two queries write the changelog in {folder}")
    files.delete(spark, *[f"{folder}/{r['name']}" for r in retired if r["at"] <= n - grace],
                 *[f"{folder}/_manifest/{m}.json" for m in _numbers(spark, folder) if m <= n - grace])
    return new


def _read(spark: SparkSession, folder: str, segments: Sequence[dict]) -> DataFrame:
    return spark.read.parquet(*[f"{folder}/{s['name']}" for s in segments])


def changelog_writer(path: str, keys: Sequence[str], *, tombstone: Column | None = None, fanout: int = FANOUT,
                     grace: int = GRACE) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of an update-mode table (one row a key and
    batch).  ``tombstone``: rows that delete their key."""
    keys = list(keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(spark, path)
        live = manifest(spark, folder) or {"number": -1, "segments": [], "retired": []}
        if not live["segments"] or live["segments"][-1]["last"] < batch_id:
            name = f"segment-{batch_id}-{batch_id}-0"
            batch.withColumn("__batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/{name}")
            new = {"name": name, "first": batch_id, "last": batch_id, "level": 0}
            live = _commit(spark, folder, live, [*live["segments"], new], grace)
        while n := due(live["segments"], fanout):
            segments, new = merged(live["segments"], n)
            rows = newest_rows(_read(spark, folder, live["segments"][-n:]), keys)
            if tombstone is not None and len(segments) == 1:  # nothing older is left to delete
                rows = rows.where(~F.coalesce(tombstone, F.lit(False)))
            rows.write.mode("overwrite").parquet(f"{folder}/{new['name']}")
            live = _commit(spark, folder, live, segments, grace)
        _drop_older_runs(spark, folder)
    return run


def read_changelog(spark: SparkSession, path: str, keys: Sequence[str], tombstone: Column | None = None) -> DataFrame:
    """The table behind a changelog: the newest row per key, without deletes
    where ``tombstone`` names them."""
    for folder in reversed(_runs(spark, path)):
        live = manifest(spark, folder)
        if live:
            out = newest_rows(_read(spark, folder, live["segments"]), list(keys)).drop("__batch")
            return out if tombstone is None else out.where(~F.coalesce(tombstone, F.lit(False)))
    raise FileNotFoundError(f"no micro-batch has been written to {path}")
