"""Session helpers: a tuned local session for tests/bench, and the shared
scratch/checkpoint folder every job that cuts lineage or writes state uses."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a cluster job would also want; the cluster's own settings win
# because ``getOrCreate`` keeps an existing session's configuration.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for a large cluster (about 100 TB of input, on the order of a
# thousand executors).  Shuffle partitions are set high and adaptive
# execution coalesces them to ~256 MB each, so a stage neither spills
# because partitions are too big nor drowns in tiny tasks; scans split at
# 256 MB; skewed shuffle-join partitions are split; keyed streaming state
# lives in RocksDB.  ``spark.checkpoint.dir`` must name a shared folder.
CLUSTER_CONF = {
    **_DEFAULTS,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "rivulet.order.bucketSeconds": "600",
}


def cluster_session(app_name: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """Session for a cluster deployment: the master, executors and
    ``spark.checkpoint.dir`` come from the submit command; this adds
    :data:`CLUSTER_CONF` where the deployment did not set a value."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static settings belong to spark-submit
            pass
    checkpoint_dir(spark)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (``local[N]``, UI off)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem or
    object store).  Only a local-mode session without it gets a private
    temporary folder, as in tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/rivulet-scratch/{name}-{uuid.uuid4().hex[:12]}"
