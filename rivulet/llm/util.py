"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from rivulet.session import scratch_path


def by_value(module: str) -> None:
    """Ship a module's task functions by value, so that Python workers need
    this package neither installed nor on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage is
    cut there, so a lost executor costs at most the tasks after it, and the
    shuffles before it need not be kept."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the path for :func:`drop`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")  # the shuffles of this write go when it ends
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no live plan reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where the table has such a column
    (Spark tells names apart without regard to case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def row_chunks(batches: Iterable, limit: int) -> Iterator[list[tuple]]:
    """Rows ``(id, text)`` of Arrow batches in lists of about ``limit``
    characters (one longer text makes a list of its own); a null text is
    empty."""
    rows: list[tuple] = []
    size = 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            t = t or ""
            if rows and size + len(t) > limit:
                yield rows
                rows, size = [], 0
            rows.append((i, t))
            size += len(t)
    if rows:
        yield rows


by_value(__name__)
