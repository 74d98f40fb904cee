"""Versioned snapshot tables maintained from a stream with ``foreachBatch``
(LIVE4-LIVE8 snapshot form, LIVE11, LIVE12, SNK7).

Each micro-batch writes a complete new version ``v=<batch_id>`` of the
table, computed from the newest earlier version and the batch - with the
same batch operators, so the work stays distributed.  A retried batch
overwrites its own version, so a retry is harmless; readers take the
newest version.  Nothing reaches the driver but the version list.

Versions live in one folder per run, ``run=<n>_<query id>``: a restart on the
same checkpoint has the same query id and goes on in its folder; a start on a
fresh checkpoint (reprocessing from the beginning) opens the next folder and
starts from nothing, however far the run before it had come.  Readers take the
newest run that has a complete version; only then are older runs removed.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

# Spark's own name for the id of the streaming query that a thread runs.
_QUERY_ID = "sql.streaming.queryId"


def _listing(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` (none if it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _runs(spark: SparkSession, path: str) -> list[str]:
    """Run folders of a sink, oldest first."""
    return [f"{path}/{n}" for n in sorted(n for n in _listing(spark, path) if n.startswith("run="))]


def run_folder(spark: SparkSession, path: str) -> str:
    """The folder of the run whose micro-batch this thread processes."""
    query = spark.sparkContext.getLocalProperty(_QUERY_ID) or "direct"
    runs = _runs(spark, path)
    for r in runs:
        if r.endswith(f"_{query}"):
            return r
    last = int(runs[-1].rpartition("run=")[2].partition("_")[0]) if runs else 0
    return f"{path}/run={last + 1:09d}_{query}"


def _drop_older_runs(spark: SparkSession, folder: str) -> None:
    path = folder.rpartition("/run=")[0]
    for r in _runs(spark, path):
        if r < folder:
            _delete(spark, r)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[2:]) for n in _listing(spark, folder)
                  if n.startswith("v=") and _exists(spark, f"{folder}/{n}/_SUCCESS"))


def read_version(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version of one run (optionally before a batch)."""
    vs = [v for v in _versions(spark, folder) if before is None or v < before]
    return spark.read.parquet(f"{folder}/v={vs[-1]}") if vs else None


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of the newest run that has one."""
    for folder in reversed(_runs(spark, path)):
        got = read_version(spark, folder)
        if got is not None:
            return got
    return None


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All output rows (``batch=<id>`` folders) of the newest run."""
    for folder in reversed(_runs(spark, path)):
        if any(_exists(spark, f"{folder}/{n}/_SUCCESS") for n in _listing(spark, folder)):
            return spark.read.parquet(folder)
    raise FileNotFoundError(f"no micro-batch has been written to {path}")


def maintain(path: str, update: Callable[[DataFrame | None, DataFrame], DataFrame],
             keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function keeping a snapshot table at ``path``.

    ``update(previous_or_None, batch) -> new snapshot``.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(spark, path)
        prev = read_version(spark, folder, before=batch_id)
        update(prev, batch).write.mode("overwrite").parquet(f"{folder}/v={batch_id}")
        _prune(spark, folder, keep_versions)

    return run


def _prune(spark: SparkSession, folder: str, keep: int) -> None:
    """Remove older runs, and all but the newest versions of this one."""
    _drop_older_runs(spark, folder)
    for v in _versions(spark, folder)[:-keep] if keep > 0 else []:
        _delete(spark, f"{folder}/v={v}")


def last_n_update(n: int, order_cols, series=None):
    """Snapshot rule for the ring buffer: newest ``n`` (per series) of
    previous snapshot plus batch."""
    from rivulet.operators.live import last_n

    def update(prev: DataFrame | None, batch: DataFrame) -> DataFrame:
        both = batch if prev is None else prev.unionByName(batch)
        return last_n(both, n, order_cols, series)
    return update


def json_snapshot(path: str, build: Callable[[DataFrame], DataFrame],
                  keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """SNK7: publish the current panel table as one small JSON document for
    an embedding page.  A document is a new version, seen by
    :func:`json_page` once it is complete, so a page never finds none; the
    exchange to one file comes after the work of ``build``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        publish_json(build(batch), path, batch_id, keep_versions)
    return run


def publish_json(table: DataFrame, path: str, batch_id: int, keep_versions: int = 2) -> None:
    from rivulet.sources.envelope import TEXT_FORMAT_OPTIONS
    spark = table.sparkSession
    folder = run_folder(spark, path)
    table.repartition(1).write.mode("overwrite").options(**TEXT_FORMAT_OPTIONS).json(f"{folder}/v={batch_id}")
    _prune(spark, folder, keep_versions)


def json_page(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete JSON document."""
    for folder in reversed(_runs(spark, path)):
        vs = _versions(spark, folder)
        if vs:
            return f"{folder}/v={vs[-1]}"
    return None


def running_totals(out_path: str | None, carry_path: str, inc: str | None, order, series=None, seed=0,
                   seq: str = "seq", total: str = "total", keep_versions: int = 2,
                   history_path: str | None = None, history_n: int | None = None,
                   history_where=None) -> Callable[[DataFrame, int], None]:
    """Streaming sequence numbers and running totals (LIVE1, LIVE6), ungrouped
    or per series, without putting a key - or the whole stream - in one task.

    Each micro-batch is numbered and summed with the bucketed batch
    operators; a carry table (one row per series: count and total so far,
    versioned by batch id) supplies the offset from earlier batches and is
    joined on the series key (a constant for the ungrouped form) and a salt,
    so a hot series meets its one row in many tasks.  Output
    rows go to ``batch=<id>`` of the run's folder under ``out_path``
    (:func:`read_batches`; None: no rows are written), overwritten on retry.  With
    ``history_path``/``history_n`` it also keeps LIVE7's bounded history:
    the newest ``history_n`` rows (per series) as a versioned snapshot,
    optionally only rows matching ``history_where`` (e.g. accepted points).
    """
    from pyspark.sql import functions as F

    from rivulet.operators.joins import join_small
    from rivulet.operators.ordered import running_sum, sequence_number

    keys = [] if series is None else ([series] if isinstance(series, str) else list(series))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("__ck", F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0)))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry_folder = run_folder(spark, carry_path)
        prev = read_version(spark, carry_folder, before=batch_id)
        cur = sequence_number(batch, order, keys, out="__s")
        if inc:
            cur = running_sum(cur, F.col(inc), order, keys, out="__r")
        cur = keyed(cur)
        if prev is not None:
            p = prev.select(F.col("__ck").alias("__pk"), "__n", "__t")
            cur = join_small(cur, p, "__ck", "__pk", order.by).drop("__pk")
        else:
            cur = cur.withColumn("__n", F.lit(None).cast("bigint")).withColumn("__t", F.lit(None).cast("bigint"))
        cur = cur.withColumn(seq, F.col("__s") + F.coalesce("__n", F.lit(0)))
        if inc:
            cur = cur.withColumn(total, F.coalesce("__t", F.lit(seed)) + F.coalesce("__r", F.lit(0)))
        else:
            cur = cur.withColumn(total, F.lit(None).cast("bigint"))
        cur = cur.persist()
        try:
            if out_path:
                out_folder = run_folder(spark, out_path)
                cur.drop("__s", "__r", "__n", "__t", "__ck", *([] if inc else [total])) \
                   .write.mode("overwrite").parquet(f"{out_folder}/batch={batch_id}")
                _drop_older_runs(spark, out_folder)
            newest = F.max(F.struct(F.col(seq).alias("n"), F.col(total).alias("t")))
            carry = cur.groupBy("__ck").agg(newest.alias("__c")).select(
                "__ck", F.col("__c.n").alias("__n"), F.col("__c.t").alias("__t"))
            if prev is not None:
                carry = carry.unionByName(prev.join(carry.select("__ck"), "__ck", "left_anti"),
                                          allowMissingColumns=True)
            carry.write.mode("overwrite").parquet(f"{carry_folder}/v={batch_id}")
            if history_path and history_n:
                from rivulet.operators.live import last_n
                rows = cur.drop("__s", "__r", "__n", "__t", "__ck")
                if history_where is not None:
                    rows = rows.where(history_where)
                history_folder = run_folder(spark, history_path)
                old = read_version(spark, history_folder, before=batch_id)
                both = rows if old is None else old.unionByName(rows)
                last_n(both, history_n, list(order.by), series).write.mode("overwrite") \
                    .parquet(f"{history_folder}/v={batch_id}")
                _prune(spark, history_folder, keep_versions)
        finally:
            cur.unpersist()
        _prune(spark, carry_folder, keep_versions)

    return run


def take_until_batches(out_path: str, carry_path: str, sentinel, order_cols=("offset",),
                       key: str = "partition", keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """SRC7 streaming without keyed state: per micro-batch, the first
    sentinel of each partition (one aggregate) and the carried set of
    partitions that already stopped (one row per partition) cut the batch;
    rows before the cut go to ``out_path/batch=<id>``."""
    from pyspark.sql import functions as F

    from rivulet.operators.joins import join_small

    order = [F.col(c) for c in order_cols]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry_folder, out_folder = run_folder(spark, carry_path), run_folder(spark, out_path)
        prev = read_version(spark, carry_folder, before=batch_id)
        flagged = batch.withColumn("__stop", F.coalesce(sentinel, F.lit(False)))
        cuts = (flagged.where("__stop").groupBy(F.col(key).alias("__p"))
                .agg(F.min(F.struct(*order)).alias("__cut")))
        if prev is not None:
            stopped = prev.select(F.col(key).alias("__p"), F.lit(True).alias("__done"))
            cuts = cuts.join(stopped, "__p", "full_outer")
        else:
            cuts = cuts.withColumn("__done", F.lit(None).cast("boolean"))
        cuts = cuts.persist()
        try:
            j = join_small(flagged, cuts, key, "__p", order)
            keep = F.col("__done").isNull() & (F.col("__cut").isNull() | (F.struct(*order) < F.col("__cut")))
            j.where(keep).drop("__stop", "__p", "__cut", "__done") \
             .write.mode("overwrite").parquet(f"{out_folder}/batch={batch_id}")
            cuts.where(F.col("__cut").isNotNull() | F.col("__done").isNotNull()) \
                .select(F.col("__p").alias(key)).write.mode("overwrite").parquet(f"{carry_folder}/v={batch_id}")
        finally:
            cuts.unpersist()
        _drop_older_runs(spark, out_folder)
        _prune(spark, carry_folder, keep_versions)

    return run


def offset_gaps_batches(out_path: str, carry_path: str, key: str = "partition", col: str = "offset",
                        keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """OPS9 streaming without keyed state: the batch's offsets plus the
    carried last offset of each partition go through the bucketed ``lag``;
    gaps and duplicates go to ``out_path/batch=<id>``."""
    from pyspark.sql import functions as F

    from rivulet.operators.topics import offset_gaps

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry_folder, out_folder = run_folder(spark, carry_path), run_folder(spark, out_path)
        prev = read_version(spark, carry_folder, before=batch_id)
        cur = batch.select(key, col).withColumn("__carried", F.lit(False))
        both = cur if prev is None else cur.unionByName(
            prev.select(key, col).withColumn("__carried", F.lit(True)))
        both = both.persist()
        try:
            found = offset_gaps(both)
            found.write.mode("overwrite").parquet(f"{out_folder}/batch={batch_id}")
            both.groupBy(key).agg(F.max(col).alias(col)).write.mode("overwrite") \
                .parquet(f"{carry_folder}/v={batch_id}")
        finally:
            both.unpersist()
        _drop_older_runs(spark, out_folder)
        _prune(spark, carry_folder, keep_versions)

    return run


def sliding_batches(out_path: str, carry_path: str, tail_path: str, order, size: int, y: str, series: str,
                    seq: str = "seq", keep_versions: int = 2) -> Callable[[DataFrame, int], None]:
    """LIVE5 streaming without keyed state: per micro-batch the bucketed
    sliding frame over the accepted points (``y`` not null) of the batch and
    the carried last ``size - 1`` accepted points per series.  Carried too:
    one row per series with its message and point counts so far."""
    from pyspark.sql import functions as F

    from rivulet.operators.joins import join_small
    from rivulet.operators.live import last_n, sequence_with_accepted, sliding

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folders = [run_folder(spark, p) for p in (out_path, carry_path, tail_path)]
        prev, tail = (read_version(spark, f, before=batch_id) for f in folders[1:])
        cur = sequence_with_accepted(batch, order, series, y, seq, "__pos")
        if prev is not None:
            p = prev.select(F.col(series).alias("__k"), F.col("__n").alias("__n0"), F.col("__a").alias("__a0"))
            cur = join_small(cur, p, series, "__k", order.by, null_safe=True)
            cur = cur.withColumns({seq: F.col(seq) + F.coalesce("__n0", F.lit(0)),
                                   "__pos": F.col("__pos") + F.coalesce("__a0", F.lit(0))}).drop("__k", "__n0", "__a0")
        cur = cur.persist()
        try:
            carry = cur.groupBy(series).agg(F.max(seq).alias("__n"), F.max("__pos").alias("__a"))
            points = cur.where(F.col(y).isNotNull()).withColumn("__old", F.lit(False))
            if prev is not None:
                k = carry.select(F.col(series).alias("__k"))
                carry = carry.unionByName(prev.join(k, F.col(series).eqNullSafe(F.col("__k")), "left_anti"))
                points = points.unionByName(tail.withColumn("__old", F.lit(True)))
            framed = sliding(points, order, size, y, series, position="__pos")
            framed.where(~F.col("__old")).drop("__old", "__pos").write.mode("overwrite") \
                .parquet(f"{folders[0]}/batch={batch_id}")
            last_n(points.drop("__old"), size - 1, ["__pos"], series).write.mode("overwrite") \
                .parquet(f"{folders[2]}/v={batch_id}")
            carry.write.mode("overwrite").parquet(f"{folders[1]}/v={batch_id}")
        finally:
            cur.unpersist()
        _drop_older_runs(spark, folders[0])
        for f in folders[1:]:
            _prune(spark, f, keep_versions)

    return run
