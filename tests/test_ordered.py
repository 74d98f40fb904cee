"""The bucketed ordered windows equal the plain one-task windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.ordered import (Order, previous_in_order, running_sum, sequence_number,
                                       sliding_frame)


def _data(spark, n=400, keys=3, seed=7, nulls=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice(["hot"] * 6 + [f"k{j}" for j in range(keys)] + ([None] if nulls else []))
        v = None if nulls and rnd.random() < 0.05 else rnd.randint(-5, 50)
        rows.append((k, rnd.randint(0, 300), i, v))
    return spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint")


def test_running_sum_equals_window(spark):
    df = _data(spark)
    order = Order.by_number("t", "id", width=7)
    got = running_sum(df, "v", order, ["k"], out="s").select("id", "s")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("v").over(w).alias("s"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_global_sequence_equals_row_number(spark):
    df = _data(spark, nulls=False)
    got = sequence_number(df, Order.by_number("t", "id", width=5)).select("id", "seq")
    exp = df.select("id", F.row_number().over(Window.orderBy("t", "id")).alias("seq"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_seeded_running_sum(spark):
    df = spark.createDataFrame([(1, 3), (2, 4), (3, 5)], "t bigint, v bigint")
    got = running_sum(df, "v", Order.by_number("t", width=1), seed=0, out="s").orderBy("t")
    assert [r.s for r in got.collect()] == [3, 7, 12]


def test_previous_in_order_equals_lag(spark):
    rnd = random.Random(3)
    rows = [(p, o) for p in range(3) for o in sorted(rnd.sample(range(0, 200), 60))]
    rows += [(0, 17), (1, 5)]  # duplicates
    df = spark.createDataFrame(rows, "p int, o bigint")
    got = previous_in_order(df, "o", ["p"], width=8, out="prev").select("p", "o", "prev")
    exp = df.select("p", "o", F.lag("o").over(Window.partitionBy("p").orderBy("o")).alias("prev"))
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)


def test_sliding_frame_equals_window(spark):
    df = _data(spark, nulls=False)
    pos = sequence_number(df, Order.by_number("t", "id", width=11), ["k"], out="pos")
    got = sliding_frame(pos, "pos", 5, {"lo": F.min("v"), "n": F.count("v"), "s": F.sum("v")}, ["k"],
                        bucket_rows=6).select("id", "lo", "n", "s")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-4, 0)
    exp = df.select("id", F.min("v").over(w).alias("lo"), F.count("v").over(w).alias("n"),
                    F.sum("v").over(w).alias("s"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_running_sums_several_values_one_pass(spark):
    from rivulet.operators.ordered import running_sums
    df = _data(spark)
    got = running_sums(df, {"s": F.col("v"), "c": F.lit(1), "pos": F.when(F.col("v") > 10, 1).otherwise(0)},
                       Order.by_number("t", "id", width=9), ["k"], seeds={"c": 100}).select("id", "s", "c", "pos")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("v").over(w).alias("s"), (F.lit(100) + F.count(F.lit(1)).over(w)).alias("c"),
                    F.sum(F.when(F.col("v") > 10, 1).otherwise(0)).over(w).alias("pos"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_null_order_values_sort_first_and_are_kept(spark):
    rows = [("a", None, 0, 1), ("a", 5, 1, 2), ("a", None, 2, 3), ("a", 1, 3, 4), ("b", None, 4, 5)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint")
    got = running_sum(df, "v", Order.by_number("t", "id", width=2), ["k"], out="s").select("id", "s")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("v").over(w).alias("s"))
    assert sorted(got.collect()) == sorted(exp.collect())
    prev = previous_in_order(df.where(F.col("t").isNotNull()), "t", ["k"], width=2, out="p")
    assert sorted((r.id, r.p) for r in prev.collect()) == [(1, 1), (3, None)]


def test_hot_key_is_spread_over_tasks(spark):
    """A key holding half of all rows: the plain window puts it in one task,
    the bucketed one spreads it over many."""
    n = 4000
    rows = [("hot" if i % 2 == 0 else f"k{i % 97}", i, i, 1) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint").repartition(8)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("s", F.sum("v").over(w)).withColumn("pid", F.spark_partition_id())
    bucketed = running_sum(df, "v", Order.by_number("t", "id", width=250), ["k"], out="s") \
        .withColumn("pid", F.spark_partition_id())
    # collect ``s`` too, so the optimizer keeps the window under the partition id;
    # adaptive coalescing would merge this tiny input's shuffle partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot_plain = len(plain.where(F.col("k") == "hot").groupBy("pid").agg(F.max("s")).collect())
        hot_bucketed = len(bucketed.where(F.col("k") == "hot").groupBy("pid").agg(F.max("s")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert hot_plain == 1
    assert hot_bucketed >= 4
    assert sorted(plain.select("id", "s").collect()) == sorted(bucketed.select("id", "s").collect())


def test_time_buckets_are_monotone_across_a_dst_gap(spark):
    import datetime as dt
    base = dt.datetime(2024, 3, 10, 1, 50)
    rows = [("k", base + dt.timedelta(minutes=5 * i), i, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id bigint, v bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = sorted(running_sum(df, "v", Order.by_time("t", "id", seconds=600), ["k"], out="s")
                     .select("id", "s").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.s for r in got] == list(range(1, 31))


def test_null_first_order_column_spreads_by_the_next(spark):
    """A topic without timestamps is bucketed by partition and offset."""
    from pyspark.sql import Window
    from rivulet.operators import ordered as O
    df = (spark.range(4000).select((F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"),
                                   F.when(F.col("id") % 10 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("timestamp"),
                                   (F.col("id") % 7).alias("v")))
    spark.conf.set(O.CONF_WIDTH, "100")
    try:
        order = O.Order.by_time("timestamp", "partition", "offset")
        got = O.running_sum(df, "v", order)
        w = Window.orderBy("timestamp", "partition", "offset").rowsBetween(Window.unboundedPreceding, 0)
        assert sorted(got.collect()) == sorted(df.withColumn("running", F.sum("v").over(w)).collect())
        buckets = O._keyed(df, (), order).groupBy(O._B).count().collect()
        assert len(buckets) > 100
        by_id = O.sequence_number(df, O.Order.by_time("timestamp", "offset"))
        w = Window.orderBy("timestamp", "offset")
        assert sorted(by_id.collect()) == sorted(df.withColumn("seq", F.row_number().over(w).cast("bigint")).collect())
    finally:
        spark.conf.unset(O.CONF_WIDTH)
