"""Appending to stored topics: dense offsets, commits, retries, groups."""

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from rivulet.sinks import topic_log as L
from rivulet.sinks import writers as W
from rivulet.sources.envelope import read_topic
from rivulet.streaming import runner as RN

T0 = dt.datetime(2024, 1, 1)


def records(spark, n, start=0, key=lambda i: f"k{i % 7}"):
    rows = [(key(i), f"v{i}", T0 + dt.timedelta(seconds=i)) for i in range(start, start + n)]
    return spark.createDataFrame(rows, "key string, value string, timestamp timestamp_ntz")


def topic_dir():
    return tempfile.mkdtemp(prefix="rv-log-") + "/topic"


def offsets(spark, topic):
    out = {}
    for r in read_topic(spark, topic).collect():
        out.setdefault(r.partition, []).append((r.offset, r.value))
    return {p: sorted(v) for p, v in out.items()}


def check_dense(spark, topic, n):
    got = offsets(spark, topic)
    assert sum(map(len, got.values())) == n == len({v for rows in got.values() for _, v in rows})
    for rows in got.values():
        assert [o for o, _ in rows] == list(range(len(rows)))
    assert L.end_offsets(spark, topic) == {p: len(rows) for p, rows in got.items()}
    return got


def test_offsets_go_on_over_batches_and_keys_keep_their_partition(spark):
    topic = topic_dir()
    for k in range(3):
        assert L.append(records(spark, 100, 100 * k).repartition(5), topic, partitions=3) == k
    check_dense(spark, topic, 300)
    by_key = read_topic(spark, topic).groupBy("key").agg(F.countDistinct("partition").alias("n")).collect()
    assert {r.n for r in by_key} == {1}
    with pytest.raises(ValueError, match="3 partitions"):
        L.append(records(spark, 1), topic, partitions=4)


def test_order_is_followed_and_a_hot_partition_spreads(spark):
    topic = topic_dir()
    df = records(spark, 4000, key=lambda i: "hot" if i % 3 else f"k{i}").repartition(7)
    L.append(df, topic, partitions=2, order=["timestamp"])
    for rows in check_dense(spark, topic, 4000).values():
        values = [int(v[1:]) for _, v in rows]
        assert values == sorted(values)
    rows = L._stage(df, topic_dir(), 2, ["timestamp"])
    tasks = rows.groupBy("partition").agg(F.countDistinct(F.shiftright("__id", L._TASK_BITS)).alias("n")).collect()
    assert max(r.n for r in tasks) >= 2


def test_records_without_key_partition_or_rows(spark):
    topic = topic_dir()
    assert L.append(records(spark, 0), topic) is None and L.commits(spark, topic) == []
    L.append(records(spark, 50).select("value"), topic, partitions=4)
    L.append(records(spark, 50, 50).withColumn("key", F.lit(None).cast("string")), topic)
    L.append(records(spark, 6, 100).withColumn("partition", F.lit(3)), topic)
    got = check_dense(spark, topic, 106)
    assert len(got) == 4 and {"v100", "v105"} <= {v for _, v in got[3]}
    assert read_topic(spark, topic).where("timestamp IS NULL").count() == 0


def test_a_crash_before_the_commit_leaves_nothing_and_a_retry_no_gap(spark):
    topic = topic_dir()
    L.append(records(spark, 40), topic, partitions=2, producer="p", batch_id=0)

    def crash():
        assert read_topic(spark, topic).count() == 40  # readers do not see what is staged
        raise RuntimeError("crash")

    with pytest.raises(RuntimeError, match="crash"):
        L.append(records(spark, 40, 40), topic, producer="p", batch_id=1, before_commit=crash)
    check_dense(spark, topic, 40)
    assert L.append(records(spark, 40, 40), topic, producer="p", batch_id=1) == 1
    assert L.append(records(spark, 40, 40), topic, producer="p", batch_id=1) is None  # again, after the commit
    assert L.append(records(spark, 40), topic, producer="p", batch_id=0) is None
    check_dense(spark, topic, 80)


def test_two_producers_at_once(spark):
    """The one that commits second gets its offsets after the first."""
    topic = topic_dir()
    L.append(records(spark, 10), topic, partitions=2, producer="a", batch_id=0)
    turn = iter([True])

    def other():
        if next(turn, False):
            L.append(records(spark, 30, 100), topic, producer="b", batch_id=0)

    assert L.append(records(spark, 20, 10), topic, producer="a", batch_id=1, before_commit=other) == 2
    check_dense(spark, topic, 60)
    assert L.state(spark, topic)["producers"] == {"a": 1, "b": 0}


def test_streaming_producer_restarts_without_gap_or_duplicate(spark):
    src, topic, ckpt = (tempfile.mkdtemp(prefix="rv-log-") + x for x in ("/src", "/topic", "/ckpt"))
    for k in range(3):
        records(spark, 50, 50 * k).write.mode("append").parquet(src)
        stream = spark.readStream.schema(records(spark, 0).schema).option("maxFilesPerTrigger", 1).parquet(src)
        RN.drain(W.to_topic(stream, topic, partitions=2, checkpoint=ckpt))
    check_dense(spark, topic, 150)
    assert len(L.state(spark, topic)["producers"]) == 1


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_a_new_group_starts_at_latest_and_stays_there(spark, fmt):
    topic, base = topic_dir(), tempfile.mkdtemp(prefix="rv-log-")
    W.to_topic(records(spark, 30), topic, partitions=2, fmt=fmt)
    for k in range(1, 4):
        df = read_topic(spark, topic, fmt=fmt, stream=True, starting="latest", group=f"{base}/g")
        RN.drain(RN.start(df, sink="parquet", path=f"{base}/out", checkpoint=f"{base}/c"))
        if k < 3:
            W.to_topic(records(spark, 30, 30 * k), topic, fmt=fmt)
    got = sorted(int(r.value[1:]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == list(range(30, 90))
    with pytest.raises(ValueError, match="group"):
        read_topic(spark, topic, starting="latest")


def test_a_produced_topic_is_pruned_by_start_offsets(spark):
    from rivulet.sources.readers import from_offsets
    topic = topic_dir()
    L.append(records(spark, 400), topic, partitions=4)
    df = from_offsets(read_topic(spark, topic), {0: 5, 1: -1}, default=-1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*partition#\d+ = 0", plan) and "GreaterThanOrEqual(offset,5)" in plan
    ends = L.end_offsets(spark, topic)
    assert df.count() == ends[0] - 5
