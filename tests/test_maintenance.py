"""Newest values without payload sorts, replica digests, offset runs, sketches, once-only records."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from rivulet.operators import live as V
from rivulet.operators import tables as T
from rivulet.operators import topics as O
from rivulet.sources import readers as S
from rivulet.sources.envelope import ENVELOPE, read_topic
from rivulet.streaming import runner as RN

T0 = dt.datetime(2024, 1, 1)


def topic(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- newest record per key

def old_newest(df, keys, order):
    rest = [c for c in df.columns if c not in keys]
    m = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *rest))
    return df.groupBy(*keys).agg(m.alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


@pytest.mark.parametrize("order", [("offset",), ("timestamp", "partition", "offset"), ("partition", "offset"), ("timestamp",),
                                   ("offset", "timestamp", "partition")])
def test_newest_record_equals_one_struct_maximum(spark, order):
    rng = random.Random(len(order))
    big = [None, -2 ** 63, -1, 0, 1, 2 ** 63 - 1]
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice(["v1", "v2", None]),
             rng.choice([None, -2 ** 31, 0, 2 ** 31 - 1]), rng.choice(big),
             rng.choice([None, T0, T0 + dt.timedelta(microseconds=1)])) for _ in range(300)]
    rows += [("alone", None, None, None, None)]
    df = topic(spark, rows + rows[:20])
    got = T.newest_record_by(df, ["key"], order)
    assert sorted(got.collect(), key=repr) == sorted(old_newest(df, ["key"], order).collect(), key=repr)
    assert "SortAggregate" not in plan(got)


def test_the_three_plans_sort_no_payload(spark):
    df = topic(spark, [("a", "x", 0, 0, T0), ("a", None, 0, 1, T0)])
    assert T.latest_by_key(df).collect() == []
    assert [r.value for r in T.latest_by_key(df, keep_tombstones=True).collect()] == [None]
    gauge = spark.createDataFrame([("c", T0, 1, 5), ("c", T0, 2, 7)], "category string, ts timestamp_ntz, event_id bigint, value bigint")
    assert [tuple(r) for r in V.category_latest(gauge, ["ts", "event_id"]).collect()] == [("c", 7)]
    for out in (T.latest_by_key(df), V.category_latest(gauge, ["ts", "event_id"]), O.compact(df)):
        assert "SortAggregate" not in plan(out)


# --- replicas

def replicas(spark, seed, n=600):
    rng = random.Random(seed)
    left = [(rng.choice(["k", None]), rng.choice(["v", "w", None, ""]), rng.choice([0, 1, None]), i,
             rng.choice([T0, None])) for i in range(n)]
    right = []
    for r in left:
        what = rng.random()
        if what < 0.01:
            continue
        right.append((*r[:1], "changed", *r[2:]) if what < 0.02 else (None if r[0] else "k", *r[1:]) if what < 0.03 else r)
    right += [("new", "x", 1, n + 5, None), ("far", "x", 7, 10 ** 12, None)]
    return topic(spark, left), topic(spark, right)


@pytest.mark.parametrize("width,levels", [(1, 1), (8, 3), (4096, 2)])
def test_digests_find_what_records_show(spark, width, levels):
    left, right = replicas(spark, width)
    got = O.reconcile_by_digest(left, right, width=width, levels=levels)
    want = O.reconcile(left, right)
    assert want.count() > 10
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_a_repeated_record_is_a_difference(spark):
    """Sums keep repeats apart, where an exclusive-or would not."""
    row = ("k", "v", 0, 3, T0)
    left, right = topic(spark, [row]), topic(spark, [row, row, row])
    assert O.differing_ranges(O.digests(left), O.digests(right)).count() == 1
    assert O.differing_ranges(O.digests(left), O.digests(left)).count() == 0


def test_equal_replicas_shuffle_ranges_only(spark):
    left, _ = replicas(spark, 1)
    base = tempfile.mkdtemp(prefix="rv-dig-")
    left.where("partition IS NOT NULL").repartition(4).write.parquet(f"{base}/topic")
    sizes = {}

    def stored(df, name):
        df.write.parquet(f"{base}/{name}")
        sizes[name] = spark.read.parquet(f"{base}/{name}").count()
        return spark.read.parquet(f"{base}/{name}")

    df = spark.read.schema(ENVELOPE).parquet(f"{base}/topic")
    out = O.reconcile_by_digest(df, df, width=100, stored=stored)
    assert out.collect() == [] and sizes["differing"] == 0 and sizes["left"] == 2 * 6


# --- offset runs

def brute_gaps(rows):
    out, by = [], {}
    for p, o in rows:
        by.setdefault(p, []).append(o)
    for p, os in by.items():
        os.sort()
        for a, b in zip(os, os[1:]):
            if a == b or b - a > 1:
                out.append((p, "duplicate" if a == b else "gap", a, b))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_gaps_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([0, 0, 0, 1, None]), rng.randrange(60 * (seed + 1))) for _ in range(150)]
    rows += [(0, 1), (0, 2), (0, 2), (0, 2), (0, 4), (2, 5)]
    df = spark.createDataFrame(rows, "partition int, offset bigint").repartition(5)
    got = O.offset_gaps(df, width=16)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_gaps(rows)


def test_a_gap_free_partition_is_one_run_a_task(spark):
    df = spark.range(20000).select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    runs = O.offset_runs(O.offset_counts(df)).collect()
    assert len(runs) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r.last - r.first + 1 for r in runs) == 20000
    assert O.offset_gaps(df).collect() == []


# --- sketches

def test_sketches_merge_within_their_error(spark):
    rng = random.Random(3)
    sizes = [int(rng.lognormvariate(3, 1)) for _ in range(20000)]
    rows = [(None, "x" * n, 0, i, T0 + dt.timedelta(seconds=i % 3600)) for i, n in enumerate(sizes)]
    rows += [(None, None, 0, 0, T0 + dt.timedelta(hours=2))]
    df = topic(spark, rows)
    parts = [O.size_sketches(df.where(F.col("offset") % 3 == k), k=200) for k in range(3)]  # three batches share buckets
    out = O.throughput_of_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), k=200).orderBy("bucket").collect()
    exact = O.throughput(df).orderBy("bucket").collect()
    assert [(r.bucket, r.records, r.bytes) for r in out] == [(r.bucket, r.records, r.bytes) for r in exact]
    for p, got in ((0.5, out[0].p50_bytes), (0.95, out[0].p95_bytes)):
        at = sum(s < got for s in sizes) / len(sizes), sum(s <= got for s in sizes) / len(sizes)
        assert at[0] - 0.02 <= p <= at[1] + 0.02
    assert out[-1].p50_bytes is None and out[-1].avg_bytes is None


# --- once

def test_redelivered_records_come_once_and_state_stays_bounded(spark):
    base = tempfile.mkdtemp(prefix="rv-once-")
    for k in range(6):  # each file repeats half of the one before, one day later
        rows = [("k", f"v{i}", i % 2, i, T0 + dt.timedelta(days=k if i >= 50 * (k + 1) else max(k - 1, 0)))
                for i in range(50 * k, 50 * k + 100)]
        topic(spark, rows + rows[:30] + [("k", "timeless", 9, k, None)]).coalesce(1).write.mode("append").parquet(f"{base}/t")
        q = RN.start(S.once(read_topic(spark, f"{base}/t", stream=True), delay="1 day"), sink="parquet", path=f"{base}/out",
                     checkpoint=f"{base}/c")
        RN.drain(q)
        held = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    got = [(r.partition, r.offset) for r in spark.read.parquet(f"{base}/out").collect()]
    assert len(got) == len(set(got)) and {o for p, o in got if p < 2} == set(range(350))
    assert held < 250
