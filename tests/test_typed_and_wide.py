"""Schema-led envelopes, wide buffers, and answers from a topic's commits."""

import datetime as dt
import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from rivulet.functions.codec import typed_envelope
from rivulet.operators import topics as O
from rivulet.operators.ordered import sliding_extremes, sliding_frame
from rivulet.sinks import topic_log as L
from rivulet.sources import readers as S
from rivulet.sources.envelope import read_topic

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("size", [1, 2, 7, 64, 300])
def test_block_heads_and_tails_equal_the_frame(spark, size):
    rng = random.Random(size)
    rows = [(k, i + 1, rng.choice([None, rng.randint(-50, 50)])) for k, n in (("hot", 400), ("a", 3), (None, 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "series string, pos bigint, y bigint").repartition(5)
    got = sliding_extremes(df, "pos", size, "y", ["series"])
    want = sliding_frame(df, "pos", size, {"n": F.count("y"), "lo": F.min("y"), "hi": F.max("y"), "total": F.sum("y")}, ["series"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def envelope(kind, payload, **more):
    return json.dumps({"schema": {"type": kind, "optional": more.pop("optional", False), **more}, "payload": payload})


CASES = [
    (envelope("string", "x"), True), (envelope("string", 5), False), (envelope("string", None), False),
    (envelope("string", None, optional=True), True), (envelope("int8", 127), True), (envelope("int8", 128), False),
    (envelope("int32", -2 ** 31), True), (envelope("int32", 2 ** 31), False), (envelope("int64", 2 ** 63 - 1), True),
    (envelope("int64", 1.5), False), (envelope("int64", "1"), False), (envelope("double", 1.5), True), (envelope("double", 3), True),
    (envelope("float", 1e300), True), (envelope("double", "3"), False), (envelope("boolean", True), True), (envelope("boolean", 1), False),
    (envelope("array", [1, "a"], items={"type": "string"}), True), (envelope("array", "a"), False),
    (envelope("struct", {"a": 1}, fields=[{"field": "a", "type": "int32", "optional": False}]), True),
    (envelope("struct", {"a": "1"}, fields=[{"field": "a", "type": "int32", "optional": False}]), False),
    (envelope("struct", {}, fields=[{"field": "a", "type": "int32", "optional": False}]), False),
    (envelope("struct", {}, fields=[{"field": "a", "type": "int32", "optional": True}]), True),
    (envelope("struct", [1], fields=[]), False), (envelope("struct", {"a": 1}), False), (envelope("strange", 1), False),
    ("", False), ("5", False), ("{}", False), ('{"payload":1}', False), ('{"schema":1,"payload":1}', False), (None, False), ("{", False)]


def test_each_record_is_judged_by_its_own_schema(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, json string")
    got = {r.i: r for r in S.unwrap_typed(df).orderBy("i").collect()}
    assert {i: got[i].valid for i in got} == {i: ok for i, (_, ok) in enumerate(CASES)}
    assert all((r.type is None) == (not r.valid) and (r.valid or r.payload is None) for r in got.values())


def test_typed_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "a\"b", True, ("x", None), [1, 2]), (None, None, None, None, None, None)],
                               "l bigint, d double, s string, b boolean, o struct<n: string, m: int>, a array<int>")
    for c, kind in (("l", "bigint"), ("d", "double"), ("s", "string"), ("b", "boolean"), ("o", "struct<n: string, m: int>"), ("a", "array<int>")):
        out = S.unwrap_typed(df.select(c, typed_envelope(df, c).alias("json")))
        rows = out.select(c, "valid", F.try_variant_get("payload", "$", kind).alias("back")).collect()
        assert all(r.valid and r.back == r[c] for r in rows), c
    with pytest.raises(TypeError):
        typed_envelope(df.select(F.current_date().alias("t")), "t")


def test_summary_lag_and_retention_read_the_commits(spark):
    topic = tempfile.mkdtemp(prefix="rv-meta-") + "/topic"
    for day in (0, 1, 5, 9):
        rows = [(f"k{i}", "v", T0 + dt.timedelta(days=day, seconds=i)) for i in range(20)]
        L.append(spark.createDataFrame(rows, "key string, value string, timestamp timestamp_ntz"), topic, partitions=3)
    df = read_topic(spark, topic)
    assert sorted(L.summary(spark, topic).collect()) == sorted(O.topic_summary(df).collect())
    done = spark.createDataFrame([(0, 2)], "partition int, committed bigint")
    assert sorted(L.lag(spark, topic, done).collect(), key=repr) == sorted(O.lag(df, done).collect(), key=repr)
    want = sorted(O.retention(df, 100).collect())
    ends = L.end_offsets(spark, topic)
    assert L.retain(spark, topic, 100) == [0, 1] and L.commits(spark, topic) == [2, 3]
    after = read_topic(spark, topic)
    assert sorted(O.retention(after, 100).collect()) == want and after.count() == 40
    assert L.retain(spark, topic, 1) == [2] and L.retain(spark, topic, 0) == []  # the newest commit holds the state
    assert L.end_offsets(spark, topic) == ends
    L.append(spark.createDataFrame([("k1", "v", T0)], "key string, value string, timestamp timestamp_ntz"), topic)
    assert sum(L.end_offsets(spark, topic).values()) == 81
