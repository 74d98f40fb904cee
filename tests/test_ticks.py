"""Ticks by timers, forgetting, restarts, state read back, TTL."""

import datetime as dt

import pytest

from rivulet.streaming import runner as RN
from rivulet.streaming import ticks as K

T0 = dt.datetime(2024, 1, 1)
STEP, DELAY, QUIET = 60_000, 30_000, 3


@pytest.fixture(autouse=True)
def one_partition(spark):
    """Each task of a stateful processor starts its own worker."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def brute(rows):
    """Ticks of all rows, from the records and the final watermark alone."""
    wm = max(r[1] for r in rows if r[1]) - dt.timedelta(milliseconds=DELAY)
    step = dt.timedelta(milliseconds=STEP)
    end = lambda t: T0 + ((t - T0) // step + 1) * step
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k and r[1]), key=lambda r: (r[1], r[2]))
        by = {}
        for r in mine:
            by.setdefault(end(r[1]), []).append(r)
        state, b = None, min(by, default=None)
        while b is not None and b <= wm:
            got = by.get(b)
            if got:
                state = [len(got) + (state[0] if state else 0), got[-1][3], 0]
            elif state:
                state[2] += 1
            if state:
                out.append((k, b, len(got or []), state[0], state[1], not got))
                if state[2] >= QUIET:
                    state = None
            b += step
    return sorted(out, key=str)


def rows():
    at = lambda s: T0 + dt.timedelta(seconds=s)
    a = [("a", at(s), i, float(i)) for i, s in enumerate([1, 5, 59, 61, 130, 400, 401, 700, 1000])]
    b = [("b", at(s), 100 + i, None if i == 1 else float(i)) for i, s in enumerate([10, 250])]
    return a + b + [(None, at(20), 200, 7.0), ("c", None, 300, 1.0), ("a", at(59), 301, 9.0), ("end", at(1100), 400, 0.0)]


def write(spark, path, data):
    spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint, v double").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema("k string, ts timestamp_ntz, id bigint, v double").parquet(path)


def run(spark, src, out, ckpt):
    df = K.ticks(stream(spark, src), "k", "ts", "v", ["ts", "id"], STEP, DELAY, QUIET)
    RN.drain(RN.start(df, sink="parquet", path=out, checkpoint=ckpt))
    return sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str)


def test_one_batch(spark, tmp_path):
    write(spark, f"{tmp_path}/in", rows())
    got = run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert got == brute(rows())
    assert any(r[-1] for r in got)


def test_silent_series_ticks_over_restarts(spark, tmp_path):
    data = sorted((r for r in rows() if r[1]), key=lambda r: r[1])
    args = (f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    for cut in (data[:4], data[4:9], data[9:]):
        write(spark, args[0], cut)
        got = run(spark, *args)
    assert got == brute(data)
    # "a" is silent from 61 s to 400 s but for one record, and "b" has no record in its later ticks
    assert sum(1 for r in got if r[0] == "b" and r[-1]) >= QUIET
    state = spark.read.format("statestore").option("stateVarName", "series").load(args[2])
    assert {r.key.k for r in state.select("key").collect()} <= {"a", "b", "end", None}
    assert state.count() < 4  # forgotten series keep no state


def test_empty_stream(spark, tmp_path):
    write(spark, f"{tmp_path}/in", [])
    df = K.ticks(stream(spark, f"{tmp_path}/in"), "k", "ts", "v", ["ts", "id"], STEP, DELAY, QUIET)
    assert df.columns == ["k", "tick", "n", "total", "value", "silent"]
    RN.drain(RN.start(df, sink="memory", query_name="no_ticks", checkpoint=f"{tmp_path}/ckpt"))
    assert spark.table("no_ticks").count() == 0


def test_ttl(spark, tmp_path):
    def counted(ttl, name):
        out = []
        for _ in range(2):
            write(spark, f"{tmp_path}/{name}", [("a", T0, 1, 1.0), ("a", T0, 2, 1.0), (None, T0, 3, 1.0)])
            RN.drain(RN.start(K.counts_with_ttl(stream(spark, f"{tmp_path}/{name}"), "k", ttl), output_mode="update", trigger="once",
                              checkpoint=f"{tmp_path}/ckpt-{name}",
                              foreach_batch=lambda df, i: out.append(sorted(map(tuple, df.collect()), key=str))))
        return [x for x in out if x]

    assert counted(3_600_000, "long") == [[("a", 2), (None, 1)], [("a", 4), (None, 2)]]
    assert counted(1, "short") == [[("a", 2), (None, 1)], [("a", 2), (None, 1)]]


def test_any_session_state_store(spark, tmp_path):
    """Spark's default provider has no column families: the query brings its own."""
    from rivulet.plans.registry import all_queries
    key = "spark.sql.streaming.stateStore.providerClass"
    before, default = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.createDataFrame([(1, T0 + dt.timedelta(hours=h), 7, "view", float(h), "{}") for h in (0, 1, 40)],
                          "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set(key, default)
    try:
        got = sorted(tuple(r) for r in all_queries()["stream_ticks"].fn(spark, str(tmp_path)).collect())
        assert spark.conf.get(key) == default
    finally:
        spark.conf.set(key, before)
    at = lambda h: T0 + dt.timedelta(hours=h)
    assert got == [(7, at(6), 2, 2, 1.0, False)] + [(7, at(6 * k), 0, 2, 1.0, True) for k in range(2, 6)]
