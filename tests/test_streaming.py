"""Batch/stream parity and restart on the same checkpoint.

The sf0.001 events topic is cut into four envelope files in time order; a
stream reads one file per micro-batch (maxFilesPerTrigger=1).
"""

import os
import tempfile
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rivulet.operators import live as L
from rivulet.operators import records as R
from rivulet.operators import tables as T
from rivulet.operators import topics as O
from rivulet.operators.ordered import Order
from rivulet.sinks import writers as W
from rivulet.sources import readers as RD
from rivulet.sources.envelope import ENVELOPE, read_lines, read_topic
from rivulet.sources.tables import env_events
from rivulet.streaming import keyed as K
from rivulet.streaming import changelog as CL
from rivulet.streaming import runner as RN
from rivulet.streaming import snapshot as SN
from tests.conftest import SF_SMALL

ORDER_COLS = ["timestamp", "partition", "offset"]


def _order():
    return Order.by_time("timestamp", "partition", "offset", seconds=3600)


@pytest.fixture(scope="module")
def topic_parts(spark):
    pdf = env_events(spark, SF_SMALL).toPandas().sort_values(ORDER_COLS).reset_index(drop=True)
    q = len(pdf) // 4
    return [pdf.iloc[i * q: (i + 1) * q if i < 3 else len(pdf)] for i in range(4)]


def _write_parts(parts, directory, start=0):
    os.makedirs(directory, exist_ok=True)
    schema = pa.schema([("key", pa.string()), ("value", pa.string()), ("partition", pa.int32()),
                        ("offset", pa.int64()), ("timestamp", pa.timestamp("us"))])
    now = time.time()
    for i, p in enumerate(parts, start=start):
        path = f"{directory}/part-{i:03d}.parquet"
        pq.write_table(pa.Table.from_pandas(p, schema=schema, preserve_index=False), path)
        os.utime(path, (now - 100 + i, now - 100 + i))  # arrival order = file order


def _stream(spark, directory):
    return read_topic(spark, directory, stream=True, options={"maxFilesPerTrigger": "1"})


def run_to_table(df, output_mode="append", checkpoint=None):
    """Drain a stream into a memory table (small test data only)."""
    name = f"rivulet_{uuid.uuid4().hex[:10]}"
    RN.drain(RN.start(df, sink="memory", output_mode=output_mode, checkpoint=checkpoint, query_name=name))
    return df.sparkSession.table(name)


def _batch(spark, parts):
    import pandas as pd
    return spark.createDataFrame(pd.concat(parts, ignore_index=True), ENVELOPE)


def test_word_count_complete_mode_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = run_to_table(T.word_count(_stream(spark, d)), output_mode="complete")
    exp = T.word_count(_batch(spark, topic_parts))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_counts_update_mode_restart(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    ckpt = tempfile.mkdtemp(prefix="rv-ckpt-")
    snap = tempfile.mkdtemp(prefix="rv-snap-") + "/counts"

    def upsert(prev, batch):
        if prev is None:
            return batch
        return prev.join(batch, "key", "left_anti").unionByName(batch)

    def run():
        q = RN.start(T.count_by_key(_stream(spark, d)), output_mode="update", checkpoint=ckpt,
                     foreach_batch=SN.maintain(snap, upsert))
        RN.drain(q)

    _write_parts(topic_parts[:2], d)
    run()
    _write_parts(topic_parts[2:], d, start=2)
    run()  # resumes after the two committed files
    got = SN.read_latest(spark, snap)
    exp = T.count_by_key(_batch(spark, topic_parts))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_keyed_sequence_and_total_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    s = _stream(spark, d).withColumn("inc", F.length("value").cast("bigint"))
    got = run_to_table(K.running_count_and_total(s, ["key"], ORDER_COLS, inc="inc", seed=0))
    b = _batch(spark, topic_parts).withColumn("inc", F.length("value").cast("bigint"))
    exp = L.running_total(L.sequence(b, _order(), "key"), "inc", _order(), "key", seed=0)
    cols = ["partition", "offset", "seq", "total"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_changelog_stream_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = run_to_table(K.changelog(_stream(spark, d), ORDER_COLS))
    exp = T.changelog(_batch(spark, topic_parts), _order())
    cols = ["key", "partition", "offset", "count"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_take_until_stream_parity(spark, topic_parts):
    from rivulet.sources.readers import take_until
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    flagged = _stream(spark, d).withColumn("stop", F.col("key") == "error")
    got = run_to_table(K.take_until(flagged, "stop"))
    exp = take_until(_batch(spark, topic_parts), F.col("key") == "error")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_last_n_snapshot_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    snap = tempfile.mkdtemp(prefix="rv-snap-") + "/lastn"
    q = RN.start(_stream(spark, d), foreach_batch=SN.maintain(snap, SN.last_n_update(20, ORDER_COLS, "key")))
    RN.drain(q)
    got = SN.read_latest(spark, snap)
    exp = L.last_n(_batch(spark, topic_parts), 20, ORDER_COLS, "key")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_latest_and_gauges_streaming_aggregates(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = run_to_table(T.latest_by_key(_stream(spark, d)), output_mode="complete")
    exp = T.latest_by_key(_batch(spark, topic_parts))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_mirror_and_text_round_trip(spark, topic_parts):
    src = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, src)
    dst = tempfile.mkdtemp(prefix="rv-mirror-") + "/topic"
    RN.drain(RN.mirror(spark, src, dst))
    assert sorted(RN.replay(spark, dst).collect()) == sorted(_batch(spark, topic_parts).collect())

    txt = tempfile.mkdtemp(prefix="rv-text-") + "/lines"
    RN.drain(W.to_text(_stream(spark, src), txt))
    lines = read_lines(spark, txt, key="1")
    assert lines.count() == sum(len(p) for p in topic_parts)
    assert lines.where(F.col("key") != "1").count() == 0


def test_topic_sink_and_long_values(spark, topic_parts):
    out = tempfile.mkdtemp(prefix="rv-out-") + "/counts"
    counts = T.count_by_key(_batch(spark, topic_parts))
    W.to_topic(W.long_values(counts), out, fmt="parquet")
    back = read_topic(spark, out, raw=True)
    assert back.columns == ["key", "value", "partition", "offset", "timestamp"]
    assert sorted(r.offset for r in back.collect()) == list(range(counts.count()))


def test_offset_gaps_stream_parity(spark, topic_parts):
    from rivulet.operators.topics import offset_gaps
    d = tempfile.mkdtemp(prefix="rv-topic-")
    thinned = [p[p["key"] != "error"] for p in topic_parts]
    _write_parts(thinned, d)
    got = run_to_table(K.offset_gaps(_stream(spark, d)))
    exp = offset_gaps(_batch(spark, thinned))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_named_state_is_readable_after_stop(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    ckpt = tempfile.mkdtemp(prefix="rv-ckpt-")
    _write_parts(topic_parts, d)
    q = RN.start(T.count_by_key(_stream(spark, d)), output_mode="update", checkpoint=ckpt,
                 sink="noop")
    RN.drain(q)
    state = spark.read.format("statestore").load(ckpt)
    got = sorted((r.key.key, r.value["count"]) for r in state.collect())
    exp = sorted(tuple(r) for r in T.count_by_key(_batch(spark, topic_parts)).collect())
    assert got == exp


def test_cadence_trigger_stamp_and_json_panel(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    out = tempfile.mkdtemp(prefix="rv-panel-") + "/panel"
    stamped = RN.stamp_arrival(_stream(spark, d))

    def build(batch):
        return L.category_domain(L.category_total(
            batch.select(F.col("key").alias("category"), F.length("value").cast("bigint").alias("value"))),
            ["click", "view", "refund"])

    q = RN.start(stamped, trigger="200 milliseconds", foreach_batch=SN.json_snapshot(out, build))
    q.processAllAvailable()
    q.stop()
    panel = spark.read.json(SN.json_page(spark, out))
    assert sorted(r.category for r in panel.collect()) == ["click", "refund", "view"]
    assert RN.trigger_args("1 second") == {"processingTime": "1 second"}
    assert "time" in stamped.columns


@pytest.mark.parametrize("series", [None, "key"])
def test_distributed_running_totals_parity(spark, topic_parts, series):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    base = tempfile.mkdtemp(prefix="rv-run-")
    s = _stream(spark, d).withColumn("inc", F.length("value").cast("bigint"))
    q = RN.start(s, foreach_batch=SN.running_totals(f"{base}/out", f"{base}/carry", "inc", _order(),
                                                   series=series, seed=5))
    RN.drain(q)
    got = SN.read_batches(spark, f"{base}/out").select("partition", "offset", "seq", "total")
    b = _batch(spark, topic_parts).withColumn("inc", F.length("value").cast("bigint"))
    exp = L.running_total(L.sequence(b, _order(), series), "inc", _order(), series, seed=5)
    cols = ["partition", "offset", "seq", "total"]
    assert sorted(got.collect()) == sorted(exp.select(*cols).collect())


def test_dashboard_stream_equals_batch_over_four_batches(spark):
    from rivulet.plans import live_queries as LQ
    from rivulet.plans.stream_queries import dashboard_specs
    from rivulet.streaming.dashboard import dashboard_sink, visible
    ev = pq.read_table(f"{SF_SMALL}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    q = ev.num_rows // 4
    d = tempfile.mkdtemp(prefix="rv-events-")
    now = time.time()
    for i in range(4):
        part = ev.slice(i * q, q if i < 3 else ev.num_rows - 3 * q)
        path = f"{d}/part-{i}.parquet"
        pq.write_table(part, path)
        os.utime(path, (now - 100 + i, now - 100 + i))
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out = tempfile.mkdtemp(prefix="rv-dash-") + "/table"
    page = tempfile.mkdtemp(prefix="rv-page-") + "/panel.json"
    RN.drain(RN.start(stream, foreach_batch=dashboard_sink(out, dashboard_specs(), json_path=page)))
    got = sorted(visible(SN.read_latest(spark, out)).collect(), key=str)
    exp = sorted(LQ.live_dashboard(spark, SF_SMALL).collect(), key=str)
    assert got == exp
    assert spark.read.json(SN.json_page(spark, page)).count() == len(exp)


def test_keyed_state_restart_on_same_checkpoint(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    ckpt = tempfile.mkdtemp(prefix="rv-ckpt-")
    out = tempfile.mkdtemp(prefix="rv-out-") + "/seq"

    def run():
        s = _stream(spark, d).withColumn("inc", F.length("value").cast("bigint"))
        RN.drain(RN.start(K.running_count_and_total(s, ["key"], ORDER_COLS, inc="inc"), sink="parquet",
                          path=out, checkpoint=ckpt))

    _write_parts(topic_parts[:2], d)
    run()
    _write_parts(topic_parts[2:], d, start=2)
    run()  # state (count, total per key) restored from the checkpoint
    b = _batch(spark, topic_parts).withColumn("inc", F.length("value").cast("bigint"))
    exp = L.running_total(L.sequence(b, _order(), "key"), "inc", _order(), "key", seed=0)
    cols = ["partition", "offset", "seq", "total"]
    assert sorted(spark.read.parquet(out).select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_foreach_batch_writers_are_idempotent_on_retry(spark, topic_parts):
    base = tempfile.mkdtemp(prefix="rv-retry-")
    batch0 = _batch(spark, topic_parts[:2]).withColumn("inc", F.lit(1).cast("bigint"))
    batch1 = _batch(spark, topic_parts[2:]).withColumn("inc", F.lit(1).cast("bigint"))
    fn = SN.running_totals(f"{base}/out", f"{base}/carry", "inc", _order(), series="key")
    fn(batch0, 0)
    fn(batch1, 1)
    first = sorted(SN.read_batches(spark, f"{base}/out").collect())
    fn(batch1, 1)  # a retried batch rewrites its own output and carry
    assert sorted(SN.read_batches(spark, f"{base}/out").collect()) == first

    snap = f"{base}/lastn"
    upd = SN.maintain(snap, SN.last_n_update(5, ORDER_COLS, "key"))
    upd(batch0, 0)
    upd(batch1, 1)
    once = sorted(SN.read_latest(spark, snap).collect())
    upd(batch1, 1)
    assert sorted(SN.read_latest(spark, snap).collect()) == once


def test_sliding_and_history_stream_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    y = F.when(F.col("offset") % 3 == 0, F.lit(None)).otherwise(F.length("value")).cast("bigint")
    s = _stream(spark, d).withColumn("y", y)
    got = RN.run_to_files(K.sequence_and_sliding(s, ["key"], ORDER_COLS, "y", 4))
    b = _batch(spark, topic_parts).withColumn("y", y)
    numbered = L.sequence_with_accepted(b, _order(), "key")
    exp = L.sliding(L.accepted(numbered), _order(), 4, "y", "key", position="apos")
    cols = ["partition", "offset", "seq", "n", "lo", "hi", "total"]
    assert sorted(got.where(F.col("y").isNotNull()).select(*cols).collect()) == \
        sorted(exp.select(*cols).collect())

    base = tempfile.mkdtemp(prefix="rv-hist-")
    inc = _stream(spark, d).withColumn("inc", F.length("value").cast("bigint"))
    RN.drain(RN.start(inc, foreach_batch=SN.running_totals(
        f"{base}/out", f"{base}/carry", "inc", _order(), seed=0,
        history_path=f"{base}/hist", history_n=50)))
    hist = SN.read_latest(spark, f"{base}/hist").select("partition", "offset", "total")
    bi = _batch(spark, topic_parts).withColumn("inc", F.length("value").cast("bigint"))
    exp_h = L.history(bi, "inc", _order(), 50).select("partition", "offset", "total")
    assert sorted(hist.collect()) == sorted(exp_h.collect())


def test_apps_run_end_to_end(spark, topic_parts):
    from rivulet import apps
    src = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, src)
    base = tempfile.mkdtemp(prefix="rv-apps-")

    RN.drain(apps.run(spark, ["wordcount", "--source", src, "--sink", f"{base}/wc",
                              "--checkpoint", f"{base}/ck-wc", "--per-trigger", "1"]))
    got = CL.read_changelog(spark, f"{base}/wc", ["key"])
    exp = T.word_count(_batch(spark, topic_parts)).withColumnRenamed("word", "key")
    assert sorted(got.collect()) == sorted(exp.collect())

    RN.drain(apps.run(spark, ["tour", "--flag", "groupby", "--source", src, "--sink", f"{base}/gb",
                              "--checkpoint", f"{base}/ck-gb"]))
    exp = T.count_by(_batch(spark, topic_parts), T.upper_value)
    assert sorted(CL.read_changelog(spark, f"{base}/gb", ["key"]).collect()) == sorted(exp.collect())

    RN.drain(apps.run(spark, ["tour", "--flag", "map", "--source", src, "--sink", f"{base}/map",
                              "--checkpoint", f"{base}/ck-map"]))
    assert spark.read.parquet(f"{base}/map").count() == sum(len(p) for p in topic_parts)

    nums = [p.assign(value=p["value"].str.len().astype(str)) for p in topic_parts]
    nsrc = tempfile.mkdtemp(prefix="rv-nums-")
    _write_parts(nums, nsrc)
    RN.drain(apps.run(spark, ["livechart", "--source", nsrc, "--sink", f"{base}/live",
                              "--checkpoint", f"{base}/ck-live", "--per-trigger", "1"]))
    live = SN.read_latest(spark, f"{base}/live/history")
    assert live.count() == 20 and live.agg(F.max("seq")).first()[0] == sum(len(p) for p in nums)

    RN.drain(apps.run(spark, ["timeseries", "--source", nsrc, "--sink", f"{base}/ts",
                              "--checkpoint", f"{base}/ck-ts", "--per-trigger", "1"]))
    newest = SN.read_latest(spark, f"{base}/ts/history").orderBy(F.col("timestamp").desc()).first()
    assert newest.total == sum(int(v) for p in nums for v in p["value"])

    RN.drain(apps.run(spark, ["gauges", "--source", nsrc, "--sink", f"{base}/g",
                              "--checkpoint", f"{base}/ck-g", "--per-trigger", "1"]))
    g = {r.key: r.value for r in CL.read_changelog(spark, f"{base}/g", ["key"]).collect()}
    import pandas as pd
    allnums = pd.concat(nums)
    assert g == {k: 10 + int(v.astype(int).sum()) for k, v in allnums.groupby("key")["value"]}


def test_update_mode_changelog_over_four_batches(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = RN.run_to_files(T.word_count(_stream(spark, d)), output_mode="update", keys=["word"])
    exp = T.word_count(_batch(spark, topic_parts))
    assert sorted(got.collect()) == sorted(exp.collect())
    latest = RN.run_to_files(T.latest_by_key(_stream(spark, d), ORDER_COLS, keep_tombstones=True),
                             output_mode="update", keys=["key"])
    assert sorted(latest.collect()) == sorted(T.latest_by_key(_batch(spark, topic_parts), ORDER_COLS).collect())


def test_distributed_take_until_and_gaps_parity(spark, topic_parts):
    from rivulet.operators.topics import offset_gaps
    from rivulet.sources.readers import take_until
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    base = tempfile.mkdtemp(prefix="rv-tu-")
    RN.drain(RN.start(_stream(spark, d), foreach_batch=SN.take_until_batches(
        f"{base}/out", f"{base}/carry", F.col("key") == "error")))
    got = SN.read_batches(spark, f"{base}/out").drop("batch")
    exp = take_until(_batch(spark, topic_parts), F.col("key") == "error")
    assert sorted(got.collect()) == sorted(exp.collect())

    thinned = [p[p["key"] != "error"] for p in topic_parts]
    d2 = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(thinned, d2)
    base2 = tempfile.mkdtemp(prefix="rv-gaps-")
    RN.drain(RN.start(_stream(spark, d2), foreach_batch=SN.offset_gaps_batches(f"{base2}/out", f"{base2}/carry")))
    got = SN.read_batches(spark, f"{base2}/out").drop("batch")
    assert sorted(got.collect()) == sorted(offset_gaps(_batch(spark, thinned)).collect())


def test_json_topic_raw_envelope_decode_and_console_lines(spark, topic_parts):
    from rivulet.sources.envelope import RAW_ENVELOPE
    from rivulet.sources.readers import decode_values
    d = tempfile.mkdtemp(prefix="rv-json-") + "/topic"
    b = _batch(spark, topic_parts)
    W.to_topic(b, d, fmt="json")
    back = read_topic(spark, d, fmt="json")
    assert sorted(back.collect()) == sorted(b.collect())

    raw_dir = tempfile.mkdtemp(prefix="rv-raw-") + "/topic"
    rows = [(None, bytearray(b"ok"), 0, 0, None), (None, bytearray(b"\xffbad"), 0, 1, None)]
    spark.createDataFrame(rows, RAW_ENVELOPE).write.parquet(raw_dir)
    decoded = RN.run_to_files(decode_values(read_topic(spark, raw_dir, stream=True, raw=True)))
    assert sorted((r.offset, r.value, r.valid) for r in decoded.collect()) == [(0, "ok", True), (1, None, False)]

    lines = W.console_lines(b.where(F.col("offset") == 0)).collect()
    assert all(r.value.startswith("Consumer Record:(") for r in lines) and len(lines) == 4


def test_mirror_json_topic_keeps_microseconds(spark, topic_parts):
    src = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, src)
    dst = tempfile.mkdtemp(prefix="rv-mirror-") + "/topic"
    RN.drain(RN.mirror(spark, src, dst, fmt="parquet"))
    jdst = tempfile.mkdtemp(prefix="rv-mirror-") + "/json"
    W.to_topic(RN.replay(spark, dst), jdst, fmt="json")
    jdst2 = tempfile.mkdtemp(prefix="rv-mirror-") + "/json2"
    RN.drain(RN.mirror(spark, jdst, jdst2, fmt="json"))
    assert sorted(RN.replay(spark, jdst2, fmt="json").collect()) == sorted(_batch(spark, topic_parts).collect())


RECORD_OPS = {
    "branch": lambda df: R.branch(df, lambda k, v: k.startswith("c"), lambda k, v: k.startswith("v"), F.lit(True)),
    "filter": lambda df: R.filter_records(df, R.first_tab_field_is_not()),
    "filter_numeric": lambda df: R.filter_records(df, R.first_tab_number_above()),
    "filter_not": lambda df: R.filter_not(df, R.first_tab_number_above()),
    "flat_map": lambda df: R.flat_map(df, R.hey_hi),
    "flat_map_values": lambda df: R.flat_map_values_split(df, "\\W+", lower=True),
    "flat_map_ws": lambda df: R.flat_map_values_split(df, "\\s+"),
    "map": lambda df: R.map_records(df, R.lower_and_length),
    "map_values": lambda df: R.map_values(df, F.upper),
    "select_key": lambda df: R.select_key(df, R.first_word_key),
    "format_line": lambda df: R.format_line(df),
    "constant_key": lambda df: R.constant_key(df),
    "route": lambda df: R.route(df, {"a": lambda d: d.where(F.col("key") == "click"),
                                     "b": lambda d: R.filter_records(d, R.first_tab_field_is_not())}),
    "json_envelope": lambda df: RD.unwrap_json(RD.wrap_json(df)),
    "long_values": lambda df: W.long_values(df.withColumn("count", F.length("value").cast("bigint"))),
}


@pytest.mark.parametrize("op", sorted(RECORD_OPS))
def test_record_operator_batch_stream_parity(spark, topic_parts, op):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = RN.run_to_files(RECORD_OPS[op](_stream(spark, d)))
    exp = RECORD_OPS[op](_batch(spark, topic_parts))
    assert got.count() == exp.count()
    assert sorted(got.select(*exp.columns).collect()) == sorted(exp.collect())


AGG_OPS = {
    "count_by_upper": (lambda df: T.count_by(df, T.upper_value), ["key"]),
    "compact": (lambda df: T.newest_record_by(df, ["partition", "key"], order_cols=("offset",)),
                ["partition", "key"]),
    "topic_summary": (lambda df: O.topic_summary(df),
                      ["partition"]),
    "throughput": (lambda df: O.throughput(df, bucket="day"),
                   ["bucket"]),
}


@pytest.mark.parametrize("op", sorted(AGG_OPS))
def test_aggregate_batch_stream_parity(spark, topic_parts, op):
    fn, keys = AGG_OPS[op]
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    got = RN.run_to_files(fn(_stream(spark, d)), output_mode="update", keys=keys)
    exp = fn(_batch(spark, topic_parts))
    assert sorted(got.select(*exp.columns).collect()) == sorted(exp.collect())


def test_stop_when_idle(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts[:1], d)
    out = tempfile.mkdtemp(prefix="rv-idle-") + "/out"
    q = RN.start(_stream(spark, d), sink="parquet", path=out, trigger="100 milliseconds")
    empty = RN.stop_when_idle(q, idle_batches=40, poll_seconds=0.25, timeout_seconds=120)
    assert not q.isActive and empty > 40
    assert spark.read.parquet(out).count() == len(topic_parts[0])


@pytest.mark.parametrize("flag", ["branch", "filter", "flatMap", "selectKey", "foreach", "groupbyKey"])
def test_tour_flags(spark, topic_parts, flag):
    from rivulet import apps
    src = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, src)
    base = tempfile.mkdtemp(prefix="rv-tour-")
    RN.drain(apps.run(spark, ["tour", "--flag", flag, "--source", src, "--sink", f"{base}/out",
                              "--checkpoint", f"{base}/ck"]))
    b = _batch(spark, topic_parts)
    if flag == "groupbyKey":
        got = CL.read_changelog(spark, f"{base}/out", ["key"])
        assert sorted(got.collect()) == sorted(T.count_by_key(b).collect())
    elif flag == "foreach":
        lines = spark.read.text(f"{base}/out")
        assert sorted(r.value for r in lines.collect()) == sorted(
            r.line for r in R.format_line(b).collect())
    else:
        got = spark.read.parquet(f"{base}/out")
        exp = apps.TOUR[flag](b)
        assert sorted(got.select("key", "value").collect()) == sorted(exp.select("key", "value").collect())


def test_consumer_app_drains_and_stops(spark, topic_parts):
    # the console sink prints from the JVM (its own stdout); the lines
    # themselves are checked in test_json_topic_raw_envelope_decode_and_console_lines
    from rivulet import apps
    src = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts[:1], src)
    q = apps.run(spark, ["consumer", "--source", src, "--checkpoint", tempfile.mkdtemp(prefix="rv-ck-")])
    RN.drain(q)
    assert not q.isActive and q.lastProgress is not None


class _Query:
    """A query that is always busy with one micro-batch, then done."""

    def __init__(self, busy, polls):
        self.busy, self.left, self.recentProgress = busy, polls, []

    @property
    def isActive(self):
        self.left -= 1
        return self.left > 0

    @property
    def status(self):
        return {"isTriggerActive": self.busy, "isDataAvailable": self.busy}

    def stop(self):
        self.left = 0


def test_a_running_micro_batch_is_not_idle():
    assert RN.stop_when_idle(_Query(True, 50), idle_batches=5, poll_seconds=0.001) == 0
    assert RN.stop_when_idle(_Query(False, 50), idle_batches=5, poll_seconds=0.001) == 6


def test_reset_and_reprocess_into_the_same_sinks(spark, topic_parts):
    """A fresh checkpoint starts from nothing and its result replaces the old."""
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    base = tempfile.mkdtemp(prefix="rv-reset-")

    def run(read):
        s = read.withColumn("inc", F.lit(1).cast("bigint")).withColumn("y", F.length("value").cast("bigint"))
        sinks = [SN.running_totals(f"{base}/out", f"{base}/carry", "inc", _order(), series="key",
                                   history_path=f"{base}/hist", history_n=3),
                 SN.maintain(f"{base}/snap", SN.last_n_update(5, ORDER_COLS, "key")),
                 SN.take_until_batches(f"{base}/t", f"{base}/tc", F.col("key") == "error"),
                 SN.offset_gaps_batches(f"{base}/g", f"{base}/gc"),
                 SN.sliding_batches(f"{base}/s", f"{base}/sc", f"{base}/st", _order(), 4, "y", "key")]
        for f in sinks:
            RN.drain(RN.start(s, foreach_batch=f))
        RN.drain(RN.start(T.count_by_key(read), output_mode="update", foreach_batch=CL.changelog_writer(f"{base}/log", ["key"])))
        got = [SN.read_batches(spark, f"{base}/{x}").drop("batch") for x in ("out", "t", "g", "s")]
        got += [SN.read_latest(spark, f"{base}/{x}") for x in ("hist", "snap", "carry")]
        return [sorted(g.select(sorted(g.columns)).collect(), key=str) for g in got] + \
            [sorted(CL.read_changelog(spark, f"{base}/log", ["key"]).collect())]

    first = run(_stream(spark, d))
    assert run(_stream(spark, d)) == first  # drained again: the same tables, not the old state continued
    half = run(_stream(spark, d).where("partition < 2"))
    assert half != first
    want = _batch(spark, topic_parts).where("partition < 2")
    assert half[-1] == sorted(T.count_by_key(want).collect())
    assert len(half[0]) == want.count()


def test_sliding_batches_parity(spark, topic_parts):
    d = tempfile.mkdtemp(prefix="rv-topic-")
    _write_parts(topic_parts, d)
    base = tempfile.mkdtemp(prefix="rv-slide-")
    big = F.lit((1 << 53) + 1).cast("bigint") + F.col("offset")
    y = F.when(F.col("offset") % 3 != 0, big)
    RN.drain(RN.start(_stream(spark, d).withColumn("y", y), foreach_batch=SN.sliding_batches(
        f"{base}/s", f"{base}/c", f"{base}/t", _order(), 20, "y", "key")))
    got = SN.read_batches(spark, f"{base}/s")
    b = L.sequence_with_accepted(_batch(spark, topic_parts).withColumn("y", y), _order(), "key")
    exp = L.sliding(L.accepted(b), _order(), 20, "y", "key", position="apos")
    cols = ["key", "partition", "offset", "y", "seq", "n", "lo", "hi", "total"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_take_until_batches_with_tied_times(spark):
    base = tempfile.mkdtemp(prefix="rv-tie-")
    rows = [(0, 5, 1, "stop"), (0, 5, 2, "after"), (0, 5, 0, "before"), (1, 5, 3, "other")]
    df = spark.createDataFrame(rows, "partition int, timestamp long, event_id long, key string")
    SN.take_until_batches(f"{base}/o", f"{base}/c", F.col("key") == "stop", ("timestamp", "event_id"))(df, 0)
    assert sorted(r.key for r in SN.read_batches(spark, f"{base}/o").collect()) == ["before", "other"]


def test_dashboard_total_survives_a_late_batch(spark):
    import datetime as dt
    from rivulet.streaming.dashboard import PanelSpec, dashboard_sink, visible
    path = tempfile.mkdtemp(prefix="rv-late-") + "/t"
    sink = dashboard_sink(path, [PanelSpec("calls", "v", "history", lambda b: b, n=10)])
    t0 = dt.datetime(2024, 1, 1)
    for k, (t, v) in enumerate([(10, 5), (3, 7), (20, 1)]):
        sink(spark.createDataFrame([("a", t0 + dt.timedelta(seconds=t), k, v)],
                                   "category string, ts timestamp_ntz, event_id long, value long"), k)
    got = {r.x_time: r.y for r in visible(SN.read_latest(spark, path)).collect()}
    assert got[t0 + dt.timedelta(seconds=20)] == 13 and len(got) == 3


def test_category_domain_of_raw_readings(spark):
    df = spark.createDataFrame([("USD", 4), ("USD", 9), ("EUR", 1)], "category string, value long")
    got = L.category_domain(df, ["INR", "USD"], start=10).orderBy("ord").collect()
    assert [(r.category, r.value) for r in got] == [("INR", 10), ("USD", 9)]


def test_kafka_options_reach_reader_and_writer(monkeypatch):
    """No broker here: only what the apps hand to Spark is looked at."""
    from rivulet import apps
    seen = {}
    monkeypatch.setattr(apps, "read_topic", lambda spark, topic, **kw: seen.update(read=(topic, kw)))
    monkeypatch.setattr(apps.W, "to_topic", lambda df, topic, **kw: seen.update(write=(topic, kw)))
    argv = ["mirror", "--source", "in", "--sink", "out", "--fmt", "kafka", "--sink-fmt", "kafka", "--starting", "latest",
            "--option", "kafka.bootstrap.servers=h:9092", "--checkpoint", "c"]
    apps.run(None, argv)
    opts = {"kafka.bootstrap.servers": "h:9092"}
    assert seen["read"] == ("in", dict(fmt="kafka", stream=True, starting="latest", options=opts, per_trigger=10_000_000))
    assert seen["write"] == ("out", dict(fmt="kafka", checkpoint="c", trigger="available-now", options=opts))
    for bad in (["wordcount", "--source", "x"], ["consumer", "--source", "x", "--starting", "latest"],
                ["dashboard", "--source", "x", "--sink", "y"]):
        with pytest.raises(SystemExit):
            apps.parse_args(bad)


def test_viewer_dashboard_produce_and_mirror(spark):
    from rivulet import apps
    base = tempfile.mkdtemp(prefix="rv-more-")
    os.makedirs(f"{base}/lines")
    with open(f"{base}/lines/a.txt", "w") as f:
        f.write("1\n2\nexit\n3\n")
    run = lambda *a: RN.drain(apps.run(spark, list(a)))
    run("produce", "--source", f"{base}/lines", "--sink", f"{base}/topic", "--key", "k")
    rows = [r.value for r in read_topic(spark, f"{base}/topic").collect()]
    assert sorted(rows) == ["1", "2", "3", "exit"]
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a" if i % 2 else "b", v, 0, i, t0 + dt.timedelta(seconds=i)) for i, v in
                           enumerate(["1", "2", "exit", "3"])], ENVELOPE).write.parquet(f"{base}/numbered")
    run("mirror", "--source", f"{base}/numbered", "--sink", f"{base}/copy")
    assert sorted(read_topic(spark, f"{base}/copy").collect()) == sorted(read_topic(spark, f"{base}/numbered").collect())
    run("viewer", "--source", f"{base}/copy", "--sink", f"{base}/view")
    assert sorted(r.value for r in SN.read_batches(spark, f"{base}/view/records").collect()) == ["1", "2"]
    run("dashboard", "--source", f"{base}/copy", "--sink", f"{base}/dash", "--domain", "a", "--domain", "c")
    page = {(r.panel, r.x_cat): r.y for r in spark.read.json(SN.json_page(spark, f"{base}/dash/page")).collect() if r.panel != "history"}
    assert page == {("latest", "a"): 3, ("latest", "c"): 10, ("total", "a"): 15, ("total", "c"): 10}


def test_table_in_a_directory_is_streamed_whole(spark, tmp_path):
    from rivulet.plans.registry import all_queries
    spark.createDataFrame([(i, f"a b{i % 3}", "en") for i in range(30)], "doc_id bigint, text string, lang string"
                          ).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in all_queries()["stream_word_count"].fn(spark, str(tmp_path)).collect()}
    assert got == {("a", 30), ("b0", 10), ("b1", 10), ("b2", 10)}
