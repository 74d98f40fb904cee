"""Golden rows for the live-table operators (FIXTURES part 2)."""

import datetime as dt

from pyspark.sql import Window, functions as F

from rivulet.operators import live as L
from rivulet.operators.ordered import Order

T0 = dt.datetime(2024, 1, 1)


def _order():
    return Order.by_time("ts", "id", seconds=60)


def _points(spark, texts, series="s"):
    rows = [(series, T0 + dt.timedelta(seconds=i), i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, id bigint, text string")


def test_sequence_parse_and_rejects(spark):
    df = L.parse_points(L.sequence(_points(spark, ["5", "x", " 7 ", "4.5", "+1_000", ""]), _order(), "series"))
    ok = [(r.seq, r.y) for r in L.accepted(df).orderBy("seq").collect()]
    bad = [r.seq for r in L.rejected(df).orderBy("seq").collect()]
    assert ok == [(1, 5), (3, 7), (5, 1000)]
    assert bad == [2, 4, 6]
    assert L.rejected(df).first().reason == "Wrong Input"


def test_last_n_keeps_newest_with_own_sequence(spark):
    df = L.parse_points(L.sequence(_points(spark, [str(i) for i in range(25)]), _order()))
    buf = L.last_n(L.accepted(df), 20, ["ts", "id"])
    assert sorted(r.seq for r in buf.collect()) == list(range(6, 26))
    per = L.last_n(L.accepted(df), 20, ["ts", "id"], "series")
    assert sorted(r.seq for r in per.collect()) == list(range(6, 26))


def _incs(spark, incs):
    rows = [("s", T0 + dt.timedelta(seconds=i), i, v) for i, v in enumerate(incs)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, id bigint, inc bigint")


def test_running_total_history_and_padding(spark):
    df = _incs(spark, [3, 4, 5])
    tot = [r.total for r in L.running_total(df, "inc", _order(), seed=0).orderBy("id").collect()]
    assert tot == [3, 7, 12]
    hist = [r.total for r in L.history(df, "inc", _order(), 2).orderBy("id").collect()]
    assert hist == [7, 12]
    pad = L.padded_history(df, "inc", _order(), "ts", 5, "series").orderBy("slot").collect()
    assert [r.total for r in pad] == [0, 0, 3, 7, 12]
    assert [r.slot for r in pad] == [1, 2, 3, 4, 5]
    assert pad[0].ts == T0


def test_sliding_frame_buffer(spark):
    df = L.parse_points(L.sequence(_points(spark, [str(i) for i in range(1, 8)]), _order()))
    out = L.sliding(L.accepted(df), _order(), 3, "y", "series").orderBy("id").collect()
    assert [(r.n, r.lo, r.hi, r.total) for r in out][-2:] == [(3, 4, 6, 15), (3, 5, 7, 18)]
    assert (out[0].n, out[0].total) == (1, 1)


def test_category_gauges_and_domain(spark):
    rows = [("INR", 0, 2), ("USD", 1, 1), ("INR", 2, 3)]
    df = spark.createDataFrame(rows, "category string, id bigint, value bigint")
    totals = L.category_total(df, start=10)
    assert sorted(tuple(r) for r in totals.collect()) == [("INR", 15), ("USD", 11)]
    shown = L.category_domain(totals, ["INR", "USD", "YEN"], start=10).orderBy("ord").collect()
    assert [(r.category, r.value) for r in shown] == [("INR", 15), ("USD", 11), ("YEN", 10)]

    latest = spark.createDataFrame([("INR", 0, 5), ("USD", 1, 6), ("INR", 2, 9)],
                                   "category string, id bigint, value bigint")
    assert sorted(tuple(r) for r in L.category_latest(latest, ["id"]).collect()) == [("INR", 9), ("USD", 6)]

    readings = spark.createDataFrame([("EUR", 0, 4), ("USD", 1, 6)], "category string, id bigint, value bigint")
    dom = L.category_domain(L.category_latest(readings, ["id"]), ["INR", "USD", "YEN"], start=10)
    assert [(r.category, r.value) for r in dom.orderBy("ord").collect()] == [("INR", 10), ("USD", 6), ("YEN", 10)]


def test_dashboard_union(spark):
    a = spark.createDataFrame([("INR", 3)], "category string, value bigint")
    b = spark.createDataFrame([(T0, 7)], "ts timestamp_ntz, total bigint")
    d = L.dashboard(L.panel(a, "currency", "value1", "value", x_cat="category"),
                    L.panel(b, "calls", "value4", "total", x_time="ts"))
    assert tuple(d.columns) == L.DASHBOARD_COLUMNS
    assert d.count() == 2
    assert d.where(F.col("panel") == "calls").first().x_time == T0


def test_last_n_numbered_equals_numbering_everything(spark):
    import random
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), i * 3 % 101, i, rng.choice([None, 1, 2])) for i in range(200)]
    rows += [("rejects", 1, 1000, None)]
    df = spark.createDataFrame(rows, "series string, t int, id long, y long")
    for series in (None, "series"):
        for n in (1, 5, 500):
            w = Window.partitionBy(*([series] if series else [])).orderBy("t", "id")
            every = df.withColumn("seq", F.row_number().over(w).cast("bigint"))
            want = L.last_n(L.accepted(every), n, ["t", "id"], series)
            got = L.last_n_numbered(df, n, ["t", "id"], series=series)
            cols = ["series", "t", "id", "y", "seq"]
            assert sorted(got.select(*cols).collect(), key=str) == sorted(want.select(*cols).collect(), key=str)
    assert L.last_n_numbered(df.limit(0), 3, ["t", "id"]).collect() == []
