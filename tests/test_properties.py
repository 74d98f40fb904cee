"""Property tests on generated inputs."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions import NON_WORD, WHITESPACE, explode_run_split, java_split
from rivulet.operators import live as L
from rivulet.operators import records as R
from rivulet.operators.ordered import Order

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)


def java_split_model(s: str, pattern: str) -> list[str]:
    """Java ``String.split(regex)`` (limit 0), ASCII classes, written from its
    documented rules: no match gives ``[s]``; a positive-width match at the
    start gives a leading empty string; trailing empty strings are removed."""
    parts, last, matched = [], 0, False
    for m in re.finditer(pattern, s, flags=re.ASCII):
        if m.end() == 0:
            continue
        matched = True
        parts.append(s[last:m.start()])
        last = m.end()
    if not matched:
        return [s]
    parts.append(s[last:])
    while parts and parts[-1] == "":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="ab .,\t\né_", max_size=12), min_size=1, max_size=8)


@SETTINGS
@given(texts)
def test_java_split_matches_model(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    for pattern in (NON_WORD, WHITESPACE):
        arr = {r.i: r.w for r in df.select("i", java_split("v", pattern).alias("w")).collect()}
        exploded = {}
        for r in explode_run_split(df, "v", pattern, out="w").collect():
            exploded.setdefault(r.i, []).append(r.w)
        for i, v in enumerate(vals):
            expect = java_split_model(v, pattern)
            assert arr[i] == expect, (v, pattern)
            assert sorted(exploded.get(i, [])) == sorted(expect), (v, pattern)


keys = st.lists(st.one_of(st.none(), st.sampled_from(["Cat", "Tom", "cat", "Ted", "x", ""])), min_size=1,
                max_size=30)


@SETTINGS
@given(keys)
def test_branch_outputs_partition_the_input(spark, ks):
    from tests.conftest import envelope
    df = envelope(spark, [(k, "v", 0, i) for i, k in enumerate(ks)])
    outs = R.branch_outputs(df, lambda k, v: k.startswith("C"), lambda k, v: k.startswith("T"), F.lit(True))
    seen = sorted(r.offset for o in outs for r in o.collect())
    assert seen == list(range(len(ks)))


points = st.lists(st.one_of(st.integers(-10**6, 10**6).map(str), st.sampled_from(["x", "4.5", " 7 ", "+1_0", ""])),
                  min_size=1, max_size=40)


@SETTINGS
@given(points, st.integers(1, 8))
def test_parse_split_last_n_suffix_and_total(spark, texts_, n):
    rows = [("s", T0 + dt.timedelta(seconds=i), i, t) for i, t in enumerate(texts_)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, id bigint, text string")
    order = Order.by_time("ts", "id", seconds=7)
    parsed = L.parse_points(L.sequence(df, order, "series"))
    acc, rej = L.accepted(parsed), L.rejected(parsed)
    assert sorted([r.seq for r in acc.collect()] + [r.seq for r in rej.collect()]) == list(range(1, len(rows) + 1))

    acc_rows = sorted(acc.collect(), key=lambda r: r.id)
    tail = [r.id for r in acc_rows][-n:]
    assert sorted(r.id for r in L.last_n(acc, n, ["ts", "id"], "series").collect()) == tail
    assert sorted(r.id for r in L.last_n(acc, n, ["ts", "id"]).collect()) == tail

    if acc_rows:
        tot = L.running_total(acc, "y", order, "series", seed=3).orderBy(F.col("id").desc()).first()
        assert tot.total == 3 + sum(r.y for r in acc_rows)


frames = st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(-50, 50)), min_size=1, max_size=40)


@SETTINGS
@given(frames, st.integers(1, 6), st.integers(1, 8))
def test_sliding_frame_any_size_and_bucket(spark, rows, size, bucket_rows):
    from pyspark.sql import Window
    from rivulet.operators.ordered import sequence_number, sliding_frame
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k string, id bigint, v bigint")
    pos = sequence_number(df, Order.by_number("id", width=3), ["k"], out="pos")
    got = sliding_frame(pos, "pos", size, {"s": F.sum("v"), "lo": F.min("v"), "n": F.count("v")}, ["k"],
                        bucket_rows=bucket_rows).select("id", "s", "lo", "n")
    w = Window.partitionBy("k").orderBy("id").rowsBetween(-(size - 1), 0)
    exp = df.select("id", F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("lo"),
                    F.count("v").over(w).alias("n"))
    assert sorted(got.collect()) == sorted(exp.collect())


offsets = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), min_size=1, max_size=50)


@SETTINGS
@given(offsets, st.integers(1, 16))
def test_previous_in_order_any_width(spark, rows, width):
    from pyspark.sql import Window
    from rivulet.operators.ordered import previous_in_order
    df = spark.createDataFrame(rows, "p int, o bigint")
    got = previous_in_order(df, "o", ["p"], width=width, out="prev").select("p", "o", "prev")
    exp = df.select("p", "o", F.lag("o").over(Window.partitionBy("p").orderBy("o")).alias("prev"))
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)


sums = st.lists(st.tuples(st.sampled_from(["a", "hot", None]), st.integers(0, 40),
                          st.one_of(st.none(), st.integers(-9, 9))), min_size=1, max_size=40)


@SETTINGS
@given(sums, st.integers(1, 12), st.one_of(st.none(), st.integers(-5, 5)))
def test_running_sums_any_width_nulls_and_seed(spark, rows, width, seed):
    from pyspark.sql import Window
    from rivulet.operators.ordered import running_sums
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)],
                               "k string, t bigint, id bigint, v bigint")
    got = running_sums(df, {"s": F.col("v"), "c": F.lit(1)}, Order.by_number("t", "id", width=width), ["k"],
                       seeds={"s": seed}).select("id", "s", "c")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    s = F.sum("v").over(w)
    if seed is not None:
        s = F.lit(seed) + F.coalesce(s, F.lit(0))
    exp = df.select("id", s.alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert sorted(got.collect()) == sorted(exp.collect())
