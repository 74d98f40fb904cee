"""Golden rows for the record operators (FIXTURES part 2) and properties."""

from pyspark.sql import functions as F

from rivulet.functions import NON_WORD
from rivulet.operators import records as R
from tests.conftest import envelope


def test_branch_first_match_and_null_key(spark):
    df = envelope(spark, [(k, "v", 0, i) for i, k in enumerate(["Cat", "Tom", "Bob", "cat", None])])
    preds = [lambda k, v: k.startswith("C"), lambda k, v: k.startswith("T"), F.lit(True)]
    got = [r.branch for r in R.branch(df, *preds).orderBy("offset").collect()]
    assert got == [0, 1, 2, 2, 2]


def test_branch_without_catch_all_drops_and_partitions_input(spark):
    df = envelope(spark, [(k, "v", 0, i) for i, k in enumerate(["Cat", "Tom", "Bob"])])
    outs = R.branch_outputs(df, lambda k, v: k.startswith("C"), lambda k, v: k.startswith("T"))
    assert [o.count() for o in outs] == [1, 1]


def test_filter_first_tab_field(spark):
    vals = ["NULL\t1", "7\tx", "NULLX", "", "\t", None]
    df = envelope(spark, [("k", v, 0, i) for i, v in enumerate(vals)])
    kept = [r.offset for r in R.filter_records(df, R.first_tab_field_is_not()).orderBy("offset").collect()]
    assert kept == [1, 2, 3, 4]


def test_numeric_filter_and_filter_not_partition_the_input(spark):
    vals = ["15\ta", "14\ta", "x\ta", None]
    df = envelope(spark, [("k", v, 0, i) for i, v in enumerate(vals)])
    p = R.first_tab_number_above(14)
    kept = [r.offset for r in R.filter_records(df, p).collect()]
    rest = sorted(r.offset for r in R.filter_not(df, p).collect())
    assert kept == [0]
    assert rest == [1, 2, 3]


def test_flat_map_hey_hi(spark):
    df = envelope(spark, [("k", "hello", 0, 0)])
    got = sorted((r.key, r.value) for r in R.flat_map(df, R.hey_hi).collect())
    assert got == [("hello", "Hey"), ("hello", "Hi")]


def test_map_lower_and_length(spark):
    df = envelope(spark, [("k", "AbC", 0, 0)])
    r = R.map_records(df, R.lower_and_length).first()
    assert (r.key, r.value) == ("abc", "3")


def test_select_key_first_word(spark):
    df = envelope(spark, [("k", "c1 x y", 0, 0), ("k", " lead", 0, 1)])
    got = [(r.key, r.value) for r in R.select_key(df, R.first_word_key).orderBy("offset").collect()]
    assert got == [("c1", "c1 x y"), ("", " lead")]


def test_flat_map_values_keeps_key(spark):
    df = envelope(spark, [("k1", "Hello hello, world", 0, 0)])
    got = [(r.key, r.value) for r in R.flat_map_values_split(df, NON_WORD, lower=True).collect()]
    assert sorted(got) == [("k1", "hello"), ("k1", "hello"), ("k1", "world")]


def test_format_lines(spark):
    df = envelope(spark, [(None, "v", 0, 7), ("k", None, 0, 7)])
    lines = [r.line for r in R.format_line(df).orderBy("value").collect()]
    assert sorted(lines) == ["k===>null", "null===>v"]
    rec = R.format_line(df.where(F.col("key") == "k"), R.RECORD_FORMAT,
                        cols=("key", "value", "partition", "offset")).first().line
    assert rec == "Consumer Record:(k, null, 0, 7)"


def test_route_builds_only_chosen(spark):
    df = envelope(spark, [("Cat", "1\tx", 0, 0), ("Bob", "NULL\tx", 0, 1)])
    routes = {"a": lambda d: d.where(F.col("key").startswith("C")),
              "b": lambda d: R.filter_records(d, R.first_tab_field_is_not()),
              "boom": lambda d: 1 / 0}
    got = sorted((r.topic, r.offset) for r in R.route(df, routes, chosen=["a", "b"]).collect())
    assert got == [("a", 0), ("b", 0)]


def test_unpivot_segments_range(spark):
    df = spark.createDataFrame([(1, 10.0, 55.5, 120.0)], "t int, cpu double, memory double, disk double")
    long = R.unpivot_readings(df, ["t"], {"CPU": "cpu", "Memory": "memory", "Disk": "disk"})
    assert sorted((r.factor, r.x) for r in long.collect()) == [("CPU", 10.0), ("Disk", 120.0), ("Memory", 55.5)]
    seg = R.segment_rows(long).where(F.col("y0") == "CPU").first()
    assert (seg.x0, seg.y0, seg.x1, seg.y1, seg.x2, seg.y2) == (0, "CPU", 10.0, "CPU", 10.0, "CPU")
    vals = spark.createDataFrame([(v,) for v in [2399, 2400, 4500, 4501]], "v int")
    assert [r.v for r in R.range_filter(vals, "v", 2400, 4500).collect()] == [2400, 4500]


def test_pandas_udf_as_mapper_escape_hatch(spark):
    """UDF2: a vectorised pandas UDF is accepted wherever a mapper returns a Column."""
    import pandas as pd

    @F.pandas_udf("string")
    def reverse(s: pd.Series) -> pd.Series:
        return s.str[::-1]

    df = envelope(spark, [("k", "abc", 0, 0), ("k", "xy z", 0, 1)])
    got = [r.value for r in R.map_values(df, reverse).orderBy("offset").collect()]
    assert got == ["cba", "z yx"]
    keyed = R.select_key(df, lambda k, v: reverse(v)).orderBy("offset").collect()
    assert [r.key for r in keyed] == ["cba", "z yx"]


def test_python_udtf_as_flat_mapper(spark):
    """UDF3: a Python UDTF used as the flat mapper equals the Column form."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="key: string, value: string")
    class HeyHi:
        def eval(self, k, v):
            for word in R.HEY_HI:
                yield v, word

    df = envelope(spark, [("k", "hello", 0, 0), (None, "x", 1, 5)])
    got = sorted(tuple(r) for r in R.flat_map_udtf(df, HeyHi).collect())
    exp = sorted(tuple(r) for r in R.flat_map(df, R.hey_hi).select(*R.flat_map_udtf(df, HeyHi).columns).collect())
    assert got == exp and len(got) == 4
