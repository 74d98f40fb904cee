"""Golden rows for the scalar functions (FIXTURES part 2)."""

from pyspark.sql import functions as F

from rivulet.functions import (NON_WORD, bytes_to_long, decode_utf8, explode_run_split, first_field,
                               from_json_envelope, java_format, java_parse_int, java_split,
                               long_to_bytes, py_int, to_json_envelope)

SPLIT_CASES = ["", "...", "a b", ".a", "a.", " a . b. "]
SPLIT_EXPECTED = [[""], [], ["a", "b"], ["", "a"], ["a"], ["", "a", "b"]]


def test_java_split_array(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SPLIT_CASES)], "i int, v string")
    got = {r.i: r.w for r in df.select("i", java_split("v", NON_WORD).alias("w")).collect()}
    assert [got[i] for i in range(len(SPLIT_CASES))] == SPLIT_EXPECTED


def test_java_split_general_pattern(spark):
    df = spark.createDataFrame([("a  b  ",), ("   ",), (" x",)], "v string")
    got = [r.w for r in df.select(java_split("v", " ").alias("w")).collect()]
    assert got == [["a", "", "b"], [], ["", "x"]]


def test_explode_run_split_matches_array_form(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SPLIT_CASES)], "i int, v string")
    rows = explode_run_split(df, "v", NON_WORD, out="w").collect()
    got = {}
    for r in rows:
        got.setdefault(r.i, []).append(r.w)
    assert [sorted(got.get(i, [])) for i in range(len(SPLIT_CASES))] == [sorted(e) for e in SPLIT_EXPECTED]


def test_first_field(spark):
    df = spark.createDataFrame([("c1 x y",), (" lead",), ("",), ("   ",), (None,)], "v string")
    got = [r.k for r in df.select(first_field("v", " ").alias("k")).collect()]
    assert got == ["c1", "", "", "", None]


def test_py_int_grammar(spark):
    vals = ["5", "x", " 7 ", "4.5", "+1_000", "", "1__0", "_1", "-3", "99999999999999999999", "٣"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.y for r in df.select(py_int("v").alias("y")).collect()]
    assert got == [5, None, 7, None, 1000, None, None, None, -3, None, None]


def test_java_parse_int(spark):
    df = spark.createDataFrame([("15",), (" 15",), ("+15",), ("x",), ("2147483648",)], "v string")
    got = [r.y for r in df.select(java_parse_int("v").alias("y")).collect()]
    assert got == [15, None, 15, None, None]


def test_long_bytes_round_trip(spark):
    df = spark.createDataFrame([(5,), (0,), (-1,), (2 ** 62,)], "n bigint")
    rows = df.select("n", long_to_bytes("n").alias("b")).select(
        "n", F.hex("b").alias("h"), bytes_to_long("b").alias("back")).collect()
    assert rows[0].h == "0000000000000005"
    assert rows[2].h == "FFFFFFFFFFFFFFFF"
    assert [r.back for r in rows] == [r.n for r in rows]


def test_decode_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"A"),), (bytearray(b"\xffA"),)], "b binary")
    got = [r.v for r in df.select(decode_utf8("b").alias("v")).collect()]
    assert got == ["A", None]


def test_java_format_nulls(spark):
    df = spark.createDataFrame([(None, "v"), ("k", None)], "k string, v string")
    got = [r.l for r in df.select(java_format("%s===>%s", "k", "v").alias("l")).collect()]
    assert got == ["null===>v", "k===>null"]


def test_json_envelope_round_trip(spark):
    df = spark.createDataFrame([('a "q"\tb',), ("é",)], "v string")
    out = df.select("v", to_json_envelope("v").alias("j"), to_json_envelope("v", False).alias("bare"))
    rows = out.select("v", "j", "bare", from_json_envelope("j").alias("p"),
                      from_json_envelope("bare", False).alias("p2")).collect()
    assert rows[0].j == '{"schema":{"type":"string","optional":false},"payload":"a \\"q\\"\\tb"}'
    assert rows[0].bare == '"a \\"q\\"\\tb"'
    assert all(r.p == r.v and r.p2 == r.v for r in rows)


def test_java_length_counts_utf16_units(spark):
    from rivulet.functions import java_length
    df = spark.createDataFrame([("abc",), ("é",), ("a\U0001F600b",), ("",)], "v string")
    assert [r.n for r in df.select(java_length("v").alias("n")).collect()] == [3, 1, 4, 0]
