"""Golden rows for the keyed tables (AGG1-AGG5)."""

from rivulet.operators import tables as T
from rivulet.operators.ordered import Order
from tests.conftest import envelope

def order():
    return Order.by_time("timestamp", "partition", "offset", seconds=1)


def test_count_by_key_ignores_nulls(spark):
    df = envelope(spark, [("a", "x", 0, 0), ("b", "x", 0, 1), ("a", "x", 0, 2), (None, "x", 0, 3),
                          ("a", None, 0, 4)])
    assert sorted(tuple(r) for r in T.count_by_key(df).collect()) == [("a", 2), ("b", 1)]


def test_count_by_upper(spark):
    df = envelope(spark, [("k", "x", 0, 0), ("k", "X", 0, 1), ("k", "y", 0, 2), ("k", None, 0, 3)])
    assert sorted(tuple(r) for r in T.count_by(df, T.upper_value).collect()) == [("X", 2), ("Y", 1)]


def test_word_count(spark):
    df = envelope(spark, [("k", "Hello hello, world", 0, 0), ("k", "world.", 0, 1)])
    assert sorted(tuple(r) for r in T.word_count(df).collect()) == [("hello", 2), ("world", 2)]


def test_changelog_per_record(spark):
    df = envelope(spark, [("a", "v", 0, 0), ("b", "v", 0, 1), ("a", "v", 0, 2)])
    got = [(r.key, r["count"]) for r in T.changelog(df, order()).orderBy("offset").collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2)]


def test_latest_by_key_and_tombstone(spark):
    df = envelope(spark, [("a", "1", 0, 0), ("b", "2", 0, 1), ("a", "3", 0, 2), ("c", "4", 0, 3),
                          ("c", None, 0, 4)])
    got = sorted(tuple(r) for r in T.latest_by_key(df).collect())
    assert got == [("a", "3"), ("b", "2")]
    with_deletes = sorted(tuple(r) for r in T.latest_by_key(df, keep_tombstones=True).collect())
    assert with_deletes == [("a", "3"), ("b", "2"), ("c", None)]


def test_changelog_newest_equals_snapshot(spark):
    rows = [(k, str(i), i % 3, i) for i, k in enumerate("abcabcaab")]
    df = envelope(spark, rows)
    log = T.changelog(df, order()).groupBy("key").agg({"count": "max"}).collect()
    counts = T.count_by_key(df).collect()
    assert sorted(tuple(r) for r in log) == sorted(tuple(r) for r in counts)
