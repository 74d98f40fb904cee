"""Compacted changelogs: few segments, whole tables at any moment, deletes, retries."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from rivulet.streaming import changelog as CL
from rivulet.streaming import snapshot as SN


def base_dir():
    return tempfile.mkdtemp(prefix="rv-cl-") + "/table"


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, value bigint").coalesce(1)


def table(spark, path, **kw):
    return {r.key: r.value for r in CL.read_changelog(spark, path, ["key"], **kw).collect()}


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_a_thousand_batches_leave_logarithmically_many_segments(fanout):
    segments, rewritten = [], 0
    for i in range(1000):
        segments.append({"name": f"s{i}", "first": i, "last": i, "level": 0})
        while n := CL.due(segments, fanout):
            segments, new = CL.merged(segments, n)
            rewritten += new["last"] - new["first"] + 1
        assert [s["first"] for s in segments] == [0, *[s["last"] + 1 for s in segments[:-1]]]
        assert len(segments) <= (fanout - 1) * (math.floor(math.log(i + 1, fanout) + 1e-9) + 1)
    assert segments[-1]["last"] == 999 and rewritten <= 1000 * math.log(1000, fanout)


def test_table_counts_folders_and_open_readers(spark):
    path, want, readers = base_dir(), {}, []
    write = CL.changelog_writer(path, ["key"], fanout=3, grace=4)
    for i in range(30):
        rows = [(f"k{j}" if j else None, 100 * i + j) for j in range(i % 5 + 1)]
        write(batch(spark, rows), i)
        want.update(rows)
        if i % 7 == 0:
            readers.append((i, CL.read_changelog(spark, path, ["key"]), dict(want)))
        for at, df, then in readers:  # a table that was opened before stays readable for a while
            if i - at <= 1:
                assert {r.key: r.value for r in df.collect()} == then
        assert table(spark, path) == want
    folder = SN._runs(spark, path)[-1]
    live = CL.manifest(spark, folder)
    assert len(live["segments"]) <= 2 * 4
    on_disk = [n for n in SN._listing(spark, folder) if n.startswith("segment-")]
    assert set(on_disk) == {s["name"] for s in live["segments"]} | {r["name"] for r in live["retired"]}
    assert len(CL._numbers(spark, folder)) <= 4


def test_deletes_go_with_the_oldest_segment(spark):
    path = base_dir()
    gone = F.col("value").isNull()
    write = CL.changelog_writer(path, ["key"], tombstone=gone, fanout=2, grace=2)
    for i, rows in enumerate([[("a", 1), ("b", 1)], [("a", None)], [("c", 3), ("b", None)], [("b", 4)]]):
        write(batch(spark, rows), i)
        assert "a" not in table(spark, path, tombstone=gone) or i == 0
    assert table(spark, path, tombstone=gone) == {"b": 4, "c": 3}
    folder = SN._runs(spark, path)[-1]
    [only] = CL.manifest(spark, folder)["segments"]
    assert only["level"] == 2
    assert sorted(r.key for r in spark.read.parquet(f"{folder}/{only['name']}").collect()) == ["b", "c"]


def test_a_batch_tried_again(spark, monkeypatch):
    path = base_dir()
    write = CL.changelog_writer(path, ["key"], fanout=2)
    write(batch(spark, [("a", 1)]), 0)
    # a crash after the segment, before its manifest: readers see the table before
    real, calls = CL._commit, iter([True])

    def crash(*a):
        if next(calls, False):
            raise RuntimeError("crash")
        return real(*a)

    monkeypatch.setattr(CL, "_commit", crash)
    with pytest.raises(RuntimeError):
        write(batch(spark, [("a", 2), ("b", 2)]), 1)
    assert table(spark, path) == {"a": 1}
    # a crash before the merge's manifest: the batch is there, the merge is done at the next try
    calls = iter([False, True])
    monkeypatch.setattr(CL, "_commit", lambda *a: real(*a) if not next(calls, False) else (_ for _ in ()).throw(RuntimeError()))
    with pytest.raises(RuntimeError):
        write(batch(spark, [("a", 2), ("b", 2)]), 1)
    assert table(spark, path) == {"a": 2, "b": 2}
    monkeypatch.setattr(CL, "_commit", real)
    write(batch(spark, [("a", 2), ("b", 2)]), 1)
    assert table(spark, path) == {"a": 2, "b": 2}
    assert [s["level"] for s in CL.manifest(spark, SN._runs(spark, path)[-1])["segments"]] == [1]


def test_reading_sorts_nothing_by_payload(spark):
    path = base_dir()
    CL.changelog_writer(path, ["key"])(batch(spark, [("a", 1)]), 0)
    plan = CL.read_changelog(spark, path, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    with pytest.raises(FileNotFoundError):
        CL.read_changelog(spark, base_dir(), ["key"])
