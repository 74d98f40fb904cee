"""Every registered query equals its DuckDB oracle (the driver's gate), on sf0.001."""

import pytest

from tests.conftest import SF_SMALL


def test_all_queries_match_oracle(spark):
    from tools.oracle_check import check
    res = check(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "no-oracle")}
    assert not bad, bad


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


@pytest.mark.parametrize("name", ["agg_word_count", "live_sequence", "ops_offset_gaps"])
def test_queries_are_lazy_dataframes(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    assert not df.isStreaming and len(df.columns) > 0


def test_oracle_in_a_daylight_saving_time_zone(spark):
    """Results must not depend on the session time zone (timestamps are
    timestamp_ntz wall clocks in the test tables)."""
    from tools.oracle_check import check
    names = {"ops_throughput", "ops_retention", "agg_changelog", "live_running_total",
             "live_history_padded", "stream_live_sequence"}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = check(spark, SF_SMALL, names, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {k: v for k, v in res.items() if v[0] != "ok"} == {}


def test_keyed_stream_runs_from_another_working_directory(tmp_path):
    """Python workers must not need this package on their path."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            f"print('ROWS', E.queries()['stream_live_sequence'](s, {SF_SMALL!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]
