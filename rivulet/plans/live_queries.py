"""Registered queries for the live-table operators (LIVE1-LIVE12, SNK7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.numbers import PY_INT_PATTERN
from rivulet.operators import live as L
from rivulet.operators import records as R
from rivulet.operators.ordered import Order
from rivulet.plans.registry import register
from rivulet.plans.views_sql import with_views
from rivulet.sources.tables import TIME_BUCKET_SECONDS, gauge_input, live_input, table, wide_input

# Buffer bounds and gauge start values of the reference charts,
# and the category domains adapted to the test event types.
LAST_N = 20
WIDE_N = 720
HISTORY_N = 3600
LAYOUT_HISTORY_N = 720
GAUGE_START = 10
SEED = 0
DOMAIN = ("click", "view", "refund")
CURRENCY_DOMAIN = ("click", "view", "signup")
STOCK_DOMAIN = ("error", "purchase", "refund")
FACTORS = {"CPU": "cpu", "Memory": "memory", "Disk": "disk"}


def _order(ts: str = "ts") -> Order:
    return Order.by_time(ts, "event_id", seconds=TIME_BUCKET_SECONDS)


def _parsed(spark, d, series=True):
    seq = L.sequence(live_input(spark, d), _order(), "series" if series else None)
    return L.parse_points(seq)


PARSE_SQL = (f"CASE WHEN regexp_matches(text, '{PY_INT_PATTERN}') "
             "THEN TRY_CAST(replace(trim(text), '_', '') AS BIGINT) END")
SEQ_SQL = "CAST(row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS BIGINT)"
GSEQ_SQL = "CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT)"
PARSED_SQL = f"SELECT series, ts, event_id, text, {SEQ_SQL} AS seq, {PARSE_SQL} AS y FROM live_input"


@register("live_sequence", "LIVE1", sql=with_views(
    f"SELECT series, event_id, text, {SEQ_SQL} AS seq FROM live_input", "live_input"))
def live_sequence(spark, d):
    return L.sequence(live_input(spark, d), _order(), "series").select("series", "event_id", "text", "seq")


@register("live_parse_ok", "LIVE2, SC10", sql=with_views(
    f"SELECT series, event_id, seq AS x, y FROM ({PARSED_SQL}) WHERE y IS NOT NULL", "live_input"))
def live_parse_ok(spark, d):
    return L.accepted(_parsed(spark, d)).select("series", "event_id", F.col("seq").alias("x"), "y")


@register("live_parse_rejects", "LIVE3", sql=with_views(
    f"SELECT series, event_id, seq, text, '{L.REJECT_REASON}' AS reason FROM ({PARSED_SQL}) "
    "WHERE y IS NULL", "live_input"))
def live_parse_rejects(spark, d):
    return L.rejected(_parsed(spark, d)).select("series", "event_id", "seq", "text", "reason")


@register("live_last_n", "LIVE4", sql=with_views(
    f"SELECT event_id, x, y FROM (SELECT ts, event_id, {GSEQ_SQL} AS x, {PARSE_SQL} AS y FROM live_input) "
    f"WHERE y IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT {LAST_N}", "live_input"))
def live_last_n(spark, d):
    out = L.last_n_numbered(L.parse_points(live_input(spark, d)), LAST_N, ["ts", "event_id"])
    return out.select("event_id", F.col("seq").alias("x"), "y")


LAST_N_BY_SERIES_SQL = with_views(
    f"SELECT series, event_id, x, y FROM (SELECT series, event_id, seq AS x, y, row_number() OVER "
    "(PARTITION BY series ORDER BY ts DESC, event_id DESC) AS r "
    f"FROM ({PARSED_SQL}) WHERE y IS NOT NULL) WHERE r <= {LAST_N}", "live_input")


@register("live_last_n_by_series", "LIVE4", sql=LAST_N_BY_SERIES_SQL)
def live_last_n_by_series(spark, d):
    out = L.last_n_numbered(L.parse_points(live_input(spark, d)), LAST_N, ["ts", "event_id"], series="series")
    return out.select("series", "event_id", F.col("seq").alias("x"), "y")


SLIDING_SQL = with_views(
    "SELECT series, event_id, seq AS x, CAST(count(y) OVER w AS BIGINT) AS n, min(y) OVER w AS lo, "
    "max(y) OVER w AS hi, CAST(sum(y) OVER w AS BIGINT) AS total "
    f"FROM ({PARSED_SQL}) WHERE y IS NOT NULL "
    f"WINDOW w AS (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN {LAST_N - 1} PRECEDING "
    "AND CURRENT ROW)", "live_input")


@register("live_sliding_frame", "LIVE5", sql=SLIDING_SQL)
def live_sliding_frame(spark, d):
    parsed = L.sequence_with_accepted(L.parse_points(live_input(spark, d)), _order(), "series")
    out = L.sliding(L.accepted(parsed), _order(), LAST_N, "y", "series", position="apos")
    return out.select("series", "event_id", F.col("seq").alias("x"), "n", "lo", "hi",
                      F.col("total").cast("bigint").alias("total"))


WIDE_SQL = SLIDING_SQL.replace(f"{LAST_N - 1} PRECEDING", f"{WIDE_N - 1} PRECEDING")


@register("live_sliding_wide", "LIVE5 (buffer of 720 points)", sql=WIDE_SQL)
def live_sliding_wide(spark, d):
    parsed = L.sequence_with_accepted(L.parse_points(live_input(spark, d)), _order(), "series")
    out = L.sliding(L.accepted(parsed), _order(), WIDE_N, "y", "series", position="apos")
    return out.select("series", "event_id", F.col("seq").alias("x"), "n", "lo", "hi",
                      F.col("total").cast("bigint").alias("total"))


def _increments(spark, d):
    ev = table(spark, d, "events")
    return ev.select(F.col("event_type").alias("series"), "ts", "event_id",
                     F.col("value").cast("decimal(18,2)").alias("inc"))


INC_SQL = ("SELECT event_type AS series, ts, event_id, CAST(value AS DECIMAL(18,2)) AS inc FROM events")


@register("live_running_total", "LIVE6, SC14, SC15", sql=(
    "SELECT series, event_id, CAST(sum(inc) OVER (PARTITION BY series ORDER BY ts, event_id "
    f"ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS total FROM ({INC_SQL})"))
def live_running_total(spark, d):
    out = L.running_total(_increments(spark, d), "inc", _order(), "series", seed=SEED)
    return out.select("series", "event_id", F.col("total").cast("decimal(28,2)").alias("total"))


@register("live_running_total_global", "LIVE6", sql=(
    "SELECT event_id, CAST(sum(inc) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) "
    f"AS DECIMAL(28,2)) AS total FROM ({INC_SQL})"))
def live_running_total_global(spark, d):
    out = L.running_total(_increments(spark, d), "inc", _order(), None, seed=SEED)
    return out.select("event_id", F.col("total").cast("decimal(28,2)").alias("total"))


HISTORY_SQL = (
    "SELECT ts, event_id, total FROM (SELECT ts, event_id, CAST(sum(inc) OVER (ORDER BY ts, event_id "
    "ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS total, row_number() OVER (ORDER BY ts DESC, "
    f"event_id DESC) AS r FROM ({INC_SQL})) WHERE r <= {HISTORY_N}")


@register("live_history", "LIVE7", sql=HISTORY_SQL)
def live_history(spark, d):
    out = L.history(_increments(spark, d), "inc", _order(), HISTORY_N, None, seed=SEED)
    return out.select("ts", "event_id", F.col("total").cast("decimal(28,2)").alias("total"))


PADDED_SQL = f"""WITH t AS (
  SELECT category AS series, ts, event_id,
         sum(value) OVER (PARTITION BY category ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total,
         row_number() OVER (PARTITION BY category ORDER BY ts DESC, event_id DESC) AS rd
  FROM gauge_input),
s AS (SELECT category AS series, count(*) AS n, min(ts) AS t0 FROM gauge_input GROUP BY category)
SELECT series, CAST({HISTORY_N} - rd + 1 AS BIGINT) AS slot, ts AS time, CAST(total AS BIGINT) AS total
FROM t WHERE rd <= {HISTORY_N}
UNION ALL
SELECT series, CAST(unnest(generate_series(1, {HISTORY_N} - n)) AS BIGINT) AS slot, t0 AS time,
       CAST({SEED} AS BIGINT) AS total
FROM s WHERE n < {HISTORY_N}"""


@register("live_history_padded", "LIVE8", sql=with_views(PADDED_SQL, "gauge_input"))
def live_history_padded(spark, d):
    g = gauge_input(spark, d).withColumnRenamed("category", "series").withColumnRenamed("ts", "time")
    out = L.padded_history(g, "value", Order.by_time("time", "event_id", seconds=TIME_BUCKET_SECONDS),
                           "time", HISTORY_N, "series", seed=SEED)
    return out.select("series", "slot", "time", F.col("total").cast("bigint").alias("total"))


TOTALS_SQL = f"SELECT category, CAST({GAUGE_START} + sum(value) AS BIGINT) AS value FROM gauge_input GROUP BY category"
LATEST_SQL = "SELECT category, arg_max(value, (ts, event_id)) AS value FROM gauge_input GROUP BY category"


@register("live_category_total", "LIVE9", sql=with_views(TOTALS_SQL, "gauge_input"))
def live_category_total(spark, d):
    return L.category_total(gauge_input(spark, d), start=GAUGE_START)


@register("live_category_latest", "LIVE10", sql=with_views(LATEST_SQL, "gauge_input"))
def live_category_latest(spark, d):
    return L.category_latest(gauge_input(spark, d), ["ts", "event_id"])


def _domain_sql(domain, values_sql):
    rows = ", ".join(f"({i}, '{c}')" for i, c in enumerate(domain))
    return (f"SELECT CAST(d.ord AS BIGINT) AS ord, d.category, CAST(coalesce(v.value, {GAUGE_START}) AS BIGINT) "
            f"AS value FROM (VALUES {rows}) d(ord, category) LEFT JOIN ({values_sql}) v "
            "ON v.category = d.category")


@register("live_category_domain", "LIVE11", sql=with_views(_domain_sql(DOMAIN, TOTALS_SQL), "gauge_input"))
def live_category_domain(spark, d):
    totals = L.category_total(gauge_input(spark, d), start=GAUGE_START)
    return L.category_domain(totals, DOMAIN, start=GAUGE_START)


DASH_SQL = f"""SELECT 'currency' AS panel, 'value1' AS series, CAST(NULL AS TIMESTAMP) AS x_time,
       category AS x_cat, value AS y FROM ({_domain_sql(CURRENCY_DOMAIN, LATEST_SQL)})
UNION ALL
SELECT 'stock', 'value2', NULL, category, value FROM ({_domain_sql(STOCK_DOMAIN, TOTALS_SQL)})
UNION ALL
SELECT 'resources', 'value3', NULL, factor, CAST(floor(x) AS BIGINT) FROM (
  SELECT factor, arg_max(x, (time, event_id)) AS x FROM (
    SELECT time, event_id, 'CPU' AS factor, cpu AS x FROM wide_input
    UNION ALL SELECT time, event_id, 'Memory', memory FROM wide_input
    UNION ALL SELECT time, event_id, 'Disk', disk FROM wide_input) GROUP BY factor)
UNION ALL
SELECT 'calls', 'value4', ts, NULL, total FROM (
  SELECT ts, CAST(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
         row_number() OVER (ORDER BY ts DESC, event_id DESC) AS r FROM gauge_input)
WHERE r <= {LAYOUT_HISTORY_N}"""


def dashboard_panels(spark, d):
    gauge = gauge_input(spark, d)
    currency = L.category_domain(L.category_latest(gauge, ["ts", "event_id"]), CURRENCY_DOMAIN,
                                 start=GAUGE_START)
    stock = L.category_domain(L.category_total(gauge, start=GAUGE_START), STOCK_DOMAIN, start=GAUGE_START)
    readings = R.unpivot_readings(wide_input(spark, d), ["time", "event_id"], FACTORS)
    newest = L.category_latest(readings, ["time", "event_id"], category="factor", value="x")
    resources = L.category_domain(newest.withColumn("x", F.floor("x")), FACTORS, category="factor", value="x",
                                  start=GAUGE_START)
    calls = L.history(gauge, "value", _order(), LAYOUT_HISTORY_N, None, seed=SEED)
    return [L.panel(currency, "currency", "value1", "value", x_cat="category"),
            L.panel(stock, "stock", "value2", "value", x_cat="category"),
            L.panel(resources, "resources", "value3", "x", x_cat="factor"),
            L.panel(calls, "calls", "value4", "total", x_time="ts")]


@register("live_dashboard", "LIVE12, SNK7", sql=with_views(DASH_SQL, "gauge_input", "wide_input"))
def live_dashboard(spark, d):
    return L.dashboard(*dashboard_panels(spark, d))
