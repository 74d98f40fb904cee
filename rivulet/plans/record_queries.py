"""Registered queries for the stateless record operators (REC1-REC16, SNK4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.text import NON_WORD, WHITESPACE
from rivulet.operators import records as R
from rivulet.plans.registry import register
from rivulet.plans.views_sql import with_views
from rivulet.sources.tables import env_dirty, env_events, env_turns, wide_input

ENV = '"key", "value", "partition", "offset", "timestamp"'
TAB = "chr(9)"

# Branch predicates adapted to the lower-case test keys
# (the reference example tests "C" and "T" on its own keys).
BRANCH_PREFIXES = ("c", "v")
FACTORS = {"CPU": "cpu", "Memory": "memory", "Disk": "disk"}
PERCENT_RANGE = (0, 100)


def _branch_preds():
    return [lambda k, v, p=p: k.startswith(p) for p in BRANCH_PREFIXES] + [F.lit(True)]


BRANCH_SQL = ("CASE WHEN coalesce(starts_with(\"key\", 'c'), false) THEN 0 "
              "WHEN coalesce(starts_with(\"key\", 'v'), false) THEN 1 ELSE 2 END")
NUMERIC_SQL = (f"(regexp_matches(split_part(\"value\", {TAB}, 1), '^[+-]?[0-9]+$') "
               f"AND TRY_CAST(split_part(\"value\", {TAB}, 1) AS INTEGER) > 14)")


def java_split_sql(src: str, pattern: str, token: str, lower: bool, cols: str) -> str:
    v = 'lower("value")' if lower else '"value"'
    return f"""SELECT {cols}, w AS "value" FROM (
  SELECT {cols}, {v} AS v, unnest(string_split_regex({v}, '{pattern}')) AS w,
         generate_subscripts(string_split_regex({v}, '{pattern}'), 1) AS i
  FROM {src})
WHERE w <> '' OR (i = 1 AND (v = '' OR regexp_matches(v, '{token}')))"""


@register("rec_branch", "REC1, SC1", sql=with_views(
    f"SELECT {ENV}, {BRANCH_SQL} AS branch FROM env_events", "env_events"))
def rec_branch(spark, d):
    return R.branch(env_events(spark, d), *_branch_preds())


@register("rec_filter", "REC2, SC2, SC8", sql=with_views(
    f"SELECT {ENV} FROM env_dirty WHERE split_part(\"value\", {TAB}, 1) <> 'NULL'", "env_events", "env_dirty"))
def rec_filter(spark, d):
    return R.filter_records(env_dirty(spark, d), R.first_tab_field_is_not())


@register("rec_filter_numeric", "REC3, SC9", sql=with_views(
    f"SELECT {ENV} FROM env_events WHERE {NUMERIC_SQL}", "env_events"))
def rec_filter_numeric(spark, d):
    return R.filter_records(env_events(spark, d), R.first_tab_number_above())


@register("rec_filter_not", "REC4", sql=with_views(
    f"SELECT {ENV} FROM env_events WHERE NOT coalesce({NUMERIC_SQL}, false)", "env_events"))
def rec_filter_not(spark, d):
    return R.filter_not(env_events(spark, d), R.first_tab_number_above())


@register("rec_flat_map", "REC5, SC13", sql=with_views(
    "SELECT \"value\" AS \"key\", 'Hey' AS \"value\", \"partition\", \"offset\", \"timestamp\" FROM env_events "
    "UNION ALL SELECT \"value\", 'Hi', \"partition\", \"offset\", \"timestamp\" FROM env_events", "env_events"))
def rec_flat_map(spark, d):
    return R.flat_map(env_events(spark, d), R.hey_hi)


@register("rec_flat_map_values", "REC6, SC3, SC4", sql=with_views(
    java_split_sql("env_turns", "\\W+", "\\w", True, '"key", "partition", "offset"'), "env_turns"))
def rec_flat_map_values(spark, d):
    return R.flat_map_values_split(env_turns(spark, d), NON_WORD, lower=True).select(
        "key", "partition", "offset", "value")


@register("rec_flat_map_ws", "REC7, SC3", sql=with_views(
    java_split_sql("env_turns", "\\s+", "\\S", False, '"key", "partition", "offset"'), "env_turns"))
def rec_flat_map_ws(spark, d):
    return R.flat_map_values_split(env_turns(spark, d), WHITESPACE).select(
        "key", "partition", "offset", "value")


@register("rec_map", "REC8, SC4, SC6, SC7", sql=with_views(
    'SELECT lower("value") AS "key", CAST(length("value") + length(regexp_replace("value", '
    '\'[^\\x{10000}-\\x{10FFFF}]\', \'\', \'g\')) AS VARCHAR) AS "value", '
    '"partition", "offset", "timestamp" FROM env_events', "env_events"))
def rec_map(spark, d):
    return R.map_records(env_events(spark, d), R.lower_and_length)


@register("rec_map_values", "REC9, SC5", sql=with_views(
    "SELECT \"key\", upper(replace(\"value\", 'ß', 'ss')) AS \"value\", \"partition\", \"offset\", "
    "\"timestamp\" FROM env_turns", "env_turns"))
def rec_map_values(spark, d):
    return R.map_values(env_turns(spark, d), F.upper)


@register("rec_select_key", "REC10, SC2", sql=with_views(
    "SELECT split_part(\"value\", ' ', 1) AS \"key\", \"value\", \"partition\", \"offset\", \"timestamp\" "
    "FROM env_events", "env_events"))
def rec_select_key(spark, d):
    return R.select_key(env_events(spark, d), R.first_word_key)


@register("rec_format_line", "REC11, SC12", sql=with_views(
    "SELECT \"partition\", \"offset\", coalesce(\"key\", 'null') || '===>' || coalesce(\"value\", 'null') "
    "AS line FROM env_dirty", "env_events", "env_dirty"))
def rec_format_line(spark, d):
    return R.format_line(env_dirty(spark, d), R.FOREACH_FORMAT).select("partition", "offset", "line")


@register("snk_record_line", "SNK4", sql=with_views(
    "SELECT \"partition\", \"offset\", 'Consumer Record:(' || coalesce(\"key\", 'null') || ', ' || "
    "coalesce(\"value\", 'null') || ', ' || CAST(\"partition\" AS VARCHAR) || ', ' || "
    "CAST(\"offset\" AS VARCHAR) || ')' AS line FROM env_dirty", "env_events", "env_dirty"))
def snk_record_line(spark, d):
    return R.format_line(env_dirty(spark, d), R.RECORD_FORMAT,
                         cols=("key", "value", "partition", "offset")).select("partition", "offset", "line")


@register("rec_constant_key", "REC12", sql=with_views(
    "SELECT '1' AS \"key\", \"value\", \"partition\", \"offset\", \"timestamp\" FROM env_turns", "env_turns"))
def rec_constant_key(spark, d):
    return R.constant_key(env_turns(spark, d))


@register("rec_route", "REC13", sql=with_views(
    f"SELECT {ENV}, 'a_topic' AS topic FROM env_events WHERE {BRANCH_SQL} = 0 "
    f"UNION ALL SELECT {ENV}, 'filter_topic' FROM env_events "
    f"WHERE split_part(\"value\", {TAB}, 1) <> 'NULL'", "env_events"))
def rec_route(spark, d):
    routes = {
        "a_topic": lambda df: R.branch_outputs(df, *_branch_preds())[0],
        "filter_topic": lambda df: R.filter_records(df, R.first_tab_field_is_not()),
        "hey_hi_topic": lambda df: R.flat_map(df, R.hey_hi),
        "topic_map": lambda df: R.map_records(df, R.lower_and_length),
    }
    return R.route(env_events(spark, d), routes, chosen=["a_topic", "filter_topic"])


UNPIVOT_SQL = " UNION ALL ".join(
    f"SELECT time, event_id, '{label}' AS factor, {col} AS x FROM wide_input"
    for label, col in FACTORS.items())


@register("rec_unpivot", "REC14", sql=with_views(UNPIVOT_SQL, "wide_input"))
def rec_unpivot(spark, d):
    return R.unpivot_readings(wide_input(spark, d), ["time", "event_id"], FACTORS)


@register("rec_segment_rows", "REC15", sql=with_views(
    "SELECT time, event_id, 0 AS x0, factor AS y0, x AS x1, factor AS y1, x AS x2, factor AS y2 "
    f"FROM ({UNPIVOT_SQL})", "wide_input"))
def rec_segment_rows(spark, d):
    long = R.unpivot_readings(wide_input(spark, d), ["time", "event_id"], FACTORS)
    return R.segment_rows(long, keep=["time", "event_id"])


@register("rec_range_filter", "REC16", sql=with_views(
    f"SELECT * FROM ({UNPIVOT_SQL}) WHERE x BETWEEN {PERCENT_RANGE[0]} AND {PERCENT_RANGE[1]}",
    "wide_input"))
def rec_range_filter(spark, d):
    long = R.unpivot_readings(wide_input(spark, d), ["time", "event_id"], FACTORS)
    return R.range_filter(long, "x", *PERCENT_RANGE)
