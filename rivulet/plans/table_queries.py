"""Registered queries for the keyed tables (AGG1-AGG5, SNK2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.numbers import bytes_to_long, long_to_bytes
from rivulet.operators import tables as T
from rivulet.operators.ordered import Order
from rivulet.plans.registry import register
from rivulet.plans.views_sql import with_views
from rivulet.sources.tables import env_dirty, TIME_BUCKET_SECONDS, env_docs, env_events

EVENT_ORDER = ("timestamp", "partition", "offset")


def _event_order() -> Order:
    return Order.by_time("timestamp", "partition", "offset", seconds=TIME_BUCKET_SECONDS)


# The Java split rule for \W+ in DuckDB: blanks only first or last; keep the
# first blank when the text has a word character, or the text is empty.
WORDS_SQL = """SELECT "key", w AS "value" FROM (
  SELECT "key", lower("value") AS v, unnest(string_split_regex(lower("value"), '\\W+')) AS w,
         generate_subscripts(string_split_regex(lower("value"), '\\W+'), 1) AS i
  FROM {src})
WHERE w <> '' OR (i = 1 AND (v = '' OR regexp_matches(v, '\\w')))"""


WORD_COUNT_SQL = with_views(
    "SELECT \"value\" AS word, CAST(count(*) AS BIGINT) AS count FROM ("
    + WORDS_SQL.format(src="env_docs") + ") GROUP BY \"value\"", "env_docs")


@register("agg_word_count", "AGG3, REC6, AGG7", sql=WORD_COUNT_SQL)
def agg_word_count(spark, d):
    return T.word_count(env_docs(spark, d, offsets=False))


@register("agg_count_by_key", "AGG1", sql=with_views(
    'SELECT "key", CAST(count(*) AS BIGINT) AS count FROM env_dirty '
    'WHERE "key" IS NOT NULL AND "value" IS NOT NULL GROUP BY "key"', "env_events", "env_dirty"))
def agg_count_by_key(spark, d):
    return T.count_by_key(env_dirty(spark, d))


@register("agg_count_by_expr", "AGG2, AGG7, SC5", sql=with_views(
    "SELECT upper(replace(\"value\", 'ß', 'ss')) AS \"key\", CAST(count(*) AS BIGINT) AS count "
    'FROM env_turns WHERE "value" IS NOT NULL GROUP BY 1', "env_turns"))
def agg_count_by_expr(spark, d):
    from rivulet.sources.tables import env_turns
    return T.count_by(env_turns(spark, d, offsets=False), T.upper_value)


@register("agg_changelog", "AGG4, SNK6", sql=with_views(
    'SELECT "key", "partition", "offset", CAST(count(*) OVER (PARTITION BY "key" '
    'ORDER BY "timestamp", "partition", "offset" ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count '
    'FROM env_events WHERE "key" IS NOT NULL AND "value" IS NOT NULL', "env_events"))
def agg_changelog(spark, d):
    out = T.changelog(env_events(spark, d), _event_order())
    return out.select("key", "partition", "offset", "count")


@register("agg_latest_by_key", "AGG5", sql=with_views(
    'SELECT "key", "value" FROM (SELECT "key", "value", row_number() OVER (PARTITION BY "key" ORDER BY "timestamp" DESC, '
    '"partition" DESC, "offset" DESC) AS r FROM env_dirty WHERE "key" IS NOT NULL) WHERE r = 1 AND "value" IS NOT NULL',
    "env_events", "env_dirty"))
def agg_latest_by_key(spark, d):
    return T.latest_by_key(env_dirty(spark, d), EVENT_ORDER)


@register("snk_long_serde", "SNK2", sql=with_views(
    "SELECT upper(replace(\"value\", 'ß', 'ss')) AS \"key\", CAST(count(*) AS BIGINT) AS count, "
    "lpad(upper(hex(CAST(count(*) AS BIGINT))), 16, '0') AS value_hex, "
    "CAST(count(*) AS BIGINT) AS decoded "
    'FROM env_events WHERE "value" IS NOT NULL GROUP BY 1', "env_events"))
def snk_long_serde(spark, d):
    counts = T.count_by(env_events(spark, d, offsets=False), T.upper_value)
    wire = counts.withColumn("__bytes", long_to_bytes("count"))
    return wire.select("key", "count", F.hex("__bytes").alias("value_hex"),
                       bytes_to_long("__bytes").alias("decoded"))
