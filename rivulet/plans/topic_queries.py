"""Registered queries for topic maintenance (OPS3-OPS9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import topics as O
from rivulet.plans.registry import register
from rivulet.plans.views_sql import with_views
from rivulet.session import scratch_path
from rivulet.sources.tables import env_events

ENV = '"key", "value", "partition", "offset", "timestamp"'

# Fixed values of the test scenario: a consumer group that processed every
# record before this instant; the replica that diverges on this key; the
# verifying consumer that lost one key's records and got another's twice.
COMMIT_BEFORE = "2024-01-15 00:00:00"
DIVERGENT_KEY = "error"
LOST_KEY = "error"
REDELIVERED_KEY = "purchase"


def _committed(df):
    return O.committed_offsets(df, F.col("timestamp") < F.lit(COMMIT_BEFORE).cast("timestamp_ntz"))


COMMITTED_SQL = (f"SELECT \"partition\", CAST(max(\"offset\") + 1 AS BIGINT) AS committed FROM env_events "
                 f"WHERE \"timestamp\" < TIMESTAMP '{COMMIT_BEFORE}' GROUP BY \"partition\"")
RETAINED_SQL = (f"SELECT {ENV} FROM env_events WHERE \"timestamp\" >= "
                f"(SELECT max(\"timestamp\") FROM env_events) - INTERVAL {O.RETENTION_HOURS} HOURS")


RETENTION_SQL = with_views(RETAINED_SQL, "env_events")


@register("ops_retention", "OPS3", sql=RETENTION_SQL)
def ops_retention(spark, d):
    return O.retention(env_events(spark, d))


@register("ops_delete_before", "OPS3", sql=with_views(
    f"SELECT e.\"key\", e.\"value\", e.\"partition\", e.\"offset\", e.\"timestamp\" FROM env_events e "
    f"LEFT JOIN ({COMMITTED_SQL}) c ON c.\"partition\" = e.\"partition\" "
    "WHERE c.committed IS NULL OR e.\"offset\" >= c.committed", "env_events"))
def ops_delete_before(spark, d):
    env = env_events(spark, d)
    return O.delete_before(env, _committed(env))


@register("ops_compact", "OPS4, AGG5", sql=with_views(
    f"SELECT {ENV} FROM (SELECT *, row_number() OVER (PARTITION BY \"partition\", \"key\" "
    "ORDER BY \"offset\" DESC) AS r FROM env_events) WHERE r = 1", "env_events"))
def ops_compact(spark, d):
    return O.compact(env_events(spark, d))


LAG_SQL = with_views(
    "SELECT e.\"partition\", e.end_offset, c.committed, "
    "coalesce(e.end_offset - c.committed, e.n) AS lag FROM (SELECT \"partition\", "
    "CAST(max(\"offset\") + 1 AS BIGINT) AS end_offset, CAST(count(*) AS BIGINT) AS n FROM env_events "
    f"GROUP BY \"partition\") e LEFT JOIN ({COMMITTED_SQL}) c ON c.\"partition\" = e.\"partition\"",
    "env_events")


@register("ops_lag", "OPS5", sql=LAG_SQL)
def ops_lag(spark, d):
    env = env_events(spark, d)
    return O.lag(env, _committed(env))


SUMMARY_SQL = with_views(
    "SELECT \"partition\", min(\"offset\") AS first_offset, max(\"offset\") AS last_offset, "
    "CAST(count(*) AS BIGINT) AS records, min(\"timestamp\") AS first_timestamp, "
    "max(\"timestamp\") AS last_timestamp FROM env_events GROUP BY \"partition\"", "env_events")


@register("ops_topic_summary", "OPS6", sql=SUMMARY_SQL)
def ops_topic_summary(spark, d):
    return O.topic_summary(env_events(spark, d))


RECONCILE_SQL = with_views(
    "SELECT coalesce(l.\"partition\", r.\"partition\") AS \"partition\", "
    "coalesce(l.\"offset\", r.\"offset\") AS \"offset\", "
    "CASE WHEN l.\"offset\" IS NULL THEN 'missing_left' WHEN r.\"offset\" IS NULL THEN 'missing_right' "
    "ELSE 'differs' END AS status, l.\"value\" AS left_value, r.\"value\" AS right_value "
    "FROM env_events l FULL OUTER JOIN (SELECT \"key\", "
    f"CASE WHEN \"key\" = '{DIVERGENT_KEY}' THEN upper(\"value\") ELSE \"value\" END AS \"value\", "
    f"\"partition\", \"offset\", \"timestamp\" FROM ({RETAINED_SQL})) r "
    "ON l.\"partition\" = r.\"partition\" AND l.\"offset\" = r.\"offset\" "
    "WHERE l.\"offset\" IS NULL OR r.\"offset\" IS NULL OR l.\"key\" IS DISTINCT FROM r.\"key\" "
    "OR l.\"value\" IS DISTINCT FROM r.\"value\" OR l.\"timestamp\" IS DISTINCT FROM r.\"timestamp\"",
    "env_events")


def _replicas(leader):
    return leader, O.retention(leader).withColumn(
        "value", F.when(F.col("key") == DIVERGENT_KEY, F.upper("value")).otherwise(F.col("value")))


@register("ops_reconcile", "OPS7", sql=RECONCILE_SQL)
def ops_reconcile(spark, d):
    return O.reconcile(*_replicas(env_events(spark, d)))


@register("ops_reconcile_digests", "OPS7 by range digests", sql=RECONCILE_SQL)
def ops_reconcile_digests(spark, d):
    base = scratch_path(spark, "digests")

    def stored(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    return O.reconcile_by_digest(*_replicas(stored(env_events(spark, d), "leader")), width=64, stored=stored)


@register("ops_throughput", "OPS8", sql=with_views(
    "SELECT date_trunc('hour', \"timestamp\") AS bucket, CAST(count(*) AS BIGINT) AS records, "
    "CAST(sum(octet_length(encode(\"value\"))) AS BIGINT) AS bytes, "
    "round(avg(octet_length(encode(\"value\"))), 6) AS avg_bytes, "
    "round(quantile_cont(octet_length(encode(\"value\")), 0.5), 4) AS p50_bytes, "
    "round(quantile_cont(octet_length(encode(\"value\")), 0.95), 4) AS p95_bytes, "
    "round(count(*) / 3600.0, 6) AS records_per_sec "
    "FROM env_events GROUP BY 1", "env_events"))
def ops_throughput(spark, d):
    out = O.throughput(env_events(spark, d, offsets=False))
    return out.withColumns({"p50_bytes": F.round("p50_bytes", 4), "p95_bytes": F.round("p95_bytes", 4),
                            "avg_bytes": F.round("avg_bytes", 6),
                            "records_per_sec": F.round("records_per_sec", 6)})


SKETCH_SQL = with_views(
    "SELECT date_trunc('hour', \"timestamp\") AS bucket, CAST(count(*) AS BIGINT) AS records, "
    "CAST(sum(octet_length(encode(\"value\"))) AS BIGINT) AS bytes, "
    "round(avg(octet_length(encode(\"value\"))), 6) AS avg_bytes, "
    "quantile_disc(octet_length(encode(\"value\")), 0.5) AS p50_bytes, "
    "quantile_disc(octet_length(encode(\"value\")), 0.95) AS p95_bytes, "
    "round(count(*) / 3600.0, 6) AS records_per_sec FROM env_events GROUP BY 1", "env_events")


def rounded(out):
    return out.withColumns({"avg_bytes": F.round("avg_bytes", 6), "records_per_sec": F.round("records_per_sec", 6)})


@register("ops_throughput_sketches", "OPS8 (KLL sketches by minute, merged to hours)", sql=SKETCH_SQL)
def ops_throughput_sketches(spark, d):
    return rounded(O.throughput_of_sketches(O.size_sketches(env_events(spark, d, offsets=False))))


GAPS_INPUT_SQL = (f"SELECT \"partition\", \"offset\" FROM env_events WHERE \"key\" <> '{LOST_KEY}' "
                  f"UNION ALL SELECT \"partition\", \"offset\" FROM env_events WHERE \"key\" = '{REDELIVERED_KEY}'")


@register("ops_offset_gaps", "OPS9", sql=with_views(
    "SELECT \"partition\", CASE WHEN \"offset\" = prev_offset THEN 'duplicate' ELSE 'gap' END AS kind, "
    "prev_offset, \"offset\" FROM (SELECT \"partition\", \"offset\", lag(\"offset\") OVER "
    f"(PARTITION BY \"partition\" ORDER BY \"offset\") AS prev_offset FROM ({GAPS_INPUT_SQL})) "
    "WHERE \"offset\" - prev_offset = 0 OR \"offset\" - prev_offset > 1", "env_events"))
def ops_offset_gaps(spark, d):
    env = env_events(spark, d)
    # what an at-least-once consumer saw: lost records 0 times, redelivered ones twice
    copies = (F.when(F.col("key") == LOST_KEY, F.array().cast("array<int>"))
              .when(F.col("key") == REDELIVERED_KEY, F.array(F.lit(1), F.lit(2)))
              .otherwise(F.array(F.lit(1))))
    consumed = env.select("partition", "offset", F.explode(copies).alias("__copy"))
    return O.offset_gaps(consumed)
