"""Registered queries for the sources (SRC1-SRC4, SRC7, SRC8, SRC10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.codec import encode_utf8, typed_envelope
from rivulet.plans.registry import register
from rivulet.plans.views_sql import with_views
from rivulet.session import scratch_path
from rivulet.sources import envelope as E
from rivulet.sources import readers as S
from rivulet.sources.tables import env_events, env_turns, table

ENV = '"key", "value", "partition", "offset", "timestamp"'

# Start positions of a consumer group per partition
# (partition 2 at "latest", partition 3 unlisted = earliest).
START_OFFSETS = {0: 1000, 1: 2000, 2: S.LATEST}
SENTINEL_KEY = "error"


@register("src_topic_stream", "SRC1", sql=with_views(f"SELECT {ENV} FROM env_events", "env_events"))
def src_topic_stream(spark, d):
    return env_events(spark, d)


@register("src_record_fields", "SRC3", sql=with_views(
    'SELECT "key", "value", "partition", "offset" FROM env_events', "env_events"))
def src_record_fields(spark, d):
    return E.record_fields(env_events(spark, d))


FROM_OFFSET_SQL = with_views(
    f"SELECT {ENV} FROM env_events WHERE CASE \"partition\" WHEN 0 THEN \"offset\" >= 1000 "
    "WHEN 1 THEN \"offset\" >= 2000 WHEN 2 THEN false ELSE true END", "env_events")


@register("src_from_offset", "SRC2", sql=FROM_OFFSET_SQL)
def src_from_offset(spark, d):
    return S.from_offsets(env_events(spark, d), START_OFFSETS)


@register("src_decode_utf8", "SRC4, SC11", sql=with_views(
    'SELECT "partition", "offset", CASE WHEN "offset" % 5 <> 1 THEN "value" END AS "value", '
    '"offset" % 5 <> 1 AS valid FROM env_turns', "env_turns"))
def src_decode_utf8(spark, d):
    # every fifth value begins with a byte that UTF-8 does not have
    sound = encode_utf8("value")
    bad = F.concat(F.unhex(F.lit("FF")), sound)
    raw = env_turns(spark, d).select("partition", "offset", F.when(F.col("offset") % 5 == 1, bad).otherwise(sound).alias("value"))
    return S.decode_values(raw).select("partition", "offset", "value", "valid")


@register("src_take_until", "SRC7", sql=with_views(
    f"SELECT {ENV} FROM (SELECT *, sum(CASE WHEN \"key\" = '{SENTINEL_KEY}' THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY \"partition\" ORDER BY \"offset\" ROWS UNBOUNDED PRECEDING) AS seen "
    "FROM env_events) WHERE seen = 0", "env_events"))
def src_take_until(spark, d):
    return S.take_until(env_events(spark, d), F.col("key") == F.lit(SENTINEL_KEY))


@register("src_text_lines", "SRC8, SRC9, REC12", sql=(
    "SELECT '1' AS \"key\", unnest(string_split(text, chr(10))) AS \"value\" FROM documents"))
def src_text_lines(spark, d):
    # The documents, written once as a text file (one record per line), then
    # read back by the line source as the line producer would send them.
    path = scratch_path(spark, "text-lines")
    table(spark, d, "documents").select("text").write.mode("overwrite").text(path)
    return E.read_lines(spark, path, key="1")


@register("src_json_envelope", "SRC10", sql=with_views(
    "SELECT \"partition\", \"offset\", CAST(json_object('schema', json_object('type', 'string', "
    "'optional', false), 'payload', \"value\") AS VARCHAR) AS json, \"value\" AS payload, "
    "CAST(to_json(\"value\") AS VARCHAR) AS bare, \"value\" AS bare_payload "
    "FROM env_events", "env_events"))
def src_json_envelope(spark, d):
    wrapped = S.wrap_json(S.wrap_json(env_events(spark, d)), schemas=False, out="bare")
    unwrapped = S.unwrap_json(S.unwrap_json(wrapped), col="bare", schemas=False, out="bare_payload")
    return unwrapped.select("partition", "offset", "json", "payload", "bare", "bare_payload")


# Records of several schemas in one topic, by offset: a whole number, a number, a
# struct, an absent optional text, and three bad ones (a number said to be text,
# one beyond its type, a text that is no JSON).
@register("src_typed_envelope", "SRC10 (schema-led)", sql=with_views(
    "SELECT \"partition\", \"offset\", "
    "CASE m WHEN 0 THEN 'int64' WHEN 1 THEN 'double' WHEN 2 THEN 'struct' WHEN 3 THEN 'string' END AS type, m < 4 AS valid, "
    "CASE WHEN m = 0 THEN \"offset\" END AS as_long, CASE WHEN m IN (0, 1) THEN \"offset\" / (1.0 + m) END AS as_double, "
    "CASE WHEN m = 2 THEN \"key\" END AS name, CASE WHEN m = 2 THEN length(\"value\") END AS size "
    "FROM (SELECT *, \"offset\" % 7 AS m FROM env_events)", "env_events"))
def src_typed_envelope(spark, d):
    env = env_events(spark, d).withColumns({
        "long": F.col("offset"), "double": F.col("offset") / 2.0, "text": F.lit(None).cast("string"),
        "object": F.struct(F.col("key").alias("name"), F.length("value").cast("bigint").alias("size"))})
    m = F.col("offset") % 7
    written = {0: typed_envelope(env, "long", optional=False), 1: typed_envelope(env, "double"),
               2: typed_envelope(env, "object"), 3: typed_envelope(env, "text"),
               4: F.lit('{"schema":{"type":"string","optional":false},"payload":5}'),
               5: F.lit('{"schema":{"type":"int8","optional":false},"payload":300}'), 6: F.lit('{"schema":')}
    json = F.coalesce(*[F.when(m == k, v) for k, v in written.items()])
    out = S.unwrap_typed(env.select("partition", "offset", json.alias("json")))
    field = lambda path, kind: F.try_variant_get("payload", path, kind)
    plain = F.col("type").isin("int64", "double")
    return out.select("partition", "offset", "type", "valid",
                      F.when(F.col("type") == "int64", field("$", "bigint")).alias("as_long"),
                      F.when(plain, field("$", "double")).alias("as_double"),
                      field("$.name", "string").alias("name"), field("$.size", "bigint").alias("size"))
