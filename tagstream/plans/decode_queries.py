"""Registered decode / reshape queries: messages encoded from the readings
by Spark, then decoded back, so the work grows with the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagstream.functions.catalog import tag_dictionary_df
from tagstream.functions.timefn import micros, parse_event_time, with_date_parts
from tagstream.operators import reshape as rs
from tagstream.plans.registry import R, r6, register
from tagstream.sources import decode as dc
from tagstream.sources import fixtures as fx

TAGS = fx.event_tags()
US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _ust(c):
    return F.date_format(F.col(c), US_FMT)


def wide_messages(spark, sf_dir, good_only=True):
    """One wide message per (source, device, time) of the events."""
    r = fx.good_readings(spark, sf_dir) if good_only else fx.readings(spark, sf_dir)
    return rs.pivot_tags(r.withColumn("source_id", F.lit(fx.SOURCE_ID)), TAGS,
                         ["source_id", "device_id", "ts"])


def encode_flat(wide):
    """V1 messages (publish format, SNK7): to_json of the wide row."""
    body = F.to_json(F.struct(
        F.date_format("ts", ISO).alias("timestamp"), "source_id", "device_id",
        F.lit(len(TAGS)).cast("long").alias("tag_count"),
        (F.lit(len(TAGS)) - F.size(F.filter(F.array(*[F.col(t) for t in TAGS]),
                                            lambda x: x.isNotNull()))).cast("long").alias("bad_count"),
        *[F.col(t) for t in TAGS]))
    return wide.select(body.alias("value"))


def json_value():
    """A reading as JSON text; a bad one is a string, a boolean or null, by event_id."""
    bad = F.element_at(F.array(F.lit('"85"'), F.lit("true"), F.lit("null")), F.pmod("event_id", F.lit(3)).cast("int") + 1)
    return F.coalesce(F.col("value").cast("string"), bad)


def encode_bad(readings):
    """A V1 message for each bad reading, with its tag's bad value."""
    head = F.to_json(F.struct(F.date_format("ts", ISO).alias("timestamp"), "source_id", "device_id"))
    body = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"'), F.col("tag_name"), F.lit('":'), json_value(), F.lit("}"))
    return readings.where("value IS NULL").withColumn("_head", head).select(body.alias("value"))


def encode_envelopes(readings):
    """One message per reading, envelope V1..V5 chosen by event_id % 5."""
    good = readings.withColumn("value", F.parse_json(json_value()))
    iso = F.date_format("ts", ISO)
    tag, val = F.col("tag_name"), F.col("value")
    v1 = F.concat(F.expr("substring(to_json(named_struct('timestamp', date_format(ts, "
                         "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), 'source_id', source_id, "
                         "'device_id', device_id, 'tag_count', 1L, 'bad_count', 0L)), 1, "
                         "length(to_json(named_struct('timestamp', date_format(ts, "
                         "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), 'source_id', source_id, "
                         "'device_id', device_id, 'tag_count', 1L, 'bad_count', 0L))) - 1)"),
                  F.lit(","), F.expr("substring(to_json(map(tag_name, value)), 2)"))
    v2 = F.to_json(F.struct((micros("ts") / F.lit(1e6)).alias("timestamp"), "source_id", "device_id",
                            F.create_map(tag, val).alias("tags"), F.lit(1).alias("tag_count"),
                            F.lit(0).alias("bad_count")))
    v3 = F.to_json(F.struct(F.array(F.struct(tag.alias("name"), val.alias("value"),
                                             F.floor(micros("ts") / 1000).alias("ts"))).alias("tags")))
    v4 = F.to_json(F.struct(F.format_string("m%d", F.col("event_id")).alias("MessageId"),
                            F.col("source_id").alias("PublisherId"),
                            F.array(F.struct(F.lit(1).alias("DataSetWriterId"),
                                             F.create_map(tag, F.struct(val.alias("Value"),
                                                                        iso.alias("SourceTimestamp")))
                                             .alias("Payload"))).alias("Messages")))
    v5 = F.to_json(F.struct(iso.alias("timestamp"), "source_id", "device_id",
                            F.create_map(tag, F.struct(val.alias("value"), F.lit("u").alias("unit"),
                                                       tag.alias("name"))).alias("readings")))
    k = F.pmod(F.col("event_id"), F.lit(5))
    msg = (F.when(k == 0, v1).when(k == 1, v2).when(k == 2, v3).when(k == 3, v4).otherwise(v5))
    # V3 / V4 carry no device (and V3 no source): the topic key supplies them.
    return good.select(msg.alias("value"), "source_id", "device_id")


@register("src1_decode_flat", f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value
FROM ({R}) r WHERE value IS NOT NULL
""")
def src1_decode_flat(spark, sf_dir):
    """Good messages, and messages whose tag is a string, a boolean or null: those tags decode to NULL."""
    raw = encode_flat(wide_messages(spark, sf_dir)).unionByName(encode_bad(fx.readings(spark, sf_dir)))
    wide = dc.decode_flat(raw, TAGS)
    tall = rs.unpivot_tags(wide, TAGS, ["device_id", "ts"])
    return tall.select("device_id", "tag_name", _ust("ts").alias("ts"), r6("value").alias("value"))


@register("src2_decode_any", f"""
SELECT device_id, tag_name,
       CASE WHEN event_id % 5 = 2 THEN {DUS.format(c="make_timestamp(epoch_us(ts) // 1000 * 1000)")}
            ELSE {DUS.format(c='ts')} END AS ts,
       round(value, 6) AS value, 'V' || CAST(event_id % 5 + 1 AS VARCHAR) AS envelope
FROM ({R}) r
""")
def src2_decode_any(spark, sf_dir):
    raw = encode_envelopes(fx.readings(spark, sf_dir))
    out = dc.decode_any(raw)
    return out.select("device_id", "tag_name", _ust("ts").alias("ts"), r6("value").alias("value"),
                      "envelope")


@register("src3_parse_event_time", f"""
SELECT event_id, epoch_us(ts) AS iso_us, epoch_us(ts) AS epoch_s_us, epoch_us(ts) // 1000 * 1000 AS epoch_ms_us
FROM ({R}) r
""")
def src3_parse_event_time(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    iso_ns = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                      F.format_string("%03d", F.pmod(F.col("event_id"), F.lit(1000))), F.lit("Z"))
    secs = (micros("ts") / F.lit(1e6)).cast("string")
    ms = F.floor(micros("ts") / 1000).cast("string")
    return r.select("event_id",
                    micros(parse_event_time(iso_ns)).alias("iso_us"),
                    micros(parse_event_time(secs)).alias("epoch_s_us"),
                    micros(parse_event_time(ms)).alias("epoch_ms_us"))


@register("src4_quarantine", f"""
SELECT event_id, CASE WHEN k >= 98 THEN 'unparseable' WHEN k = 97 THEN 'no_timestamp'
                      WHEN k = 96 THEN 'no_tags' END AS quarantine_reason
FROM ({R}) r
""")
def src4_quarantine(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    good_msg = F.to_json(F.struct(F.date_format("ts", ISO).alias("timestamp"), "device_id",
                                  F.create_map("tag_name", "value").alias("tags")))
    raw = r.select("event_id", F.when(F.col("k") >= 98, F.substring(good_msg, 1, 20))
                   .when(F.col("k") == 97, F.to_json(F.struct(F.lit("x").alias("timestamp"),
                                                              F.create_map("tag_name", "value").alias("tags"))))
                   .when(F.col("k") == 96, F.to_json(F.struct(F.date_format("ts", ISO).alias("timestamp"))))
                   .otherwise(good_msg).alias("value"))
    return dc.quarantine(raw).select("event_id", "quarantine_reason")


_PIVOT_SQL = f"""
SELECT device_id, ts, {", ".join(f"max(CASE WHEN tag_name = '{t}' THEN value END) AS {t}" for t in TAGS)}
FROM ({R}) r WHERE value IS NOT NULL GROUP BY device_id, ts"""


@register("prj2_pivot", f"""
SELECT device_id, {DUS.format(c='ts')} AS ts, {", ".join(f"round({t}, 6) AS {t}" for t in TAGS)}
FROM ({_PIVOT_SQL}) w
""")
def prj2_pivot(spark, sf_dir):
    w = wide_messages(spark, sf_dir)
    return w.select("device_id", _ust("ts").alias("ts"), *[r6(t).alias(t) for t in TAGS])


@register("prj1_unpivot", f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value
FROM ({R}) r WHERE value IS NOT NULL
""")
def prj1_unpivot(spark, sf_dir):
    tall = rs.unpivot_tags(wide_messages(spark, sf_dir), TAGS, ["device_id", "ts"])
    return tall.select("device_id", "tag_name", _ust("ts").alias("ts"), r6("value").alias("value"))


@register("jon2_explode_pairs", f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value
FROM ({R}) r WHERE value IS NOT NULL
""")
def jon2_explode_pairs(spark, sf_dir):
    w = wide_messages(spark, sf_dir).select("device_id", "ts", F.array(*[F.lit(t) for t in TAGS]).alias("names"),
                                     F.array(*[F.col(t) for t in TAGS]).alias("vals"))
    p = dc.explode_pairs(w, "names", "vals", keep=["device_id", "ts"]).where(F.col("value").isNotNull())
    return p.select("device_id", "tag_name", _ust("ts").alias("ts"), r6("value").alias("value"))


@register("prj3_tag_dimension", f"""
SELECT tag_name,
       CASE WHEN regexp_extract(tag_name, '^(.*)_(\\d+)$', 1) = '' THEN tag_name
            ELSE regexp_extract(tag_name, '^(.*)_(\\d+)$', 1) END AS tag_group,
       TRY_CAST(NULLIF(regexp_extract(tag_name, '^(.*)_(\\d+)$', 2), '') AS INTEGER) AS tag_index,
       3 AS namespace, 'ns=3;i=' || (2000 + list_position({TAGS}, tag_name)) AS node_id
FROM (SELECT DISTINCT tag_name FROM ({R}) r) t
""")
def prj3_tag_dimension(spark, sf_dir):
    tags = fx.readings(spark, sf_dir).select("tag_name").distinct()
    return rs.tag_dimension(tags, dictionary=tag_dictionary_df(spark, TAGS))


@register("prj4_line_protocol", f"""
SELECT 'opc_data,device_id=' || device_id || ',source_id=events ' || tag_name || '='
       || CAST(value AS VARCHAR) || ' ' || CAST(epoch_us(ts) * 1000 AS VARCHAR) AS line
FROM ({R}) r WHERE value IS NOT NULL
""")
def prj4_line_protocol(spark, sf_dir):
    return rs.line_protocol(fx.points(spark, sf_dir))


@register("prj7_with_date_parts", f"""
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM ({R}) r
""")
def prj7_with_date_parts(spark, sf_dir):
    return with_date_parts(fx.readings(spark, sf_dir), "ts", hour=True)\
        .select("event_id", "year", "month", "day", "hour")


@register("prj8_message_quality", f"""
SELECT device_id, {DUS.format(c='ts')} AS ts, CAST({len(TAGS)} AS BIGINT) AS tag_count,
       count(DISTINCT tag_name) FILTER (WHERE value IS NOT NULL) AS observed_count,
       {len(TAGS)} - count(DISTINCT tag_name) FILTER (WHERE value IS NOT NULL) AS bad_count
FROM ({R}) r GROUP BY device_id, ts
""")
def prj8_message_quality(spark, sf_dir):
    q = rs.message_quality(wide_messages(spark, sf_dir, good_only=False), TAGS)
    return q.select("device_id", _ust("ts").alias("ts"), "tag_count", "observed_count", "bad_count")


@register("prj9_status_color", f"""
SELECT event_id, round(value, 6) AS value,
       CASE WHEN value IS NULL THEN NULL WHEN value >= 90 THEN 'red' WHEN value >= 70 THEN 'yellow'
            ELSE 'green' END AS status FROM ({R}) r
""")
def prj9_status_color(spark, sf_dir):
    s = rs.status_color(fx.readings(spark, sf_dir), "cpu")
    return s.select("event_id", r6("value").alias("value"), "status")
