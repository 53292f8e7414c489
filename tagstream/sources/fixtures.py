"""Map the driver's test tables onto telemetry readings.

``events`` (event_id, ts, user_id, event_type, value, props) stands in for
the sensor feed: a device per 50 users, a tag per (event_type, user_id % 20),
and the reading is bad (NULL) when ``props.k >= 95``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.catalog import Rule

SOURCE_ID = "events"
MEASUREMENT = "opc_data"

# FIXED VALUES: threshold rules used with the events fixture (2-day cooldown).
EVENT_RULES = [
    Rule("click_", 150.0, None, "u", "Critical", "click value high"),
    Rule("view_", 120.0, 1.0, "u", "High", "view value out of range"),
    Rule("purchase_", 200.0, 2.0, "u", "Medium", "purchase value out of range"),
    Rule("signup_", 180.0, None, "u", "High", "signup value high"),
]
EVENT_COOLDOWN_SECONDS = 2 * 86_400
EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]
TAGS_PER_TYPE = 20


def event_tags() -> list[str]:
    """Fixture tag dictionary: every event type × index 00..19 (100 tags)."""
    return [f"{e}_{i:02d}" for e in EVENT_TYPES for i in range(TAGS_PER_TYPE)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read as it is: scan tasks follow its splits."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings, bad ones with ``value`` NULL.

    Columns: event_id, source_id, device_id, tag_name, ts (timestamp), k, value.
    """
    return readings_of(table(spark, sf_dir, "events"))


def readings_of(ev: DataFrame) -> DataFrame:
    """The readings projection of an events DataFrame (batch or streaming)."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.col("event_id"),
        F.lit(SOURCE_ID).alias("source_id"),
        F.format_string("dev_%02d", F.floor(F.col("user_id") / 50).cast("long")).alias("device_id"),
        F.format_string("%s_%02d", F.col("event_type"), F.pmod(F.col("user_id"), F.lit(20))).alias("tag_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        k.alias("k"),
        F.when(k < 95, F.col("value")).alias("value"),
    )


def good_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).where(F.col("value").isNotNull())


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as points (measurement, labels, field, time, value)."""
    r = good_readings(spark, sf_dir)
    return r.select(
        "event_id",
        F.lit(MEASUREMENT).alias("measurement"),
        F.create_map(F.lit("device_id"), F.col("device_id"),
                     F.lit("source_id"), F.col("source_id")).alias("labels"),
        F.col("device_id"),
        F.col("tag_name").alias("field"),
        F.col("ts").alias("time"),
        F.col("value"),
    )


# Host-metric stand-in: each event type plays one collector measurement.
HOST_MEASUREMENTS = {"click": ("cpu", "usage_idle"), "view": ("mem", "used_percent"),
                     "purchase": ("disk", "used_percent"), "signup": ("diskio", "reads"),
                     "error": ("opc_data", "error_value")}


def host_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as collector points: measurement and field by event type,
    host per device, disk mount / file system and diskio device by user parity,
    percentages folded into [0, 100)."""
    r = good_readings(spark, sf_dir)
    et = F.regexp_extract("tag_name", r"^(.*)_\d+$", 1)
    meas = F.coalesce(*[F.when(et == k, F.lit(m)) for k, (m, _f) in HOST_MEASUREMENTS.items()])
    field = F.coalesce(*[F.when(et == k, F.lit(f)) for k, (_m, f) in HOST_MEASUREMENTS.items()])
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    labels = (F.when(meas == "disk", F.create_map(
                  F.lit("host"), F.col("device_id"), F.lit("path"), F.when(odd, "/run").otherwise("/"),
                  F.lit("fstype"), F.when(odd, "tmpfs").otherwise("ext4")))
               .when(meas == "diskio", F.create_map(
                  F.lit("host"), F.col("device_id"), F.lit("name"), F.when(odd, "loop0").otherwise("sda")))
               .otherwise(F.create_map(F.lit("host"), F.col("device_id"))))
    pct = meas.isin("cpu", "mem", "disk")
    return r.select("event_id", meas.alias("measurement"), labels.alias("labels"),
                    field.alias("field"), F.col("ts").alias("time"),
                    F.when(pct, F.col("value") % 100).otherwise(F.col("value")).alias("value"))


HOST_POINTS_SQL = """
SELECT event_id,
       CASE split_part(tag_name, '_', 1) WHEN 'click' THEN 'cpu' WHEN 'view' THEN 'mem'
            WHEN 'purchase' THEN 'disk' WHEN 'signup' THEN 'diskio' ELSE 'opc_data' END AS measurement,
       CASE split_part(tag_name, '_', 1) WHEN 'click' THEN 'usage_idle' WHEN 'view' THEN 'used_percent'
            WHEN 'purchase' THEN 'used_percent' WHEN 'signup' THEN 'reads' ELSE 'error_value' END AS field,
       device_id AS host,
       CASE WHEN event_id % 2 = 1 THEN '/run' ELSE '/' END AS path,
       CASE WHEN event_id % 2 = 1 THEN 'tmpfs' ELSE 'ext4' END AS fstype,
       CASE WHEN event_id % 2 = 1 THEN 'loop0' ELSE 'sda' END AS dev_name,
       ts AS time,
       CASE WHEN split_part(tag_name, '_', 1) IN ('click', 'view', 'purchase') THEN fmod(value, 100)
            ELSE value END AS value
FROM ({readings}) r WHERE value IS NOT NULL
"""


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume stand-in: lineitem quantities as readings of per-flag tags."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.lit("lineitem").alias("source_id"),
        F.format_string("sup_%d", F.pmod(F.col("l_suppkey"), F.lit(100))).alias("device_id"),
        F.format_string("qty_%s%s_%02d", F.col("l_returnflag"), F.col("l_linestatus"),
                        F.pmod(F.col("l_partkey"), F.lit(50))).alias("tag_name"),
        (F.col("l_shipdate").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.pmod(F.col("l_orderkey"), F.lit(24)).cast("int"),
                              F.pmod(F.col("l_partkey"), F.lit(60)).cast("int"),
                              F.lit(0))).alias("ts"),
        F.col("l_quantity").alias("value"),
    )


# DuckDB form of the same views, used by the oracle SQL.
READINGS_SQL = """
SELECT event_id,
       'events' AS source_id,
       printf('dev_%02d', CAST(floor(user_id / 50) AS BIGINT)) AS device_id,
       printf('%s_%02d', event_type, user_id % 20) AS tag_name,
       CAST(ts AS TIMESTAMP) AS ts,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) < 95 THEN value END AS value
FROM events
"""
