"""Registered storage-lifecycle queries (SNK1-6, SRC5-7, JON6).

Each one writes real tables under the shared checkpoint folder from data that
Spark derives from ``events`` and reads them back through the library's own
readers, so the work (and the files) grow with the events table:

* the raw lake is written by the SNK1 stream sink from a file stream of the
  events (SRC7 stand-in), one flat message per reading, and read by SRC5;
* rollup writes (SNK2), backfill (SNK3), compaction (SNK4), expiry (SNK5),
  partition sync (JON6) and export (SNK6) all start from that lake or from
  the readings.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.timefn import with_date_parts
from tagstream.operators import reshape as rs
from tagstream.operators import rollup as ru
from tagstream.plans import lifecycle as lc
from tagstream.plans.registry import REGISTRY, R, dtxt, r6, register, txt
from tagstream.plans.decode_queries import wide_messages
from tagstream.plans.stream_queries import events_stream
from tagstream.session import checkpoint_dir
from tagstream.sources import fixtures as fx
from tagstream.sources.decode import decode_flat
from tagstream.sources.lake import PARTS, ROLLUP_SCHEMA, read_compacted, read_raw_lake, read_rollup

TAGS = fx.event_tags()
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
KEEP_DAYS = 7
# Tag selection and time range of the export query (the feature's parameters).
EXPORT_TYPES = ("click", "view")
EXPORT_START, EXPORT_STOP = "2024-01-08 00:00:00", "2024-01-22 00:00:00"

_GOOD = "value IS NOT NULL AND NOT isnan(value)"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lifecycle/{name}-{uuid.uuid4().hex[:12]}"


def reading_messages(readings: DataFrame) -> DataFrame:
    """One flat V1 message per reading: the reading's tag holds the value (NULL
    and ``bad_count`` 1 when bad), every other tag is absent.  A projection,
    so it works on a stream."""
    tag = F.col("tag_name")
    return readings.select(
        F.date_format("ts", ISO).alias("timestamp"), "source_id", "device_id",
        F.lit(1).cast("long").alias("tag_count"),
        F.col("value").isNull().cast("long").alias("bad_count"),
        *[F.when(tag == t, F.col("value")).alias(t) for t in TAGS],
        "ts")


def build_lake(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Stream the events through SNK1 into a JSON lake; return its path."""
    base = scratch(spark, name)
    msgs = reading_messages(fx.readings_of(events_stream(spark, sf_dir)))
    q = lc.write_raw_lake(msgs, f"{base}/lake", f"{base}/ck", trigger="availableNow")
    q.awaitTermination()
    return f"{base}/lake"


def _lake_tall(spark: SparkSession, lake: str) -> DataFrame:
    raw = read_raw_lake(spark, lake, TAGS)
    return rs.unpivot_tags(raw, TAGS, ["source_id", "device_id", "ts", *PARTS])


def _tall_out(df: DataFrame, extra=()) -> DataFrame:
    return df.select("device_id", "tag_name", F.date_format("ts", US_FMT).alias("ts"),
                     r6("value").alias("value"), *PARTS, *extra)


def _tall_sql(extra: str = "") -> str:
    return f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day{extra}
FROM ({R}) r WHERE {_GOOD}
"""


@register("snk1_src5_raw_lake", _tall_sql())
def snk1_src5_raw_lake(spark, sf_dir):
    """SNK1 stream sink → y/m/d JSON lake → SRC5 partitioned reader."""
    return _tall_out(_lake_tall(spark, build_lake(spark, sf_dir, "snk1")))


@register("snk2_src6_rollup_rerun", REGISTRY["agg1_rollup_1h"][1])
def snk2_src6_rollup_rerun(spark, sf_dir):
    """SNK2 twice over the same hours (a rerun) → SRC6: one copy remains."""
    path = scratch(spark, "snk2") + "/sensor_1h"
    hourly = ru.rollup_1h(fx.readings(spark, sf_dir))
    lc.write_rollup(hourly, path)
    lc.write_rollup(hourly, path)
    h = read_rollup(spark, path, "1h")
    return h.select(txt("hour").alias("hour"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"),
                    "samples", "year", "month", "day")


def _lake_days(spark: SparkSession, lake: str) -> tuple[dt.datetime, dt.datetime]:
    """First day and the day after the last one present in the lake (partition
    metadata only: one row per day)."""
    parts = lc.list_partitions(spark, lake)
    d = F.to_date(F.concat_ws("-", *PARTS))
    lo, hi = parts.agg(F.min(d), F.max(d)).first()
    return (dt.datetime.combine(lo, dt.time()),
            dt.datetime.combine(hi + dt.timedelta(days=1), dt.time()))


def _backfill(spark, sf_dir) -> str:
    lake = build_lake(spark, sf_dir, "snk3")
    out = lake.rsplit("/", 1)[0]
    start, stop = _lake_days(spark, lake)
    lc.backfill(spark, lake, f"{out}/sensor_1h", f"{out}/sensor_1d", TAGS, start, stop)
    return out


@register("snk3_backfill_1h", f"""
WITH r AS ({R})
SELECT {dtxt("date_trunc('hour', ts)")} AS hour, tag_name,
       round(avg(value), 6) AS avg_val, round(max(value), 6) AS max_val,
       round(min(value), 6) AS min_val, count(*) AS samples,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hr
FROM r WHERE {_GOOD}
GROUP BY 1, 2, 7, 8, 9, 10
""")
def snk3_backfill_1h(spark, sf_dir):
    """SNK3: backfill of the lake's whole range in one job; hourly table."""
    h = read_rollup(spark, _backfill(spark, sf_dir) + "/sensor_1h", "1h", extra_parts=["hr"])
    return h.select(txt("hour").alias("hour"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"),
                    "samples", "year", "month", "day", "hr")


@register("snk3_backfill_1d", REGISTRY["agg3_rollup_1d_weighted"][1])
def snk3_backfill_1d(spark, sf_dir):
    """SNK3: the daily table of the same backfill (weighted mean)."""
    d = read_rollup(spark, _backfill(spark, sf_dir) + "/sensor_1d", "1d")
    return d.select(txt("day_ts").alias("day_ts"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"),
                    "samples", "year", "month", "day")


_HR = ", strftime(ts, '%H') AS hr"


@register("snk4_compact_tall", _tall_sql(_HR))
def snk4_compact_tall(spark, sf_dir):
    """SNK4: JSON lake → tall Parquet ZSTD with an hour partition."""
    lake = build_lake(spark, sf_dir, "snk4t")
    path = lake.rsplit("/", 1)[0] + "/compact"
    lc.compact(read_raw_lake(spark, lake, TAGS), path, TAGS, layout="tall")
    return _tall_out(read_compacted(spark, path, "tall"), ["hr"])


@register("snk4_compact_map", _tall_sql(_HR))
def snk4_compact_map(spark, sf_dir):
    """SNK4: JSON lake → Parquet ``tags map<string,double>`` per message."""
    lake = build_lake(spark, sf_dir, "snk4m")
    path = lake.rsplit("/", 1)[0] + "/compact"
    lc.compact(read_raw_lake(spark, lake, TAGS), path, TAGS, layout="map")
    m = read_compacted(spark, path, "map")
    tall = m.select("device_id", "ts", F.explode("tags").alias("tag_name", "value"), *PARTS, "hr")
    return _tall_out(tall, ["hr"])


_DAYS_SQL = f"""
days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM ({R}) r),
cut AS (SELECT max(d) - INTERVAL {KEEP_DAYS} DAY AS c FROM days)"""


def _parts_sql(action: str) -> str:
    return f"""
WITH {_DAYS_SQL}
SELECT strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day,
       '{action}' AS action
FROM days, cut WHERE d < c
"""


@register("snk5_expire_dry_run", _parts_sql("WOULD_DROP"))
def snk5_expire_dry_run(spark, sf_dir):
    """SNK5: lake partitions older than KEEP_DAYS before the newest day."""
    lake = build_lake(spark, sf_dir, "snk5")
    _lo, stop = _lake_days(spark, lake)
    as_of = (stop - dt.timedelta(days=1)).date()
    return lc.expire(spark, lake, KEEP_DAYS, as_of).select(*PARTS, "action")


@register("jon6_partition_diff_full", _parts_sql("DROP"))
def jon6_partition_diff_full(spark, sf_dir):
    """JON6 FULL sync after a real expiry: the catalog (partition list taken
    before) still names the dropped days; storage no longer holds them."""
    lake = build_lake(spark, sf_dir, "jon6")
    _lo, stop = _lake_days(spark, lake)
    # The listing is built from driver-side metadata rows, so it is a snapshot.
    catalog = lc.list_partitions(spark, lake)
    lc.expire(spark, lake, KEEP_DAYS, (stop - dt.timedelta(days=1)).date(), dry_run=False)
    storage = lc.list_partitions(spark, lake)
    return lc.partition_diff(storage, catalog, mode="FULL").select(*PARTS, "action")


@register("jon6_partition_sync", f"""
WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS hour, tag_name FROM ({R}) r WHERE {_GOOD}),
cut AS (SELECT max(CAST(hour AS DATE)) - INTERVAL {KEEP_DAYS} DAY AS c FROM h)
SELECT strftime(hour, '%Y') AS year, strftime(hour, '%m') AS month, strftime(hour, '%d') AS day, count(*) AS rows
FROM h, cut WHERE CAST(hour AS DATE) >= c GROUP BY 1, 2, 3
""")
def jon6_partition_sync(spark, sf_dir):
    """JON6 applied: a catalog table over the hourly rollup, synced before and
    after a real expiry; its partitions and their rows are read through the catalog."""
    path = scratch(spark, "jon6-sync") + "/sensor_1h"
    lc.write_rollup(ru.rollup_1h(fx.readings(spark, sf_dir)), path)
    table = f"sensor_1h_{uuid.uuid4().hex[:12]}"
    lc.register_lake(spark, table, path, ROLLUP_SCHEMA["1h"], "parquet")
    lc.sync_partitions(spark, table, path, "ADD")
    _lo, stop = _lake_days(spark, path)
    lc.expire(spark, path, KEEP_DAYS, (stop - dt.timedelta(days=1)).date(), dry_run=False)
    lc.sync_partitions(spark, table, path)
    rows = spark.table(table).groupBy(*PARTS).agg(F.count("*").alias("rows"))
    return lc.catalog_partitions(spark, table).join(rows, PARTS, "left")


@register("agg11_ingest_report_files", f"""
SELECT source_id, {dtxt("date_trunc('day', ts)")} AS day_ts, count(DISTINCT (device_id, ts)) AS messages,
       count(value) AS tag_values, 1 AS files, TRUE AS sized
FROM ({R}) r GROUP BY 1, 2
""")
def agg11_ingest_report_files(spark, sf_dir):
    """AGG11 with files and bytes, over a lake that is written with one file a day.

    Sizes are not in the tables: ``sized`` says that the day has bytes, all of
    them in its files; the tests hold the bytes against the file system."""
    path = scratch(spark, "agg11") + "/lake"
    parts = with_date_parts(fx.readings(spark, sf_dir).drop("k"), "ts")
    parts.repartition(*PARTS).write.partitionBy(*PARTS).parquet(path)
    raw = spark.read.schema(parts.schema).parquet(path).select("*", "_metadata.file_path", "_metadata.file_size")
    rep = ru.ingest_report(raw, bytes_col="file_size", file_col="file_path")
    sized = (F.col("bytes") > 0) & (F.col("bytes_per_file") * F.col("files") == F.col("bytes"))
    return rep.select("source_id", txt("day_ts").alias("day_ts"), "messages", "tag_values", F.col("files").cast("int").alias("files"),
                      sized.alias("sized"))


@register("snk7_publish_body", f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value FROM ({R}) r WHERE {_GOOD}
""")
def snk7_publish_body(spark, sf_dir):
    """SNK7: the message bodies that a publisher sends, decoded by SRC1 as a subscriber would."""
    wide = wide_messages(spark, sf_dir).withColumn("timestamp", F.date_format("ts", ISO)).drop("ts")
    got = decode_flat(lc.to_publish_format(wide), TAGS)
    tall = rs.unpivot_tags(got, TAGS, ["device_id", "ts"])
    return tall.select("device_id", "tag_name", F.date_format("ts", US_FMT).alias("ts"), r6("value").alias("value"))


@register("snk6_export_csv", f"""
SELECT device_id, tag_name, {DUS.format(c='ts')} AS ts, round(value, 6) AS value
FROM ({R}) r
WHERE {_GOOD} AND split_part(tag_name, '_', 1) IN {EXPORT_TYPES}
  AND ts >= TIMESTAMP '{EXPORT_START}' AND ts < TIMESTAMP '{EXPORT_STOP}'
""")
def snk6_export_csv(spark, sf_dir):
    """SNK6: a tag selection and time range exported as CSV, read back."""
    path = scratch(spark, "snk6") + "/export"
    tags = [t for t in TAGS if t.split("_")[0] in EXPORT_TYPES]
    good = fx.good_readings(spark, sf_dir).select("device_id", "tag_name", "ts", "value")
    lc.export(good, "csv", path, tags=tags, start=EXPORT_START, stop=EXPORT_STOP)
    back = (spark.read.option("header", "true").option("timestampFormat", lc.EXPORT_TS_FORMAT)
                 .schema("device_id string, tag_name string, ts timestamp, value double").csv(path))
    return back.select("device_id", "tag_name", F.date_format("ts", US_FMT).alias("ts"),
                       r6("value").alias("value"))
