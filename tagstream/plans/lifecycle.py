"""Storage lifecycle jobs: raw sink, rollup writes, slots and backfill,
compaction, expiry, export, publish, partition sync (SNK1-7, JON6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.functions.timefn import with_date_parts
from tagstream.operators.reshape import unpivot_tags
from tagstream.operators.rollup import rollup_1d, rollup_1h
from tagstream.operators.series import time_range
from tagstream.sources.lake import PARTS, read_raw_lake, read_rollup

HOURLY_PARTS = PARTS + ["hr"]
# Text exports keep microseconds (the writers' default format stops at ms).
EXPORT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_raw_lake(stream: DataFrame, path: str, checkpoint: str,
                   trigger: str = "60 seconds", max_records_per_file: int = 1000,
                   ts: str = "ts"):
    """SNK1: stream of decoded wide messages → JSON objects under y/m/d of
    *event* time (not arrival time).  One micro-batch per trigger, files of
    at most ``max_records_per_file`` messages.  ``trigger="availableNow"``
    drains the input and stops (backfills, tests).  Returns the started query."""
    out = with_date_parts(stream, ts).drop(ts)
    w = (out.writeStream.format("json").partitionBy(*PARTS)
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", str(max_records_per_file)).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()


def write_rollup(df: DataFrame, path: str, parts: Sequence[str] = PARTS,
                 max_records_per_file: int = 5_000_000) -> None:
    """SNK2: overwrite exactly the partitions present in ``df`` (dynamic mode),
    so re-running a slot leaves one copy.  Repartitioned by the partition
    columns first: one writer per partition, no small-file spray."""
    (df.repartition(*parts).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", str(max_records_per_file))
       .partitionBy(*parts).parquet(path))


def previous_slot(now: dt.datetime, grain: str) -> tuple[dt.datetime, dt.datetime]:
    """SNK3: the previous complete UTC hour or day before ``now``."""
    now = now.replace(tzinfo=None)
    if grain == "1h":
        end = now.replace(minute=0, second=0, microsecond=0)
        return end - dt.timedelta(hours=1), end
    if grain == "1d":
        end = now.replace(hour=0, minute=0, second=0, microsecond=0)
        return end - dt.timedelta(days=1), end
    raise ValueError(grain)


def _days(start: dt.datetime, stop: dt.datetime) -> list[dt.date]:
    d, out = start.date(), []
    while dt.datetime.combine(d, dt.time()) < stop:
        out.append(d)
        d += dt.timedelta(days=1)
    return out


def _day_filter(df: DataFrame, days: list[dt.date]) -> DataFrame:
    keys = [f"{d:%Y-%m-%d}" for d in days]
    return df.where(F.concat_ws("-", *[F.col(p) for p in PARTS]).isin(keys)
                    if len(keys) > 1 else
                    (F.col("year") == f"{days[0]:%Y}") & (F.col("month") == f"{days[0]:%m}")
                    & (F.col("day") == f"{days[0]:%d}"))


def backfill(spark: SparkSession, raw_path: str, out_1h: str, out_1d: str | None,
             tags: Sequence[str], start: dt.datetime, stop: dt.datetime,
             avg: str = "weighted") -> None:
    """SNK3: roll up ``[start, stop)`` in ONE job per grain (not a loop of slots).

    Raw partitions of the days touched are pruned by y/m/d, rows by event
    time; hourly output overwrites its ``y/m/d/hr`` partitions, daily
    output its ``y/m/d`` partitions, so reruns and overlaps are idempotent.
    A range that cuts an hour is widened to whole hours: the hour's partition
    is overwritten, so all its samples must be read.
    """
    start = start.replace(minute=0, second=0, microsecond=0)
    if stop != (whole_hour := stop.replace(minute=0, second=0, microsecond=0)):
        stop = whole_hour + dt.timedelta(hours=1)
    days = _days(start, stop)
    raw = _day_filter(read_raw_lake(spark, raw_path, tags), days)
    tall = unpivot_tags(time_range(raw, start, stop), tags,
                        ["source_id", "device_id", "ts"])
    hourly = rollup_1h(tall, exact=True).withColumn("hr", F.date_format("hour", "HH"))
    write_rollup(hourly, out_1h, HOURLY_PARTS)
    if out_1d:
        h = read_rollup(spark, out_1h, "1h", extra_parts=["hr"])
        h = _day_filter(h, days)
        whole = [d for d in days if dt.datetime.combine(d, dt.time()) >= start
                 and dt.datetime.combine(d + dt.timedelta(days=1), dt.time()) <= stop]
        if whole:
            write_rollup(rollup_1d(_day_filter(h, whole), avg=avg), out_1d)


def run_slot(spark: SparkSession, raw_path: str, out_1h: str, out_1d: str | None,
             tags: Sequence[str], now: dt.datetime, grain: str = "1h") -> tuple:
    """SNK3: the scheduled job: previous hour (``5 * * * *``) or day (``10 0 * * *``)."""
    start, stop = previous_slot(now, grain)
    backfill(spark, raw_path, out_1h, out_1d if grain == "1d" else None, tags, start, stop)
    return start, stop


def compact(raw: DataFrame, path: str, tags: Sequence[str], layout: str = "tall",
            max_records_per_file: int = 5_000_000) -> None:
    """SNK4: JSON lake → Parquet ZSTD with an hour partition.

    ``layout="tall"`` (default) writes (source, device, tag, ts, value):
    column pruning and clustering by tag survive.  ``layout="map"`` writes
    ``tags map<string,double>`` of the good tags per message.
    """
    df = with_date_parts(raw, "ts", hour=True).withColumnRenamed("hour", "hr")
    if layout == "tall":
        out = unpivot_tags(df, tags, ["source_id", "device_id", "ts", *PARTS, "hr"])
        order = [*PARTS, "hr", "tag_name", "ts"]
    elif layout == "map":
        entries = F.filter(F.array(*[F.struct(F.lit(t).alias("k"), F.col(f"`{t}`").alias("v"))
                                     for t in tags]), lambda e: e["v"].isNotNull())
        out = df.select("source_id", "device_id", "ts", "tag_count", "bad_count",
                        F.map_from_entries(entries).alias("tags"), *PARTS, "hr")
        order = [*PARTS, "hr", "ts"]
    else:
        raise ValueError(layout)
    # Range partitioning on (partition dirs, tag, time): a busy hour is split
    # across several writer tasks by sampled boundaries, files stay clustered
    # by tag and time, and no task receives a whole day.
    (out.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").option("maxRecordsPerFile", str(max_records_per_file))
        .partitionBy(*PARTS, "hr").parquet(path))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Partition directories ``year=/month=/day=`` under ``path`` (metadata only)."""
    fs, root, jvm = _fs(spark, path)
    rows = []
    if fs.exists(root):
        for y in fs.listStatus(root):
            yn = y.getPath().getName()
            if not (y.isDirectory() and yn.startswith("year=")):
                continue
            for m in fs.listStatus(y.getPath()):
                mn = m.getPath().getName()
                if not (m.isDirectory() and mn.startswith("month=")):
                    continue
                for d in fs.listStatus(m.getPath()):
                    dn = d.getPath().getName()
                    if d.isDirectory() and dn.startswith("day="):
                        rows.append((yn[5:], mn[6:], dn[4:], d.getPath().toString()))
    return spark.createDataFrame(rows, "year string, month string, day string, location string")


def expire(spark: SparkSession, path: str, keep_days: int, as_of: dt.date,
           dry_run: bool = True) -> DataFrame:
    """SNK5: partitions older than ``keep_days`` before ``as_of`` (e.g. 90 hot,
    1825 lake).  Dry run by default: returns what would be dropped; with
    ``dry_run=False`` deletes those directories and raises if one stays."""
    cutoff = as_of - dt.timedelta(days=keep_days)
    parts = list_partitions(spark, path)
    pday = F.to_date(F.concat_ws("-", "year", "month", "day"))
    old = parts.where(pday < F.lit(cutoff)).orderBy("year", "month", "day")
    if not dry_run:
        fs, _root, jvm = _fs(spark, path)
        for r in old.select("location").toLocalIterator():
            gone = jvm.org.apache.hadoop.fs.Path(r["location"])
            if not fs.delete(gone, True) and fs.exists(gone):
                raise OSError(f"could not delete {r['location']}")
    return old.withColumn("action", F.lit("DROP" if not dry_run else "WOULD_DROP"))


def export(df: DataFrame, fmt: str, path: str, tags: Sequence[str] | None = None,
           start=None, stop=None, ts: str = "ts", tag: str = "tag_name") -> None:
    """SNK6: a time range and tag selection of readings to CSV / JSON / Parquet."""
    out = df
    if start is not None and stop is not None:
        out = time_range(out, start, stop, ts)
    if tags is not None:
        out = out.where(F.col(tag).isin(list(tags)))
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").option("timestampFormat", EXPORT_TS_FORMAT).csv(path)
    elif fmt == "json":
        w.option("timestampFormat", EXPORT_TS_FORMAT).json(path)
    elif fmt == "parquet":
        w.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(fmt)


def to_publish_format(wide: DataFrame, key: str | None = None) -> DataFrame:
    """SNK7 body: flat JSON per wide message (``value``, optional ``key``)."""
    cols = [c for c in wide.columns if c != key]
    out = wide.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])).alias("value"),
                      *([F.col(key).cast("string").alias("key")] if key else []))
    return out


def publish(stream: DataFrame, topic: str, servers: str, checkpoint: str):
    """SNK7: write flat JSON to a topic (needs the Kafka connector)."""
    return (to_publish_format(stream).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def partition_diff(storage: DataFrame, catalog: DataFrame, mode: str = "ADD") -> DataFrame:
    """JON6: partitions to ADD (in storage, not in catalog) and, with
    ``mode="FULL"``, to DROP (in catalog, gone from storage)."""
    s = storage.select(*PARTS).distinct()
    c = catalog.select(*PARTS).distinct()
    add = s.join(c, PARTS, "left_anti").withColumn("action", F.lit("ADD"))
    if mode == "ADD":
        return add
    if mode != "FULL":
        raise ValueError(mode)
    drop = c.join(s, PARTS, "left_anti").withColumn("action", F.lit("DROP"))
    return add.unionByName(drop)


def catalog_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The y / m / d partitions that the catalog lists for ``table``."""
    part = F.str_to_map("partition", F.lit("/"), F.lit("="))
    return spark.sql(f"SHOW PARTITIONS {table}").select(*[part[p].alias(p) for p in PARTS])


def register_lake(spark: SparkSession, table: str, path: str, schema: str, fmt: str = "parquet") -> None:
    """A catalog table over a y / m / d folder written by batch jobs; it lists no partition until a sync."""
    fields = [f for f in T.StructType.fromDDL(schema) if f.name not in PARTS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = ", ".join(f"{p} string" for p in PARTS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {parts}) USING {fmt} PARTITIONED BY ({', '.join(PARTS)}) "
              f"LOCATION '{path}'")


def sync_partitions(spark: SparkSession, table: str, path: str, mode: str = "FULL", batch: int = 500) -> DataFrame:
    """JON6 applied: brings the catalog's partitions of ``table`` in line with storage.

    ``ADD`` adds what storage has and the catalog lacks; ``FULL`` also drops
    what is gone. ``IF [NOT] EXISTS`` makes each statement safe to run again,
    so a sync that was stopped is repaired by the next one. One row per
    partition to the driver: metadata, some hundred per year.
    Returns the actions taken.
    """
    storage = list_partitions(spark, path)
    todo = partition_diff(storage, catalog_partitions(spark, table), mode)
    todo = todo.join(storage.select(*PARTS, "location"), PARTS, "left").orderBy("action", *PARTS)
    rows = [tuple(r) for r in todo.collect()]
    for action in ("ADD", "DROP"):
        own = [r for r in rows if r[3] == action]
        for at in range(0, len(own), batch):
            specs = []
            for y, m, d, _, location in own[at:at + batch]:
                spec = f"PARTITION (year='{y}', month='{m}', day='{d}')"
                specs.append(f"{spec} LOCATION '{location}'" if action == "ADD" else spec)
            if action == "ADD":
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")
            else:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    spark.catalog.refreshTable(table)
    return spark.createDataFrame(rows, "year string, month string, day string, action string, location string")
