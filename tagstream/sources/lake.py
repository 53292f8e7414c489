"""Table and stream readers (SRC5-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.functions.timefn import parse_event_time
from tagstream.sources.admission import SLICE_BYTES, Admission
from tagstream.sources.decode import wide_schema

PARTS = ["year", "month", "day"]


def _with_parts(schema: T.StructType, hour: bool = False) -> T.StructType:
    fields = list(schema.fields) + [T.StructField(p, T.StringType()) for p in PARTS]
    if hour:
        fields.append(T.StructField("hour", T.StringType()))
    return T.StructType(fields)


def read_raw_lake(spark: SparkSession, path: str, tags: Sequence[str]) -> DataFrame:
    """SRC5: partitioned JSON lake (``year=/month=/day=`` strings) with a fixed
    schema from the dictionary; NDJSON and single-line JSON arrays both read.

    Filters on year / month / day prune directories before any file is opened.
    """
    schema = _with_parts(wide_schema(tags, corrupt=False))
    df = spark.read.schema(schema).json(path)
    return df.withColumn("ts", parse_event_time(F.col("timestamp")))


ROLLUP_SCHEMA = {
    "1h": "hour timestamp, tag_name string, avg_val double, max_val double, min_val double, "
          "samples long, sum_val decimal(38,9), year string, month string, day string",
    "1d": "day_ts timestamp, tag_name string, avg_val double, max_val double, min_val double, "
          "samples long, year string, month string, day string",
}


def read_rollup(spark: SparkSession, path: str, grain: str = "1h",
                extra_parts: Sequence[str] = ()) -> DataFrame:
    """SRC6: Parquet rollup table.  The schema is given, so partition columns
    stay zero-padded strings ("05") whatever the session's type inference;
    ``extra_parts`` names further partition levels (e.g. ``hr``)."""
    if grain not in ROLLUP_SCHEMA:
        raise ValueError(grain)
    schema = ROLLUP_SCHEMA[grain] + "".join(f", {p} string" for p in extra_parts)
    return spark.read.schema(schema).parquet(path)


COMPACT_SCHEMA = {
    "tall": "source_id string, device_id string, ts timestamp, tag_name string, value double, "
            "year string, month string, day string, hr string",
    "map": "source_id string, device_id string, ts timestamp, tag_count long, bad_count long, "
           "tags map<string,double>, year string, month string, day string, hr string",
}


def read_compacted(spark: SparkSession, path: str, layout: str = "tall") -> DataFrame:
    """Read a table written by ``compact`` (SNK4), partition columns as strings."""
    if layout not in COMPACT_SCHEMA:
        raise ValueError(layout)
    return spark.read.schema(COMPACT_SCHEMA[layout]).parquet(path)


def stream_source(spark: SparkSession, spec: dict) -> DataFrame:
    """SRC7: a streaming DataFrame of raw messages in column ``value``.

    ``spec["format"] == "kafka"`` builds the Kafka reader (topic, servers,
    ``startingOffsets`` earliest for the lake path, latest for hot paths;
    needs the Kafka connector on the cluster).  ``"text"``/``"json"`` read a
    directory of message files, used as the stand-in in tests.  ``"parquet"``
    (``path``, ``schema``) reads a folder of part files, or one file, by size
    (``max_bytes_per_trigger``), in the order in which they were written:
    enough for stateless queries.  With ``root`` the files are admitted in
    event-time order instead (``sources.admission``), which stateful queries
    need; ``Admission.run`` then drives the query.  Each consumer path is its
    own query with its own checkpoint, like independent consumer groups.
    """
    fmt = spec.get("format", "kafka")
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", spec["servers"])
             .option("subscribe", spec["topic"])
             .option("startingOffsets", spec.get("starting", "latest"))
             .option("failOnDataLoss", "false"))
        if spec.get("max_offsets_per_trigger"):
            r = r.option("maxOffsetsPerTrigger", str(spec["max_offsets_per_trigger"]))
        return r.load().select(F.col("value").cast("string").alias("value"),
                               F.col("key").cast("string").alias("key"),
                               "partition", "offset", F.col("timestamp").alias("arrival_ts"))
    if fmt == "text":
        r = spark.readStream.format("text")
        if spec.get("max_files_per_trigger"):
            r = r.option("maxFilesPerTrigger", str(spec["max_files_per_trigger"]))
        return r.load(spec["path"]).select("value")
    if fmt == "parquet":
        if spec.get("root"):
            return Admission(spark, spec["path"], spec["root"], spec["schema"], spec.get("ts", "ts"),
                             slice_bytes=spec.get("slice_bytes", SLICE_BYTES)).stream()
        path = spark._jvm.org.apache.hadoop.fs.Path(spec["path"])
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            raise FileNotFoundError(spec["path"])
        r = (spark.readStream.schema(spec["schema"])
             .option("maxBytesPerTrigger", str(spec.get("max_bytes_per_trigger", SLICE_BYTES))))
        if fs.getFileStatus(path).isDirectory():
            return r.option("recursiveFileLookup", "true").parquet(spec["path"])
        return r.option("pathGlobFilter", path.getName()).parquet(path.getParent().toString())
    raise ValueError(f"unknown stream format {fmt!r}")


def read_points(points: DataFrame, mounts: Sequence[str] | None = None,
                devices: Sequence[str] | None = None,
                fs_deny: Sequence[str] = ("tmpfs", "devtmpfs", "overlay", "squashfs")) -> DataFrame:
    """SRC8: host metric points with the collector's allow / deny lists.

    ``disk`` points keep only allowed mount points and drop denied file
    systems; ``diskio`` keeps only allowed devices; other measurements pass.
    """
    m = F.col("measurement")
    labels = F.col("labels")
    keep = F.lit(True)
    disk_ok = ~labels["fstype"].isin(list(fs_deny)) | labels["fstype"].isNull()
    if mounts is not None:
        disk_ok = disk_ok & labels["path"].isin(list(mounts))
    keep = F.when(m == "disk", disk_ok).otherwise(keep)
    if devices is not None:
        keep = F.when(m == "diskio", labels["name"].isin(list(devices))).otherwise(keep)
    return points.where(keep)
