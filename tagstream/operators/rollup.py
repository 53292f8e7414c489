"""Downsampling and volume reports (AGG1-3, AGG8-11).

Every aggregate here is a ``groupBy`` whose partial (map-side) aggregation
runs before the shuffle, so the exchange carries one row per output group
and task, whatever the raw volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.functions.timefn import with_date_parts
from tagstream.operators.joins import null_safe_join
from tagstream.operators.series import partition_filter


def _good(df: DataFrame, value: str) -> DataFrame:
    # NULL is a bad reading; NaN would sort above every limit, so it is bad too.
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))


SUM_SCALE = 9        # digits after the point of the exact sums


def rollup_1h(readings: DataFrame, keys: Sequence[str] = ("tag_name",), ts: str = "ts",
              value: str = "value", grain: str = "hour", out_ts: str = "hour",
              exact: bool = False) -> DataFrame:
    """AGG1: avg / max / min / samples per (hour, keys); NULL readings dropped.

    Adds y / m / d partition strings taken from the bucket start (event time).
    ``exact`` adds ``sum_val``, a decimal sum of the values to ``SUM_SCALE``
    digits: sums of hours merge into sums of days without rounding, in any order.
    It is NULL where a value does not fit 19 digits before the point.
    """
    g = _good(readings, value)
    fixed = F.col(value).try_cast(f"decimal({19 + SUM_SCALE}, {SUM_SCALE})")
    sums = [F.when(F.count(fixed) == F.count(F.lit(1)), F.sum(fixed)).alias("sum_val")] if exact else []
    agg = (g.groupBy(F.date_trunc(grain, F.col(ts)).alias(out_ts), *keys)
             .agg(F.avg(value).alias("avg_val"),
                  F.max(value).alias("max_val"),
                  F.min(value).alias("min_val"),
                  F.count(F.lit(1)).alias("samples"), *sums))
    return with_date_parts(agg, out_ts)


def rollup_1d(hourly: DataFrame, keys: Sequence[str] = ("tag_name",), avg: str = "weighted",
              hour: str = "hour") -> DataFrame:
    """AGG2 / AGG3: daily rows from hourly rows (never from raw).

    ``avg="mean_of_means"`` averages hourly means (the plant's daily job);
    ``avg="weighted"`` is the true mean ``sum(avg*samples)/sum(samples)``.
    max of max, min of min and sum of samples are exact either way.  With
    ``sum_val`` (``rollup_1h(exact=True)``) both means are decimal quotients
    of exact sums, so they do not depend on the order in which rows meet;
    a day with an hour without it falls back to the double means.
    """
    if avg == "mean_of_means":
        avg_expr = F.avg("avg_val")
    elif avg == "weighted":
        avg_expr = F.sum(F.col("avg_val") * F.col("samples")) / F.sum("samples")
    else:
        raise ValueError(f"unknown avg mode {avg!r}")
    if "sum_val" in hourly.columns:
        exact = (F.sum("sum_val") / F.sum("samples") if avg == "weighted"
                 else F.avg((F.col("sum_val") / F.col("samples")).cast(f"decimal(28, {SUM_SCALE})")))
        avg_expr = F.when(F.count("sum_val") == F.count(F.lit(1)), exact.cast("double")).otherwise(avg_expr)
    agg = (hourly.groupBy(F.date_trunc("day", F.col(hour)).alias("day_ts"), *keys)
                 .agg(avg_expr.alias("avg_val"),
                      F.max("max_val").alias("max_val"),
                      F.min("min_val").alias("min_val"),
                      F.sum("samples").alias("samples")))
    return with_date_parts(agg, "day_ts")


def partition_counts(raw: DataFrame, ts: str | None = "ts") -> DataFrame:
    """AGG8: rows per year / month / day, sorted (small output, sort is global)."""
    df = raw if ts is None else with_date_parts(raw, ts)
    return (df.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))
              .orderBy("year", "month", "day"))


def distinct_days(raw: DataFrame, ts: str | None = "ts") -> DataFrame:
    """AGG9: number of distinct (year, month, day) partitions holding rows."""
    df = raw if ts is None else with_date_parts(raw, ts)
    return df.agg(F.count_distinct(F.struct("year", "month", "day")).alias("days"))


def hourly_mean(raw: DataFrame, tag: str, year: str, month: str, day: str,
                ts: str = "ts", tag_col: str = "tag_name", value: str = "value") -> DataFrame:
    """AGG10: mean of one tag by hour on one day, ordered by hour.

    Filters on y / m / d and on the same day as a time range first, so a
    partitioned table is pruned to one day and any other to its row groups.
    """
    df = raw if "year" in raw.columns else with_date_parts(raw, ts)
    one = partition_filter(df, year, month, day, ts).where(F.col(tag_col) == tag)
    return (one.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"))
               .agg(F.avg(value).alias("avg_val"))
               .orderBy("hour"))


def ingest_report(raw: DataFrame, source: str = "source_id", ts: str = "ts",
                  value: str = "value", bytes_col: str | None = None,
                  file_col: str | None = None, device: str = "device_id") -> DataFrame:
    """AGG11: per source and day: messages, good tag values, mean and peak rate.

    A message is a distinct (source, device, time), whatever number of tag
    rows it has.  Aggregated by message, then by (source, second), then by
    (source, day), so the peak rate never needs the raw rows of a day in one
    place.  ``bytes_col`` / ``file_col`` (``_metadata.file_size`` and
    ``_metadata.file_path``, carried as columns) add files, bytes and bytes per
    file: the files that hold the day's rows, each counted once.
    """
    src, day = F.col(source).alias("source_id"), F.date_trunc("day", F.col(ts)).alias("day_ts")
    per_msg = raw.groupBy(src, F.col(device).alias("_device"), F.col(ts).alias("_ts")).agg(F.count(value).alias("vals"))
    per_sec = per_msg.groupBy("source_id", F.date_trunc("second", "_ts").alias("second")).agg(
        F.count(F.lit(1)).alias("msgs"), F.sum("vals").alias("vals"))
    out = per_sec.groupBy("source_id", F.date_trunc("day", "second").alias("day_ts")).agg(
        F.sum("msgs").alias("messages"),
        F.sum("vals").alias("tag_values"),
        (F.sum("msgs") / F.lit(86400.0)).alias("avg_msgs_per_sec"),
        F.max("msgs").alias("peak_msgs_per_sec"),
        F.count(F.lit(1)).alias("active_seconds"))
    if not (bytes_col and file_col):
        return out
    per_file = raw.groupBy(src, day, F.col(file_col).alias("f")).agg(F.max(bytes_col).alias("b"))
    files = per_file.groupBy("source_id", "day_ts").agg(F.count(F.lit(1)).alias("files"), F.sum("b").alias("bytes"))
    return (null_safe_join(out, files, ["source_id", "day_ts"], "left")
            .withColumn("bytes_per_file", F.col("bytes") / F.col("files")))
