"""Registered queries: Spark plan + equivalent DuckDB SQL per operator.

Each entry maps a key to ``(spark_fn(spark, sf_dir) -> DataFrame, sql | None)``.
Outputs use text for times and doubles rounded to 6 places so the two
engines hash equal values equally.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.sources import fixtures as fx
from tagstream.operators import rollup as ru

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DUCK_TS_FMT = "%Y-%m-%d %H:%M:%S"
R = fx.READINGS_SQL


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def txt(c: str) -> F.Column:
    return F.date_format(F.col(c), TS_FMT)


def r6(c: str | F.Column) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6)


def dtxt(c: str) -> str:
    return f"strftime({c}, '{DUCK_TS_FMT}')"


# ---------------------------------------------------------------- rollups
@register("agg1_rollup_1h", f"""
WITH r AS ({R})
SELECT {dtxt("date_trunc('hour', ts)")} AS hour, tag_name,
       round(avg(value), 6) AS avg_val, round(max(value), 6) AS max_val,
       round(min(value), 6) AS min_val, count(*) AS samples,
       strftime(date_trunc('hour', ts), '%Y') AS year,
       strftime(date_trunc('hour', ts), '%m') AS month,
       strftime(date_trunc('hour', ts), '%d') AS day
FROM r WHERE value IS NOT NULL AND NOT isnan(value)
GROUP BY 1, 2, 7, 8, 9
""")
def agg1_rollup_1h(spark, sf_dir):
    h = ru.rollup_1h(fx.readings(spark, sf_dir))
    return h.select(txt("hour").alias("hour"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"),
                    "samples", "year", "month", "day")


@register("agg1_rollup_1h_device", f"""
WITH r AS ({R})
SELECT {dtxt("date_trunc('hour', ts)")} AS hour, device_id, tag_name,
       round(avg(value), 6) AS avg_val, round(max(value), 6) AS max_val,
       round(min(value), 6) AS min_val, count(*) AS samples
FROM r WHERE value IS NOT NULL AND NOT isnan(value)
GROUP BY 1, 2, 3
""")
def agg1_rollup_1h_device(spark, sf_dir):
    h = ru.rollup_1h(fx.readings(spark, sf_dir), keys=("device_id", "tag_name"))
    return h.select(txt("hour").alias("hour"), "device_id", "tag_name",
                    r6("avg_val").alias("avg_val"), r6("max_val").alias("max_val"),
                    r6("min_val").alias("min_val"), "samples")


# Exact daily means: hourly sums in units of 10^-9, quotients rounded half up on integers.
_EXACT_HOURLY_SQL = f"""
h AS (SELECT date_trunc('hour', ts) AS hour, tag_name, max(value) AS max_val, min(value) AS min_val, count(*) AS samples,
             CAST(sum(CAST(value AS DECIMAL(28, 9))) * 1000000000 AS HUGEINT) AS t
      FROM ({R}) r WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2)"""


def _quotient(t: str, n: str) -> str:
    """t / n rounded half away from zero, as an integer."""
    return f"(sign({t}) * ((2 * abs({t}) + {n}) // (2 * {n})))::HUGEINT"


def _daily_sql(digits: int, mean: str) -> str:
    """``mean``: the day's mean in units of 10^-digits."""
    return f"""
WITH {_EXACT_HOURLY_SQL},
d AS (SELECT date_trunc('day', hour) AS day, tag_name, {mean} AS m, max(max_val) AS mx, min(min_val) AS mn,
             CAST(sum(samples) AS BIGINT) AS samples FROM h GROUP BY 1, 2)
SELECT {dtxt("day")} AS day_ts, tag_name, CAST({_quotient('m', str(10 ** (digits - 6)))} AS DOUBLE) / 1000000.0 AS avg_val,
       round(mx, 6) AS max_val, round(mn, 6) AS min_val, samples,
       strftime(day, '%Y') AS year, strftime(day, '%m') AS month, strftime(day, '%d') AS day
FROM d
"""


def _daily(spark, sf_dir, mode):
    h = ru.rollup_1h(fx.readings(spark, sf_dir), exact=True)
    d = ru.rollup_1d(h, avg=mode)
    return d.select(txt("day_ts").alias("day_ts"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"),
                    "samples", "year", "month", "day")


@register("agg2_rollup_1d_mean_of_means", _daily_sql(
    13, _quotient(f"(sum({_quotient('t', 'samples')}) * 10000)", "count(*)")))
def agg2_rollup_1d_mean_of_means(spark, sf_dir):
    return _daily(spark, sf_dir, "mean_of_means")


@register("agg3_rollup_1d_weighted", _daily_sql(9, _quotient("sum(t)", "sum(samples)")))
def agg3_rollup_1d_weighted(spark, sf_dir):
    return _daily(spark, sf_dir, "weighted")


@register("agg8_partition_counts", f"""
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       count(*) AS rows
FROM ({R}) r GROUP BY 1, 2, 3 ORDER BY 1, 2, 3
""")
def agg8_partition_counts(spark, sf_dir):
    return ru.partition_counts(fx.readings(spark, sf_dir))


@register("agg9_distinct_days", f"""
SELECT count(DISTINCT (strftime(ts, '%Y'), strftime(ts, '%m'), strftime(ts, '%d'))) AS days
FROM ({R}) r
""")
def agg9_distinct_days(spark, sf_dir):
    return ru.distinct_days(fx.readings(spark, sf_dir))


@register("agg10_hourly_mean", f"""
SELECT {dtxt("date_trunc('hour', ts)")} AS hour, round(avg(value), 6) AS avg_val
FROM ({R}) r
WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '15'
  AND tag_name = 'click_07'
GROUP BY 1 ORDER BY 1
""")
def agg10_hourly_mean(spark, sf_dir):
    h = ru.hourly_mean(fx.readings(spark, sf_dir), "click_07", "2024", "01", "15")
    return h.select(txt("hour").alias("hour"), r6("avg_val").alias("avg_val"))


@register("agg11_ingest_report", f"""
WITH s AS (SELECT source_id, date_trunc('second', ts) AS second, count(DISTINCT (device_id, ts)) AS msgs,
                  count(value) AS vals
           FROM ({R}) r GROUP BY 1, 2)
SELECT source_id, {dtxt("date_trunc('day', second)")} AS day_ts,
       CAST(sum(msgs) AS BIGINT) AS messages, CAST(sum(vals) AS BIGINT) AS tag_values,
       round(sum(msgs) / 86400.0, 6) AS avg_msgs_per_sec, max(msgs) AS peak_msgs_per_sec,
       count(*) AS active_seconds
FROM s GROUP BY 1, 2
""")
def agg11_ingest_report(spark, sf_dir):
    rep = ru.ingest_report(fx.readings(spark, sf_dir))
    return rep.select("source_id", txt("day_ts").alias("day_ts"), "messages", "tag_values",
                      r6("avg_msgs_per_sec").alias("avg_msgs_per_sec"), "peak_msgs_per_sec",
                      "active_seconds")


@register("lineitem_rollup_1h", """
WITH r AS (
  SELECT printf('qty_%s%s_%02d', l_returnflag, l_linestatus, l_partkey % 50) AS tag_name,
         CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_orderkey % 24 AS BIGINT))
           + to_minutes(CAST(l_partkey % 60 AS BIGINT)) AS ts,
         l_quantity AS value
  FROM lineitem)
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, tag_name,
       round(avg(value), 6) AS avg_val, round(max(value), 6) AS max_val,
       round(min(value), 6) AS min_val, count(*) AS samples
FROM r WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2
""")
def lineitem_rollup_1h(spark, sf_dir):
    h = ru.rollup_1h(fx.lineitem_readings(spark, sf_dir))
    return h.select(txt("hour").alias("hour"), "tag_name", r6("avg_val").alias("avg_val"),
                    r6("max_val").alias("max_val"), r6("min_val").alias("min_val"), "samples")
