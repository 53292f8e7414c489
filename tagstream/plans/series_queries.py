"""Registered series queries: filters, windows, last values, rates, gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagstream.operators import series as se
from tagstream.plans.registry import R, dtxt, r6, register, txt
from tagstream.sources import fixtures as fx

SERIES = ("device_id", "tag_name")
_ROW_COLS = "event_id, device_id, tag_name, {ts} AS ts, round(value, 6) AS value"


def _rows(df):
    return df.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"),
                     r6("value").alias("value"))


@register("flt1_time_range", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
""")
def flt1_time_range(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    return _rows(se.time_range(r, "2024-01-10 00:00:00", "2024-01-12 00:00:00"))


@register("flt1_time_range_relative", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 12 HOUR
  AND ts < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 90 MINUTE
""")
def flt1_time_range_relative(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    return _rows(se.time_range(r, "-12h", "-90m", now="2024-01-20 12:00:00"))


@register("flt2_select_series", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE value IS NOT NULL AND tag_name IN ('click_01', 'view_02', 'error_19')
  AND device_id = 'dev_01'
""")
def flt2_select_series(spark, sf_dir):
    p = fx.points(spark, sf_dir)
    sel = se.select_series(p, measurement=fx.MEASUREMENT,
                           fields=["click_01", "view_02", "error_19"],
                           labels={"device_id": "dev_01"})
    return _rows(sel.withColumnRenamed("field", "tag_name").withColumnRenamed("time", "ts"))


@register("flt3_select_fields_regex", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE value IS NOT NULL AND regexp_matches(tag_name, '^click_1')
""")
def flt3_select_fields_regex(spark, sf_dir):
    p = fx.points(spark, sf_dir)
    sel = se.select_fields_regex(p, "^click_1")
    return _rows(sel.withColumnRenamed("field", "tag_name").withColumnRenamed("time", "ts"))


@register("prj5_keep_fields", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE value IS NOT NULL AND (tag_name LIKE 'view\\_0%' ESCAPE '\\' OR regexp_matches(tag_name, '^signup_1.$'))
""")
def prj5_keep_fields(spark, sf_dir):
    p = fx.points(spark, sf_dir)
    sel = se.keep_fields(p, ["view_0*", "signup_1?"])
    return _rows(sel.withColumnRenamed("field", "tag_name").withColumnRenamed("time", "ts"))


@register("flt4_partition_filter", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '07'
""")
def flt4_partition_filter(spark, sf_dir):
    from tagstream.functions.timefn import with_date_parts
    r = with_date_parts(fx.readings(spark, sf_dir), "ts")
    return _rows(se.partition_filter(r, "2024", "01", "07", ts="ts"))


@register("flt5_hour_slice", f"""
SELECT {_ROW_COLS.format(ts=dtxt('ts'))} FROM ({R}) r
WHERE ts >= TIMESTAMP '2024-01-15 10:00:00' AND ts < TIMESTAMP '2024-01-15 11:00:00'
""")
def flt5_hour_slice(spark, sf_dir):
    return _rows(se.hour_slice(fx.readings(spark, sf_dir), "2024-01-15 10:00:00"))


@register("flt6_changed_only", f"""
WITH g AS (SELECT event_id, device_id, tag_name, ts, floor(value / 50) AS level
           FROM ({R}) r WHERE value IS NOT NULL),
l AS (SELECT *, lag(level) OVER (PARTITION BY device_id, tag_name ORDER BY ts, event_id) AS prev
      FROM g)
SELECT event_id, device_id, tag_name, {dtxt('ts')} AS ts, round(level, 6) AS level
FROM l WHERE prev IS NULL OR level <> prev
""")
def flt6_changed_only(spark, sf_dir):
    g = fx.good_readings(spark, sf_dir).withColumn("level", F.floor(F.col("value") / 50).cast("double"))
    ch = se.changed_only(g, SERIES, value="level", tiebreak="event_id", bucket="1 hour")
    return ch.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"),
                     r6("level").alias("level"))


# Change of a tag's value that is worth a report.
DEADBAND = 25.0
DEADBAND_SQL = f"""
WITH RECURSIVE n AS (SELECT event_id, device_id, tag_name, ts, value,
                            row_number() OVER (PARTITION BY tag_name ORDER BY ts, event_id) AS i FROM ({R}) r),
f AS (SELECT event_id, device_id, tag_name, ts, value, i, value AS last, TRUE AS kept FROM n WHERE i = 1
      UNION ALL
      SELECT n.event_id, n.device_id, n.tag_name, n.ts, n.value, n.i,
             CASE WHEN (n.value IS NULL) <> (f.last IS NULL) OR n.value < f.last - {DEADBAND}
                       OR n.value > f.last + {DEADBAND} THEN n.value ELSE f.last END,
             coalesce((n.value IS NULL) <> (f.last IS NULL) OR n.value < f.last - {DEADBAND}
                      OR n.value > f.last + {DEADBAND}, FALSE)
      FROM f JOIN n ON n.tag_name = f.tag_name AND n.i = f.i + 1)
SELECT event_id, device_id, tag_name, {dtxt('ts')} AS ts, round(value, 6) AS value FROM f WHERE kept
"""


@register("flt6_deadband", DEADBAND_SQL)
def flt6_deadband(spark, sf_dir):
    """Per tag, over all devices: readings more than a deadband away from the last one reported."""
    ch = se.changed_only(fx.readings(spark, sf_dir), ["tag_name"], deadband=DEADBAND, tiebreak="event_id", bucket="1 day")
    return ch.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"), r6("value").alias("value"))


@register("flt7_latest_rows", f"""
SELECT event_id, device_id, tag_name, {dtxt('ts')} AS ts
FROM ({R}) r ORDER BY r.ts DESC, event_id DESC LIMIT 10
""")
def flt7_latest_rows(spark, sf_dir):
    top = se.latest_rows(fx.readings(spark, sf_dir), 10, tiebreak="event_id")
    return top.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"))


def _win_sql(every_sql: str, agg: str) -> str:
    return f"""
SELECT device_id, tag_name, {dtxt(f"time_bucket(INTERVAL '{every_sql}', ts)")} AS window_start,
       {dtxt(f"time_bucket(INTERVAL '{every_sql}', ts) + INTERVAL '{every_sql}'")} AS window_stop,
       round({agg}, 6) AS value
FROM ({R}) r WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4
"""


def _win(spark, sf_dir, every, fn):
    g = fx.good_readings(spark, sf_dir)
    a = se.aggregate_window(g, SERIES, every, fn, tiebreak="event_id")
    return a.select("device_id", "tag_name", txt("window_start").alias("window_start"),
                    txt("window_stop").alias("window_stop"), r6("value").alias("value"))


@register("agg4_window_mean", _win_sql("6 hours", "avg(value)"))
def agg4_window_mean(spark, sf_dir):
    return _win(spark, sf_dir, "6h", "mean")


@register("agg4_window_last", _win_sql("6 hours", "arg_max(value, (ts, event_id))"))
def agg4_window_last(spark, sf_dir):
    return _win(spark, sf_dir, "6h", "last")


@register("agg4_window_max", _win_sql("1 hour", "max(value)"))
def agg4_window_max(spark, sf_dir):
    return _win(spark, sf_dir, "1h", "max")


@register("agg4_window_count_empty", f"""
WITH s AS (SELECT DISTINCT tag_name FROM ({R}) r WHERE value IS NOT NULL),
b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS hi
      FROM ({R}) r WHERE value IS NOT NULL),
grid AS (SELECT tag_name, t AS window_start
         FROM s, (SELECT unnest(range(lo, hi, INTERVAL 1 HOUR)) AS t FROM b) AS g),
a AS (SELECT tag_name, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(value) AS value
      FROM ({R}) r WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT grid.tag_name, {dtxt('grid.window_start')} AS window_start,
       {dtxt("grid.window_start + INTERVAL 1 HOUR")} AS window_stop,
       coalesce(a.value, 0) AS value
FROM grid LEFT JOIN a ON grid.tag_name = a.tag_name AND grid.window_start = a.window_start
""")
def agg4_window_count_empty(spark, sf_dir):
    g = fx.good_readings(spark, sf_dir)
    a = se.aggregate_window(g, ["tag_name"], "1h", "count", create_empty=True)
    return a.select("tag_name", txt("window_start").alias("window_start"),
                    txt("window_stop").alias("window_stop"), F.col("value").cast("long").alias("value"))


@register("agg5_series_last", f"""
SELECT device_id, tag_name, round(arg_max(value, (ts, event_id)), 6) AS last_value,
       {dtxt('max(ts)')} AS last_ts
FROM ({R}) r WHERE value IS NOT NULL GROUP BY 1, 2
""")
def agg5_series_last(spark, sf_dir):
    s = se.series_last(fx.readings(spark, sf_dir), SERIES, tiebreak="event_id")
    return s.select("device_id", "tag_name", r6("last_value").alias("last_value"),
                    txt("last_ts").alias("last_ts"))


@register("agg6_series_stats", f"""
SELECT device_id, tag_name, count(value) AS count, round(avg(value), 6) AS mean,
       round(max(value), 6) AS max
FROM ({R}) r WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'
GROUP BY 1, 2
""")
def agg6_series_stats(spark, sf_dir):
    r = se.time_range(fx.readings(spark, sf_dir), "2024-01-08 00:00:00", "2024-01-22 00:00:00")
    s = se.series_stats(r, SERIES)
    return s.select("device_id", "tag_name", "count", r6("mean").alias("mean"), r6("max").alias("max"))


@register("agg7_legend_calcs", f"""
WITH w AS (SELECT tag_name, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, avg(value) AS value
           FROM ({R}) r WHERE value IS NOT NULL GROUP BY 1, 2),
     e AS (SELECT tag_name,
                  CAST(sum(CAST(value AS DECIMAL(38, 9))) * 1000000000 AS HUGEINT) AS t,
                  count(*) AS h, max(value) AS mx, arg_max(value, window_start) AS lst
           FROM w GROUP BY 1)
SELECT tag_name,
       CAST(sign(t) * ((2 * abs(t) + 1000 * h) // (2000 * h)) AS DOUBLE) / 1000000.0 AS mean,
       round(mx, 6) AS max, round(lst, 6) AS last_not_null
FROM e
""")
def agg7_legend_calcs(spark, sf_dir):
    g = fx.good_readings(spark, sf_dir)
    w = se.aggregate_window(g, ["tag_name"], "1h", "mean")
    # Exact decimal mean of the hourly means (9 digits each), rounded half-up to 6.
    lc = se.legend_calcs(w, ["tag_name"], exact_scale=9)
    return lc.select("tag_name", F.round("mean", 6).cast("double").alias("mean"),
                     r6("max").alias("max"), r6("last_not_null").alias("last_not_null"))


@register("win1_derivative", f"""
WITH l AS (SELECT event_id, device_id, tag_name, ts, value,
                  lag(ts) OVER w AS pts, lag(value) OVER w AS pv
           FROM ({R}) r WHERE value IS NOT NULL
           WINDOW w AS (PARTITION BY device_id, tag_name ORDER BY ts, event_id))
SELECT event_id, device_id, tag_name, {dtxt('ts')} AS ts,
       round(CASE WHEN value - pv >= 0 AND epoch_us(ts) > epoch_us(pts)
                  THEN (value - pv) / CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE) * 1000000.0 END, 6) AS rate
FROM l WHERE pts IS NOT NULL
""")
def win1_derivative(spark, sf_dir):
    g = fx.good_readings(spark, sf_dir)
    d = se.derivative(g, SERIES, tiebreak="event_id", bucket="1 hour")
    return d.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"), r6("rate").alias("rate"))


@register("win1_rate_window_mean", f"""
WITH l AS (SELECT device_id, tag_name, ts, value, lag(ts) OVER w AS pts, lag(value) OVER w AS pv
           FROM ({R}) r WHERE value IS NOT NULL
           WINDOW w AS (PARTITION BY device_id, tag_name ORDER BY ts, event_id)),
d AS (SELECT device_id, tag_name, ts, (value - pv) / CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE) * 1000000.0 AS rate
      FROM l WHERE value >= pv AND epoch_us(ts) > epoch_us(pts))
SELECT device_id, tag_name, {dtxt("time_bucket(INTERVAL 6 HOUR, ts)")} AS window_start, round(avg(rate), 6) AS value
FROM d GROUP BY 1, 2, 3
""")
def win1_rate_window_mean(spark, sf_dir):
    """A counter's rate, then its mean per window (the disk I/O panel): WIN1 and AGG4 composed."""
    d = se.derivative(fx.good_readings(spark, sf_dir), SERIES, tiebreak="event_id", bucket="1 hour")
    w = se.aggregate_window(d.where("rate IS NOT NULL"), SERIES, "6h", "mean", value="rate")
    return w.select(*SERIES, txt("window_start").alias("window_start"), r6("value").alias("value"))


@register("win4_ingest_gaps", f"""
WITH l AS (SELECT source_id, ts, lead(ts) OVER (PARTITION BY source_id ORDER BY ts, event_id) AS nts
           FROM ({R}) r)
SELECT source_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS gap_start,
       strftime(nts, '%Y-%m-%d %H:%M:%S.%f') AS gap_end,
       round((epoch_us(nts) - epoch_us(ts)) / 1000000.0, 6) AS gap_seconds
FROM l WHERE epoch_us(nts) - epoch_us(ts) > 900000000
""")
def win4_ingest_gaps(spark, sf_dir):
    gaps = se.ingest_gaps(fx.readings(spark, sf_dir), "15m", tiebreak="event_id")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return gaps.select("source_id", F.date_format("gap_start", fmt).alias("gap_start"),
                       F.date_format("gap_end", fmt).alias("gap_end"),
                       r6("gap_seconds").alias("gap_seconds"))
