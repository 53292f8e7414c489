"""Registered host-metric queries (collector points derived from events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagstream.operators import reshape as rs
from tagstream.plans.registry import R, dtxt, r6, register, txt
from tagstream.sources import fixtures as fx
from tagstream.sources.lake import read_points

HP = fx.HOST_POINTS_SQL.format(readings=R)


def _out(df):
    return df.select("event_id", "measurement", "field", txt("time").alias("time"),
                     r6("value").alias("value"))


@register("src8_read_points", f"""
SELECT event_id, measurement, field, {dtxt('time')} AS time, round(value, 6) AS value
FROM ({HP}) p
WHERE (measurement <> 'disk' OR (fstype NOT IN ('tmpfs', 'devtmpfs', 'overlay', 'squashfs') AND path IN ('/')))
  AND (measurement <> 'diskio' OR dev_name IN ('sda'))
""")
def src8_read_points(spark, sf_dir):
    return _out(read_points(fx.host_points(spark, sf_dir), mounts=["/"], devices=["sda"]))


@register("prj6_cpu_usage", f"""
SELECT event_id, measurement, CASE WHEN field = 'usage_idle' THEN 'usage' ELSE field END AS field,
       {dtxt('time')} AS time,
       round(CASE WHEN field = 'usage_idle' THEN 100.0 - value ELSE value END, 6) AS value
FROM ({HP}) p WHERE measurement = 'cpu'
""")
def prj6_cpu_usage(spark, sf_dir):
    p = fx.host_points(spark, sf_dir).where(F.col("measurement") == "cpu")
    return _out(rs.cpu_usage(p))


@register("prj9_status_color_hosts", f"""
SELECT event_id, measurement, round(v, 6) AS value,
       CASE WHEN v >= 90 THEN 'red'
            WHEN v >= (CASE measurement WHEN 'cpu' THEN 70 ELSE 75 END) THEN 'yellow'
            ELSE 'green' END AS status
FROM (SELECT event_id, measurement,
             CASE WHEN field = 'usage_idle' THEN 100.0 - value ELSE value END AS v
      FROM ({HP}) p WHERE measurement IN ('cpu', 'mem', 'disk')) x
""")
def prj9_status_color_hosts(spark, sf_dir):
    p = rs.cpu_usage(fx.host_points(spark, sf_dir)).where(F.col("measurement").isin("cpu", "mem", "disk"))
    out = rs.status_color(p, "by_measurement")
    return out.select("event_id", "measurement", r6("value").alias("value"), "status")
