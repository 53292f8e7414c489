"""Registered streaming queries.

Each runs a real Structured Streaming query over the files of ``events``,
admitted in event-time order (``sources.admission``), with ``availableNow``
(all input, then stop), writes through a parquet file sink in the shared
checkpoint folder, and returns that table.
Append mode: only windows the watermark has closed are emitted, and the
SQL twins apply the same rule (window end <= max event time - delay).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.operators import alerting as al
from tagstream.operators import rules as ru
from tagstream.plans.alert_queries import BOILER, _eval_sql
from tagstream.plans.registry import R, dtxt, r6, register, txt
from tagstream.plans.rule_queries import _cooldown_sql
from tagstream.plans.series_queries import DEADBAND, DEADBAND_SQL
from tagstream.session import checkpoint_dir
from tagstream.sources import fixtures as fx
from tagstream.sources.admission import SLICE_BYTES, Admission
from tagstream.sources.lake import stream_source
from tagstream.streaming import queries as sq


def _events(spark: SparkSession, sf_dir: str) -> dict:
    return {"format": "parquet", "path": f"{sf_dir.rstrip('/')}/events.parquet",
            "schema": fx.table(spark, sf_dir, "events").schema}


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a plain file stream, for stateless queries: a folder of part files or one file."""
    return stream_source(spark, _events(spark, sf_dir))


def run_available_now(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a stateless streaming DataFrame to the end of its input; return the sink table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"
    q = (df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def stream_to_table(spark: SparkSession, source: dict, build: Callable[[DataFrame], DataFrame], name: str,
                    base: str | None = None) -> tuple[str, str]:
    """Run ``build`` over all files of a source in event-time order; return (sink path, its schema).

    ``base`` holds the admitted files, the checkpoint and the sink; a run on
    the ``base`` of a stopped one goes on where that stopped.
    """
    base = base or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"
    admission = Admission(spark, source["path"], f"{base}/admission", source["schema"], source.get("ts", "ts"),
                          slice_bytes=source.get("slice_bytes", SLICE_BYTES))
    seen = []

    def start(stream):
        out = build(stream)
        seen.append(out.schema)
        return (out.writeStream.format("parquet").option("path", f"{base}/out")
                .option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True).start())

    admission.run(start)
    return f"{base}/out", seen[-1] if seen else build(admission.stream()).schema


def run_events(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame], name: str,
               **spec) -> DataFrame:
    """The sink table of ``build`` over the readings stream of the events table."""
    out, schema = stream_to_table(spark, _events(spark, sf_dir) | spec, lambda s: build(fx.readings_of(s)), name)
    return spark.read.schema(schema).parquet(out)


@register("str1_stream_rollup_1h", f"""
WITH g AS (SELECT * FROM ({R}) r WHERE value IS NOT NULL AND NOT isnan(value)),
wm AS (SELECT max(ts) - INTERVAL 10 MINUTE AS w FROM g),
h AS (SELECT date_trunc('hour', ts) AS hour, tag_name, avg(value) AS avg_val, max(value) AS max_val,
             min(value) AS min_val, count(*) AS samples FROM g GROUP BY 1, 2)
SELECT {dtxt('hour')} AS hour, tag_name, round(avg_val, 6) AS avg_val, round(max_val, 6) AS max_val,
       round(min_val, 6) AS min_val, samples
FROM h, wm WHERE h.hour + INTERVAL 1 HOUR <= wm.w
""")
def str1_stream_rollup_1h(spark, sf_dir):
    out = run_events(spark, sf_dir, lambda r: sq.stream_rollup_1h(r, delay="10 minutes"), "str1")
    return out.select(txt("hour").alias("hour"), "tag_name", r6("avg_val").alias("avg_val"),
                      r6("max_val").alias("max_val"), r6("min_val").alias("min_val"), "samples")


_STR2_SQL = f"""
WITH e AS {_eval_sql(BOILER, "max(value)", "value > 150.0")},
wm AS (SELECT max(ts) - INTERVAL 2 MINUTE AS w FROM ({R}) r
       WHERE value IS NOT NULL AND regexp_matches(tag_name, '^click_'))
SELECT device_id, field, {dtxt('tick')} AS tick, round(value, 6) AS value,
       CASE WHEN value > 150.0 THEN 1.0 ELSE 0.0 END AS firing
FROM e, wm WHERE e.tick <= wm.w
"""


def _boiler_evals(readings: DataFrame) -> DataFrame:
    pts = readings.where(F.col("value").isNotNull()).select("device_id", F.lit(fx.MEASUREMENT).alias("measurement"),
                   F.col("tag_name").alias("field"), F.col("ts").alias("time"), "value")
    return sq.stream_alerts(pts, BOILER, keys=("device_id", "field"), delay="2 minutes")


@register("str2_stream_alerts", _STR2_SQL)
def str2_stream_alerts(spark, sf_dir):
    out = run_events(spark, sf_dir, _boiler_evals, "str2")
    return out.select("device_id", "field", txt("tick").alias("tick"), r6("value").alias("value"),
                      "firing")


_STR2_EVALS_SQL = f"""(SELECT e.* FROM {_eval_sql(BOILER, "max(value)", "value > 150.0")} e,
  (SELECT max(ts) - INTERVAL 2 MINUTE AS w FROM ({R}) r
   WHERE value IS NOT NULL AND regexp_matches(tag_name, '^click_')) wm
  WHERE e.tick <= wm.w)"""


@register("str4_stream_pending_firing", f"""
WITH ev AS {_STR2_EVALS_SQL},
mx AS (SELECT max(tick) AS m FROM ev),
e AS (SELECT * FROM ev WHERE value > 150.0),
l AS (SELECT *, lag(tick) OVER w AS pt, lead(tick) OVER w AS nt FROM e
      WINDOW w AS (PARTITION BY device_id, field ORDER BY tick)),
s AS (SELECT *, max(CASE WHEN pt IS NULL OR tick - pt > INTERVAL 1 MINUTE THEN tick END)
                 OVER (PARTITION BY device_id, field ORDER BY tick
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM l),
st AS (SELECT *, CASE WHEN tick - since >= INTERVAL 1 MINUTE THEN 'Firing' ELSE 'Pending' END
                 AS state FROM s),
out AS (
  SELECT device_id, field, tick, state, since AS active_since FROM st
  UNION ALL
  SELECT device_id, field, tick + INTERVAL 1 MINUTE, 'Resolved', since FROM st, mx
  WHERE (nt IS NULL OR nt - tick > INTERVAL 1 MINUTE) AND state = 'Firing'
    AND (tick + INTERVAL 1 MINUTE < mx.m
         OR EXISTS (SELECT 1 FROM ev x WHERE x.device_id = st.device_id AND x.field = st.field
                    AND x.tick > st.tick)))
SELECT device_id, field, {dtxt('tick')} AS tick, state, {dtxt('active_since')} AS active_since
FROM out
""")
def str4_stream_pending_firing(spark, sf_dir):
    """STR4 chained after STR2: the evaluation table is read back as a file
    stream (Spark allows no state function after a streaming aggregation in
    append mode).  A run is resolved by the next evaluation of its series or,
    when none follows, by the event-time timeout once the watermark passes."""
    evals, schema = stream_to_table(spark, _events(spark, sf_dir), lambda s: _boiler_evals(fx.readings_of(s)), "str4-evals")
    path, states = stream_to_table(
        spark, {"path": evals, "schema": schema, "ts": "tick"},
        lambda s: sq.stream_pending_firing(s, ["device_id", "field"], BOILER.for_), "str4")
    return spark.read.schema(states).parquet(path).select("device_id", "field", txt("tick").alias("tick"), "state",
                      txt("active_since").alias("active_since"))


@register("str3_stream_cooldown", _cooldown_sql(["tag_name"]))
def str3_stream_cooldown(spark, sf_dir):
    out = run_events(spark, sf_dir, lambda r: sq.stream_cooldown(
        ru.violations(r, fx.EVENT_RULES), fx.EVENT_COOLDOWN_SECONDS, keys=["tag_name"], cols=("device_id", "value")), "str3")
    return out.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"),
                      r6("value").alias("value"))


@register("flt6_stream_deadband", DEADBAND_SQL)
def flt6_stream_deadband(spark, sf_dir):
    out = run_events(spark, sf_dir, lambda r: sq.stream_changed_only(
        r, ["tag_name"], DEADBAND, cols=("device_id",)), "flt6")
    return out.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"), r6("value").alias("value"))


def redelivered(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The events as a source delivers them after retries: every third one again, in another file."""
    ev = fx.table(spark, sf_dir, "events")
    ev.write.parquet(f"{folder}/delivered")
    ev.where(F.pmod("event_id", F.lit(3)) == 0).write.parquet(f"{folder}/delivered/again")
    return f"{folder}/delivered"


@register("str6_dedup", f"""
WITH sent AS (SELECT * FROM ({R}) r UNION ALL SELECT * FROM ({R}) r WHERE event_id % 3 = 0)
SELECT DISTINCT device_id, tag_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM sent
""")
def str6_dedup(spark, sf_dir):
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/str6-input-{uuid.uuid4().hex[:12]}"
    source = _events(spark, sf_dir) | {"path": redelivered(spark, sf_dir, base)}
    path, schema = stream_to_table(
        spark, source, lambda s: sq.dedup(fx.readings_of(s), keys=("source_id", "device_id", "ts", "tag_name"),
                                          delay="10 minutes").select("device_id", "tag_name", "ts"), "str6")
    out = spark.read.schema(schema).parquet(path)
    return out.select("device_id", "tag_name", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


# ------------------------------------------------------------------ STR5
SILENCE = "15 minutes"


@register("str5_watchdog", f"""
WITH t AS (SELECT DISTINCT split_part(tag_name, '_', 1) AS source_id, ts FROM ({R}) r),
l AS (SELECT *, lead(ts) OVER (PARTITION BY source_id ORDER BY ts) AS nt FROM t),
w AS (SELECT source_id, 'silent' AS status, ts + INTERVAL {SILENCE} AS at_ts, ts AS last_seen FROM l
      WHERE nt IS NULL OR nt - ts > INTERVAL {SILENCE}
      UNION ALL SELECT source_id, 'resumed', nt, nt FROM l WHERE nt - ts > INTERVAL {SILENCE})
SELECT source_id, status, strftime(at_ts, '%Y-%m-%d %H:%M:%S.%f') AS at_ts, strftime(last_seen, '%Y-%m-%d %H:%M:%S.%f') AS last_seen
FROM w
""")
def str5_watchdog(spark, sf_dir):
    """STR5: each event type is a source; the clock ticks every hour until a day after the newest event."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/streams/str5-input-{uuid.uuid4().hex[:12]}"
    rows = fx.readings(spark, sf_dir).select(F.split_part("tag_name", F.lit("_"), F.lit(1)).alias("source_id"), "ts",
                                             F.lit(False).alias("clock"))
    span = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    ticks = span.select(F.lit(None).cast("string").alias("source_id"), F.explode(F.expr(
        "sequence(lo, hi + INTERVAL 1 DAY, INTERVAL 1 HOUR)")).alias("ts"), F.lit(True).alias("clock"))
    rows.unionByName(ticks).write.parquet(folder)
    path, schema = stream_to_table(
        spark, {"path": folder, "schema": rows.schema},
        lambda s: sq.clocked_watchdog(s.where("NOT clock"), s.where("clock"), SILENCE), "str5")
    out = spark.read.schema(schema).parquet(path)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return out.select("source_id", "status", F.date_format("at", fmt).alias("at_ts"), F.date_format("last_seen", fmt).alias("last_seen"))


# ------------------------------------------------------------------ STR7
LATE_AFTER = "10 minutes"


@register("str7_split_late", f"""
WITH first AS (SELECT max(ts) - INTERVAL {LATE_AFTER} AS wm FROM ({R}) r WHERE event_id % 5 <> 0)
SELECT event_id, device_id, tag_name, CASE WHEN event_id % 5 = 0 AND ts < wm THEN 'late' ELSE 'on_time' END AS kind
FROM ({R}) r, first
""")
def str7_split_late(spark, sf_dir):
    """STR7: every fifth event arrives after the others; what the watermark has passed by then goes to the late table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/str7-{uuid.uuid4().hex[:12]}"
    events = fx.table(spark, sf_dir, "events")
    late = F.pmod("event_id", F.lit(5)) == 0
    route = sq.late_router(f"{base}/on_time", f"{base}/late", LATE_AFTER)

    def start(stream):
        return (fx.readings_of(stream).writeStream.foreachBatch(route).option("checkpointLocation", f"{base}/ck")
                .trigger(availableNow=True).start())

    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(f"{base}/in")
        Admission(spark, f"{base}/in", f"{base}/admission", events.schema).run(start)
    kinds = [spark.read.parquet(f"{base}/{k}").select("event_id", "device_id", "tag_name", F.lit(k).alias("kind"))
             for k in ("on_time", "late")]
    return kinds[0].unionByName(kinds[1])


# ------------------------------------------------------------------ ALR7
@register("alr7_classify_lag", """
WITH n AS (SELECT count(*) AS total, count(*) FILTER (WHERE event_id % 2 = 0) AS half FROM events),
o AS (SELECT 'hot-path' AS consumer_group, total AS end_offset, total AS committed_offset FROM n
      UNION ALL SELECT 'lake-path', total, half FROM n)
SELECT consumer_group, end_offset, committed_offset, 0 AS active_members, end_offset - committed_offset AS lag,
       CASE WHEN end_offset - committed_offset < 10 THEN 'normal'
            WHEN end_offset - committed_offset > 1000 THEN 'check' ELSE 'watch' END AS band,
       end_offset > committed_offset AS orphan
FROM o
""")
def alr7_classify_lag(spark, sf_dir):
    """ALR7 on what Spark reports: two stream queries read the events as they
    arrive in two deliveries; one of them is not started again after the first.
    Committed rows come from the queries' own progress, members from their state."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/alr7-{uuid.uuid4().hex[:12]}"
    events = fx.table(spark, sf_dir, "events")
    even = F.pmod("event_id", F.lit(2)) == 0
    last, committed = {}, {"hot-path": 0, "lake-path": 0}
    for part, groups in ((events.where(even), ("hot-path", "lake-path")), (events.where(~even), ("hot-path",))):
        part.write.mode("append").parquet(f"{base}/in")
        for g in groups:
            stream = stream_source(spark, {"format": "parquet", "path": f"{base}/in", "schema": events.schema})
            last[g] = (stream.writeStream.format("noop").option("checkpointLocation", f"{base}/ck-{g}")
                       .trigger(availableNow=True).start())
            last[g].awaitTermination()
            committed[g] += sq.rows_read(last[g])
    end = spark.read.schema(events.schema).parquet(f"{base}/in").count()
    rows = [(g, end, committed[g], int(q.isActive)) for g, q in last.items()]
    offsets = spark.createDataFrame(rows, "consumer_group string, end_offset long, committed_offset long, active_members int")
    return al.classify_lag(offsets)
