"""Stream = batch on file streams with availableNow."""

import datetime as dt
import os

from tagstream.operators import rules as ru
from tagstream.operators.rollup import rollup_1h
from tagstream.streaming import queries as sq

SCHEMA = "event_id long, source_id string, device_id string, tag_name string, ts timestamp, value double"
T0 = dt.datetime(2026, 5, 7)


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _run(df, name, tmp, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
           .option("checkpointLocation", os.path.join(tmp, "ck_" + name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_stream_rollup_equals_batch(spark, tmp):
    src = os.path.join(tmp, "in")
    rows = [(i, "s", "d", f"T{i % 2}", T0 + dt.timedelta(minutes=7 * i), float(i)) for i in range(40)]
    _write(spark, src, rows)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    _run(sq.stream_rollup_1h(stream, delay="0 seconds"), "r1", tmp)
    got = {(r.hour, r.tag_name): (r.samples, r.max_val) for r in spark.table("r1").collect()}
    batch = {(r.hour, r.tag_name): (r.samples, r.max_val)
             for r in rollup_1h(spark.read.parquet(src)).collect()}
    # the last open hour is still in state (watermark = max event time)
    assert got and all(batch[k] == v for k, v in got.items()) and len(batch) - len(got) <= 2


def test_stream_cooldown_equals_batch(spark, tmp):
    src = os.path.join(tmp, "v")
    secs = [0, 100, 299, 300, 599, 600, 1000, 1100]
    _write(spark, src, [(i, "s", "d", "Temp_Boiler_01", T0 + dt.timedelta(seconds=s), 99.0)
                        for i, s in enumerate(secs[:4])])
    _write(spark, src, [(i + 4, "s", "d", "Temp_Boiler_01", T0 + dt.timedelta(seconds=s), 99.0)
                        for i, s in enumerate(secs[4:])])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    _run(sq.stream_cooldown(stream, 300), "c1", tmp)
    got = sorted(int((r.ts - T0).total_seconds()) for r in spark.table("c1").collect())
    batch = sorted(int((r.ts - T0).total_seconds())
                   for r in ru.cooldown(spark.read.parquet(src), 300).collect())
    assert got == batch == [0, 300, 600, 1000]


def test_stream_dedup_and_pending(spark, tmp):
    src = os.path.join(tmp, "d")
    row = (1, "s", "d", "T", T0, 1.0)
    _write(spark, src, [row, row, (2, "s", "d", "T", T0 + dt.timedelta(seconds=1), 1.0)])
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    _run(sq.dedup(stream), "dd", tmp)
    assert spark.table("dd").count() == 2
    ev = os.path.join(tmp, "ev")
    flags = [1, 1, 0, 1, 1, 1, 0]
    spark.createDataFrame([("f", T0 + dt.timedelta(minutes=i), float(x)) for i, x in enumerate(flags)],
                          "field string, tick timestamp, firing double").write.parquet(ev)
    s2 = spark.readStream.schema("field string, tick timestamp, firing double").parquet(ev)
    _run(sq.stream_pending_firing(s2, ["field"], "2m"), "pf", tmp)
    got = sorted((r.tick.minute, r.state) for r in spark.table("pf").collect())
    assert got == [(0, "Pending"), (1, "Pending"), (3, "Pending"), (4, "Pending"), (5, "Firing"),
                   (6, "Resolved")]


def test_late_router(spark, tmp):
    route = sq.late_router(os.path.join(tmp, "on"), os.path.join(tmp, "late"), "10 minutes")
    b1 = spark.createDataFrame([(1, "s", "d", "T", T0 + dt.timedelta(hours=1), 1.0)], SCHEMA)
    b2 = spark.createDataFrame([(2, "s", "d", "T", T0, 1.0),
                                (3, "s", "d", "T", T0 + dt.timedelta(minutes=55), 1.0)], SCHEMA)
    route(b1, 0)
    route(b1, 0)          # a replay leaves one copy
    route(b2, 1)
    route(b2, 1)
    assert spark.read.parquet(os.path.join(tmp, "on")).count() == 2
    assert [r.event_id for r in spark.read.parquet(os.path.join(tmp, "late")).collect()] == [2]


def test_stream_alert_rule(spark, tmp):
    from tagstream.functions.catalog import PLANT_ALERT_RULES
    rule = [r for r in PLANT_ALERT_RULES if r.uid == "boiler_temp_critical"][0]
    src = os.path.join(tmp, "p")
    spark.createDataFrame([("opc_data", "Temp_Boiler_01", T0 + dt.timedelta(seconds=30), 96.0),
                           ("opc_data", "Temp_Boiler_01", T0 + dt.timedelta(minutes=10), 20.0)],
                          "measurement string, field string, time timestamp, value double").write.parquet(src)
    s = spark.readStream.schema("measurement string, field string, time timestamp, value double").parquet(src)
    _run(sq.stream_alerts(s, rule, delay="0 seconds"), "al", tmp)
    got = sorted((r.tick.minute, r.firing) for r in spark.table("al").collect())
    assert got == [(1, 1.0), (2, 1.0)]


def test_ingest_watchdog_reports_silence(spark, tmp):
    import time
    src = os.path.join(tmp, "w")
    _write(spark, src, [(1, "s1", "d", "T", T0, 1.0)])
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    q = (sq.ingest_watchdog(stream, timeout="2 seconds").writeStream.format("memory")
           .queryName("wd").outputMode("append")
           .option("checkpointLocation", os.path.join(tmp, "ck_wd"))
           .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        rows = []
        while time.time() < deadline:
            rows = spark.table("wd").collect()
            if any(r.status == "silent" for r in rows):
                break
            time.sleep(1)
    finally:
        q.stop()
    silent = [r for r in rows if r.status == "silent"]
    assert silent and silent[0].source_id == "s1" and silent[0].last_seen == T0


def test_stream_pending_resolves_without_following_eval(spark, tmp):
    from tagstream.operators.alerting import pending_firing
    ev = os.path.join(tmp, "ev2")
    # sparse evaluations: a run 0-3, silence, a lone active tick at 9, then a late inactive one
    pts = [(0, 1), (1, 1), (2, 1), (3, 1), (9, 1), (30, 0)]
    spark.createDataFrame([("f", T0 + dt.timedelta(minutes=m), float(x)) for m, x in pts],
                          "field string, tick timestamp, firing double").write.parquet(ev)
    s2 = spark.readStream.schema("field string, tick timestamp, firing double").parquet(ev)
    _run(sq.stream_pending_firing(s2, ["field"], "2m"), "pf2", tmp)
    got = sorted((r.tick.minute, r.state) for r in spark.table("pf2").collect())
    batch = sorted((r.tick.minute, r.state) for r in
                   pending_firing(spark.read.parquet(ev), ["field"], "2m").collect())
    assert got == batch
    assert (4, "Resolved") in got
