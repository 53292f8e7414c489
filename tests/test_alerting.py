"""Alert evaluation, no-data policies, pending/firing, routing, muting."""

import datetime as dt

from pyspark.sql import functions as F

from tagstream.functions.catalog import PLANT_ALERT_RULES, AlertRule
from tagstream.operators import alerting as al

T0 = dt.datetime(2026, 5, 7, 10, 0, 0)
RULES = {r.uid: r for r in PLANT_ALERT_RULES}


def _points(spark, rows):
    data = [("opc_data", f, T0 + dt.timedelta(seconds=s), v) for f, s, v in rows]
    return spark.createDataFrame(data, "measurement string, field string, time timestamp, value double")


def test_boiler_rule_max_over_two_minutes(spark):
    p = _points(spark, [("Temp_Boiler_01", 30, 96.0), ("Temp_Boiler_01", 200, 90.0),
                        ("Press_Line_01", 30, 500.0)])
    ev = al.eval_rule(p, RULES["boiler_temp_critical"]).orderBy("tick").collect()
    assert [(r.tick.minute, r.firing) for r in ev] == [(1, 1.0), (2, 1.0), (4, 0.0), (5, 0.0)]


def test_hydraulic_last_either_limit(spark):
    p = _points(spark, [("Press_Hydraulic_01", 10, 170.0), ("Press_Hydraulic_01", 20, 100.0)])
    ev = al.eval_rule(p, RULES["hydraulic_pressure_critical"]).collect()
    assert {r.firing for r in ev} == {0.0}


def _evals(spark, flags):
    data = [("f", T0 + dt.timedelta(minutes=i), 1.0 if x else 0.0) for i, x in enumerate(flags)]
    return spark.createDataFrame(data, "field string, tick timestamp, firing double")


def test_flapping_resets_pending(spark):
    ev = _evals(spark, [True, True, False, True, True, True])
    st = al.pending_firing(ev, ["field"], "2m").orderBy("tick").collect()
    assert [(r.tick.minute, r.state) for r in st] == [
        (0, "Pending"), (1, "Pending"), (3, "Pending"), (4, "Pending"), (5, "Firing"), (6, "Resolved")]


def test_silence_and_no_data_policies(spark):
    p = _points(spark, [("x", 0, 1.0), ("x", 420, 1.0)])  # 7 min gap
    stop = T0 + dt.timedelta(minutes=9)
    ingest = RULES["opc_ingest_stopped"]
    msgs = p.select(F.lit("opc_data").alias("measurement"), "time", "value")
    ev = al.eval_rule(msgs, ingest, keys=("measurement",))
    series = spark.range(1).select(F.lit("opc_data").alias("measurement"))
    st = al.no_data_state(ev, ingest, ["measurement"], T0, stop, series=series).orderBy("tick").collect()
    alerting = [r.tick.minute for r in st if r.state == "Alerting"]
    assert alerting == [0, 3, 4, 5, 6, 7]
    nd = AlertRule("x", None, "max", "2 minutes", ((">", 5.0),), "1 minute", "warning", no_data="NoData")
    ev2 = al.eval_rule(p.withColumn("field", F.lit("x")), nd)
    st2 = al.no_data_state(ev2, nd, ["field"], T0, stop).collect()
    assert {r.state for r in st2} == {"NoData", "Normal"}


def test_route_and_mute(spark):
    alerts = spark.createDataFrame(
        [("a", "critical", T0), ("b", "warning", T0), ("c", "info", T0)],
        "alertname string, severity string, tick timestamp")
    r = {x.alertname: (x.route_order, x.group_wait_s, x.repeat_interval_s)
         for x in al.route(alerts).collect()}
    assert r == {"a": (1, 0, 3600), "b": (2, 60, 21600), "c": (0, 30, 14400)}
    n = spark.createDataFrame([(dt.datetime(2026, 5, 7, 18, 49),), (dt.datetime(2026, 5, 7, 18, 51),)],
                              "notify_at timestamp")
    kept = al.mute(n, "01:50", "02:30", "Asia/Bangkok").collect()
    assert [x.notify_at.minute for x in kept] == [49]


def test_group_notifications_grid(spark):
    # one critical alert firing from minute 0 to 149: initial, repeats, resolution
    ev = spark.createDataFrame([("s1", T0 + dt.timedelta(minutes=m), 1.0) for m in range(150)],
                               "field string, tick timestamp, firing double")
    st = al.pending_firing(ev, ["field"], "0 minutes")
    alerts = (st.withColumn("alertname", F.lit("a")).withColumn("severity", F.lit("critical"))
                .withColumn("device_id", F.lit("d")))
    n = al.group_notifications(al.route(alerts)).orderBy("notify_at").collect()
    got = [((x.notify_at - T0).total_seconds() / 60, x.kind, x.firing, x.resolved) for x in n]
    assert got == [(0, "initial", 1, 0), (60, "repeat", 1, 0), (120, "repeat", 1, 0),
                   (150, "update", 0, 1)]
    assert al.render(spark.createDataFrame(
        [("a", "critical", 2, 1)], "alertname string, severity string, firing long, resolved long")
    ).collect()[0].subject == "[alert] a"


def test_group_notifications_warning_waits_and_batches(spark):
    # two warning alerts start firing at minutes 0 and 3
    rows = [("s1", T0 + dt.timedelta(minutes=m), 1.0) for m in range(0, 20)]
    rows += [("s2", T0 + dt.timedelta(minutes=m), 1.0) for m in range(3, 8)]
    ev = spark.createDataFrame(rows, "field string, tick timestamp, firing double")
    st = al.pending_firing(ev, ["field"], "0 minutes")
    alerts = (st.withColumn("alertname", F.lit("w")).withColumn("severity", F.lit("warning"))
                .withColumn("device_id", F.lit("d")))
    n = al.group_notifications(al.route(alerts)).orderBy("notify_at").collect()
    got = [((x.notify_at - T0).total_seconds() / 60, x.kind, x.firing, x.resolved) for x in n]
    # group_wait 1 m, group_interval 5 m: flushes on the grid 1, 6, 11, 16, 21 ...
    assert got == [(1, "initial", 1, 0), (6, "update", 2, 0), (11, "update", 1, 1),
                   (21, "update", 0, 1)]


def test_classify_lag(spark):
    off = spark.createDataFrame([("g", 0, 100, 95, 1), ("g", 1, 5000, 100, 1), ("g", 2, 50, 20, 0)],
                                "group string, partition int, end_offset long, committed_offset long, "
                                "active_members int")
    r = {x.partition: (x.band, x.orphan) for x in al.classify_lag(off).collect()}
    assert r == {0: ("normal", False), 1: ("check", False), 2: ("watch", True)}


def test_missing_tags(spark):
    tags = spark.createDataFrame([("A",), ("B",)], "tag_name string")
    rd = spark.createDataFrame([("A", T0, 1.0), ("B", T0, None)], "tag_name string, ts timestamp, value double")
    m = al.missing_tags(rd, tags, T0.replace(hour=0), T0.replace(hour=0) + dt.timedelta(days=1), "1 day")
    assert [r.tag_name for r in m.collect()] == ["B"]


def test_tag_count_rule_watches_observed_count(spark):
    from tagstream.functions.catalog import plant_tags
    from tagstream.operators.reshape import quality_points
    tags = plant_tags()
    full = {t: 1.0 for t in tags}
    short = dict(full, Temp_Boiler_01=None)
    rows = [dict(source_id="s", device_id="d", ts=T0, **full),
            dict(source_id="s", device_id="d", ts=T0 + dt.timedelta(minutes=3), **short)]
    cols = ["source_id", "device_id", "ts", *tags]
    wide = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 "source_id string, device_id string, ts timestamp, "
                                 + ", ".join(f"{t} double" for t in tags))
    pts = quality_points(wide, tags)
    ev = al.eval_rule(pts, RULES["opc_tag_count_low"], keys=("device_id", "field"))
    fired = sorted(r.tick.minute for r in ev.collect() if r.firing == 1.0)
    assert fired == [4, 5, 6, 7, 8]  # the 03:xx message is the last one in [T-5m, T)


def test_eval_rules_equals_per_rule_evaluation(spark):
    import random
    rnd = random.Random(4)
    fields = ["Temp_Boiler_01", "Temp_Boiler_02", "Press_Hydraulic_01", "Vibration_Pump_03", "Counter"]
    rows = [(fields[rnd.randrange(5)], rnd.randrange(0, 3600), rnd.uniform(0, 200)) for _ in range(300)]
    p = _points(spark, rows)
    rules = [RULES[u] for u in ("boiler_temp_critical", "hydraulic_pressure_critical", "vibration_high")]
    together = {(r.uid, r.field, r.tick, round(r.value, 9), r.firing)
                for r in al.eval_rules(p, rules).collect()}
    apart = set()
    for rule in rules:
        apart |= {(rule.uid, r.field, r.tick, round(r.value, 9), r.firing)
                  for r in al.eval_rule(p, rule).collect()}
    assert together == apart and len(together) > 0
    plan = al.eval_rules(p, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
