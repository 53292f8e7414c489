"""Silence in the alert rules: gaps as ticks, no-data policies, and runs across buckets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tagstream.functions.catalog import AlertRule
from tagstream.operators import alerting as al
from tagstream.operators.series import eval_grid
from tagstream.plans import checks

T0 = dt.datetime(2024, 3, 1)
MIN = dt.timedelta(minutes=1)
RULES = [AlertRule("stopped", "^n$", "count", "2 minutes", (("<", 1.0),), "1 minute", "critical", no_data="Alerting"),
         AlertRule("low", "^v$", "last", "5 minutes", (("<", 3.0),), "3 minutes", "warning", no_data="NoData"),
         AlertRule("high", "^v$", "mean", "3 minutes", ((">", 7.0),), "1 minute", "warning", no_data="OK")]


@pytest.fixture(scope="module")
def points(spark):
    """Two sources over three days, with silences of minutes to more than a day; one source id is NULL."""
    r = random.Random(5)
    rows, t = [], T0 + dt.timedelta(seconds=30)
    while t < T0 + dt.timedelta(days=3):
        for f in "nv":
            rows.append((r.choice(["a", None]), f, t, float(r.randint(0, 9))))
        t += dt.timedelta(seconds=r.choice([20, 40, 60, 60, 300, 1200, 4000, 30 * 3600 if r.random() < 0.02 else 90]))
    return spark.createDataFrame(rows, "source_id string, field string, time timestamp, value double")


def brute(points, start, stop, expected):
    rows = [tuple(r) for r in points.collect()]
    out = {}
    for rule in RULES:
        k, field = int(rule.range_.split()[0]), rule.field_regex.strip("^$")
        own = {}
        for s, f, t, v in rows:
            if f == field:
                own.setdefault((s, f), []).append((t, v))
        for key in set(own) | set(expected):
            t = start
            while t < stop:
                seen = sorted(x for x in own.get(key, []) if t - k * MIN <= x[0] < t)
                if seen:
                    vals = [v for _, v in seen]
                    value = {"count": float(len(vals)), "last": vals[-1], "mean": sum(vals) / len(vals)}[rule.reducer]
                    fires = any(value < x if op == "<" else value > x for op, x in rule.condition)
                    got = (round(value, 9), float(fires), "Alerting" if fires else "Normal", rule.uid)
                else:
                    got = {"stopped": (0.0, 1.0, "Alerting", "stopped"), "low": (None, 1.0, "NoData", al.NO_DATA_ALERT),
                           "high": (None, 0.0, "Normal", "high")}[rule.uid]
                out[(rule.uid, *key, t)] = got
                t += MIN
    return out


def test_with_silence_equals_brute_force(spark, points):
    expected = spark.createDataFrame([("c", "n"), ("c", "v")], "source_id string, field string")
    start, stop = T0 - dt.timedelta(hours=30), T0 + dt.timedelta(days=4)
    ev = al.eval_rules(points, RULES, ("source_id", "field"))
    got = al.with_silence(ev, RULES, ("source_id", "field"), start, stop, series=expected)
    rows = got.collect()
    found = {(r.uid, r.source_id, r.field, r.tick): (None if r.value is None else round(r.value, 9), r.firing, r.state, r.alertname)
             for r in rows}
    assert len(found) == len(rows)
    # every rule expects the listed series, whatever its field
    want = brute(points, start, stop, [("c", "n"), ("c", "v")])
    assert found == want
    assert {(r.uid, r.severity, r.for_s) for r in rows} == {("stopped", "critical", 60), ("low", "warning", 180), ("high", "warning", 60)}


def test_range_defaults_to_the_evaluations(spark, points):
    ev = al.eval_rules(points, RULES[:1], ("source_id", "field"))
    lo, hi = ev.agg(F.min("tick"), F.max("tick")).first()
    got = al.with_silence(ev, RULES[:1], ("source_id", "field")).agg(F.min("tick"), F.max("tick"), F.count("*")).first()
    assert tuple(got) == (lo, hi, 2 * ((hi - lo) // MIN + 1))
    none = points.limit(0)
    assert al.with_silence(al.eval_rules(none, RULES, ("source_id", "field")), RULES, ("source_id", "field")).count() == 0


def test_no_data_alert_fires_and_resolves(spark):
    rows = [("a", "v", T0 + dt.timedelta(seconds=s), 5.0) for s in (0, 60, 20 * 60, 21 * 60)]
    pts = spark.createDataFrame(rows, "source_id string, field string, time timestamp, value double")
    ev = al.with_silence(al.eval_rules(pts, RULES[1:2], ("source_id", "field")), RULES[1:2], ("source_id", "field"))
    st = al.pending_firing(ev, ["alertname", "severity", "source_id"], "0 minutes", for_col="for_s").orderBy("tick").collect()
    # the last point before the silence covers five minutes; the alert holds three before it fires
    assert {r.alertname for r in st} == {al.NO_DATA_ALERT} and st[0].tick == T0 + 7 * MIN
    assert [r.state for r in st] == ["Pending"] * 3 + ["Firing"] * 11 + ["Resolved"] and st[-1].tick == T0 + 21 * MIN


def test_pending_firing_across_buckets_equals_fold(spark):
    r = random.Random(9)
    rows, want = [], []
    for key in ("a", "b", None):
        t, ticks = 0, []
        for _ in range(400):
            t += r.choice([1, 1, 1, 1, 1, 2, 7, 90])
            ticks.append(t)
        since = prev = None
        fired = False
        for t in ticks:
            if prev is None or t - prev > 1:
                if fired:
                    want.append((key, prev + 1, "Resolved", since))
                since, fired = t, False
            state = "Firing" if t - since >= 2 else "Pending"
            fired = fired or state == "Firing"
            want.append((key, t, state, since))
            prev = t
        if fired:
            want.append((key, prev + 1, "Resolved", since))
        rows += [(key, T0 + t * MIN, 1.0) for t in ticks] + [(key, T0 + (ticks[-1] + 5) * MIN, 0.0)]
    ev = spark.createDataFrame(rows, "k string, tick timestamp, firing double")
    st = al.pending_firing(ev, ["k"], "2 minutes", bucket="7 minutes")
    got = [(x.k, (x.tick - T0) // MIN, x.state, (x.active_since - T0) // MIN) for x in st.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pending_firing_plan_shuffles(spark, points):
    st = al.pending_firing(al.eval_rule(points, RULES[1], ("source_id", "field"), ts="time"), ["source_id", "field"], "3 minutes")
    plan = checks.physical_plan(st)
    # the evaluation's shuffle, the ticks by (series, day), the day summaries by series
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def test_grid_is_generated_day_by_day(spark):
    ser = spark.createDataFrame([("a",), (None,)], "k string")
    g = eval_grid(ser, T0 + dt.timedelta(seconds=7), T0 + dt.timedelta(days=2, seconds=7), "7 minutes")
    lo = T0 + dt.timedelta(seconds=7)
    want = [lo + i * 7 * MIN for i in range(412)]
    got = sorted(r.tick for r in g.where("k = 'a'").collect())
    assert got == [t for t in want if t < lo + dt.timedelta(days=2)] and g.count() == 2 * len(got)
    assert eval_grid(ser, None, None, "1 minute").count() == 0


def test_stream_pending_firing_equals_fold_over_batches(spark, tmp):
    from tagstream.plans import stream_queries as st
    from tagstream.streaming import queries as sq
    import os
    r = random.Random(21)
    rows = []
    for key in ("a", "b", None):
        on = False
        for t in range(1, 700):
            on = r.random() < (0.85 if on else 0.3)
            if r.random() < 0.9:
                rows.append((key, T0 + t * MIN, float(on)))
    ev = spark.createDataFrame(rows, "k string, tick timestamp, firing double")
    want = {(x.k, x.tick, x.state, x.active_since) for x in al.pending_firing(ev, ["k"], "2 minutes").collect()}
    ev.repartition(6, F.rand(2)).write.parquet(f"{tmp}/ev")
    size = sum(os.path.getsize(f"{tmp}/ev/{f}") for f in os.listdir(f"{tmp}/ev") if f.endswith(".parquet"))
    path, schema = st.stream_to_table(spark, {"path": f"{tmp}/ev", "schema": ev.schema, "ts": "tick", "slice_bytes": size // 5},
                                      lambda s: sq.stream_pending_firing(s, ["k"], "2 minutes"), "pf", f"{tmp}/run")
    got = {(x.k, x.tick, x.state, x.active_since) for x in spark.read.schema(schema).parquet(path).collect()}
    # a run that still stands at the watermark is not resolved yet
    newest = max(t for _, t, _ in rows)
    open_ = {x for x in want - got if x[2] == "Resolved" and x[1] >= newest}
    assert got <= want and want - got == open_
