"""Threshold rules, classification and cooldown (FIXTURES §2)."""

import datetime as dt
import random

from tagstream.functions.catalog import PLANT_RULES, Rule, rules_df
from tagstream.operators import rules as ru

T0 = dt.datetime(2026, 5, 7, 0, 0, 0)


def _rows(spark, rows):
    """rows: (event_id, device, tag, seconds offset, value)"""
    data = [(i, d, t, T0 + dt.timedelta(seconds=s), v) for i, d, t, s, v in rows]
    return spark.createDataFrame(data, "event_id long, device_id string, tag_name string, ts timestamp, value double")


def test_limits_are_strict(spark):
    df = _rows(spark, [(1, "d", "Press_Line_01", 0, 8.0), (2, "d", "Press_Line_01", 1, 2.0),
                       (3, "d", "Press_Line_01", 2, 8.0001), (4, "d", "Press_Line_01", 3, 1.9999)])
    v = ru.classify(ru.violations(df, PLANT_RULES))
    got = sorted((r.event_id, r.direction, r.threshold, r.priority) for r in v.collect())
    assert got == [(3, "HIGH", 8.0, "2"), (4, "LOW", 2.0, "2")]


def test_no_rule_never_alarms_and_null_is_skipped(spark):
    df = _rows(spark, [(1, "d", "Noise_Floor_01", 0, 1e9), (2, "d", "Temp_Ambient_01", 0, -1e9),
                       (3, "d", "Temp_Boiler_01", 0, None), (4, "d", "Counter", 0, 1e12)])
    assert ru.violations(df, PLANT_RULES).count() == 0


def test_nan_is_not_a_violation(spark):
    df = _rows(spark, [(1, "d", "Temp_Boiler_01", 0, float("nan"))])
    assert ru.violations(df, PLANT_RULES).count() == 0


def test_first_match_wins(spark):
    rules = [Rule("Temp_", 10.0, None, "u", "Medium", "broad"),
             Rule("Temp_Boiler_", 95.0, None, "u", "Critical", "narrow")]
    df = _rows(spark, [(1, "d", "Temp_Boiler_01", 0, 50.0)])
    m = ru.match_rules(df, rules).collect()[0]
    assert m.rule_order == 1 and m.prefix == "Temp_"
    m2 = ru.match_rules(df, rules_df(spark, rules)).collect()[0]
    assert m2.rule_order == 1


def test_violations_plan_has_no_nested_loop(spark):
    df = _rows(spark, [(1, "d", "Temp_Boiler_01", 0, 150.0)])
    plan = ru.violations(df, PLANT_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan


def _fired(spark, seconds_list, cooldown=300, keys=("tag_name",)):
    rows = [(i, "d", "Temp_Boiler_01", s, 100.0) for i, s in enumerate(seconds_list)]
    out = ru.cooldown(_rows(spark, rows), cooldown, keys=keys)
    return sorted(int((r.ts - T0).total_seconds()) for r in out.collect())


def test_cooldown_boundaries(spark):
    assert _fired(spark, [0, 100, 299, 300, 599, 600]) == [0, 300, 600]


def test_cooldown_chain_fires_every_400s(spark):
    # every 200 s for 2000 s: the lag rule would fire once; the fold every 400 s
    assert _fired(spark, list(range(0, 2001, 200))) == list(range(0, 2001, 400))


def test_cooldown_two_devices(spark):
    rows = [(1, "d1", "Temp_Boiler_01", 0, 100.0), (2, "d2", "Temp_Boiler_01", 0, 100.0)]
    by_tag = ru.cooldown(_rows(spark, rows), 300, keys=["tag_name"]).count()
    by_dev = ru.cooldown(_rows(spark, rows), 300, keys=["device_id", "tag_name"]).count()
    assert (by_tag, by_dev) == (1, 2)


def _python_fold(times, c):
    last, out = None, []
    for t in sorted(times):
        if last is None or t - last >= c:
            out.append(t)
            last = t
    return out


def test_cooldown_matches_python_fold_on_random_data(spark):
    rnd = random.Random(7)
    rows, expect = [], {}
    for tag in ("Temp_Boiler_01", "Temp_Boiler_02", "Press_Line_03"):
        ts = sorted(rnd.sample(range(0, 20_000), 120))
        rows += [(len(rows) + i, "d", tag, s, 100.0) for i, s in enumerate(ts)]
        expect[tag] = _python_fold(ts, 300)
    out = ru.cooldown(_rows(spark, rows), 300).collect()
    got = {}
    for r in out:
        got.setdefault(r.tag_name, []).append(int((r.ts - T0).total_seconds()))
    assert {k: sorted(v) for k, v in got.items()} == expect


def test_cooldown_long_stuck_episode(spark):
    # a stuck sensor: one long episode, firings exactly C apart
    secs = list(range(0, 6000, 7))
    assert _fired(spark, secs, cooldown=301) == _python_fold(secs, 301)


def test_alarm_and_work_order_text(spark):
    df = _rows(spark, [(1, "dev", "Temp_Boiler_01", 0, 96.123456)])
    a = ru.alarms(ru.violations(df, PLANT_RULES))
    wo = ru.work_orders(a).collect()[0]
    al = a.collect()[0]
    assert al.alarm_name == "[AUTO] Temp_Boiler_01 HIGH: 96.12 °C"
    assert "reading=96.1235 | limit=95.0 | side=HIGH" in al.alarm_notes and f"alarm={al.alarm_id} | priority=1" in wo.process_notes
    assert wo.short_descr == "[AUTO] Temp_Boiler_01 HIGH: 96.12 °C (threshold: 95.0)"
    assert wo.alarm_id == al.alarm_id and wo.priority == "1"
    linked = ru.link_alarm_work_order(a, ru.work_orders(a)).collect()[0]
    assert linked.alarm_name == al.alarm_name


def test_cap_per_hour_and_batch(spark):
    rows = [(i, "dev", f"Temp_Boiler_{i % 3 + 1:02d}", i * 60, 100.0) for i in range(10)]
    v = ru.violations(_rows(spark, rows), PLANT_RULES)
    assert ru.cap_per_hour(v, n=4).count() == 4
    b = ru.batch_per_device(v, "15 minutes").orderBy("batch_start").collect()
    assert [r.violations for r in b] == [10] and b[0].tag_list == "Temp_Boiler_01,Temp_Boiler_02,Temp_Boiler_03"


def test_cap_per_hour_limits_before_shuffle(spark):
    rows = [(i, "dev", "Temp_Boiler_01", i, 100.0) for i in range(20)]
    plan = ru.cap_per_hour(ru.violations(_rows(spark, rows), PLANT_RULES), n=3)\
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_cooldown_with_buckets_much_smaller_than_c(spark):
    rnd = random.Random(11)
    secs = sorted(rnd.sample(range(0, 200_000), 300))
    rows = [(i, "d", "Temp_Boiler_01", s, 100.0) for i, s in enumerate(secs)]
    out = ru.cooldown(_rows(spark, rows), 3000, bucket="7 minutes").collect()
    got = sorted(int((r.ts - T0).total_seconds()) for r in out)
    assert got == _python_fold(secs, 3000)
