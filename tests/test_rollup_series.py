"""Rollups, series operators and the bucketed sequence helpers."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagstream.operators import rollup as ro
from tagstream.operators import series as se
from tagstream.operators.sequence import running_in_series, shift_in_series

T0 = dt.datetime(2026, 5, 6, 0, 0, 0)


def _df(spark, rows):
    data = [(i, "s1", "d1", t, T0 + dt.timedelta(seconds=s), v) for i, (t, s, v) in enumerate(rows)]
    return spark.createDataFrame(
        data, "event_id long, source_id string, device_id string, tag_name string, ts timestamp, value double")


def test_uneven_hours_mean_of_means_differs_from_weighted(spark):
    rows = [("T", 60 * i, 10.0) for i in range(10)] + [("T", 3600 + 5, 100.0)]
    h = ro.rollup_1h(_df(spark, rows))
    mm = ro.rollup_1d(h, avg="mean_of_means").collect()[0]
    w = ro.rollup_1d(h, avg="weighted").collect()[0]
    assert mm.avg_val == 55.0 and abs(w.avg_val - 200.0 / 11) < 1e-9
    assert mm.samples == w.samples == 11 and mm.max_val == 100.0


def test_all_bad_gives_no_rollup_row(spark):
    rows = [("T", i, None) for i in range(5)]
    assert ro.rollup_1h(_df(spark, rows)).count() == 0


def test_midnight_events_land_in_their_own_day(spark):
    rows = [("T", -2, 1.0), ("T", 2, 3.0)]  # 23:59:58 and 00:00:02
    h = ro.rollup_1h(_df(spark, rows)).orderBy("hour").collect()
    assert [(r.day, r.hour.hour) for r in h] == [("05", 23), ("06", 0)]


def test_rollup_of_split_equals_rollup_of_whole(spark):
    rnd = random.Random(3)
    rows = [(f"T{rnd.randint(0, 3)}", rnd.randint(0, 20000), rnd.uniform(-5, 5)) for _ in range(400)]
    df = _df(spark, rows)
    whole = {(r.hour, r.tag_name): r for r in ro.rollup_1h(df).collect()}
    a, b = df.randomSplit([0.5, 0.5], seed=1)
    parts = ro.rollup_1h(a).unionByName(ro.rollup_1h(b))
    merged = (parts.groupBy("hour", "tag_name")
                   .agg(F.max("max_val").alias("mx"), F.min("min_val").alias("mn"),
                        F.sum("samples").alias("n"),
                        (F.sum(F.col("avg_val") * F.col("samples")) / F.sum("samples")).alias("avg")))
    for r in merged.collect():
        w = whole[(r.hour, r.tag_name)]
        assert (r.mx, r.mn, r.n) == (w.max_val, w.min_val, w.samples)
        assert abs(r.avg - w.avg_val) < 1e-9


def test_shift_and_running_match_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(f"T{rnd.randint(0, 2)}", rnd.randint(0, 50000), float(rnd.randint(0, 9))) for _ in range(500)]
    df = _df(spark, rows)
    w = Window.partitionBy("tag_name").orderBy("ts", "event_id")
    ref = df.select("event_id", F.lag("value").over(w).alias("p"), F.lead("ts").over(w).alias("n"),
                    F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = shift_in_series(df, ["tag_name"], "ts", ["value"], "prev", "10 minutes", "event_id")
    got = shift_in_series(got, ["tag_name"], "ts", [], "next", "7 minutes", "event_id")
    got = running_in_series(got, ["tag_name"], "ts", "value", "sum", "s", "13 minutes", "event_id")
    g = {r.event_id: (r.prev_value, r.next_ts, r.s) for r in got.collect()}
    for r in ref.collect():
        assert g[r.event_id] == (r.p, r.n, r.s)


def test_derivative_counter_reset(spark):
    rows = [("C", 0, 10.0), ("C", 10, 20.0), ("C", 20, 5.0), ("C", 30, 15.0)]
    d = se.derivative(_df(spark, rows), ["tag_name"], tiebreak="event_id").orderBy("ts").collect()
    assert [r.rate for r in d] == [1.0, None, 1.0]


def test_ingest_gaps_and_changed_only(spark):
    rows = [("T", 0, 1.0), ("T", 60, 1.0), ("T", 60 + 1200, 2.0), ("T", 1300, 2.0)]
    g = se.ingest_gaps(_df(spark, rows), "15m", tiebreak="event_id").collect()
    assert len(g) == 1 and g[0].gap_seconds == 1200.0
    c = se.changed_only(_df(spark, rows), ["tag_name"], tiebreak="event_id").orderBy("ts").collect()
    assert [r.value for r in c] == [1.0, 2.0]


def test_time_range_is_half_open_and_relative(spark):
    rows = [("T", 0, 1.0), ("T", 120, 2.0), ("T", 119, 3.0)]
    now = T0 + dt.timedelta(seconds=120)
    got = se.time_range(_df(spark, rows), "-2m", now=now).collect()
    assert sorted(r.value for r in got) == [1.0, 3.0]


def test_aggregate_window_create_empty(spark):
    rows = [("T", 10, 1.0), ("T", 7300, 2.0)]
    a = se.aggregate_window(_df(spark, rows), ["tag_name"], "1h", "count", create_empty=True,
                            start=T0, stop=T0 + dt.timedelta(hours=3)).orderBy("window_start")
    assert [r.value for r in a.collect()] == [1, 0, 1]


def test_series_last_uses_tiebreak(spark):
    rows = [("T", 5, 1.0), ("T", 5, 2.0), ("T", 1, 9.0)]
    r = se.series_last(_df(spark, rows), ["tag_name"], tiebreak="event_id").collect()[0]
    assert r.last_value == 2.0


def test_latest_rows_plan_is_top_n(spark):
    rows = [("T", i, float(i)) for i in range(50)]
    q = se.latest_rows(_df(spark, rows), 3, tiebreak="event_id")
    assert "TakeOrderedAndProject" in q._jdf.queryExecution().executedPlan().toString()
    assert [r.value for r in q.collect()] == [49.0, 48.0, 47.0]


def test_hourly_rollup_partial_aggregation_before_shuffle(spark):
    rows = [("T", i, 1.0) for i in range(10)]
    plan = ro.rollup_1h(_df(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan or "partial_count" in plan


def test_legend_exact_mean_rounds_a_tie_half_up(spark):
    from decimal import Decimal
    # the mean is 2.275 / 5 = 0.455 exactly: a tie at two digits, which a
    # double sum may land on either side of, depending on summation order
    vals = [0.1, 0.2, 0.3, 0.4, 1.275]
    df = spark.createDataFrame([("t", i, v) for i, v in enumerate(vals)],
                               "tag_name string, window_start int, value double")
    lc = se.legend_calcs(df.repartition(3), ["tag_name"], exact_scale=9)
    r = lc.select("mean", F.round("mean", 2).cast("double").alias("m2"), "max",
                  "last_not_null").collect()[0]
    assert r["mean"] == Decimal("0.455") and r["m2"] == 0.46
    assert r["max"] == 1.275 and r["last_not_null"] == 1.275


def test_relative_range_counts_both_ends_from_now(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [(m, now - dt.timedelta(minutes=m)) for m in range(0, 8)]
    df = spark.createDataFrame(rows, "m int, ts timestamp")
    got = sorted(r.m for r in se.time_range(df, "-5m", "-1m", now="2024-01-01 12:00:00").collect())
    assert got == [2, 3, 4, 5]
