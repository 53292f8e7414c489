"""Property tests (hypothesis), few examples each: every example is a Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagstream.operators import reshape as rs
from tagstream.operators import rules as ru
from tagstream.operators.sequence import shift_in_series

T0 = dt.datetime(2026, 5, 7)
SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "event_id long, device_id string, tag_name string, ts timestamp, value double"

times = st.lists(st.integers(min_value=0, max_value=20_000), min_size=1, max_size=60)


def _fold(ts, c):
    last, out = None, []
    for t in sorted(ts):
        if last is None or t - last >= c:
            out.append(t)
            last = t
    return out


@SETTINGS
@given(a=times, b=times, c=st.integers(min_value=1, max_value=3000),
       bucket=st.sampled_from(["1 minute", "17 minutes", "1 hour"]))
def test_cooldown_is_the_fold(spark, a, b, c, bucket):
    rows = [(i, "d", "A", T0 + dt.timedelta(seconds=s), 1.0) for i, s in enumerate(a)]
    rows += [(1000 + i, "d", "B", T0 + dt.timedelta(seconds=s), 1.0) for i, s in enumerate(b)]
    out = ru.cooldown(spark.createDataFrame(rows, SCHEMA), c, bucket=bucket).collect()
    got = {}
    for r in out:
        got.setdefault(r.tag_name, []).append(int((r.ts - T0).total_seconds()))
    got = {k: sorted(v) for k, v in got.items()}
    assert got == {"A": _fold(a, c), "B": _fold(b, c)}
    for v in got.values():
        assert all(y - x >= c for x, y in zip(v, v[1:]))


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", "z"]),
                               st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=30))
def test_pivot_unpivot_identity(spark, vals):
    seen, rows = set(), []
    for s, tag, v in vals:
        if (s, tag) not in seen:
            seen.add((s, tag))
            rows.append(("d", T0 + dt.timedelta(seconds=s), tag, v))
    tall = spark.createDataFrame(rows, "device_id string, ts timestamp, tag_name string, value double")
    back = rs.unpivot_tags(rs.pivot_tags(tall, ["x", "y", "z"], ["device_id", "ts"]),
                           ["x", "y", "z"], ["device_id", "ts"])
    assert sorted(map(tuple, back.select(*tall.columns).collect())) == sorted(rows)


@SETTINGS
@given(ts=st.lists(st.integers(0, 50_000), min_size=1, max_size=80),
       bucket=st.sampled_from(["30 seconds", "5 minutes", "1 day"]))
def test_bucketed_lag_equals_window_lag(spark, ts, bucket):
    rows = [(i, "d", "AB"[i % 2], T0 + dt.timedelta(seconds=s), float(i)) for i, s in enumerate(ts)]
    df = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("tag_name").orderBy("ts", "event_id")
    ref = {r.event_id: r.p for r in df.select("event_id", F.lag("value").over(w).alias("p")).collect()}
    got = {r.event_id: r.prev_value for r in
           shift_in_series(df, ["tag_name"], "ts", ["value"], "prev", bucket, "event_id").collect()}
    assert got == ref


@SETTINGS
@given(ts=st.lists(st.integers(0, 50_000), min_size=1, max_size=80),
       bucket=st.sampled_from(["30 seconds", "5 minutes", "1 day"]))
def test_bucketed_neighbours_equal_window_lag_and_lead(spark, ts, bucket):
    from tagstream.operators.sequence import neighbours_in_series
    rows = [(i, "d", "AB"[i % 2], T0 + dt.timedelta(seconds=s), float(i)) for i, s in enumerate(ts)]
    df = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("tag_name").orderBy("ts", "event_id")
    ref = {r.event_id: (r.p, r.n) for r in df.select(
        "event_id", F.lag("value").over(w).alias("p"), F.lead("value").over(w).alias("n")).collect()}
    got = {r.event_id: (r.prev_value, r.next_value) for r in
           neighbours_in_series(df, ["tag_name"], "ts", ["value"], bucket, "event_id").collect()}
    assert got == ref
