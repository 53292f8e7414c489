"""Report on change from the last reported value, against a plain fold."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagstream.operators import deadband as db
from tagstream.operators import series as se

T0 = dt.datetime(2024, 1, 1, 0, 0, 3)
SCHEMA = "event_id long, device_id string, ts timestamp, value double, note string"


def fold(values, d, last=None, known=False):
    """Indexes reported, and the last reported value; None is a bad reading."""
    out = []
    for i, v in enumerate(values):
        bad = v is None or math.isnan(v)
        was_bad = last is None or math.isnan(last)
        if not known or bad != was_bad or (not bad and (v < last - d or v > last + d)):
            out.append(i)
            last, known = v, True
    return out, last


numbers = st.lists(st.one_of(st.integers(-6, 6).map(float), st.just(math.nan)), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(numbers, st.integers(0, 4), st.lists(st.integers(1, 39), max_size=4), st.one_of(st.integers(-6, 6).map(float), st.just(math.nan)))
def test_functions_of_stretches_combine(values, d, cuts, x):
    v = np.array(values)
    cuts = sorted({c for c in cuts if c < len(v)})
    spans = [db.Span.of(p, d) for p in np.split(v, cuts)]
    whole = db.combine(spans, d)
    want, end = fold(values, d, x, True)
    for s in (db.Span.of(v, d), whole):
        pos, got = s.fires(np.array([x]), d)
        assert (pos[0] == (want[0] if want else db.NONE)) and (got[0] == end or (math.isnan(got[0]) and math.isnan(end)))
        head = fold(values, d)[1]
        assert s.head == head or (math.isnan(s.head) and math.isnan(head))


def reported(spark, rows, d, bucket="1 hour"):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = se.changed_only(df, ["device_id"], deadband=d, tiebreak="event_id", bucket=bucket)
    assert out.columns == df.columns
    return sorted(r.event_id for r in out.collect())


def test_drift_is_measured_from_the_last_report(spark):
    rows = [(i, "a", T0 + i * dt.timedelta(minutes=40), 0.6 * i, None) for i in range(5)]
    assert reported(spark, rows, 1.0) == [0, 2, 4]


@pytest.mark.parametrize("bucket,d", [("10 minutes", 0.8), ("1 hour", 2.5), ("2 days", 0.8)])
def test_series_equal_a_fold(spark, bucket, d):
    r = random.Random(3)
    rows, want, n = [], [], 0
    for key in ("a", "b", None, "hot"):
        t, v, vals, ids = T0, 0.0, [], []
        for _ in range(1500 if key == "hot" else 200):
            t += dt.timedelta(seconds=r.choice([0, 1, 30, 600, 90_000 if r.random() < 0.01 else 20]))
            v += r.choice([-0.5, -0.1, 0, 0.1, 0.5, 3.0 if r.random() < 0.02 else 0])
            value = r.choice([round(v, 6)] * 9 + [None])
            rows.append((n, key, t, value, "x"))
            vals.append(value)
            ids.append(n)
            n += 1
        want += [ids[i] for i in fold(vals, d)[0]]
    assert reported(spark, rows, d, bucket) == want


def test_odd_inputs(spark):
    assert reported(spark, [(1, "a", T0, 5.0, None)], 1.0) == [1]
    assert reported(spark, [(1, "a", T0, None, None), (2, "a", T0, None, None), (3, "a", T0, 1.0, None)], 1.0) == [1, 3]
    assert spark.createDataFrame([], SCHEMA).transform(lambda e: se.changed_only(e, ["device_id"], deadband=1.0)).count() == 0
    same = [(7, "a", T0, 5.0, None)] * 3
    assert reported(spark, same, 1.0) == [7]
    with pytest.raises(ValueError):
        reported(spark, same, -1.0)
