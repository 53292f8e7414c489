"""Series queries: ranges, selections, windows, last values, rates, gaps.

FLT1-7, AGG4-7, WIN1, WIN4 and the evaluation grid (JON5).  A *series* is
the set of points sharing measurement, labels and field; callers pass the
key columns that identify it.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.operators.deadband import changed_by
from tagstream.operators.joins import null_safe_join
from tagstream.functions.timefn import duration_micros, interval_text, micros
from tagstream.operators.sequence import shift_in_series


# ------------------------------------------------------------------ filters
def time_range(df: DataFrame, start, stop=None, ts: str = "ts", now=None) -> DataFrame:
    """FLT1: half-open ``[start, stop)``.

    ``start``/``stop`` are timestamps (str or datetime) or relative
    durations such as ``"-2m"``; both ends count from ``now`` (default:
    the current time), which is also the default ``stop``.
    """
    base = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()

    def resolve(x):
        if x is None:
            return base
        if isinstance(x, str) and x.strip().startswith("-"):
            return base - F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(0), F.lit(duration_micros(x.strip()[1:]) / 1e6))
        return F.lit(x).cast("timestamp")

    return df.where((F.col(ts) >= resolve(start)) & (F.col(ts) < resolve(stop)))


def select_series(df: DataFrame, measurement: str | None = None, fields=None,
                  labels: dict | None = None, field_col: str = "field",
                  measurement_col: str = "measurement") -> DataFrame:
    """FLT2: equality / OR-list on measurement, field and labels."""
    cond = F.lit(True)
    if measurement is not None:
        cond = cond & (F.col(measurement_col) == measurement)
    if fields is not None:
        fields = [fields] if isinstance(fields, str) else list(fields)
        cond = cond & F.col(field_col).isin(fields)
    for k, v in (labels or {}).items():
        col = F.col(k) if k in df.columns else F.col("labels")[k]
        vals = [v] if isinstance(v, str) else list(v)
        cond = cond & col.isin(vals)
    return df.where(cond)


def select_fields_regex(df: DataFrame, pattern: str, field_col: str = "field") -> DataFrame:
    """FLT3: regex on the field name (anchor it with ``^`` as the rules do)."""
    return df.where(F.col(field_col).rlike(pattern))


def keep_fields(df: DataFrame, globs: Sequence[str], field_col: str = "field") -> DataFrame:
    """PRJ5: keep fields matching any glob (``*``, ``?``, ``[..]``)."""
    regex = "|".join(f"(?:{fnmatch.translate(g).replace('(?s:', '(?:')})" for g in globs)
    return df.where(F.col(field_col).rlike(f"^(?:{regex})"))


def partition_filter(df: DataFrame, year: str, month: str, day: str, ts: str | None = None) -> DataFrame:
    """FLT4: y / m / d equality; on a partitioned table Spark prunes directories.

    ``ts`` names the event time that the parts come from: the same day as a time
    range also reaches the scan of a table without such directories."""
    one = df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    if ts is None:
        return one
    lo = F.lit(f"{year}-{month}-{day}").cast("timestamp")
    return one.where((F.col(ts) >= lo) & (F.col(ts) < lo + F.expr("INTERVAL 1 DAY")))


def hour_slice(df: DataFrame, hour_start, ts: str = "ts") -> DataFrame:
    """FLT5: rows of one hour as a time range (the date is part of the test)."""
    lo = F.lit(hour_start).cast("timestamp")
    return df.where((F.col(ts) >= lo) & (F.col(ts) < lo + F.expr("INTERVAL 1 HOUR")))


def changed_only(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                 deadband: float = 0.0, tiebreak: str | None = None,
                 bucket: str = "1 hour") -> DataFrame:
    """FLT6: keep a reading only when it differs from the last reported one by > deadband.

    The first reading of a series is always kept. With deadband 0, the
    plant's data-change report (its subscription sets no deadband filter), the
    last reported value is the previous reading's, so one lag decides. A wider
    band follows the reports (``operators.deadband``): outside means below
    ``last - deadband`` or above ``last + deadband``. A NULL reading is kept
    when the last reported one was not NULL, and the other way round.
    """
    if deadband < 0:
        raise ValueError("deadband must not be negative")
    if deadband:
        return changed_by(df, keys, deadband, ts, value, tiebreak, bucket)
    d = shift_in_series(df, keys, ts, [value], "prev", bucket, tiebreak)
    keep = (F.col("prev_" + ts).isNull()
            | (F.abs(F.col(value) - F.col("prev_" + value)) > F.lit(deadband))
            | (F.col("prev_" + value).isNull() != F.col(value).isNull()))
    return d.where(keep).drop("prev_" + ts, "prev_" + value)


def latest_rows(df: DataFrame, n: int, ts: str = "ts", cols: Sequence[str] | None = None,
                tiebreak: str | None = None) -> DataFrame:
    """FLT7: newest ``n`` rows (TakeOrderedAndProject: a per-task top-n, no full sort)."""
    order = [F.col(ts).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    out = df.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out


# -------------------------------------------------------------- aggregation
_REDUCERS = {
    "mean": lambda v, ts, tb: F.avg(v),
    "max": lambda v, ts, tb: F.max(v),
    "min": lambda v, ts, tb: F.min(v),
    "sum": lambda v, ts, tb: F.sum(v),
    "count": lambda v, ts, tb: F.count(v),
    "last": lambda v, ts, tb: F.max_by(F.col(v), F.struct(*([ts] + ([tb] if tb else [])))),
    "first": lambda v, ts, tb: F.min_by(F.col(v), F.struct(*([ts] + ([tb] if tb else [])))),
}


def reducer(name: str, value: str = "value", ts: str = "ts", tiebreak: str | None = None):
    if name not in _REDUCERS:
        raise ValueError(f"unknown reducer {name!r}")
    return _REDUCERS[name](value, ts, tiebreak)


def aggregate_window(df: DataFrame, keys: Sequence[str], every: str, fn: str = "mean",
                     ts: str = "ts", value: str = "value", tiebreak: str | None = None,
                     create_empty: bool = False, start=None, stop=None) -> DataFrame:
    """AGG4: per-series tumbling windows (epoch aligned); output window start/stop.

    ``create_empty`` adds windows without points over ``[start, stop)``
    (NULL value, 0 for count), one grid row per series and window; the range
    defaults to the windows of all points.
    """
    w = F.window(F.col(ts), interval_text(every))
    agg = (df.groupBy(*keys, w.alias("w"))
             .agg(reducer(fn, value, ts, tiebreak).alias("value"))
             .select(*keys, F.col("w.start").alias("window_start"),
                     F.col("w.end").alias("window_stop"), "value"))
    if not create_empty:
        return agg
    if start is None or stop is None:
        first, end = data_span(df, every, ts)
        start, stop = first if start is None else start, end if stop is None else stop
    grid = eval_grid(df.select(*keys).distinct(), start, stop, every, tick="window_start")
    grid = grid.withColumn("window_stop", F.col("window_start")
                           + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                F.lit(duration_micros(every) / 1e6)))
    out = null_safe_join(grid, agg.drop("window_stop"), [*keys, "window_start"], "left")
    if fn == "count":
        out = out.withColumn("value", F.coalesce(F.col("value"), F.lit(0)))
    return out


DAY_US = 86_400_000_000


def ticks_between(spans: DataFrame, keys: Sequence[str], lo: str, hi: str, every: str, tick: str = "tick") -> DataFrame:
    """Every tick ``lo, lo + every, ... <= hi`` (µs columns) of each row's span.

    The spans are cut by day first and the pieces dealt out, so that a long
    span's ticks come from many tasks; a task generates a day of ticks at a time.
    """
    step = duration_micros(every)
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = spans.select(*keys, F.col(lo).alias("_a"), F.col(hi).alias("_b")).where("_a <= _b")
    pieces = cut.withColumn("_d", F.explode(F.sequence(
        F.col("_a") - F.pmod("_a", F.lit(DAY_US)), F.col("_b"), F.lit(DAY_US))))
    first = F.greatest("_a", F.col("_d") + F.pmod(F.col("_a") - F.col("_d"), F.lit(step)))
    last = F.least("_b", F.col("_d") + F.lit(DAY_US - 1))
    pieces = pieces.select(*keys, "_d", first.alias("_a"), last.alias("_b")).where("_a <= _b").repartition(tasks, *keys, "_d")
    return (pieces.withColumn("_t", F.explode(F.sequence("_a", "_b", F.lit(step))))
            .select(*keys, F.timestamp_micros("_t").alias(tick)))


def grid_ends(start, stop, every: str) -> tuple[F.Column, F.Column]:
    """``[start, stop)`` as microseconds; the grid is ``start, start + every, ...``."""
    lo, hi = (F.unix_micros(F.lit(x).cast("timestamp")) for x in (start, stop))
    return lo, hi - F.lit(1)


def eval_grid(series: DataFrame, start, stop, every: str, tick: str = "tick") -> DataFrame:
    """JON5 grid: one row per series and tick in ``[start, stop)`` stepping ``every``.

    A generator over the (distinct) series rows, not a join: the output size
    is the grid itself, made day by day.
    """
    lo, hi = grid_ends(start, stop, every)
    keys = series.columns
    return ticks_between(series.withColumns({"_lo": lo, "_hi": hi}), keys, "_lo", "_hi", every, tick)


def data_span(df: DataFrame, every: str, ts: str = "ts") -> tuple:
    """(start, stop) of the rows' times, widened to the ``every`` grid; (None, None) without rows.

    A partial aggregate, one row to the driver."""
    step = duration_micros(every)
    t = micros(ts)
    lo, hi = F.min(t), F.max(t)
    row = df.agg(F.timestamp_micros(lo - F.pmod(lo, F.lit(step))), F.timestamp_micros(hi - F.pmod(hi, F.lit(step)) + step)).first()
    return row[0], row[1]


def series_last(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
                tiebreak: str | None = None) -> DataFrame:
    """AGG5: newest non-null value per series and its time."""
    order = F.struct(*([ts] + ([tiebreak] if tiebreak else [])))
    g = df.where(F.col(value).isNotNull())
    return g.groupBy(*keys).agg(F.max_by(F.col(value), order).alias("last_value"),
                                F.max(F.col(ts)).alias("last_ts"))


def series_stats(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """AGG6: count, mean, max per series (over whatever range was selected)."""
    return df.groupBy(*keys).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                                 F.max(value).alias("max"))


def legend_calcs(windowed: DataFrame, keys: Sequence[str], ts: str = "window_start",
                 value: str = "value", exact_scale: int | None = None) -> DataFrame:
    """AGG7: mean, max and lastNotNull of a (windowed) series.

    With ``exact_scale`` the mean is a decimal: each value is fixed to that many
    digits and summed exactly, so the result does not depend on the order in
    which partial sums meet (a double sum can round a tie either way).
    """
    g = windowed.where(F.col(value).isNotNull())
    v = F.col(value) if exact_scale is None else F.col(value).cast(T.DecimalType(38, exact_scale))
    return g.groupBy(*keys).agg(F.avg(v).alias("mean"), F.max(value).alias("max"),
                                F.max_by(F.col(value), F.col(ts)).alias("last_not_null"))


# ------------------------------------------------------------ sequence ops
def derivative(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
               unit: str = "1s", non_negative: bool = True, tiebreak: str | None = None,
               bucket: str = "1 hour") -> DataFrame:
    """WIN1: rate of change per ``unit``; first point of a series dropped.

    With ``non_negative`` a decrease (counter reset) gives NULL.  Points at
    the same time as the previous one give NULL (no elapsed time).
    """
    d = shift_in_series(df, keys, ts, [value], "prev", bucket, tiebreak)
    d = d.where(F.col("prev_" + ts).isNotNull())
    dt_us = micros(ts) - micros("prev_" + ts)
    dv = F.col(value) - F.col("prev_" + value)
    rate = F.when(dt_us > 0, dv / dt_us.cast("double") * F.lit(float(duration_micros(unit))))
    if non_negative:
        rate = F.when(dv >= 0, rate)
    return d.withColumn("rate", rate).drop("prev_" + value)


def ingest_gaps(df: DataFrame, max_gap: str, keys: Sequence[str] = ("source_id",),
                ts: str = "ts", tiebreak: str | None = None,
                bucket: str = "10 minutes") -> DataFrame:
    """WIN4: stretches longer than ``max_gap`` with no data, per source.

    One row per gap: (keys, gap_start, gap_end, gap_seconds).  A source is a
    hot series by nature (all its tags), hence the short default slice.
    """
    d = shift_in_series(df.select(*keys, ts, *([tiebreak] if tiebreak else [])),
                        keys, ts, [], "next", bucket, tiebreak)
    gap = micros("next_" + ts) - micros(ts)
    return (d.where(gap > F.lit(duration_micros(max_gap)))
             .select(*keys, F.col(ts).alias("gap_start"), F.col("next_" + ts).alias("gap_end"),
                     (gap / 1e6).alias("gap_seconds")))
