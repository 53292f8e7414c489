"""Per-series sequence primitives that stay parallel inside one hot series.

``Window.partitionBy(series)`` sends a whole series to one task; a stuck or
chatty sensor (or a single-source feed) can hold a third of all rows.  These
helpers partition by ``(series, time bucket)`` instead, so a task holds at most
one bucket of one series (bounded by ingest rate × bucket width), and repair
the bucket edges from a table with at most one or two rows per non-empty bucket
(bounded by time span / bucket width, not by data volume).

All of it is built-in window, aggregate, union and join expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagstream.operators.joins import null_safe_join
from tagstream.functions.timefn import bucket_of, duration_micros

BK = "_bk"


def _order_cols(ts: str, tiebreak: str | None) -> list[str]:
    return [ts] + ([tiebreak] if tiebreak else [])


def _with_bucket(df: DataFrame, ts: str, bucket: str | int) -> DataFrame:
    return df.withColumn(BK, bucket_of(ts, duration_micros(bucket)))


def _bucket_neighbours(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
                       bucket: str | int, tiebreak: str | None, prev: bool, nxt: bool,
                       prev_prefix: str = "prev_", next_prefix: str = "next_") -> DataFrame:
    """lag / lead within (series, bucket), then repair the bucket edges.

    Only the first row of a bucket (for lag) and the last one (for lead) can
    have a neighbour in another bucket.  Those edge rows, at most two per
    non-empty bucket, take lag / lead from one window per series ordered the
    same way, and are unioned back with the untouched interior rows: no
    aggregate and no join, and the rows are shuffled once, on (series, bucket).
    """
    keys = list(keys)
    carried = [ts] + [c for c in cols if c != ts]
    order = _order_cols(ts, tiebreak)
    d = _with_bucket(df, ts, bucket)
    w = Window.partitionBy(*keys, BK).orderBy(*order)
    d = (d.withColumn("_first", F.lag(F.lit(1)).over(w).isNull())
          .withColumn("_last", F.lead(F.lit(1)).over(w).isNull()))
    for c in carried:
        if prev:
            d = d.withColumn(prev_prefix + c, F.lag(F.col(c)).over(w))
        if nxt:
            d = d.withColumn(next_prefix + c, F.lead(F.col(c)).over(w))
    fix = F.lit(False)
    if prev:
        fix = fix | F.col("_first")
    if nxt:
        fix = fix | F.col("_last")
    inner = d.where(~fix)
    edges = d.where(F.col("_first") | F.col("_last"))
    we = Window.partitionBy(*keys).orderBy(*order)
    for c in carried:
        if prev:
            edges = edges.withColumn(prev_prefix + c, F.when(F.col("_first"), F.lag(F.col(c)).over(we))
                                     .otherwise(F.col(prev_prefix + c)))
        if nxt:
            edges = edges.withColumn(next_prefix + c, F.when(F.col("_last"), F.lead(F.col(c)).over(we))
                                     .otherwise(F.col(next_prefix + c)))
    return inner.unionByName(edges.where(fix)).drop("_first", "_last", BK)


def shift_in_series(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
                    direction: str = "prev", bucket: str | int = "1 hour",
                    tiebreak: str | None = None, prefix: str | None = None) -> DataFrame:
    """Add ``prev_<c>`` (lag 1) or ``next_<c>`` (lead 1) for ``ts`` and ``cols``.

    Order within a series is ``(ts, tiebreak)``.  Equal to
    ``lag/lead(c).over(Window.partitionBy(keys).orderBy(ts, tiebreak))``.
    """
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    prefix = prefix or f"{direction}_"
    if direction == "prev":
        return _bucket_neighbours(df, keys, ts, cols, bucket, tiebreak, True, False,
                                  prev_prefix=prefix)
    return _bucket_neighbours(df, keys, ts, cols, bucket, tiebreak, False, True,
                              next_prefix=prefix)


def neighbours_in_series(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str] = (),
                         bucket: str | int = "1 hour", tiebreak: str | None = None) -> DataFrame:
    """``prev_<c>`` and ``next_<c>`` together, from one bucketed window sort."""
    return _bucket_neighbours(df, keys, ts, cols, bucket, tiebreak, True, True)


def running_in_series(df: DataFrame, keys: Sequence[str], ts: str, col: str, fn: str,
                      out: str, bucket: str | int = "1 hour",
                      tiebreak: str | None = None) -> DataFrame:
    """Running ``sum`` or ``max`` of ``col`` per series, in (ts, tiebreak) order.

    In-bucket running value plus the cumulative value of all earlier buckets
    (a running window over the per-bucket summary).
    """
    keys = list(keys)
    agg = {"sum": F.sum, "max": F.max}[fn]
    order = _order_cols(ts, tiebreak)
    d = _with_bucket(df, ts, bucket)
    w = (Window.partitionBy(*keys, BK).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_in", agg(F.col(col)).over(w))
    per = d.groupBy(*keys, BK).agg(agg(F.col(col)).alias("_b"))
    wb = (Window.partitionBy(*keys).orderBy(BK)
          .rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*keys, BK, agg(F.col("_b")).over(wb).alias("_before"))
    res = null_safe_join(d, per, [*keys, BK], "left")
    if fn == "sum":
        val = F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0))
    else:
        val = F.greatest(F.col("_before"), F.col("_in"))
    return res.withColumn(out, val).drop("_in", "_before", BK)
