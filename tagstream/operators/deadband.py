"""Report on change with a deadband (FLT6): report a reading that lies more than
the deadband away from the last *reported* one.

What is reported depends on everything before it, but a stretch of a series is
a function of one number: from the last reported value at its start to the one
at its end. The first reading it reports is the first below ``value - deadband``
or above ``value + deadband``, so the function's table needs only the readings
that are the lowest or highest so far, each with the value that stands at the
end when the chain starts there. Functions of neighbouring stretches combine
into the function of both. So the work is a tree over time: functions of
buckets, of ``FAN`` buckets, of ``FAN`` times as many, up to the whole range;
then the value that enters each stretch, from the top down; then the reported
readings of each bucket. A task holds one bucket of one series, or the
functions of ``FAN`` stretches, never a series.

A bad reading (NULL or NaN) is a value of its own: it is reported when the last
report was a number, and a number is when the last report was bad.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.functions.timefn import bucket_of, duration_micros
from tagstream.session import checkpoint_dir

FAN = 32
NONE = np.iinfo(np.int64).max


# ------------------------------------------------------------ groups of a partition
def _splits(batch: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First row of each run of equal keys (NULL equals NULL)."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for k in keys:
        c = batch[k].combine_chunks()
        a, b = c[1:], c[:-1]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        change[1:] |= ~np.asarray(same.to_numpy(zero_copy_only=False), bool)
    return np.flatnonzero(change)


def _by_group(keys: Sequence[str], fn: Callable[[pa.Table], Iterator[pa.Table]]):
    """A mapInArrow function for partitions sorted by ``keys``: calls ``fn`` with each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            cuts = _splits(t, keys)
            out = [g for lo, hi in zip(cuts[:-1], cuts[1:]) for g in fn(t.slice(lo, hi - lo))]
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
            held = t.slice(cuts[-1])
        if held is not None:
            out = list(fn(held))
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
    return run


# ------------------------------------------------------------------- functions
def next_reported(v: np.ndarray, d: float) -> np.ndarray:
    """For each reading the first later one to report after it (``len(v)``: none).

    Minima and maxima over blocks of 1, 2, 4, ... readings let every search
    skip blocks within its band, for all readings at once.
    """
    n = len(v)
    bad = np.isnan(v)
    size = 1 << max(0, int(n - 1).bit_length())
    low, high = np.full(size, np.inf), np.full(size, -np.inf)
    low[:n], high[:n] = np.where(bad, -np.inf, v), np.where(bad, np.inf, v)
    lows, highs = [low], [high]
    while len(lows[-1]) > 1:
        lows.append(lows[-1].reshape(-1, 2).min(axis=1))
        highs.append(highs[-1].reshape(-1, 2).max(axis=1))
    x = np.where(bad, 0.0, v)
    lo, hi = x - d, x + d
    p, found = np.arange(1, n + 1), np.full(n, -1)
    for k in range(len(lows)):
        at = np.flatnonzero((found < 0) & (p < size) & (p >> k & 1 == 1))
        b = p[at] >> k
        hit = (lows[k][b] < lo[at]) | (highs[k][b] > hi[at])
        found[at[hit]] = k
        p[at[~hit]] += 1 << k
    for k in range(len(lows) - 1, 0, -1):
        at = np.flatnonzero(found >= k)
        b = p[at] >> (k - 1)
        hit = (lows[k - 1][b] < lo[at]) | (highs[k - 1][b] > hi[at])
        p[at[~hit]] += 1 << (k - 1)
    nxt = np.where(found >= 0, p, n)
    if bad.any():                                       # after a bad reading: the next number
        good = np.where(bad, n, np.arange(n))
        after = np.append(np.minimum.accumulate(good[::-1])[::-1], n)
        nxt = np.where(bad, after[1:], nxt)
    return nxt


class Span:
    """The function of a stretch: tables (position, value, value at the end), and the same for a bad or no value."""

    __slots__ = ("n", "low", "high", "bad", "good", "head")

    def __init__(self, n, low, high, bad, good, head):
        self.n, self.low, self.high, self.bad, self.good, self.head = n, low, high, bad, good, head

    @staticmethod
    def of(v: np.ndarray, d: float) -> Span:
        n = len(v)
        end = np.minimum(next_reported(v, d), n)
        last = np.where(end < n, end, np.arange(n))
        while not np.array_equal(last, last[last]):
            last = last[last]
        ends = v[last]
        bad = np.isnan(v)

        def table(sign):
            x = np.where(bad, np.inf, sign * v)
            before = np.append(np.inf, np.minimum.accumulate(x)[:-1])
            at = np.flatnonzero(x < before)
            return at.astype(np.int64), v[at], ends[at]

        def first(mask):
            at = int(mask.argmax()) if mask.any() else -1
            return (at, ends[at]) if at >= 0 else (NONE, np.nan)
        return Span(n, table(1.0), table(-1.0), first(bad), first(~bad), ends[0])

    def fires(self, x: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
        """For each entering number: the first reported position (``NONE``: none) and the value at the end."""
        best, end = np.full(len(x), NONE), x.astype(float).copy()
        for (at, v, e), side in ((self.low, -1), (self.high, 1)):
            if len(at):
                i = np.searchsorted(-v, d - x, side="right") if side < 0 else np.searchsorted(v, x + d, side="right")
                ok = i < len(at)
                j = i[ok]
                pos, val = np.full(len(x), NONE), np.zeros(len(x))
                pos[ok], val[ok] = at[j], e[j]
                better = pos < best
                best, end = np.where(better, pos, best), np.where(better, val, end)
        better = self.bad[0] < best
        best, end = np.where(better, self.bad[0], best), np.where(better, self.bad[1], end)
        lost = np.isnan(x)                              # the last report was bad
        return np.where(lost, self.good[0], best), np.where(lost, self.good[1], end)

    def end_of(self, x: np.ndarray, d: float) -> np.ndarray:
        return self.fires(x, d)[1]


def combine(spans: list[Span], d: float) -> Span:
    """The function of consecutive stretches."""
    n, low, high = 0, [], []
    bad = good = (NONE, np.nan)
    least, most = np.inf, -np.inf
    head = None
    for k, s in enumerate(spans):
        def on(x, k=k):
            x = np.asarray(x, float)
            for later in spans[k + 1:]:
                x = later.end_of(x, d)
            return x
        for table, out, sign, limit in ((s.low, low, 1, least), (s.high, high, -1, -most)):
            keep = sign * table[1] < limit
            if keep.any():
                out.append((table[0][keep] + n, table[1][keep], on(table[2][keep])))
        least = min(least, s.low[1].min(initial=np.inf))
        most = max(most, s.high[1].max(initial=-np.inf))
        if bad[0] == NONE and s.bad[0] != NONE:
            bad = s.bad[0] + n, on([s.bad[1]])[0]
        if good[0] == NONE and s.good[0] != NONE:
            good = s.good[0] + n, on([s.good[1]])[0]
        if head is None:
            head = on([s.head])[0]
        n += s.n

    def table(parts):
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    return Span(n, table(low), table(high), bad, good, head)


_TABLES = ("low_at", "low_v", "low_end", "high_at", "high_v", "high_end")
SPAN = ("n long, " + ", ".join(f"{c} array<{'long' if c.endswith('at') else 'double'}>" for c in _TABLES)
        + ", bad_at long, bad_end double, good_at long, good_end double, head double")
_SPAN_COLS = [c.split()[0] for c in SPAN.split(", ")]


def _pack(s: Span) -> dict:
    """One row of a written function; a bad value travels as NaN."""
    return dict(zip(_SPAN_COLS, [s.n, *s.low, *s.high, *s.bad, *s.good, s.head]))


def _unpack(t: pa.Table, i: int) -> Span:
    r = {c: t[c][i] for c in _SPAN_COLS}
    tab = [np.asarray(r[c].values) for c in _TABLES]
    return Span(r["n"].as_py(), tuple(tab[:3]), tuple(tab[3:]), (r["bad_at"].as_py(), r["bad_end"].as_py()),
                (r["good_at"].as_py(), r["good_end"].as_py()), r["head"].as_py())


def _span_table(keys: pa.Table, bucket: int, s: Span) -> pa.Table:
    types = {c: (pa.list_(pa.int64() if c.endswith("at") else pa.float64()) if c in _TABLES
                 else pa.int64() if c in ("n", "bad_at", "good_at") else pa.float64()) for c in _SPAN_COLS}
    row = _pack(s)
    t = keys.append_column("_bk", pa.array([bucket], pa.int64()))
    for c in _SPAN_COLS:
        t = t.append_column(c, pa.array([row[c]], types[c]))
    return t


# ------------------------------------------------------------------------ operator
def changed_by(df: DataFrame, keys: Sequence[str], deadband: float, ts: str = "ts", value: str = "value",
               tiebreak: str | None = None, bucket: str = "1 hour") -> DataFrame:
    """Rows whose value lies more than ``deadband`` from the last reported one of their series.

    The first reading of a series is reported. Order within a series is
    (``ts``, ``tiebreak``). Rows without a time take no part.
    """
    keys, d = list(keys), float(deadband)
    spark = df.sparkSession
    base = df.where(F.col(ts).isNotNull()).withColumn("_bk", bucket_of(ts, duration_micros(bucket)))
    row = (F.struct(*df.columns).alias("_row"), F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("_v"))
    order = [ts] + ([tiebreak] if tiebreak else [])
    rows = base.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_bk",
                       *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *row)
    ks = [f"_k{i}" for i in range(len(keys))]
    os_ = [f"_o{i}" for i in range(len(order))]
    key_ddl = ", ".join(f"{a} {df.schema[k].dataType.simpleString()}" for a, k in zip(ks, keys))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(x: DataFrame, by: list[str], then: list[str]) -> DataFrame:
        return x.repartition(tasks, *by).sortWithinPartitions(*by, *then)

    def numbers(t: pa.Table) -> np.ndarray:
        return t["_v"].to_numpy()

    def spans_of(t: pa.Table) -> Iterator[pa.Table]:
        yield _span_table(t.select(ks).slice(0, 1), t["_bk"][0].as_py(), Span.of(numbers(t), d))

    span_ddl = f"{key_ddl}, _bk long, {SPAN}"
    level = dealt(rows.select(*ks, "_bk", *os_, "_v"), [*ks, "_bk"], os_).mapInArrow(_by_group([*ks, "_bk"], spans_of), span_ddl)
    levels = [_written(level)]
    first, last = levels[0].agg(F.min("_bk"), F.max("_bk")).first()
    if first is None:
        return df.limit(0)

    def joined(t: pa.Table) -> Iterator[pa.Table]:
        yield _span_table(t.select(ks).slice(0, 1), t["_p"][0].as_py(), combine([_unpack(t, i) for i in range(t.num_rows)], d))

    depth = 0
    while first // FAN ** depth != last // FAN ** depth:
        depth += 1
        child = levels[-1].withColumn("_p", F.floor(F.col("_bk") / F.lit(FAN)).cast("long"))
        levels.append(_written(dealt(child, [*ks, "_p"], ["_bk"]).mapInArrow(_by_group([*ks, "_p"], joined), span_ddl)))

    # the value that enters each stretch: none at the top, then child by child
    enter_ddl = f"{key_ddl}, _bk long, _x double, _any boolean"
    entering = levels[-1].select(*ks, "_bk", F.lit(None).cast("double").alias("_x"), F.lit(False).alias("_any"))

    def handed(t: pa.Table) -> Iterator[pa.Table]:
        x, known = t["_x"][0].as_py(), t["_any"][0].as_py()
        xs, anys = [], []
        for i in range(1, t.num_rows):
            s = _unpack(t, i)
            xs.append(x)
            anys.append(known)
            x = float(s.end_of(np.array([x]), d)[0]) if known else s.head
            known = True
        out = t.select([*ks, "_bk"]).slice(1)
        yield out.append_column("_x", pa.array(xs, pa.float64())).append_column("_any", pa.array(anys, pa.bool_()))

    for child in reversed(levels[:-1]):
        up = entering.withColumnRenamed("_bk", "_p").withColumn("_bk", F.lit(None).cast("long"))
        down = child.withColumn("_p", F.floor(F.col("_bk") / F.lit(FAN)).cast("long"))
        both = up.unionByName(down, allowMissingColumns=True)
        # a stretch's own row sorts before its children: its _bk is NULL
        entering = dealt(both, [*ks, "_p"], ["_bk"]).mapInArrow(_by_group([*ks, "_p"], handed), enter_ddl)
        entering = _written(entering)

    def reported(t: pa.Table) -> Iterator[pa.Table]:
        x, known = t["_x"][0].as_py(), t["_any"][0].as_py()
        t = t.slice(1)
        v = numbers(t)
        if not known:
            at = 0
        elif np.isnan(x):
            at = int((~np.isnan(v)).argmax()) if not np.isnan(v).all() else len(v)
        else:
            out = np.isnan(v) | (v < x - d) | (v > x + d)
            at = int(out.argmax()) if out.any() else len(v)
        keep, nxt = [], next_reported(v, d).tolist()
        while at < len(v):
            keep.append(at)
            at = nxt[at]
        if keep:
            yield t.select(["_row"]).take(pa.array(keep))

    both = entering.unionByName(rows, allowMissingColumns=True)
    out = dealt(both, [*ks, "_bk"], os_).select(*ks, "_bk", "_x", "_any", "_v", "_row")
    return out.mapInArrow(_by_group([*ks, "_bk"], reported), f"_row {rows.schema['_row'].dataType.simpleString()}").select("_row.*")


def _written(df: DataFrame) -> DataFrame:
    """A checkpoint: read more than once, and small next to the readings."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
