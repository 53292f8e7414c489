"""Structured Streaming forms of the operators (STR1-7).

Stateless and windowed parts are the batch expressions plus a watermark.
Sequential state (cooldown, pending/firing, silence) uses
``applyInPandasWithState`` keyed by series: Arrow batches, one small state
record per key; ordering inside a micro-batch is by event time.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tagstream.functions.catalog import EVAL_INTERVAL, AlertRule
from tagstream.functions.timefn import duration_micros, interval_text, micros
from tagstream.operators.alerting import condition_expr
from tagstream.operators.deadband import next_reported
from tagstream.operators.series import reducer


def stream_rollup_1h(stream: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("tag_name",),
                     ts: str = "ts", value: str = "value") -> DataFrame:
    """STR1: hourly rollup emitted once the watermark passes the hour (append)."""
    good = stream.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    return (good.withWatermark(ts, interval_text(delay))
                .groupBy(F.window(F.col(ts), "1 hour").alias("w"), *keys)
                .agg(F.avg(value).alias("avg_val"), F.max(value).alias("max_val"),
                     F.min(value).alias("min_val"), F.count(F.lit(1)).alias("samples"))
                .select(F.col("w.start").alias("hour"), *keys, "avg_val", "max_val", "min_val",
                        "samples"))


def stream_alerts(points: DataFrame, rule: AlertRule, keys: Sequence[str] = ("field",),
                  ts: str = "time", value: str = "value", delay: str = "2 minutes",
                  every: str = EVAL_INTERVAL, field_col: str = "field") -> DataFrame:
    """STR2: the ALR1 evaluation on a stream (sliding windows, append)."""
    p = points
    if rule.measurement and "measurement" in p.columns:
        p = p.where(F.col("measurement") == rule.measurement)
    if rule.field_regex:
        p = p.where(F.col(field_col).rlike(rule.field_regex))
    w = F.window(F.col(ts), interval_text(rule.range_), interval_text(every))
    agg = (p.withWatermark(ts, interval_text(delay))
            .groupBy(*keys, w.alias("w")).agg(reducer(rule.reducer, value, ts).alias("value"))
            .select(*keys, F.col("w.end").alias("tick"), "value"))
    return agg.withColumn("firing", F.when(condition_expr(F.col("value"), rule.condition), 1.0)
                          .otherwise(0.0))


def _keys_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def stream_cooldown(violations: DataFrame, seconds: float, keys: Sequence[str] = ("tag_name",),
                    ts: str = "ts", tiebreak: str | None = "event_id",
                    cols: Sequence[str] = ("value",)) -> DataFrame:
    """STR3: WIN2 on a stream; state per key = last firing time (µs).

    Rows of a micro-batch are taken in (ts, tiebreak) order; from one firing a
    binary search finds the next, so the work is per firing, not per row. The
    state survives restarts through the checkpoint, unlike an in-memory dict.
    A task holds a key's rows of one micro-batch: admitted slices bound that.
    """
    keys = list(keys)
    c_us = duration_micros(seconds)
    extra = [c for c in cols if c not in keys]
    tb = [tiebreak] if tiebreak else []
    sel = violations.select(*keys, micros(ts).alias("_t"), *tb, *extra)
    out_schema = ", ".join([_keys_schema(violations, keys), "_t long"]
                           + [f"{c} {violations.schema[c].dataType.simpleString()}" for c in tb + extra])

    def fold(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True)
        order = np.lexsort([pdf[c].to_numpy() for c in (*tb, "_t")])
        t = pdf["_t"].to_numpy()[order]
        at = int(np.searchsorted(t, state.get[0] + c_us)) if state.exists else 0
        keep = []
        while at < len(t):
            keep.append(order[at])
            at = max(at + 1, int(np.searchsorted(t, t[at] + c_us)))
        if keep:  # keys with nothing to emit yield no frame
            state.update((int(pdf["_t"].iloc[keep[-1]]),))
            yield pdf.iloc[keep]

    fired = sel.groupBy(*keys).applyInPandasWithState(
        fold, out_schema, "last_fired long", "append", GroupStateTimeout.NoTimeout)
    return fired.withColumn(ts, F.timestamp_micros("_t")).drop("_t")


def stream_changed_only(readings: DataFrame, keys: Sequence[str], deadband: float = 0.0, ts: str = "ts",
                        value: str = "value", tiebreak: str | None = "event_id", cols: Sequence[str] = ()) -> DataFrame:
    """FLT6 on a stream; state per key = the last reported value and whether it was bad.

    Rows of a micro-batch are taken in (ts, tiebreak) order; from one report
    the search for the next skips whole blocks within the band.
    """
    keys, d = list(keys), float(deadband)
    tb = [tiebreak] if tiebreak else []
    sel = readings.select(*keys, micros(ts).alias("_t"), *tb, F.col(value).cast("double").alias(value), *cols)
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sel.schema)

    def fold(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["_t"] + tb, kind="stable")
        v = pdf[value].to_numpy(dtype=float, na_value=np.nan)
        out = np.isnan(v)
        if not state.exists:
            out = np.ones(len(v), bool)
        elif state.get[1]:
            out = ~out
        else:
            out = out | (v < state.get[0] - d) | (v > state.get[0] + d)
        at = int(out.argmax()) if out.any() else len(v)
        keep, nxt = [], next_reported(v, d).tolist()
        while at < len(v):
            keep.append(at)
            at = nxt[at]
        if keep:
            last = float(v[keep[-1]])
            state.update((0.0, True) if np.isnan(last) else (last, False))
            yield pdf.iloc[keep]

    kept = sel.groupBy(*keys).applyInPandasWithState(
        fold, out_schema, "last double, bad boolean", "append", GroupStateTimeout.NoTimeout)
    return kept.withColumn(ts, F.timestamp_micros("_t")).drop("_t")


def stream_pending_firing(evals: DataFrame, keys: Sequence[str], for_: str,
                          every: str = EVAL_INTERVAL, tick: str = "tick",
                          delay: str = "0 seconds") -> DataFrame:
    """STR4: WIN3 on a stream of evaluations; state per series =
    (active_since µs, last active tick µs, reached firing).

    Same output as the batch operator: a run ends at the first tick after
    its last active tick, so ``Resolved`` is stamped ``last + every`` whether
    an inactive evaluation arrives or nothing arrives at all; the latter is
    noticed by an event-time timeout once the watermark passes that tick.
    """
    keys = list(keys)
    step, hold = duration_micros(every), duration_micros(for_)
    sel = (evals.withWatermark(tick, interval_text(delay))
                .select(*keys, F.col(tick).alias("_tick"), micros(tick).alias("_t"),
                        F.col("firing").cast("double").alias("firing")))
    out_schema = _keys_schema(evals, keys) + ", _t long, state string, _since long"

    def emit(key, t, states, since):
        out = pd.DataFrame({"_t": t, "state": states, "_since": since})
        for i, k in enumerate(keys):
            out.insert(i, k, key[i])
        return out

    def step_fn(key, pdfs, state: GroupState):
        since, last, fired = state.get if state.exists else (None, None, False)
        if state.hasTimedOut:
            state.remove()
            if fired:
                yield emit(key, [last + step], ["Resolved"], [since])
            return
        pdf = pd.concat([p[["_t", "firing"]] for p in pdfs], ignore_index=True)
        order = np.argsort(pdf["_t"].to_numpy(), kind="stable")
        ticks, active = pdf["_t"].to_numpy()[order], pdf["firing"].to_numpy()[order] == 1.0
        # active ticks, each with the inactive ones before it; an open run goes on as its last tick
        t, quiet = ticks[active], np.cumsum(~active)[active]
        carried = since is not None
        if carried:
            t, quiet = np.append(last, t), np.append(0, quiet)
        if not len(t):
            return
        start = np.append(True, (np.diff(t) > step) | (np.diff(quiet) > 0))
        run = np.cumsum(start) - 1
        begun = t[start]
        if carried:
            begun[0] = since
        ends = np.append(t[np.flatnonzero(start)[1:] - 1], t[-1])
        reached = ends - begun >= hold
        if carried:
            reached[0] |= fired
        over = np.ones(len(begun), bool)
        over[-1] = (~active).sum() > quiet[-1]              # an inactive tick after the last active one
        new = slice(1 if carried else 0, None)
        states = np.where(t - begun[run] >= hold, "Firing", "Pending")[new]
        done = over & reached
        if over[-1]:
            state.remove()
        else:
            state.update((int(begun[-1]), int(t[-1]), bool(reached[-1])))
            state.setTimeoutTimestamp((int(t[-1]) + step) // 1000)
        if len(states) or done.any():
            yield emit(key, np.append(t[new], ends[done] + step), np.append(states, np.full(done.sum(), "Resolved")).astype(object),
                       np.append(begun[run][new], begun[done]))

    out = sel.groupBy(*keys).applyInPandasWithState(
        step_fn, out_schema, "since long, last long, fired boolean", "append",
        GroupStateTimeout.EventTimeTimeout)
    return (out.withColumn(tick, F.timestamp_micros("_t"))
               .withColumn("active_since", F.timestamp_micros("_since")).drop("_t", "_since"))


def ingest_watchdog(stream: DataFrame, timeout: str = "2 minutes",
                    keys: Sequence[str] = ("source_id",), ts: str = "ts") -> DataFrame:
    """STR5: emit a ``silent`` row when a source sends nothing for ``timeout``
    of processing time (a watermark cannot advance without data), and a
    ``resumed`` row when it comes back."""
    keys = list(keys)
    t_ms = duration_micros(timeout) // 1000
    sel = stream.select(*keys, micros(ts).alias("_t"))
    out_schema = _keys_schema(stream, keys) + ", status string, last_seen long"

    def watch(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            last, silent = state.get
            state.update((last, True))
            yield pd.DataFrame([[*key, "silent", last]], columns=[*keys, "status", "last_seen"])
            return
        prev_silent = state.get[1] if state.exists else False
        mx = None
        for pdf in pdfs:
            if len(pdf):
                v = int(pdf["_t"].max())
                mx = v if mx is None else max(mx, v)
        if mx is None and state.exists:
            mx = state.get[0]
        state.update((mx, False))
        state.setTimeoutDuration(t_ms)
        if prev_silent:
            yield pd.DataFrame([[*key, "resumed", mx]], columns=[*keys, "status", "last_seen"])

    out = sel.groupBy(*keys).applyInPandasWithState(
        watch, out_schema, "last_seen long, silent boolean", "append",
        GroupStateTimeout.ProcessingTimeTimeout)
    return out.withColumn("last_seen", F.timestamp_micros("last_seen"))


def clocked_watchdog(stream: DataFrame, clock: DataFrame, timeout: str = "2 minutes",
                     keys: Sequence[str] = ("source_id",), ts: str = "ts") -> DataFrame:
    """STR5 by a clock that is itself a stream: ``silent`` when a source sends
    nothing for ``timeout``, ``resumed`` when it comes back.

    ``clock`` holds times in column ``ts``: Spark's rate source for wall-clock
    time, or a table of ticks for a controlled clock. Its rows move the
    watermark while the sources are silent, so an event-time timer fires
    without data; the result depends on the times alone, not on micro-batches.
    State per source: last time seen, and whether silence was reported. Output:
    keys, status, ``at`` (when the silence counts, or the source is back), ``last_seen``.
    """
    keys = list(keys)
    limit = duration_micros(timeout)
    data = stream.select(*keys, F.col(ts), F.lit(False).alias("_clock"))
    ticks = clock.select(*[F.lit(None).cast(stream.schema[k].dataType).alias(k) for k in keys], F.col(ts), F.lit(True).alias("_clock"))
    both = data.unionByName(ticks).withWatermark(ts, "0 seconds").select("*", micros(ts).alias("_t"))
    out_schema = _keys_schema(stream, keys) + ", status string, at long, last_seen long"

    def watch(key, pdfs, state: GroupState):
        if key[-1]:                                   # the clock has no state
            for _ in pdfs:
                pass
            return
        rows = []
        if state.hasTimedOut:
            last, silent = state.get
            if not silent:
                rows.append(("silent", last + limit, last))
            state.update((last, True))
        else:
            last, silent = state.get if state.exists else (None, False)
            t = np.sort(np.concatenate([p["_t"].to_numpy() for p in pdfs]))
            before = np.append([t[0] if last is None else last], t[:-1])
            for i in np.flatnonzero(t - before > limit).tolist():
                if not (silent and i == 0):
                    rows.append(("silent", int(before[i]) + limit, int(before[i])))
                rows.append(("resumed", int(t[i]), int(t[i])))
            last = int(t[-1]) if last is None else max(last, int(t[-1]))
            state.update((last, False))
            # the first millisecond after the limit, and never before the watermark
            state.setTimeoutTimestamp(max((last + limit) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame([[*key[:-1], *r] for r in rows], columns=[*keys, "status", "at", "last_seen"])

    out = both.groupBy(*keys, "_clock").applyInPandasWithState(
        watch, out_schema, "last_seen long, silent boolean", "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumns({c: F.timestamp_micros(c) for c in ("at", "last_seen")})


def dedup(stream: DataFrame, keys: Sequence[str] = ("source_id", "device_id", "ts", "tag_name"),
          ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """STR6: drop redelivered messages/readings seen within the watermark delay."""
    return stream.withWatermark(ts, interval_text(delay)).dropDuplicatesWithinWatermark(list(keys))


def rows_read(query) -> int:
    """Rows that a finished run of a query has read, from its own progress reports."""
    return sum(p["numInputRows"] for p in query.recentProgress)


def split_late(batch: DataFrame, watermark, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """STR7 (per micro-batch): rows at or after ``watermark`` are on time, the
    rest late (for a batch rerun of their day).  Use from ``foreachBatch``
    with the query's current watermark."""
    wm = F.lit(watermark).cast("timestamp")
    return batch.where(F.col(ts) >= wm), batch.where(F.col(ts) < wm)


def late_router(on_time_path: str, late_path: str, delay: str, ts: str = "ts",
                partition_by: Sequence[str] = ()):
    """STR7: a ``foreachBatch`` function routing each micro-batch.

    Like Spark's watermark, rows of batch N are judged against the latest
    event time seen in batches before N, minus ``delay``; late rows go to
    ``late_path`` instead of being silently dropped.  The running maximum is
    kept in a one-row progress record per batch (``<on_time_path>_progress``,
    partition ``batch_id``): batch N reads only batch N-1's record, so the
    cost does not grow with the data and a replayed batch gets the same
    threshold.  Both outputs are partitioned by ``batch_id`` first and a batch
    overwrites its own partition, so a replay leaves one copy of its rows.
    """
    d_us = duration_micros(delay)
    progress = on_time_path.rstrip("/") + "_progress"

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = None
        folder = spark._jvm.org.apache.hadoop.fs.Path(progress)
        if batch_id > 0 and folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            prev = (spark.read.parquet(progress).where(F.col("batch_id") == batch_id - 1)
                         .agg(F.max("max_ts")).first()[0])
        wm = (prev - datetime.timedelta(microseconds=d_us)) if prev is not None else datetime.datetime.min
        batch.persist()  # read three times below; released at the end of the batch
        try:
            on_time, late = split_late(batch, wm, ts)
            for part, path, by in ((on_time, on_time_path, partition_by), (late, late_path, ())):
                (part.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", *by).parquet(path))
            cur = batch.agg(F.max(ts).alias("m")).first()["m"]
        finally:
            batch.unpersist()
        top = max([x for x in (prev, cur) if x is not None], default=None)
        (spark.createDataFrame([(batch_id, top)], "batch_id long, max_ts timestamp")
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(progress))

    return route
