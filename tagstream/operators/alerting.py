"""Hot-path alert rules: evaluation, no-data, pending/firing, routing,
grouping, muting, rendering, lag bands (ALR1-7, WIN3, JON4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagstream.operators.joins import null_safe_join
from tagstream.functions.catalog import (DEFAULT_ROUTE, EVAL_INTERVAL, GROUP_BY, LAG_CHECK_ABOVE,
                                         LAG_NORMAL_BELOW, PLANT_ROUTES, AlertRule, Route)
from tagstream.functions.timefn import duration_micros, interval_text, micros
from tagstream.operators.sequence import shift_in_series
from tagstream.operators.series import data_span, eval_grid, reducer, ticks_between, time_range

_OPS = {">": lambda v, x: v > x, "<": lambda v, x: v < x, ">=": lambda v, x: v >= x,
        "<=": lambda v, x: v <= x, "==": lambda v, x: v == x, "!=": lambda v, x: v != x}


def condition_expr(value: F.Column, condition) -> F.Column:
    """OR of ``(op, limit)`` comparisons."""
    out = None
    for op, lim in condition:
        c = _OPS[op](value, F.lit(float(lim)))
        out = c if out is None else (out | c)
    return out


def condition_holds(value: float, condition) -> bool:
    return any(_OPS[op](value, float(lim)) for op, lim in condition)


def eval_rule(points: DataFrame, rule: AlertRule, keys: Sequence[str] = ("field",),
              ts: str = "time", value: str = "value", field_col: str = "field",
              every: str = EVAL_INTERVAL, tiebreak: str | None = None) -> DataFrame:
    """ALR1: per series and evaluation tick, reduce the last ``range`` of points.

    Sliding ``window(ts, range, every)``: the tick is the window end, so a
    tick T sees ``[T - range, T)``.  Output: keys, tick, value, firing
    (1.0 when the condition holds, else 0.0).  Ticks without points are
    absent; ``no_data_state`` and ``with_silence`` fill them.
    """
    p = points
    if rule.measurement and "measurement" in p.columns:
        p = p.where(F.col("measurement") == rule.measurement)
    if rule.field_regex:
        p = p.where(F.col(field_col).rlike(rule.field_regex))
    w = F.window(F.col(ts), interval_text(rule.range_), interval_text(every))
    red = reducer(rule.reducer, value, ts, tiebreak)
    agg = (p.groupBy(*keys, w.alias("w")).agg(red.alias("value"))
            .select(*keys, F.col("w.end").alias("tick"), "value"))
    cond = condition_expr(F.col("value"), rule.condition)
    return agg.withColumn("firing", F.when(cond, 1.0).otherwise(0.0))


def eval_rules(points: DataFrame, rules: Sequence[AlertRule], keys: Sequence[str] = ("field",),
               ts: str = "time", value: str = "value", field_col: str = "field",
               every: str = EVAL_INTERVAL, tiebreak: str | None = None) -> DataFrame:
    """ALR1 for many rules in ONE scan and ONE shuffle.

    Each point is tagged with every rule it matches (measurement, field
    regex), exploded to the evaluation ticks whose window contains it (ends
    in ``(t, t + range]`` on the ``every`` grid, the same windows as
    ``eval_rule``), and one ``groupBy(rule, series, tick)`` computes all
    reducers; each rule keeps its own.  Output adds ``uid``, ``severity``
    and ``for_s`` (hold seconds) to ``eval_rule``'s columns.
    """
    rules = list(rules)
    step = duration_micros(every)

    def matches(r: AlertRule) -> F.Column:
        c = F.lit(True)
        if r.measurement and "measurement" in points.columns:
            c = c & (F.col("measurement") == r.measurement)
        if r.field_regex:
            c = c & F.col(field_col).rlike(r.field_regex)
        return c

    tagged = points.withColumn(
        "_rule", F.explode(F.array_compact(F.array(*[F.when(matches(r), F.lit(i))
                                                     for i, r in enumerate(rules)]))))
    rng = F.element_at(F.array(*[F.lit(duration_micros(r.range_)) for r in rules]),
                       F.col("_rule") + 1)
    t = micros(ts)
    first_end = t - F.pmod(t, F.lit(step)) + F.lit(step)
    ticks = tagged.withColumn("_tick", F.explode(F.sequence(first_end, t + rng, F.lit(step))))
    agg = (ticks.groupBy("_rule", *keys, "_tick")
                .agg(*[reducer(n, value, ts, tiebreak).alias(f"_{n}")
                       for n in sorted({r.reducer for r in rules})]))
    pick = pick_cond = None
    for i, r in enumerate(rules):
        is_r = F.col("_rule") == i
        pick = (F.when(is_r, F.col(f"_{r.reducer}").cast("double")) if pick is None
                else pick.when(is_r, F.col(f"_{r.reducer}").cast("double")))
    agg = agg.withColumn("value", pick)
    for i, r in enumerate(rules):
        is_r = F.col("_rule") == i
        c = condition_expr(F.col("value"), r.condition)
        pick_cond = F.when(is_r, c) if pick_cond is None else pick_cond.when(is_r, c)
    meta = lambda attr: F.element_at(F.array(*[F.lit(attr(r)) for r in rules]),
                                     F.col("_rule") + 1)
    return agg.select(meta(lambda r: r.uid).alias("uid"), meta(lambda r: r.severity).alias("severity"),
                      meta(lambda r: duration_micros(r.for_) // 1_000_000).alias("for_s"),
                      *keys, F.timestamp_micros("_tick").alias("tick"), "value",
                      F.when(pick_cond, 1.0).otherwise(0.0).alias("firing"))


def silent_ticks(evals: DataFrame, keys: Sequence[str], start, stop, every: str = EVAL_INTERVAL,
                 tick: str = "tick", series: DataFrame | None = None) -> DataFrame:
    """JON5 / ALR2: the ticks of ``[start, stop)`` at which a series has no evaluation.

    ``series`` (default: those evaluated) lists the series expected, also ones
    without a single point. Silence is found as gaps between neighbouring
    evaluations, the range's ends counting as evaluations; only the gaps are
    turned into ticks, day by day.
    """
    keys = list(keys)
    step = duration_micros(every)
    lo, hi = (F.unix_micros(F.lit(x).cast("timestamp")) for x in (start, stop))
    first, end = _ceil_to_grid(lo, F.lit(step)), _ceil_to_grid(hi, F.lit(step))
    t = micros(tick)
    inside = evals.where((t >= first) & (t < end)).select(*keys, t.alias("_t"))
    ser = (series if series is not None else evals).select(*keys).distinct()
    ends = ser.select(*keys, F.explode(F.array(first - F.lit(step), end)).alias("_t"))
    marks = inside.unionByName(ends).withColumn("_ts", F.timestamp_micros("_t"))
    marks = shift_in_series(marks, keys, "_ts", ["_t"], "prev", "1 day")
    gaps = (marks.where(F.col("_t") - F.col("prev__t") > F.lit(step))
            .select(*keys, (F.col("prev__t") + F.lit(step)).alias("_lo"), (F.col("_t") - F.lit(step)).alias("_hi")))
    return ticks_between(gaps, keys, "_lo", "_hi", every, tick)


# FIXED VALUE: the alert that stands for a rule without data when its policy is ``NoData``.
NO_DATA_ALERT = "DatasourceNoData"


def _no_data(rule: AlertRule) -> tuple[float | None, float, str, str]:
    """(value, firing, state, alert name) of a tick without points, by the rule's policy.

    ``Alerting`` counts the condition as true, ``NoData`` raises an alert of
    its own, ``OK`` is normal. A ``count`` rule counts 0, which may be its condition.
    """
    if rule.no_data not in ("Alerting", "NoData", "OK"):
        raise ValueError(f"unknown no-data policy {rule.no_data!r}")
    count = rule.reducer == "count"
    fires = count and condition_holds(0.0, rule.condition)
    value = 0.0 if count else None
    if fires or rule.no_data == "Alerting":
        return value, 1.0, "Alerting", rule.uid
    if rule.no_data == "NoData" and not count:
        return value, 1.0, "NoData", NO_DATA_ALERT
    return value, 0.0, "Normal", rule.uid


def with_silence(evals: DataFrame, rules: Sequence[AlertRule], keys: Sequence[str], start=None, stop=None,
                 every: str = EVAL_INTERVAL, series: DataFrame | None = None) -> DataFrame:
    """ALR2 for many rules: ``eval_rules`` output plus a row for each silent tick.

    Adds ``state`` (Alerting, NoData, Normal) and ``alertname``: the rule, or
    ``NO_DATA_ALERT`` where missing data is an alert of its own; ``firing`` is 1
    for both kinds, so the rows feed WIN3, ALR3 and ALR4 as they are. The range
    defaults to the evaluated ticks. ``series`` (key columns) lists series that
    every rule expects, beside those evaluated.
    """
    rules, keys = list(rules), list(keys)
    if start is None or stop is None:
        first, end = data_span(evals, every, "tick")
        start, stop = first if start is None else start, end if stop is None else stop
    t = F.col("tick")
    evals = evals.where((t >= F.lit(start).cast("timestamp")) & (t < F.lit(stop).cast("timestamp")))
    seen = evals.select("uid", *keys).distinct()
    if series is not None:
        uids = F.explode(F.array(*[F.lit(r.uid) for r in rules])).alias("uid")
        seen = seen.unionByName(series.select(uids, *keys)).distinct()
    silent = silent_ticks(evals, ["uid", *keys], start, stop, every, series=seen)

    def pick(of, kind):
        out = F.lit(None).cast(kind)
        for r in rules:
            out = F.when(F.col("uid") == r.uid, F.lit(of(r)).cast(kind)).otherwise(out)
        return out

    silent = silent.select(
        "uid", pick(lambda r: r.severity, "string").alias("severity"),
        pick(lambda r: duration_micros(r.for_) // 1_000_000, "long").alias("for_s"), *keys, "tick",
        *[pick(lambda r, i=i: _no_data(r)[i], kind).alias(n)
          for i, n, kind in ((0, "value", "double"), (1, "firing", "double"), (2, "state", "string"), (3, "alertname", "string"))])
    known = (evals.withColumn("for_s", F.col("for_s").cast("long"))
             .withColumn("state", F.when(F.col("firing") == 1.0, "Alerting").otherwise("Normal")).withColumn("alertname", F.col("uid")))
    return known.unionByName(silent)


def no_data_state(evals: DataFrame, rule: AlertRule, keys: Sequence[str], start, stop,
                  every: str = EVAL_INTERVAL, series: DataFrame | None = None) -> DataFrame:
    """ALR2 (+JON5): every tick of ``[start, stop)`` per series with a state.

    A tick without points takes the rule's no-data policy: ``Alerting``
    (condition counted true), ``NoData`` (own state) or ``OK`` (false); its
    ``firing`` stays NULL.  ``count`` rules get an explicit 0 instead, so
    ``count < 1`` can fire.
    """
    value, _, state, _ = _no_data(rule)
    t = F.col("tick")
    known = (evals.where((t >= F.lit(start).cast("timestamp")) & (t < F.lit(stop).cast("timestamp")))
             .withColumn("state", F.when(F.col("firing") == 1.0, "Alerting").otherwise("Normal")))
    silent = silent_ticks(evals, keys, start, stop, every, series=series)
    firing = None if value is None else 1.0 if condition_holds(value, rule.condition) else 0.0
    silent = silent.select(*keys, "tick", F.lit(value).cast(evals.schema["value"].dataType).alias("value"),
                           F.lit(firing).cast("double").alias("firing"), F.lit(state).alias("state"))
    return known.select(*keys, "tick", "value", "firing", "state").unionByName(silent)


def pending_firing(evals: DataFrame, keys: Sequence[str], for_: str,
                   every: str = EVAL_INTERVAL, tick: str = "tick",
                   active: F.Column | None = None, bucket: str = "1 day",
                   for_col: str | None = None) -> DataFrame:
    """WIN3: Pending → Firing once the condition held for ``for_``; Resolved after.

    Input: one row per (series, tick) where evaluated; ``active`` (default
    ``firing == 1``) marks ticks where the condition holds.  Ticks absent or
    inactive are Normal.  Output: one row per active tick with its state
    (``Pending``/``Firing``), ``active_since``, and one ``Resolved`` row at
    the first inactive tick after a run that reached Firing.

    One scan and two shuffles: the active ticks of a (series, ``bucket``) become
    one row with the bucket's runs, at most ``bucket / every`` ticks; one
    window over these rows, by first and last tick and the start of the last
    run that began inside, tells where a bucket's first run began and what
    follows its last one. Nothing is joined back. The keys form one struct, so
    NULL keys match.
    """
    keys = list(keys)
    step = F.lit(duration_micros(every))
    hold = (F.col(for_col).cast("long") * 1_000_000 if for_col  # per-row hold in seconds, constant within a series
            else F.lit(duration_micros(for_)))
    act = evals.where(active if active is not None else (F.col("firing") == 1.0)).select(
        F.struct(*keys).alias("_k"), micros(tick).alias("_t"), hold.alias("_hold"))
    per = act.groupBy("_k", F.floor(F.col("_t") / F.lit(duration_micros(bucket))).alias("_bk")).agg(
        F.sort_array(F.collect_list("_t")).alias("_ts"), F.max("_hold").alias("_hold"))

    def at(i):
        return F.get("_ts", i)

    n = F.size("_ts")
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (at(i) - at(i - 1) > step))
    per = per.withColumn("_runs", begins).select(
        "_k", "_bk", "_hold", "_ts", "_runs", at(F.lit(0)).alias("_f"), at(n - 1).alias("_l"),
        F.when(F.size("_runs") > 1, at(F.element_at("_runs", -1))).alias("_s"))
    w = Window.partitionBy("_k").orderBy("_bk")
    begun = F.lag("_l").over(w).isNull() | (F.col("_f") - F.lag("_l").over(w) > step)
    per = per.withColumn("_own", F.when(begun, F.col("_f")))
    earlier = F.max(F.coalesce("_s", "_own")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    per = per.withColumns({"_first": F.coalesce("_own", earlier), "_after": F.lead("_f").over(w)})
    run = F.transform("_runs", lambda a, j: F.struct(
        a.alias("a"), F.coalesce(F.get("_runs", j + 1), n).alias("b"), (j == 0).alias("first")))
    r = per.withColumn("_r", F.explode(run)).select(
        "_k", "_hold", F.slice("_ts", F.col("_r.a") + 1, F.col("_r.b") - F.col("_r.a")).alias("_ts"),
        F.when(F.col("_r.first"), F.col("_first")).otherwise(at(F.col("_r.a"))).alias("_since"),
        F.when(F.col("_r.b") == n, F.col("_after")).alias("_after"))
    last = F.element_at("_ts", -1)
    over = (F.col("_after").isNull() | (F.col("_after") - last > step)) & (last - F.col("_since") >= F.col("_hold"))
    states = F.transform("_ts", lambda t: F.struct(t.alias("t"), F.when(
        t - F.col("_since") >= F.col("_hold"), "Firing").otherwise("Pending").alias("state")))
    end = F.array(F.struct((last + step).alias("t"), F.lit("Resolved").alias("state")))
    out = r.select("_k", "_since", F.explode(F.when(over, F.concat(states, end)).otherwise(states)).alias("_o"))
    return out.select(*[F.col(f"_k.{k}").alias(k) for k in keys], F.timestamp_micros("_o.t").alias("tick"),
                      F.col("_o.state").alias("state"), F.timestamp_micros("_since").alias("active_since"))


# ----------------------------------------------------------------- routes
def route(alerts: DataFrame, routes: Sequence[Route] = PLANT_ROUTES,
          default: Route = DEFAULT_ROUTE) -> DataFrame:
    """ALR3: the first route whose label matchers all hold, else the default.

    Matchers compile to one CASE (first match); the policy's attributes are
    picked from literal arrays by the route's number: no join.
    """
    expr = F.lit(0)
    for i, r in reversed(list(enumerate(routes, 1))):
        cond = F.lit(True)
        for label, val in r.matchers:
            cond = cond & (F.col(label) == F.lit(val))
        expr = F.when(cond, F.lit(i)).otherwise(expr)
    out = alerts.withColumn("route_order", expr)
    for name in ("receiver", "group_wait_s", "group_interval_s", "repeat_interval_s"):
        values = F.array(*[F.lit(getattr(r, name)) for r in (default, *routes)])
        out = out.withColumn(name, F.element_at(values, F.col("route_order") + 1))
    return out


def _ceil_to_grid(x: F.Column, step: F.Column) -> F.Column:
    """Smallest multiple of ``step`` that is >= ``x`` (x >= 0, integer µs)."""
    return x + F.pmod(-x, step)


def firing_runs(routed: DataFrame, group_by: Sequence[str] = GROUP_BY, series: Sequence[str] = ("device_id", "field"),
                tick: str = "tick", state: str = "state", every: str = EVAL_INTERVAL,
                keep: Sequence[str] = ()) -> DataFrame:
    """The stretches over which each alert fires: ``_s`` (first Firing tick) to ``_e`` (Resolved tick), µs."""
    fire_t = F.when(F.col(state) == "Firing", micros(tick))
    return (routed.groupBy("route_order", *group_by, *series, "active_since", *keep)
                  .agg(F.min(fire_t).alias("_s"), F.max(fire_t).alias("_lf"),
                       F.max(F.when(F.col(state) == "Resolved", micros(tick))).alias("_r"))
                  .where(F.col("_s").isNotNull())
                  .withColumn("_e", F.coalesce("_r", F.col("_lf") + F.lit(duration_micros(every)))).drop("_lf", "_r"))


def group_notifications(routed: DataFrame, group_by: Sequence[str] = GROUP_BY,
                        series: Sequence[str] = ("device_id", "field"), tick: str = "tick",
                        state: str = "state", every: str = EVAL_INTERVAL) -> DataFrame:
    """ALR4: notifications per alert group (``group_by`` labels within a route).

    Input: routed alert states (WIN3 output + ALR3 columns).  A group session
    lasts while any of its alerts fires, plus ``group_interval`` after the last
    one resolved (firing runs of its series merged as islands).  Flushes lie on the grid ``anchor + group_wait + k*group_interval``;
    every change (an alert starts firing or resolves) is sent at the first grid
    tick at or after it; between two sends of a session the group repeats every
    ``repeat_interval`` rounded up to the grid.  Each notification carries the
    number of firing alerts and of alerts resolved since the previous send.

    What a group sends depends only on how many of its alerts start and end at
    each time, and how long the latest of those starting lasts. So the runs
    are summed by (group, time) first, partially before the shuffle: however
    many series a rule fires for, a group comes to at most one row per tick,
    and the windows over a group run over those. Two such windows find the
    sessions and the counts at each send; nothing is joined or written.
    """
    gk = ["route_order", *group_by]
    pol = ["group_wait_s", "group_interval_s", "repeat_interval_s"]
    runs = firing_runs(routed, group_by, series, tick, state, every, pol).select(*gk, *pol, "_s", "_e")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    starts = F.struct(F.col("_s").alias("_t"), one.alias("_n"), none.alias("_x"), F.col("_e").alias("_until"))
    stops = F.struct(F.col("_e").alias("_t"), none.alias("_n"), one.alias("_x"), F.lit(None).cast("long").alias("_until"))
    per = (runs.select(*gk, *pol, F.inline(F.array(starts, stops))).groupBy(*gk, *pol, "_t")
               .agg(F.sum("_n").alias("_n"), F.sum("_x").alias("_x"), F.max("_until").alias("_until")))
    gw = F.col("group_wait_s").cast("long") * 1_000_000
    gi = F.col("group_interval_s").cast("long") * 1_000_000
    # a session opens when a run starts more than group_interval after every
    # earlier run ended (the group lingers until its resolution flush)
    w = Window.partitionBy(*gk).orderBy("_t")
    before = F.max("_until").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col("_n") > 0) & (before.isNull() | (F.col("_t") > before + gi))
    per = per.withColumn("_open", F.when(opens, F.col("_t")))
    per = per.withColumn("_anchor", F.max("_open").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.col("_anchor") + gw
    change = F.struct("_t", (F.col("_n") - F.col("_x")).alias("_d"), F.col("_x").alias("_rs"), F.lit(0).alias("_m"))
    send = F.struct((first + _ceil_to_grid(F.greatest(F.col("_t") - first, F.lit(0)), gi)).alias("_t"),
                    none.alias("_d"), none.alias("_rs"), F.lit(1).alias("_m"))
    stream = (per.select(*gk, *pol, "_anchor", F.inline(F.array(change, send)))
                 .groupBy(*gk, *pol, "_anchor", "_t", "_m").agg(F.sum("_d").alias("_d"), F.sum("_rs").alias("_rs")))
    upto = Window.partitionBy(*gk).orderBy("_t", "_m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stream = stream.withColumns({"firing": F.sum("_d").over(upto), "_rcum": F.sum("_rs").over(upto)})
    sent = stream.where(F.col("_m") == 1)
    last = F.lag("_anchor").over(w)
    out = sent.select(
        *gk, *pol, F.col("_t").alias("_n"), "firing", (F.col("_rcum") - F.coalesce(F.lag("_rcum").over(w), none)).alias("resolved"),
        F.when(last.isNull() | (last != F.col("_anchor")), "initial").otherwise("update").alias("kind"),
        F.when(F.lead("_anchor").over(w) == F.col("_anchor"), F.lead("_t").over(w)).alias("_next"))
    rep = _ceil_to_grid(F.col("repeat_interval_s").cast("long") * 1_000_000, gi)
    between = F.when(F.col("_next") > F.col("_n") + rep, F.sequence(F.col("_n") + rep, F.col("_next") - 1, rep))
    own = F.array(F.struct("_n", "firing", "resolved", "kind"))
    repeats = F.transform(between, lambda t: F.struct(t.alias("_n"), F.col("firing"), none.alias("resolved"), F.lit("repeat").alias("kind")))
    res = out.select(*gk, *pol, F.inline(F.concat(own, F.coalesce(repeats, F.slice(own, 1, 0)))))
    return res.withColumn("notify_at", F.timestamp_micros("_n")).drop("_n")


def mute(notifications: DataFrame, start: str, end: str, tz: str,
         ts: str = "notify_at") -> DataFrame:
    """ALR5: drop notifications whose local time of day is in ``[start, end)``."""
    local = F.from_utc_timestamp(F.col(ts), tz)
    minute = F.hour(local) * 60 + F.minute(local)
    sh, sm = (int(x) for x in start.split(":"))
    eh, em = (int(x) for x in end.split(":"))
    lo, hi = sh * 60 + sm, eh * 60 + em
    inside = (minute >= lo) & (minute < hi) if lo <= hi else (minute >= lo) | (minute < hi)
    return notifications.where(~inside)


# FIXED VALUES: notification subject and body layout.
SUBJECT_FMT = "[alert] %s"
BODY_FMT = "**Alert:** %s\n**Severity:** %s\n**Time:** %d firing, %d resolved"


def render(notifications: DataFrame, subject: str = SUBJECT_FMT) -> DataFrame:
    """ALR6: subject and body text per notification; ``subject`` formats the alert's name."""
    return notifications.select(
        "*",
        F.format_string(subject, F.col("alertname")).alias("subject"),
        F.format_string(BODY_FMT, F.col("alertname"), F.col("severity"), F.col("firing"),
                        F.col("resolved")).alias("body"))


LINE_FMT = "%s firing since %s"


def alert_lines(notifications: DataFrame, routed: DataFrame, group_by: Sequence[str] = GROUP_BY,
                series: Sequence[str] = ("device_id", "field"), every: str = EVAL_INTERVAL) -> DataFrame:
    """ALR6: one line for each alert that fires when its group's notification goes out.

    Adds ``line`` to the notification's columns. Notifications meet the firing
    runs of their group and day; the output is as long as the lists themselves.
    """
    gk = ["route_order", *group_by]
    day = F.lit(86_400_000_000)
    name = F.concat_ws("/", *[F.col(c) for c in series])
    runs = firing_runs(routed, group_by, series, every=every).select(
        F.struct(*gk).alias("_k"), "_s", "_e", F.explode(F.sequence(F.col("_s") - F.pmod("_s", day), F.col("_e"), day)).alias("_day"),
        F.format_string(LINE_FMT, name, F.date_format("active_since", "yyyy-MM-dd HH:mm:ss")).alias("line"))
    at = micros("notify_at")
    sent = notifications.withColumns({"_k": F.struct(*gk), "_n": at, "_day": at - F.pmod(at, day)})
    hit = sent.join(runs, ["_k", "_day"]).where((F.col("_s") <= F.col("_n")) & (F.col("_n") < F.col("_e")))
    return hit.select(*notifications.columns, "line")


def unknown_tags(readings: DataFrame, tags: DataFrame, ts: str = "ts", tag: str = "tag_name") -> DataFrame:
    """Schema drift: tags that deliver but are not in the dictionary, with rows, first and last time.

    Summed by tag first, so the dictionary meets one row per tag."""
    seen = readings.groupBy(tag).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    return null_safe_join(seen, tags.select(tag).distinct(), [tag], "left_anti")


def classify_lag(offsets: DataFrame, normal_below: int = LAG_NORMAL_BELOW,
                 check_above: int = LAG_CHECK_ABOVE) -> DataFrame:
    """ALR7: consumer lag per (group, partition) with a band and orphan flag."""
    lag = F.col("end_offset") - F.col("committed_offset")
    return (offsets.withColumn("lag", lag)
                   .withColumn("band", F.when(F.col("lag") < normal_below, "normal")
                               .when(F.col("lag") > check_above, "check").otherwise("watch"))
                   .withColumn("orphan", (F.col("lag") > 0) & (F.col("active_members") == 0)))


def missing_tags(readings: DataFrame, tags: DataFrame, start, stop, every: str,
                 ts: str = "ts", tag: str = "tag_name", value: str = "value") -> DataFrame:
    """JON4: dictionary tags with no good value in a window of ``[start, stop)``.

    Grid = dictionary rows × window starts (a generator, not a join), then
    ``left_anti`` against the (tag, window) pairs that did report in the range.
    """
    grid = eval_grid(tags.select(F.col(tag)), start, stop, every, "window_start")
    seen = (time_range(readings, start, stop, ts).where(F.col(value).isNotNull())
                    .select(F.col(tag), F.window(F.col(ts), interval_text(every)).start
                            .alias("window_start")).distinct())
    return null_safe_join(grid, seen, [tag, "window_start"], "left_anti")
