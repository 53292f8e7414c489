"""Registered alert-rule queries over the events fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagstream.functions.catalog import (DEFAULT_ROUTE, MUTE_WINDOWS, PLANT_ROUTES, AlertRule,
                                         tag_dictionary_df)
from tagstream.operators import alerting as al
from tagstream.operators import reshape as rs
from tagstream.operators.series import data_span
from tagstream.plans.decode_queries import TAGS, wide_messages
from tagstream.plans.registry import R, dtxt, r6, register, txt
from tagstream.sources import fixtures as fx

KEYS = ("device_id", "field")


def span_sql(every: str) -> str:
    """The data's time range on the ``every`` (minute or day) grid: columns lo, hi."""
    return f"""(SELECT date_trunc('{every}', min(ts)) AS lo, date_trunc('{every}', max(ts)) + INTERVAL 1 {every} AS hi
  FROM ({R}) r)"""


def _span(spark, sf_dir, every: str):
    return data_span(fx.readings(spark, sf_dir), every)


# Fixture stand-ins for the plant rules (same shapes, fixture thresholds).
BOILER = AlertRule("click_high", "^click_", "max", "2 minutes", ((">", 150.0),), "1 minute",
                   "critical")
HYDRAULIC = AlertRule("view_out_of_range", "^view_", "last", "2 minutes",
                      ((">", 120.0), ("<", 1.0)), "1 minute", "critical")
VIBRATION = AlertRule("purchase_high", "^purchase_", "max", "5 minutes", ((">", 200.0),),
                      "2 minutes", "warning")
SIGNUP = AlertRule("signup_high", "^signup_", "max", "2 minutes", ((">", 180.0),), "1 minute",
                   "info")
INGEST = AlertRule("ingest_stopped", None, "count", "2 minutes", (("<", 1.0),), "1 minute",
                   "critical", no_data="Alerting", measurement=fx.MEASUREMENT)
BAD = AlertRule("bad_value_high", "^bad_count$", "mean", "5 minutes", ((">", 0.5),), "5 minutes",
                "warning", no_data="OK")


def _evals(spark, sf_dir, rule):
    return al.eval_rule(fx.points(spark, sf_dir), rule, KEYS, tiebreak="event_id")


def _eval_sql(rule: AlertRule, agg: str, cond: str) -> str:
    k = int(rule.range_.split()[0])
    return f"""(SELECT device_id, tag_name AS field,
         date_trunc('minute', ts) + to_minutes(CAST(g.i AS BIGINT)) AS tick,
         {agg} AS value
  FROM ({R}) r, range(1, {k + 1}) AS g(i)
  WHERE value IS NOT NULL AND regexp_matches(tag_name, '{rule.field_regex}')
  GROUP BY 1, 2, 3)"""


def _eval_out_sql(rule, agg, cond):
    return f"""
SELECT device_id, field, {dtxt('tick')} AS tick, round(value, 6) AS value,
       CASE WHEN {cond} THEN 1.0 ELSE 0.0 END AS firing
FROM {_eval_sql(rule, agg, cond)} e
"""


def _eval_out(df):
    return df.select("device_id", "field", txt("tick").alias("tick"), r6("value").alias("value"),
                     "firing")


@register("alr1_boiler_max", _eval_out_sql(BOILER, "max(value)", "value > 150.0"))
def alr1_boiler_max(spark, sf_dir):
    return _eval_out(_evals(spark, sf_dir, BOILER))


@register("alr1_hydraulic_last", _eval_out_sql(
    HYDRAULIC, "arg_max(value, (ts, event_id))", "value > 120.0 OR value < 1.0"))
def alr1_hydraulic_last(spark, sf_dir):
    return _eval_out(_evals(spark, sf_dir, HYDRAULIC))


@register("alr1_vibration_max", _eval_out_sql(VIBRATION, "max(value)", "value > 200.0"))
def alr1_vibration_max(spark, sf_dir):
    return _eval_out(_evals(spark, sf_dir, VIBRATION))


_GRID = f"(SELECT unnest(range(lo, hi, INTERVAL 1 MINUTE)) AS tick FROM {span_sql('minute')} b) AS g"


@register("alr1_ingest_stopped", f"""
WITH c AS (SELECT date_trunc('minute', ts) + to_minutes(CAST(g.i AS BIGINT)) AS tick, count(*) AS n
           FROM ({R}) r, range(1, 3) AS g(i) GROUP BY 1)
SELECT 'opc_data' AS measurement, {dtxt('g.tick')} AS tick, coalesce(c.n, 0) AS value,
       CASE WHEN coalesce(c.n, 0) < 1 THEN 1.0 ELSE 0.0 END AS firing,
       CASE WHEN coalesce(c.n, 0) < 1 THEN 'Alerting' ELSE 'Normal' END AS state
FROM {_GRID} LEFT JOIN c ON c.tick = g.tick
""")
def alr1_ingest_stopped(spark, sf_dir):
    msgs = fx.readings(spark, sf_dir).select(
        F.lit(fx.MEASUREMENT).alias("measurement"), F.col("ts").alias("time"), "value")
    ev = al.eval_rule(msgs, INGEST, keys=("measurement",), value="time")
    series = spark.range(1).select(F.lit(fx.MEASUREMENT).alias("measurement"))
    st = al.no_data_state(ev, INGEST, ["measurement"], *_span(spark, sf_dir, "1 minute"), series=series)
    return st.select("measurement", txt("tick").alias("tick"), F.col("value").cast("long").alias("value"),
                     "firing", "state")


@register("alr2_no_data_state", f"""
WITH e AS (SELECT date_trunc('minute', ts) + to_minutes(CAST(g.i AS BIGINT)) AS tick,
                  avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS v
           FROM ({R}) r, range(1, 6) AS g(i) GROUP BY 1)
SELECT 'events' AS source_id, {dtxt('g.tick')} AS tick, round(e.v, 6) AS value,
       CASE WHEN e.v > 0.5 THEN 1.0 WHEN e.v IS NOT NULL THEN 0.0 END AS firing,
       CASE WHEN e.v > 0.5 THEN 'Alerting' ELSE 'Normal' END AS state
FROM {_GRID} LEFT JOIN e ON e.tick = g.tick
""")
def alr2_no_data_state(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    bad = r.select("source_id", F.lit("bad_count").alias("field"), F.col("ts").alias("time"),
                   F.when(F.col("value").isNull(), 1.0).otherwise(0.0).alias("value"))
    ev = al.eval_rule(bad, BAD, keys=("source_id",))
    series = spark.range(1).select(F.lit(fx.SOURCE_ID).alias("source_id"))
    st = al.no_data_state(ev, BAD, ["source_id"], *_span(spark, sf_dir, "1 minute"), series=series)
    return st.select("source_id", txt("tick").alias("tick"), r6("value").alias("value"),
                     "firing", "state")


def _runs_sql(active: str, keys: str) -> str:
    """WIN3 over ``active``: the active ticks with their keys and ``hold`` minutes."""
    step = "INTERVAL 1 MINUTE"
    return f"""(
WITH e AS (SELECT * FROM {active} x),
l AS (SELECT *, lag(tick) OVER w AS pt, lead(tick) OVER w AS nt FROM e
      WINDOW w AS (PARTITION BY {keys} ORDER BY tick)),
s AS (SELECT *, max(CASE WHEN pt IS NULL OR tick - pt > {step} THEN tick END)
                 OVER (PARTITION BY {keys} ORDER BY tick
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM l),
st AS (SELECT *, CASE WHEN tick - since >= to_minutes(hold) THEN 'Firing' ELSE 'Pending' END
                 AS state FROM s)
SELECT {keys}, tick, state, since AS active_since FROM st
UNION ALL
SELECT {keys}, tick + {step}, 'Resolved', since FROM st
WHERE (nt IS NULL OR nt - tick > {step}) AND state = 'Firing')"""


def _states_sql(rule: AlertRule, agg: str, cond: str) -> str:
    hold = int(rule.for_.split()[0])
    return _runs_sql(f"(SELECT *, {hold} AS hold FROM {_eval_sql(rule, agg, cond)} y WHERE {cond})", "device_id, field")


def _states(spark, sf_dir, rule):
    return al.pending_firing(_evals(spark, sf_dir, rule), KEYS, rule.for_)


@register("win3_pending_firing", f"""
SELECT device_id, field, {dtxt('tick')} AS tick, state, {dtxt('active_since')} AS active_since
FROM {_states_sql(VIBRATION, "max(value)", "value > 200.0")} s
""")
def win3_pending_firing(spark, sf_dir):
    s = _states(spark, sf_dir, VIBRATION)
    return s.select("device_id", "field", txt("tick").alias("tick"), "state",
                    txt("active_since").alias("active_since"))


_ALERT_RULES = [(BOILER, "max(value)", "value > 150.0"),
                (VIBRATION, "max(value)", "value > 200.0"),
                (SIGNUP, "max(value)", "value > 180.0")]


def _alerts(spark, sf_dir):
    """All alert rules in one scan: eval_rules + one pending/firing pipeline."""
    rules = [r for r, _a, _c in _ALERT_RULES]
    ev = al.eval_rules(fx.points(spark, sf_dir), rules, KEYS, tiebreak="event_id")
    st = al.pending_firing(ev, ["uid", "severity", *KEYS], "0 minutes", for_col="for_s")
    return st.withColumnRenamed("uid", "alertname")


def _alerts_sql() -> str:
    parts = [f"SELECT '{r.uid}' AS alertname, '{r.severity}' AS severity, s.* "
             f"FROM {_states_sql(r, a, c)} s" for r, a, c in _ALERT_RULES]
    return "(" + " UNION ALL ".join(parts) + ")"


def _route_sql(alerts: str | None = None) -> str:
    case = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'{lbl} = {chr(39)}{v}{chr(39)}' for lbl, v in r.matchers)} THEN {i}"
        for i, r in enumerate(PLANT_ROUTES, 1)) + " ELSE 0 END"
    rows = [(0, DEFAULT_ROUTE)] + list(enumerate(PLANT_ROUTES, 1))
    vals = ", ".join(f"({i}, '{r.receiver}', {r.group_wait_s}, {r.group_interval_s}, "
                     f"{r.repeat_interval_s})" for i, r in rows)
    return f"""(SELECT a.*, p.receiver, p.group_wait_s, p.group_interval_s, p.repeat_interval_s
  FROM (SELECT *, {case} AS route_order FROM {alerts or _alerts_sql()} x) a
  JOIN (VALUES {vals}) AS p(route_order, receiver, group_wait_s, group_interval_s,
                            repeat_interval_s) ON a.route_order = p.route_order)"""


@register("alr3_route", f"""
SELECT alertname, severity, device_id, field, {dtxt('tick')} AS tick, state, route_order,
       receiver, group_wait_s, repeat_interval_s
FROM {_route_sql()} r
""")
def alr3_route(spark, sf_dir):
    r = al.route(_alerts(spark, sf_dir))
    return r.select("alertname", "severity", "device_id", "field", txt("tick").alias("tick"),
                    "state", "route_order", "receiver", "group_wait_s", "repeat_interval_s")


def _notif_sql(alerts: str | None = None, series: str = "device_id, field") -> str:
    g = "route_order, alertname, severity"
    return f"""(
WITH r AS {_route_sql(alerts)},
runs AS (
  SELECT {g}, {series}, active_since,
         any_value(group_wait_s) AS gw, any_value(group_interval_s) AS gi,
         any_value(repeat_interval_s) AS rep,
         min(epoch_us(tick)) FILTER (WHERE state = 'Firing') AS s,
         coalesce(max(epoch_us(tick)) FILTER (WHERE state = 'Resolved'),
                  max(epoch_us(tick)) FILTER (WHERE state = 'Firing') + 60000000) AS e
  FROM r GROUP BY {g}, {series}, active_since
  HAVING min(epoch_us(tick)) FILTER (WHERE state = 'Firing') IS NOT NULL),
c AS (SELECT *, max(e) OVER (PARTITION BY {g} ORDER BY s, {series}
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
      FROM runs),
i AS (SELECT *, max(CASE WHEN prev_max IS NULL OR s > prev_max + gi * 1000000 THEN s END)
                  OVER (PARTITION BY {g} ORDER BY s, {series} ROWS UNBOUNDED PRECEDING)
                  AS anchor FROM c),
ch AS (SELECT {g}, gw, gi, rep, anchor, s AS t, 1 AS d, 0 AS rs FROM i
       UNION ALL SELECT {g}, gw, gi, rep, anchor, e, -1, 1 FROM i),
snd AS (SELECT DISTINCT {g}, gw, gi, rep, anchor,
               anchor + gw * 1000000 + greatest(t - anchor - gw * 1000000, 0)
               + (((-greatest(t - anchor - gw * 1000000, 0)) % (gi * 1000000)) + gi * 1000000)
                 % (gi * 1000000) AS n
        FROM ch),
cnt AS (SELECT snd.*, (SELECT sum(d) FROM ch WHERE ch.route_order = snd.route_order
                        AND ch.alertname = snd.alertname AND ch.severity = snd.severity
                        AND ch.t <= snd.n) AS firing,
               (SELECT sum(rs) FROM ch WHERE ch.route_order = snd.route_order
                        AND ch.alertname = snd.alertname AND ch.severity = snd.severity
                        AND ch.t <= snd.n) AS rcum
        FROM snd),
o AS (SELECT *, rcum - coalesce(lag(rcum) OVER w, 0) AS resolved,
             CASE WHEN lag(anchor) OVER w IS NULL OR lag(anchor) OVER w <> anchor
                  THEN 'initial' ELSE 'update' END AS kind,
             CASE WHEN lead(anchor) OVER w = anchor THEN lead(n) OVER w END AS nxt
      FROM cnt WINDOW w AS (PARTITION BY {g} ORDER BY n)),
rp AS (SELECT o.*, gi * 1000000 * CAST(ceil(rep / gi) AS BIGINT) AS step FROM o)
SELECT {g}, CAST(firing AS BIGINT) AS firing, CAST(resolved AS BIGINT) AS resolved, kind,
       make_timestamp(n) AS notify_at FROM o
UNION ALL
SELECT {g}, CAST(firing AS BIGINT), 0, 'repeat', make_timestamp(x)
FROM rp, unnest(generate_series(n + step, nxt - 1, step)) AS u(x)
WHERE nxt IS NOT NULL AND n + step < nxt)"""


def _notifications(spark, sf_dir):
    return al.group_notifications(al.route(_alerts(spark, sf_dir)))


_NOTIF_COLS = ("route_order", "alertname", "severity", "firing", "resolved")


@register("alr4_group_notifications", f"""
SELECT route_order, alertname, severity, firing, resolved, kind,
       {dtxt('notify_at')} AS notify_at FROM {_notif_sql()} n
""")
def alr4_group_notifications(spark, sf_dir):
    n = _notifications(spark, sf_dir)
    return n.select(*_NOTIF_COLS, "kind", txt("notify_at").alias("notify_at"))


_MUTE_NAME, _MUTE_START, _MUTE_END, _MUTE_TZ = MUTE_WINDOWS[0]
# Asia/Bangkok has no daylight saving: local = UTC + 7 h in the DuckDB twin.
_MUTED_SQL = f"""(SELECT * FROM {_notif_sql()} n
  WHERE NOT (CAST(strftime(notify_at + INTERVAL 7 HOUR, '%H') AS INT) * 60
             + CAST(strftime(notify_at + INTERVAL 7 HOUR, '%M') AS INT) >= 110
         AND CAST(strftime(notify_at + INTERVAL 7 HOUR, '%H') AS INT) * 60
             + CAST(strftime(notify_at + INTERVAL 7 HOUR, '%M') AS INT) < 150))"""


@register("alr5_mute", f"""
SELECT route_order, alertname, severity, firing, resolved, {dtxt('notify_at')} AS notify_at
FROM {_MUTED_SQL} m
""")
def alr5_mute(spark, sf_dir):
    m = al.mute(_notifications(spark, sf_dir), _MUTE_START, _MUTE_END, _MUTE_TZ)
    return m.select(*_NOTIF_COLS, txt("notify_at").alias("notify_at"))


@register("alr6_render", f"""
SELECT alertname, severity, {dtxt('notify_at')} AS notify_at,
       printf('{al.SUBJECT_FMT}', alertname) AS subject,
       printf('{al.BODY_FMT}', alertname, severity, firing, resolved) AS body
FROM {_MUTED_SQL} m
""")
def alr6_render(spark, sf_dir):
    m = al.mute(_notifications(spark, sf_dir), _MUTE_START, _MUTE_END, _MUTE_TZ)
    return al.render(m).select("alertname", "severity", txt("notify_at").alias("notify_at"),
                               "subject", "body")


# ------------------------------------------------- silence, from rule to notification
# The three ingest rules on the message counts, one series per source.
STOPPED = AlertRule("ingest_stopped", "^tag_count$", "count", "2 minutes", (("<", 1.0),), "1 minute",
                    "critical", no_data="Alerting")
TAGS_LOW = AlertRule("tag_count_low", "^observed_count$", "last", "5 minutes", (("<", 1.0),), "3 minutes",
                     "warning", no_data="NoData")
BAD_HIGH = AlertRule("bad_value_high", "^bad_count$", "mean", "5 minutes", ((">", 99.5),), "5 minutes",
                     "warning", no_data="OK")
SOURCE_KEYS = ("source_id", "field")
_INGEST_RULES = [(STOPPED, "tag_count", "count(*)::DOUBLE", "value < 1.0"),
                 (TAGS_LOW, "observed_count", "arg_max(observed_count, (ts, device_id))", "value < 1.0"),
                 (BAD_HIGH, "bad_count", "avg(bad_count)", "value > 99.5")]
_QUALITY_SQL = f"""(SELECT source_id, device_id, ts, {len(TAGS)}.0 AS tag_count,
  count(DISTINCT tag_name) FILTER (WHERE value IS NOT NULL)::DOUBLE AS observed_count,
  {len(TAGS)} - count(DISTINCT tag_name) FILTER (WHERE value IS NOT NULL)::DOUBLE AS bad_count
  FROM ({R}) r GROUP BY ALL)"""


def ingest_evals(spark, sf_dir, rules):
    """The rules over the message counts, with a row for every tick, silent or not."""
    points = rs.quality_points(wide_messages(spark, sf_dir, good_only=False), TAGS)
    ev = al.eval_rules(points, rules, SOURCE_KEYS, tiebreak="device_id")
    return al.with_silence(ev, rules, SOURCE_KEYS, *_span(spark, sf_dir, "1 minute"))


def _ingest_sql(rule: AlertRule, field: str, agg: str, cond: str) -> str:
    """Every tick of one ingest rule; a silent one takes the rule's policy (count: 0)."""
    k = int(rule.range_.split()[0])
    silent = ({"Alerting": ("1.0", "Alerting", rule.uid), "NoData": ("1.0", "NoData", al.NO_DATA_ALERT),
               "OK": ("0.0", "Normal", rule.uid)})[rule.no_data]
    return f"""(
WITH e AS (SELECT source_id, date_trunc('minute', ts) + to_minutes(CAST(g.i AS BIGINT)) AS tick, {agg} AS value
           FROM {_QUALITY_SQL} q, range(1, {k + 1}) AS g(i) GROUP BY 1, 2),
s AS (SELECT DISTINCT source_id FROM e)
SELECT '{rule.uid}' AS uid, '{rule.severity}' AS severity, {int(rule.for_.split()[0])} AS hold, s.source_id,
       '{field}' AS field, g.tick, {'coalesce(e.value, 0.0)' if rule.reducer == 'count' else 'e.value'} AS value,
       CASE WHEN e.tick IS NULL THEN {silent[0]} WHEN {cond} THEN 1.0 ELSE 0.0 END AS firing,
       CASE WHEN e.tick IS NULL THEN '{silent[1]}' WHEN {cond} THEN 'Alerting' ELSE 'Normal' END AS state,
       CASE WHEN e.tick IS NULL THEN '{silent[2]}' ELSE '{rule.uid}' END AS alertname
FROM s CROSS JOIN {_GRID} LEFT JOIN e ON e.source_id = s.source_id AND e.tick = g.tick)"""


def _ingest_out_sql(rule, field, agg, cond):
    return f"""SELECT source_id, {dtxt('tick')} AS tick, round(value, 6) AS value, firing, state, alertname
FROM {_ingest_sql(rule, field, agg, cond)} e"""


def _ingest_out(df):
    return df.select("source_id", txt("tick").alias("tick"), r6("value").alias("value"), "firing", "state", "alertname")


@register("alr1_tag_count_low", _ingest_out_sql(*_INGEST_RULES[1]))
def alr1_tag_count_low(spark, sf_dir):
    return _ingest_out(ingest_evals(spark, sf_dir, [TAGS_LOW]))


@register("alr1_bad_value_high", _ingest_out_sql(*_INGEST_RULES[2]))
def alr1_bad_value_high(spark, sf_dir):
    return _ingest_out(ingest_evals(spark, sf_dir, [BAD_HIGH]))


_INGEST_KEYS = "alertname, severity, uid, source_id, field"
_INGEST_ALERTS_SQL = _runs_sql(
    f"""(SELECT {_INGEST_KEYS}, tick, hold FROM ({' UNION ALL '.join(f'FROM {_ingest_sql(*r)}' for r in _INGEST_RULES)}) y
  WHERE firing = 1.0)""", _INGEST_KEYS)


@register("alr4_ingest_stopped_notifications", f"""
SELECT route_order, alertname, severity, firing, resolved, kind, {dtxt('notify_at')} AS notify_at
FROM {_notif_sql(_INGEST_ALERTS_SQL, "uid, source_id, field")} n
""")
def alr4_ingest_stopped_notifications(spark, sf_dir):
    """Silence to notification: counts, no-data policies, pending/firing, routes, groups."""
    ev = ingest_evals(spark, sf_dir, [r for r, *_ in _INGEST_RULES])
    st = al.pending_firing(ev, _INGEST_KEYS.split(", "), "0 minutes", for_col="for_s")
    n = al.group_notifications(al.route(st), series=("uid", "source_id", "field"))
    return n.select(*_NOTIF_COLS, "kind", txt("notify_at").alias("notify_at"))


@register("alr6_alert_lines", f"""
WITH runs AS (
  SELECT route_order, alertname, severity, device_id, field, active_since,
         min(tick) FILTER (WHERE state = 'Firing') AS s,
         coalesce(max(tick) FILTER (WHERE state = 'Resolved'),
                  max(tick) FILTER (WHERE state = 'Firing') + INTERVAL 1 MINUTE) AS e
  FROM {_route_sql()} r GROUP BY ALL HAVING count(*) FILTER (WHERE state = 'Firing') > 0)
SELECT n.alertname, n.severity, n.kind, {dtxt('n.notify_at')} AS notify_at,
       printf('{al.LINE_FMT}', device_id || '/' || field, {dtxt('active_since')}) AS line
FROM {_notif_sql()} n JOIN runs USING (route_order, alertname, severity)
WHERE s <= n.notify_at AND n.notify_at < e
""")
def alr6_alert_lines(spark, sf_dir):
    routed = al.route(_alerts(spark, sf_dir))
    lines = al.alert_lines(al.group_notifications(routed), routed)
    return lines.select("alertname", "severity", "kind", txt("notify_at").alias("notify_at"), "line")


# The dictionary of an older plant: the last two tags of each type are new to it.
_OLD_TAGS = [t for t in TAGS if t[-2:] not in ("18", "19")]


@register("jon4_unknown_tags", f"""
SELECT tag_name, count(*) AS rows, {dtxt('min(ts)')} AS first_seen, {dtxt('max(ts)')} AS last_seen
FROM ({R}) r WHERE NOT list_contains({_OLD_TAGS}, tag_name) GROUP BY 1
""")
def jon4_unknown_tags(spark, sf_dir):
    drift = al.unknown_tags(fx.readings(spark, sf_dir), tag_dictionary_df(spark, _OLD_TAGS))
    return drift.select("tag_name", "rows", txt("first_seen").alias("first_seen"), txt("last_seen").alias("last_seen"))


@register("jon4_missing_tags", f"""
WITH d AS (SELECT unnest(['{"', '".join(fx.event_tags())}']) AS tag_name),
grid AS (SELECT tag_name, w AS window_start FROM d,
         (SELECT unnest(range(lo, hi, INTERVAL 1 DAY)) AS w FROM {span_sql('day')} b) AS g),
seen AS (SELECT DISTINCT tag_name, date_trunc('day', ts) AS window_start FROM ({R}) r
         WHERE value IS NOT NULL)
SELECT grid.tag_name, {dtxt('grid.window_start')} AS window_start FROM grid
WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.tag_name = grid.tag_name
                  AND seen.window_start = grid.window_start)
""")
def jon4_missing_tags(spark, sf_dir):
    tags = tag_dictionary_df(spark, fx.event_tags())
    m = al.missing_tags(fx.readings(spark, sf_dir), tags, *_span(spark, sf_dir, "1 day"), "1 day")
    return m.select("tag_name", txt("window_start").alias("window_start"))


_MULTI = [(BOILER, "max(value)", "value > 150.0"),
          (HYDRAULIC, "arg_max(value, (ts, event_id))", "value > 120.0 OR value < 1.0"),
          (VIBRATION, "max(value)", "value > 200.0")]


@register("alr1_eval_rules", " UNION ALL ".join(
    f"""SELECT '{r.uid}' AS uid, device_id, field, {dtxt('tick')} AS tick, round(value, 6) AS value,
       CASE WHEN {c} THEN 1.0 ELSE 0.0 END AS firing FROM {_eval_sql(r, a, c)} e{i}"""
    for i, (r, a, c) in enumerate(_MULTI)))
def alr1_eval_rules(spark, sf_dir):
    ev = al.eval_rules(fx.points(spark, sf_dir), [r for r, _a, _c in _MULTI], KEYS,
                       tiebreak="event_id")
    return ev.select("uid", "device_id", "field", txt("tick").alias("tick"),
                     r6("value").alias("value"), "firing")
