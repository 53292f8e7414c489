"""Registered threshold-alarm queries over the events fixture rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagstream.functions.catalog import PRIORITY, rules_df
from tagstream.operators import rules as ru
from tagstream.plans.registry import R, dtxt, r6, register, txt
from tagstream.sources import fixtures as fx

RULES = fx.EVENT_RULES
C_US = fx.EVENT_COOLDOWN_SECONDS * 1_000_000


def _sql_lit(x):
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return repr(float(x))


def _rules_values() -> str:
    rows = ", ".join(
        f"({i}, {_sql_lit(r.prefix)}, CAST({_sql_lit(r.max)} AS DOUBLE), "
        f"CAST({_sql_lit(r.min)} AS DOUBLE), {_sql_lit(r.unit)}, {_sql_lit(r.severity)}, "
        f"{_sql_lit(r.description)})" for i, r in enumerate(RULES, 1))
    return (f"(SELECT * FROM (VALUES {rows}) AS t(rule_order, prefix, max_val, min_val, unit, "
            f"severity, description))")


def _case() -> str:
    whens = " ".join(f"WHEN starts_with(tag_name, {_sql_lit(r.prefix)}) THEN {i}"
                     for i, r in enumerate(RULES, 1))
    return f"CASE {whens} END"


PRIO_SQL = "CASE severity " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY.items()) + " END"

MATCHED = f"""(SELECT r.*, rl.prefix, rl.max_val, rl.min_val, rl.unit, rl.severity, rl.description,
       rl.rule_order
  FROM (SELECT *, {_case()} AS ro FROM ({R}) x) r
  JOIN {_rules_values()} rl ON r.ro = rl.rule_order)"""

VIOL = f"""(SELECT * FROM {MATCHED} m WHERE value IS NOT NULL AND NOT isnan(value) AND
   ((max_val IS NOT NULL AND value > max_val) OR (min_val IS NOT NULL AND value < min_val)))"""

CLASSIFIED = f"""(SELECT v.*,
   CASE WHEN max_val IS NOT NULL AND value > max_val THEN 'HIGH' ELSE 'LOW' END AS direction,
   CASE WHEN max_val IS NOT NULL AND value > max_val THEN max_val ELSE min_val END AS threshold,
   {PRIO_SQL} AS priority FROM {VIOL} v)"""

ALARM_ID_SQL = "printf('ALARM-%s-%s-%s', device_id, tag_name, strftime(ts, '%Y%m%d%H%M%S%f'))"
ISO_US_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _violations(spark, sf_dir):
    return ru.violations(fx.readings(spark, sf_dir), RULES)


@register("jon1_match_rules", f"""
SELECT event_id, tag_name, {_case()} AS rule_order FROM ({R}) r
""")
def jon1_match_rules(spark, sf_dir):
    m = ru.match_rules(fx.readings(spark, sf_dir), RULES)
    return m.select("event_id", "tag_name", "rule_order")


@register("jon1_match_rules_table", f"""
SELECT event_id, tag_name, {_case()} AS rule_order FROM ({R}) r
""")
def jon1_match_rules_table(spark, sf_dir):
    m = ru.match_rules(fx.readings(spark, sf_dir), rules_df(spark, RULES))
    return m.select("event_id", "tag_name", "rule_order")


@register("alm2_violations", f"""
SELECT event_id, device_id, tag_name, {dtxt('ts')} AS ts, round(value, 6) AS value,
       rule_order, severity FROM {VIOL} v
""")
def alm2_violations(spark, sf_dir):
    v = _violations(spark, sf_dir)
    return v.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"),
                    r6("value").alias("value"), "rule_order", "severity")


@register("alm3_classify", f"""
SELECT event_id, tag_name, direction, round(threshold, 6) AS threshold, priority, severity
FROM {CLASSIFIED} c
""")
def alm3_classify(spark, sf_dir):
    c = ru.classify(_violations(spark, sf_dir))
    return c.select("event_id", "tag_name", "direction", r6("threshold").alias("threshold"),
                    "priority", "severity")


@register("alm4_alarms", f"""
SELECT event_id, {ALARM_ID_SQL} AS alarm_id,
       printf('[AUTO] %s %s: %.2f %s', tag_name, direction, value, unit) AS alarm_name,
       description AS alarm_description,
       concat_ws(' | ', 'tag=' || tag_name, 'reading=' || printf('%.4f', value), 'limit=' || CAST(threshold AS VARCHAR),
                 'side=' || direction, 'at=' || {ISO_US_SQL}) AS alarm_notes
FROM {CLASSIFIED} c
""")
def alm4_alarms(spark, sf_dir):
    a = ru.alarms(_violations(spark, sf_dir))
    return a.select("event_id", "alarm_id", "alarm_name", "alarm_description", "alarm_notes")


@register("alm5_work_orders", f"""
SELECT 'WO-' || {ALARM_ID_SQL} AS work_order_id, {ALARM_ID_SQL} AS alarm_id,
       printf('[AUTO] %s %s: %.2f %s (threshold: %s)', tag_name, direction, value, unit,
              CAST(threshold AS VARCHAR)) AS short_descr,
       concat_ws(' | ', 'alarm=' || {ALARM_ID_SQL}, 'priority=' || priority, 'reading=' || printf('%.4f', value),
                 'limit=' || CAST(threshold AS VARCHAR), 'at=' || {ISO_US_SQL}) AS process_notes,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS opening_date, severity, priority, event_id
FROM {CLASSIFIED} c
""")
def alm5_work_orders(spark, sf_dir):
    wo = ru.work_orders(ru.alarms(_violations(spark, sf_dir)))
    return wo.select("work_order_id", "alarm_id", "short_descr", "process_notes", "opening_date",
                     "severity", "priority", "event_id")


@register("jon3_link_alarm_work_order", f"""
SELECT 'WO-' || {ALARM_ID_SQL} AS work_order_id, {ALARM_ID_SQL} AS alarm_id,
       printf('[AUTO] %s %s: %.2f %s', tag_name, direction, value, unit) AS alarm_name
FROM {CLASSIFIED} c
""")
def jon3_link_alarm_work_order(spark, sf_dir):
    a = ru.alarms(_violations(spark, sf_dir))
    wo = ru.work_orders(a)
    return ru.link_alarm_work_order(a, wo).select("work_order_id", "alarm_id", "alarm_name")


def _cooldown_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"v.{x} = f.{x}" for x in keys)
    return f"""
WITH RECURSIVE v AS (SELECT *, epoch_us(ts) AS t FROM {VIOL} x),
f AS (
  SELECT {k}, min(t) AS t, arg_min(event_id, (t, event_id)) AS event_id FROM v GROUP BY {k}
  UNION ALL
  SELECT {", ".join("v." + x for x in keys)}, min(v.t), arg_min(v.event_id, (v.t, v.event_id))
  FROM f JOIN v ON {on} AND v.t >= f.t + {C_US}
  GROUP BY {", ".join("v." + x for x in keys)}
)
SELECT v.event_id, v.device_id, v.tag_name, {dtxt('v.ts')} AS ts, round(v.value, 6) AS value
FROM v JOIN f ON v.event_id = f.event_id
"""


def _cooldown(spark, sf_dir, keys):
    fired = ru.cooldown(_violations(spark, sf_dir), fx.EVENT_COOLDOWN_SECONDS, keys=keys)
    return fired.select("event_id", "device_id", "tag_name", txt("ts").alias("ts"),
                        r6("value").alias("value"))


@register("win2_cooldown", _cooldown_sql(["tag_name"]))
def win2_cooldown(spark, sf_dir):
    return _cooldown(spark, sf_dir, ["tag_name"])


@register("win2_cooldown_device", _cooldown_sql(["device_id", "tag_name"]))
def win2_cooldown_device(spark, sf_dir):
    return _cooldown(spark, sf_dir, ["device_id", "tag_name"])


@register("win5_cap_per_hour", f"""
SELECT event_id, tag_name, {dtxt('ts')} AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts, event_id) AS rn
  FROM {VIOL} v) x WHERE rn <= 2
""")
def win5_cap_per_hour(spark, sf_dir):
    wo = ru.work_orders(ru.alarms(_violations(spark, sf_dir)))
    capped = ru.cap_per_hour(wo, n=2)
    return capped.select("event_id", "tag_name", txt("ts").alias("ts"))


@register("alm6_batch_per_device", f"""
SELECT device_id, {dtxt("time_bucket(INTERVAL 15 MINUTE, ts)")} AS batch_start,
       {dtxt("time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE")} AS batch_end,
       count(*) AS violations, count(DISTINCT tag_name) AS tags,
       array_to_string(list_sort(list(DISTINCT tag_name)), ',') AS tag_list,
       min(CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 END) AS top_priority,
       {dtxt('min(ts)')} AS first_ts, round(max(value), 6) AS max_value
FROM {VIOL} v GROUP BY 1, 2, 3
""")
def alm6_batch_per_device(spark, sf_dir):
    b = ru.batch_per_device(_violations(spark, sf_dir))
    return b.select("device_id", txt("batch_start").alias("batch_start"),
                    txt("batch_end").alias("batch_end"), "violations", "tags", "tag_list",
                    "top_priority", txt("first_ts").alias("first_ts"),
                    r6("max_value").alias("max_value"))


@register("alm6_asset_work_orders", f"""
WITH RECURSIVE v AS (SELECT *, epoch_us(ts) AS t FROM {VIOL} x),
f AS (
  SELECT device_id, tag_name, min(t) AS t, arg_min(event_id, (t, event_id)) AS event_id
  FROM v GROUP BY device_id, tag_name
  UNION ALL
  SELECT v.device_id, v.tag_name, min(v.t), arg_min(v.event_id, (v.t, v.event_id))
  FROM f JOIN v ON v.device_id = f.device_id AND v.tag_name = f.tag_name AND v.t >= f.t + {C_US}
  GROUP BY v.device_id, v.tag_name),
fired AS (SELECT v.* FROM v JOIN f ON v.event_id = f.event_id),
b AS (SELECT device_id, time_bucket(INTERVAL 15 MINUTE, ts) AS batch_start, count(*) AS violations,
             count(DISTINCT tag_name) AS tags,
             array_to_string(list_sort(list(DISTINCT tag_name)), ',') AS tag_list,
             min(CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 END)
               AS top_priority
      FROM fired GROUP BY 1, 2),
c AS (SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', batch_start)
                                   ORDER BY batch_start, device_id) AS rn FROM b)
SELECT device_id, {dtxt('batch_start')} AS batch_start, violations, tags, tag_list, top_priority
FROM c WHERE rn <= 50
""")
def alm6_asset_work_orders(spark, sf_dir):
    wo = ru.asset_work_orders(fx.readings(spark, sf_dir), RULES,
                              cooldown_s=fx.EVENT_COOLDOWN_SECONDS)
    return wo.select("device_id", txt("batch_start").alias("batch_start"), "violations", "tags",
                     "tag_list", "top_priority")


@register("alm1_rules_df", f"""
WITH t AS (SELECT tag_name, count(*) AS n FROM ({R}) r GROUP BY 1)
SELECT rl.rule_order, rl.prefix, rl.max_val, rl.min_val, rl.severity, count(t.tag_name) AS tags, coalesce(sum(t.n), 0)::BIGINT AS readings
FROM {_rules_values()} rl LEFT JOIN t ON starts_with(t.tag_name, rl.prefix) GROUP BY ALL
""")
def alm1_rules_df(spark, sf_dir):
    """ALM1: the rule list with the tags and readings that each rule applies to."""
    tags = fx.readings(spark, sf_dir).groupBy("tag_name").agg(F.count("*").alias("n"))
    matched = ru.match_rules(tags, RULES, "tag_name", how="inner").groupBy("prefix").agg(
        F.count("*").alias("tags"), F.sum("n").alias("readings"))
    r = rules_df(spark, RULES).join(matched, "prefix", "left")
    return r.select("rule_order", "prefix", "max_val", "min_val", "severity", F.coalesce("tags", F.lit(0)).alias("tags"),
                    F.coalesce("readings", F.lit(0)).alias("readings"))
