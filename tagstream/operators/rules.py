"""Threshold alarms: rule match, violations, alarms, work orders, cooldown.

JON1, JON3, ALM2-6, WIN2, WIN5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagstream.operators.joins import null_safe_join
from tagstream.functions.catalog import PRIORITY, Rule, rules_df
from tagstream.functions.timefn import duration_micros, micros
from tagstream.operators.sequence import shift_in_series
from tagstream.session import checkpoint_dir

RULE_COLS = ["prefix", "max_val", "min_val", "unit", "severity", "description"]


# ------------------------------------------------------------------ JON1
def first_match_order(tag: str, rules: Sequence[Rule]) -> F.Column:
    """1-based order of the first rule whose prefix starts ``tag`` (NULL if none).

    A CASE expression: evaluated inside whole-stage codegen, no join.
    """
    expr = None
    for i, r in enumerate(rules, 1):
        cond = F.col(tag).startswith(F.lit(r.prefix))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def match_rules(readings: DataFrame, rules: Sequence[Rule] | DataFrame,
                tag: str = "tag_name", how: str = "left") -> DataFrame:
    """JON1: attach the first matching rule (lowest ``rule_order``) to each row.

    ``rules`` as a list: compiled to a CASE for the order, then a join with
    the literal rules table, whose size Spark knows.
    ``rules`` as a DataFrame (rule_order, prefix, ...) of any size: every
    prefix of the *distinct* tag names meets the rules in an equi-join, the
    lowest order is kept per tag, and that tag→rule table is joined back
    (AQE broadcasts it when small).
    """
    spark = readings.sparkSession
    if isinstance(rules, DataFrame):
        tags = readings.select(F.col(tag).alias("_tag")).distinct()
        starts = tags.select("_tag", F.explode(F.transform(
            F.sequence(F.lit(0), F.length("_tag")), lambda n: F.substring("_tag", F.lit(1), n))).alias("prefix"))
        cand = starts.join(rules.select("rule_order", "prefix"), "prefix")
        best = cand.groupBy("_tag").agg(F.min("rule_order").alias("rule_order"))
        best = best.join(rules, "rule_order")
        out = readings.join(best, readings[tag] == best["_tag"], how).drop("_tag")
        return out
    table = rules_df(spark, list(rules))
    d = readings.withColumn("rule_order", first_match_order(tag, rules))
    return d.join(table, "rule_order", how)


# ------------------------------------------------------------- ALM2-ALM3
def violations(readings: DataFrame, rules: Sequence[Rule] | DataFrame,
               value: str = "value", tag: str = "tag_name") -> DataFrame:
    """ALM2: readings strictly above max or strictly below min of their rule.

    NULL / NaN readings never violate; tags without a rule never violate.
    """
    good = readings.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    m = match_rules(good, rules, tag, how="inner")
    hit = ((F.col("max_val").isNotNull() & (F.col(value) > F.col("max_val")))
           | (F.col("min_val").isNotNull() & (F.col(value) < F.col("min_val"))))
    return m.where(hit)


def classify(v: DataFrame, value: str = "value") -> DataFrame:
    """ALM3: direction HIGH/LOW, the threshold crossed, and priority 1/2/3."""
    high = F.col("max_val").isNotNull() & (F.col(value) > F.col("max_val"))
    prio = F.create_map(*[x for k, p in PRIORITY.items() for x in (F.lit(k), F.lit(p))])
    return (v.withColumn("direction", F.when(high, "HIGH").otherwise("LOW"))
             .withColumn("threshold", F.when(high, F.col("max_val")).otherwise(F.col("min_val")))
             .withColumn("priority", prio[F.col("severity")]))


def _num(c: str) -> F.Column:
    # threshold printed like a Python float ("95.0")
    return F.col(c).cast("string")


def _pairs(**named: F.Column) -> F.Column:
    """``name=value`` of the named columns, one after the other; NULLs are left out."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}="), c) for k, c in named.items()])


ISO_SEC = "yyyy-MM-dd'T'HH:mm:ss"
ISO_US = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def alarms(v: DataFrame, ts: str = "ts", tag: str = "tag_name", device: str = "device_id",
           value: str = "value") -> DataFrame:
    """ALM4: alarm records. Id is deterministic: device, tag and event time (µs)."""
    c = v if "direction" in v.columns else classify(v, value)
    alarm_id = F.format_string("ALARM-%s-%s-%s", F.col(device), F.col(tag),
                               F.date_format(ts, "yyyyMMddHHmmssSSSSSS"))
    name = F.format_string("[AUTO] %s %s: %.2f %s", F.col(tag), F.col("direction"),
                           F.col(value), F.col("unit"))
    notes = _pairs(tag=F.col(tag), reading=F.format_string("%.4f", F.col(value)), limit=_num("threshold"),
                   side=F.col("direction"), at=F.date_format(ts, ISO_US))
    return c.select(*[x for x in c.columns if x not in ("alarm_id",)],
                    alarm_id.alias("alarm_id"), name.alias("alarm_name"),
                    F.col("description").alias("alarm_description"), notes.alias("alarm_notes"))


def work_orders(a: DataFrame, ts: str = "ts", tag: str = "tag_name",
                value: str = "value") -> DataFrame:
    """ALM5: corrective work order per alarm row, linked by ``alarm_id``."""
    c = a if "alarm_id" in a.columns else alarms(a, ts=ts, tag=tag, value=value)
    short = F.format_string("[AUTO] %s %s: %.2f %s (threshold: %s)", F.col(tag),
                            F.col("direction"), F.col(value), F.col("unit"), _num("threshold"))
    notes = _pairs(alarm=F.col("alarm_id"), priority=F.col("priority"), reading=F.format_string("%.4f", F.col(value)),
                   limit=_num("threshold"), at=F.date_format(ts, ISO_US))
    return c.select(
        F.concat(F.lit("WO-"), F.col("alarm_id")).alias("work_order_id"),
        F.col("alarm_id"), short.alias("short_descr"), notes.alias("process_notes"),
        F.date_format(ts, ISO_SEC).alias("opening_date"), F.col("severity"),
        F.col("priority"), F.lit(True).alias("advance"),
        *[F.col(x) for x in ("event_id", "device_id", tag, ts) if x in c.columns])


def link_alarm_work_order(alarm_df: DataFrame, orders: DataFrame) -> DataFrame:
    """JON3: each work order with its alarm (left join on ``alarm_id``)."""
    a = alarm_df.select("alarm_id", "alarm_name")
    return orders.join(a, "alarm_id", "left")


# ------------------------------------------------------------------ WIN2
def _next_pointers(nodes: DataFrame, w_us: int) -> DataFrame:
    """Of each node (``_k``, ``_n`` = (t, tiebreak), ``_c``, ``_root``) the first one at least ``_c`` later, as ``_nxt``.

    Nodes and targets meet in windows of one (key, time slice); a target whose
    slice holds nothing later takes the first node of the next slice that has
    one, from a window over slice summaries.
    """
    at = F.col("_n.t")
    target = at + F.col("_c")
    node = F.struct("_n.t", "_n.tb", "_root")
    none = F.lit(None).cast("struct<t:bigint,tb:bigint,_root:boolean>")
    data = nodes.select("_k", F.floor(at / w_us).alias("_sb"), at.alias("_at"), F.lit(0).alias("_kind"), node.alias("_node"),
                        F.lit(None).cast("struct<t:bigint,tb:bigint,_root:boolean>").alias("_src"))
    asked = nodes.select("_k", F.floor(target / w_us).alias("_sb"), target.alias("_at"), F.lit(1).alias("_kind"),
                         none.alias("_node"), node.alias("_src"))
    w = (Window.partitionBy("_k", "_sb").orderBy(F.desc("_at"), "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    here = data.unionByName(asked).withColumn("_here", F.min("_node").over(w))
    firsts = here.groupBy("_k", "_sb").agg(F.min("_node").alias("_first"))
    wk = Window.partitionBy("_k").orderBy(F.desc("_sb")).rowsBetween(Window.unboundedPreceding, -1)
    later = firsts.select("_k", "_sb", F.min("_first").over(wk).alias("_later"))
    return (here.where("_kind = 1").join(later, ["_k", "_sb"])
            .select("_k", F.struct("_src.t", "_src.tb").alias("_n"), F.col("_src._root").alias("_root"),
                    F.coalesce("_here", "_later").alias("_nxt")))


def cooldown(v: DataFrame, seconds: float | str, keys: Sequence[str] = ("tag_name",),
             ts: str = "ts", tiebreak: str | None = "event_id",
             bucket: str = "1 hour") -> DataFrame:
    """WIN2: rows that fire when each key is silenced ``seconds`` after it fired.

    A row fires iff at least ``seconds`` passed since the key last *fired*
    (an equal gap fires again).  ``seconds`` is a number or the name of a
    column constant within each key (e.g. a route's repeat interval).

    Exact and parallel: the firings of a key are the orbit of its first
    violation under ``next`` (first violation at least C later).  Rows whose
    gap to the previous violation is >= C always fire ("episode roots"); the
    rest is found by pointer doubling over ``next`` restricted to non-roots.
    A round is one join and one aggregate: it both doubles the pointers and
    marks what the marked rows point to. ``ceil(log2(longest chain))`` rounds,
    each checkpointed to the shared checkpoint folder; only keys and times are
    written, never the rows.  No key, episode or chain is gathered into one
    task: every window is partitioned by (key, ``bucket``-wide time slice), so
    a task holds at most ingest rate × ``bucket`` of one key, whatever C is.
    """
    keys = list(keys)
    spark = v.sparkSession
    checkpoint_dir(spark)
    if isinstance(seconds, str):
        c_col = F.round(F.col(seconds).cast("double") * 1_000_000).cast("long")
    else:
        c_us = duration_micros(seconds)
        if c_us <= 0:
            return v
        c_col = F.lit(c_us).cast("long")
    tb = F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")
    if not tiebreak:
        v = v.dropDuplicates([*keys, ts])
    # one struct per key: it groups and joins with NULL equal to NULL
    key, node = F.struct(*keys), F.struct(micros(ts).alias("t"), tb.alias("tb"))
    base = v.select(key.alias("_k"), node.alias("_n"), c_col.alias("_c"))
    base = base.withColumns({"_ts": F.timestamp_micros("_n.t"), "_tb": F.col("_n.tb")})
    sh = shift_in_series(base, ["_k"], "_ts", ["_n"], "prev", bucket, "_tb")
    sh = sh.where(F.col("prev__n").isNull() | (F.col("prev__n") != F.col("_n")))       # rows of one node count once
    root = F.col("prev__ts").isNull() | (F.col("_n.t") - micros("prev__ts") >= F.col("_c"))
    nodes = sh.select("_k", "_n", "_c", root.alias("_root")).checkpoint()
    follow = F.when(~F.col("_nxt._root"), F.struct("_nxt.t", "_nxt.tb"))
    links = (_next_pointers(nodes, duration_micros(bucket)).select("_k", "_n", follow.alias("_j"), F.col("_root").alias("_r"))
             .where("_j IS NOT NULL").checkpoint())
    while not links.where("_j IS NOT NULL").isEmpty():
        a = links.select("_k", "_n", F.col("_j").alias("_to"), "_r").alias("a")
        b = links.where("_j IS NOT NULL").select("_k", F.col("_n").alias("_to"), "_j")
        on = a.join(b, ["_k", "_to"], "left")
        none = F.lit(None).cast(links.schema["_j"].dataType)
        own = F.struct("_n", "_j", "_r")
        marked = F.struct(F.col("_to").alias("_n"), none.alias("_j"), F.lit(True).alias("_r"))
        both = F.when(F.col("_r") & F.col("_to").isNotNull(), F.array(own, marked)).otherwise(F.array(own))
        links = (on.select("_k", F.inline(both)).groupBy("_k", "_n").agg(F.max("_j").alias("_j"), F.max("_r").alias("_r"))
                 .checkpoint())
    fired = nodes.where("_root").select("_k", "_n").unionByName(links.where("_r").select("_k", "_n"))
    return (v.withColumns({"_k": key, "_n": node}).join(fired, ["_k", "_n"], "left_semi").select(*v.columns))


# ------------------------------------------------------------- WIN5, ALM6
def cap_per_hour(orders: DataFrame, n: int = 50, ts: str = "ts",
                 tiebreak: str | None = "event_id") -> DataFrame:
    """WIN5: at most ``n`` work orders per clock hour, earliest first.

    ``row_number() <= n`` lets Catalyst plan a partial ``WindowGroupLimit``
    before the exchange: each map task ships at most ``n`` rows per hour, so
    even a hot hour reaches its final task as ``n × map tasks`` rows (an
    exact two-stage top-n).
    """
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    w = Window.partitionBy(F.date_trunc("hour", F.col(ts))).orderBy(*order)
    return orders.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


SEVERITY_RANK = {"Critical": 1, "High": 2, "Medium": 3}


def batch_per_device(v: DataFrame, window: str = "15 minutes", ts: str = "ts",
                     device: str = "device_id", tag: str = "tag_name",
                     value: str = "value") -> DataFrame:
    """ALM6: one work order per device and batch window listing its violations."""
    rank = F.create_map(*[x for k, p in SEVERITY_RANK.items() for x in (F.lit(k), F.lit(p))])
    return (v.groupBy(F.col(device), F.window(F.col(ts), window).alias("w"))
             .agg(F.count(F.lit(1)).alias("violations"),
                  F.count_distinct(F.col(tag)).alias("tags"),
                  F.concat_ws(",", F.array_sort(F.collect_set(F.col(tag)))).alias("tag_list"),
                  F.min(rank[F.col("severity")]).alias("top_priority"),
                  F.min(ts).alias("first_ts"), F.max(value).alias("max_value"))
             .select(device, F.col("w.start").alias("batch_start"), F.col("w.end").alias("batch_end"),
                     "violations", "tags", "tag_list", "top_priority", "first_ts", "max_value"))


def asset_work_orders(readings: DataFrame, rules: Sequence[Rule] | DataFrame,
                      cooldown_s: float = 900, window: str = "15 minutes", cap: int = 50,
                      keys: Sequence[str] = ("device_id", "tag_name"),
                      tiebreak: str | None = "event_id") -> DataFrame:
    """The scaled asset path: violations → cooldown per (device, tag) →
    one work order per device and batch window → at most ``cap`` per hour.

    Composition of ALM2, WIN2, ALM6 and WIN5; every step is parallel
    (cooldown by pointer doubling, batching by a partial aggregate, the cap
    by a window-group limit before the shuffle).
    """
    v = classify(violations(readings, rules))
    fired = cooldown(v, cooldown_s, keys=keys, tiebreak=tiebreak)
    batches = batch_per_device(fired, window)
    return cap_per_hour(batches, n=cap, ts="batch_start", tiebreak="device_id")
