"""Wide ↔ tall reshaping, tag names, line protocol, quality, colours (PRJ1-4, 6, 8, 9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.functions.catalog import STATUS_STEPS, tag_dictionary_df


def unpivot_tags(wide: DataFrame, tags: Sequence[str], ids: Sequence[str],
                 drop_null: bool = True) -> DataFrame:
    """PRJ1: wide → tall ``(ids..., tag_name, value)``; NULL tags dropped.

    An aggregation on top pre-aggregates per task before any shuffle. With
    ``drop_null`` a message makes as many rows as it has values, not one per
    tag of the dictionary; else it plans as an ``Expand``.
    """
    if not drop_null:
        return wide.unpivot(list(ids), list(tags), "tag_name", "value")
    pairs = F.array(*[F.struct(F.lit(t).alias("tag_name"), F.col(f"`{t}`").alias("value")) for t in tags])
    return wide.select(*ids, F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))


def pivot_tags(readings: DataFrame, tags: Sequence[str], ids: Sequence[str],
               tag: str = "tag_name", value: str = "value") -> DataFrame:
    """PRJ2: tall → one row per ids with one column per dictionary tag.

    The explicit value list avoids the extra distinct job and fixes the
    column order.  If a tag repeats, its largest value is kept, whatever the
    row order.

    Wide rows are mostly NULL, so their shuffled bytes say little about the
    memory they take: the readings are dealt by ids to all of the session's
    shuffle partitions, which AQE would merge by those bytes.
    """
    conf = readings.sparkSession.conf
    parts = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                or conf.get("spark.sql.shuffle.partitions"))
    # dealt by a hash column, which no optimiser rule takes out of the keys as it does constant ids
    return (readings.withColumn("_deal", F.xxhash64(*ids)).repartition(parts, "_deal")
                    .groupBy(*ids, "_deal").pivot(tag, list(tags)).agg(F.max(F.col(value))).drop("_deal"))


def tag_dimension(tags: DataFrame, tag: str = "tag_name", dictionary: DataFrame | None = None) -> DataFrame:
    """PRJ3: tag name → group and index (``Temp_Boiler_07`` → ``Temp_Boiler``, 7),
    plus namespace and node id.  Names without a numeric suffix are their own group.
    Namespace and node id come from ``dictionary`` (``tag_dictionary_df``; default: the
    plant's); they are NULL for a tag that it does not list."""
    known = tag_dictionary_df(tags.sparkSession) if dictionary is None else dictionary
    tags = tags.select(F.col(tag)).join(
        known.select(F.col("tag_name").alias(tag), "namespace", "node_id"), tag, "left")
    m = F.regexp_extract(F.col(tag), r"^(.*)_(\d+)$", 1)
    idx = F.regexp_extract(F.col(tag), r"^(.*)_(\d+)$", 2)
    return tags.select(
        F.col(tag),
        F.when(m == "", F.col(tag)).otherwise(m).alias("tag_group"),
        F.when(idx == "", None).otherwise(idx.cast("int")).alias("tag_index"),
        "namespace", "node_id")


def _escape_key(c):
    return F.regexp_replace(c, r"([,= ])", r"\\$1")


def line_protocol(points: DataFrame, measurement: str = "measurement", labels: str = "labels",
                  field: str = "field", value: str = "value", ts: str = "time") -> DataFrame:
    """PRJ4: ``measurement,k=v,... field=value ns`` text per point (labels sorted)."""
    tags = F.array_sort(F.map_entries(F.col(labels)))
    tag_txt = F.concat_ws(",", F.transform(
        tags, lambda e: F.concat(_escape_key(e["key"]), F.lit("="), _escape_key(e["value"]))))
    head = F.when(F.size(tags) > 0, F.concat(_escape_key(F.col(measurement)), F.lit(","), tag_txt))\
            .otherwise(_escape_key(F.col(measurement)))
    ns = (F.unix_micros(F.col(ts).cast("timestamp")) * F.lit(1000)).cast("string")
    line = F.concat(head, F.lit(" "), _escape_key(F.col(field)), F.lit("="),
                    F.col(value).cast("string"), F.lit(" "), ns)
    return points.select(line.alias("line"))


def export_line_protocol(points: DataFrame, path: str, **kw) -> None:
    """PRJ4 sink: write the lines as text files."""
    line_protocol(points, **kw).write.mode("overwrite").text(path)


def cpu_usage(points: DataFrame, idle_field: str = "usage_idle", new_field: str = "usage",
              field: str = "field", value: str = "value") -> DataFrame:
    """PRJ6: ``100 - usage_idle`` renamed to ``usage`` (other points untouched)."""
    is_idle = F.col(field) == idle_field
    return (points.withColumn(value, F.when(is_idle, F.lit(100.0) - F.col(value)).otherwise(F.col(value)))
                  .withColumn(field, F.when(is_idle, F.lit(new_field)).otherwise(F.col(field))))


def message_quality(wide: DataFrame, tags: Sequence[str]) -> DataFrame:
    """PRJ8: ``tag_count`` (dictionary size), ``bad_count`` (NULL tags) and
    ``observed_count`` (tags with a value) per wide message."""
    vals = F.array(*[F.col(f"`{t}`") for t in tags])
    observed = F.size(F.filter(vals, lambda x: x.isNotNull()))
    return (wide.withColumn("tag_count", F.lit(len(tags)).cast("long"))
                .withColumn("observed_count", observed.cast("long"))
                .withColumn("bad_count", (F.lit(len(tags)) - observed).cast("long")))


def quality_points(wide: DataFrame, tags: Sequence[str], ts: str = "ts",
                   keys: Sequence[str] = ("source_id", "device_id"),
                   measurement: str = "opc_data") -> DataFrame:
    """Message counts as points (fields tag_count, bad_count, observed_count)
    for the ingest alert rules."""
    q = message_quality(wide, tags)
    cnt = ["tag_count", "bad_count", "observed_count"]
    tall = q.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in cnt])\
            .unpivot([*keys, ts], cnt, "field", "value")
    return tall.select(F.lit(measurement).alias("measurement"), *keys, "field",
                       F.col(ts).alias("time"), "value")


def status_color(df: DataFrame, steps: tuple[float, float] | str = "cpu",
                 value: str = "value", out: str = "status",
                 measurement: str = "measurement") -> DataFrame:
    """PRJ9: green below the first step, yellow below the second, red above.

    ``steps`` is a pair, a panel name (``"cpu"``, ``"mem"``, ``"disk"``), or
    ``"by_measurement"`` to take each row's steps from its measurement (one
    pass over mixed points; rows of other measurements get NULL).
    """
    if steps == "by_measurement":
        m = F.col(measurement)
        lo = hi = None
        for name, (a, b) in STATUS_STEPS.items():
            lo = F.when(m == name, F.lit(a)) if lo is None else lo.when(m == name, F.lit(a))
            hi = F.when(m == name, F.lit(b)) if hi is None else hi.when(m == name, F.lit(b))
    else:
        a, b = STATUS_STEPS[steps] if isinstance(steps, str) else steps
        lo, hi = F.lit(a), F.lit(b)
    c = F.col(value)
    return df.withColumn(out, F.when(c.isNull() | hi.isNull(), None).when(c >= hi, "red")
                         .when(c >= lo, "yellow").otherwise("green"))
