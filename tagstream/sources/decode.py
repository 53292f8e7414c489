"""Message decoding: five envelopes → one tall readings table (SRC1-4, JON2).

All parsing is ``from_json`` into typed structs or ``VARIANT`` values, so it
runs in the JVM; nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.functions.timefn import parse_event_time

HEADER_FIELDS = ["timestamp", "source_id", "device_id", "tag_count", "bad_count"]
CORRUPT = "_corrupt_record"


def wide_schema(tags: Sequence[str], corrupt: bool = True) -> T.StructType:
    """V1 flat message: 5 header fields + one double per dictionary tag."""
    fields = [T.StructField("timestamp", T.StringType()), T.StructField("source_id", T.StringType()),
              T.StructField("device_id", T.StringType()), T.StructField("tag_count", T.LongType()),
              T.StructField("bad_count", T.LongType())]
    fields += [T.StructField(t, T.DoubleType()) for t in tags]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def _nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def decode_flat(raw: DataFrame, tags: Sequence[str], col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """SRC1: V1 JSON text/bytes → typed wide row (+ ``ts`` and corrupt text).

    Non-numbers in a tag (bool, string, "NaN") become NULL for that tag only;
    the other tags are kept (PERMISSIVE).  Unknown tags are dropped by the
    fixed schema; use ``decode_any`` to see them.
    """
    schema = wide_schema(tags)
    parsed = raw.select(*keep, F.from_json(F.col(col).cast("string"), schema,
                                           {"mode": "PERMISSIVE",
                                            "columnNameOfCorruptRecord": CORRUPT}).alias("m"))
    cols = [F.col("m.timestamp").alias("timestamp"), F.col("m.source_id").alias("source_id"),
            F.col("m.device_id").alias("device_id"), F.col("m.tag_count").alias("tag_count"),
            F.col("m.bad_count").alias("bad_count")]
    cols += [_nan_to_null(F.col("m").getField(t)).alias(t) for t in tags]
    return parsed.select(*keep, *cols, parse_event_time(F.col("m.timestamp")).alias("ts"),
                         F.col("m").getField(CORRUPT).alias(CORRUPT))


def _num(v: Column) -> Column:
    """A JSON *number* as double (NaN → NULL); strings, booleans, objects → NULL."""
    kind = F.schema_of_variant(v)
    d = F.try_variant_get(v, "$", "double")
    return F.when(kind.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)") & ~F.isnan(d), d)


def _str(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _envelope(mm: Column) -> Column:
    """V1..V5 of a parsed message (NULL if it did not parse)."""
    tags_kind = F.schema_of_variant(mm["tags"])
    return (F.when(mm["Messages"].isNotNull(), "V4")
              .when(tags_kind.startswith("ARRAY"), "V3")
              .when(tags_kind.startswith("OBJECT"), "V2")
              .when(F.schema_of_variant(mm["readings"]).startswith("OBJECT"), "V5")
              .when(mm.isNotNull(), "V1"))


def _items(mm: Column, env: Column) -> Column:
    """The readings of a parsed message: array of (tag_name, value, ts_raw)."""
    ts_top = _str(mm["timestamp"])
    item = "struct<tag_name:string,value:double,ts_raw:string>"

    def mk(name: Column, value: Column, ts_raw: Column) -> Column:
        return F.struct(name.alias("tag_name"), value.alias("value"), ts_raw.alias("ts_raw"))

    v1 = F.transform(F.filter(F.map_entries(mm), lambda e: ~e["key"].isin(HEADER_FIELDS)),
                     lambda e: mk(e["key"], _num(e["value"]), ts_top))
    v2_map = F.try_variant_get(mm["tags"], "$", "map<string,variant>")
    v2 = F.transform(F.map_entries(v2_map), lambda e: mk(e["key"], _num(e["value"]), ts_top))
    v3_arr = F.try_variant_get(mm["tags"], "$", "array<struct<name:string,value:variant,ts:variant>>")
    v3 = F.transform(v3_arr, lambda e: mk(e["name"], _num(e["value"]), _str(e["ts"])))
    v4_arr = F.try_variant_get(
        mm["Messages"], "$",
        "array<struct<Payload:map<string,struct<Value:variant,SourceTimestamp:string>>>>")
    v4 = F.flatten(F.transform(v4_arr, lambda msg: F.transform(
        F.map_entries(msg["Payload"]),
        lambda e: mk(e["key"], _num(e["value"]["Value"]), e["value"]["SourceTimestamp"]))))
    v5_map = F.try_variant_get(mm["readings"], "$", "map<string,struct<value:variant,unit:string,name:string>>")
    v5 = F.transform(F.map_entries(v5_map), lambda e: mk(e["key"], _num(e["value"]["value"]), ts_top))
    return (F.when(env == "V1", v1).when(env == "V2", v2).when(env == "V3", v3)
              .when(env == "V4", v4).when(env == "V5", v5).cast(f"array<{item}>"))


def decode_any(raw: DataFrame, col: str = "value", source_col: str | None = "source_id",
               device_col: str | None = "device_id") -> DataFrame:
    """SRC2: any of V1-V5 → readings ``(source_id, device_id, tag_name, ts, value, envelope)``.

    V1 flat, V2 nested ``tags{}`` with epoch-second time, V3 REST array
    ``tags:[{name,value,ts}]`` (epoch ms), V4 publish/subscribe
    ``Messages[].Payload{tag:{Value,SourceTimestamp}}`` (every message and
    each tag's own time), V5 ``readings{name:{value,unit,name}}``.
    ``source_col``/``device_col`` name columns of ``raw`` supplying ids the
    message lacks (e.g. the topic key).  One row per tag and time; NULL value
    for bad tags.  Rows that do not parse are absent (see ``quarantine``).
    """
    m = F.from_json(F.col(col).cast("string"), "map<string,variant>")
    mm = F.col("_m")
    # parse once and classify once; the branches below only read these columns
    d = raw.select("*", m.alias("_m")).select("*", _envelope(mm).alias("_env"))
    none = F.lit(None).cast("string")
    src = F.coalesce(_str(mm["source_id"]), _str(mm["PublisherId"]),
                     F.col(source_col) if source_col in raw.columns else none)
    dev = F.coalesce(_str(mm["device_id"]),
                     F.col(device_col) if device_col in raw.columns else none)
    out = d.select(src.alias("source_id"), dev.alias("device_id"), F.col("_env").alias("envelope"),
                   F.explode(_items(mm, F.col("_env"))).alias("r"))
    return out.select("source_id", "device_id", F.col("r.tag_name").alias("tag_name"),
                      parse_event_time(F.col("r.ts_raw")).alias("ts"),
                      F.col("r.value").alias("value"), "envelope")


def quarantine(raw: DataFrame, col: str = "value") -> DataFrame:
    """SRC4: every input row with ``quarantine_reason`` (NULL = good).

    Reasons: ``unparseable`` (not a JSON object), ``no_timestamp`` (no
    parsable time), ``no_tags`` (its envelope yields no reading, the same
    items that ``decode_any`` explodes).  A bad tag alone does not quarantine
    its message.  Split with ``split_quarantine``.
    """
    m = F.from_json(F.col(col).cast("string"), "map<string,variant>")
    mm = F.col("_m")
    d = raw.withColumn("_m", m).withColumn("_env", _envelope(mm))
    has_time = (parse_event_time(_str(mm["timestamp"])).isNotNull()
                | mm["Messages"].isNotNull()
                | F.coalesce(F.schema_of_variant(mm["tags"]).startswith("ARRAY"), F.lit(False)))
    n_items = F.coalesce(F.size(_items(mm, F.col("_env"))), F.lit(0))
    reason = (F.when(mm.isNull(), "unparseable")
               .when(~has_time, "no_timestamp")
               .when(n_items <= 0, "no_tags"))
    return d.withColumn("quarantine_reason", reason).drop("_m", "_env")


def split_quarantine(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")
    bad = tagged.where(F.col("quarantine_reason").isNotNull())
    return good, bad


def explode_pairs(df: DataFrame, names: str, values: str, keep: Sequence[str] = ()) -> DataFrame:
    """JON2: parallel arrays (names, values) → one row per pair (lateral unnest)."""
    z = F.explode(F.arrays_zip(F.col(names).alias("n"), F.col(values).alias("v")))
    return df.select(*keep, z.alias("_p")).select(*keep, F.col("_p.n").alias("tag_name"),
                                                  F.col("_p.v").alias("value"))
