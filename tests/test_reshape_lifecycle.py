"""Reshape round trips and storage lifecycle (SNK*, SRC5-6, JON6)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tagstream.functions.catalog import plant_tags, tag_dictionary_df
from tagstream.operators import reshape as rs
from tagstream.plans import lifecycle as lc
from tagstream.sources.lake import read_points, read_raw_lake

TAGS = ["Temp_Boiler_01", "Press_Line_01", "Counter"]


def test_dictionary_has_307_tags(spark):
    tags = plant_tags()
    assert len(tags) == 307 and len(set(tags)) == 307
    dim = rs.tag_dimension(tag_dictionary_df(spark)).where("tag_name = 'Temp_Boiler_07'").collect()[0]
    assert (dim.tag_group, dim.tag_index, dim.node_id) == ("Temp_Boiler", 7, "ns=3;i=2007")


def test_pivot_unpivot_identity(spark):
    t = dt.datetime(2026, 5, 7)
    tall = spark.createDataFrame([("d", t, "Temp_Boiler_01", 1.0), ("d", t, "Press_Line_01", 2.0),
                                  ("d", t + dt.timedelta(seconds=2), "Counter", 3.0)],
                                 "device_id string, ts timestamp, tag_name string, value double")
    wide = rs.pivot_tags(tall, TAGS, ["device_id", "ts"])
    back = rs.unpivot_tags(wide, TAGS, ["device_id", "ts"])
    assert sorted(map(tuple, back.select(*tall.columns).collect())) == sorted(map(tuple, tall.collect()))
    q = rs.message_quality(wide, TAGS).orderBy("ts").collect()
    assert [(r.tag_count, r.observed_count, r.bad_count) for r in q] == [(3, 2, 1), (3, 1, 2)]


def test_line_protocol_and_cpu(spark):
    p = spark.createDataFrame([("cpu", {"host": "n1", "cpu": "cpu-total"}, "usage_idle", dt.datetime(2026, 5, 7), 93.5)],
                              "measurement string, labels map<string,string>, field string, time timestamp, value double")
    line = rs.line_protocol(rs.cpu_usage(p)).collect()[0].line
    assert line == "cpu,cpu=cpu-total,host=n1 usage=6.5 1778112000000000000"
    s = rs.status_color(spark.createDataFrame([(69.9,), (70.0,), (95.0,)], "value double"), "cpu")
    assert [r.status for r in s.collect()] == ["green", "yellow", "red"]


def _write_lake(root):
    day = os.path.join(root, "year=2026", "month=05", "day=07")
    os.makedirs(day)
    msgs = []
    for i in range(6):
        msgs.append({"timestamp": f"2026-05-07T0{i // 3}:1{i}:00Z", "source_id": "s", "device_id": "d",
                     "tag_count": 3, "bad_count": 0, "Temp_Boiler_01": float(i), "Press_Line_01": 2.0,
                     "Counter": None})
    with open(os.path.join(day, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(m) for m in msgs[:4]) + "\n")
    with open(os.path.join(day, "b.json"), "w") as f:  # single-line JSON array
        f.write(json.dumps(msgs[4:]))


def test_raw_lake_backfill_rerun_is_idempotent(spark, tmp):
    raw = os.path.join(tmp, "raw")
    _write_lake(raw)
    df = read_raw_lake(spark, raw, TAGS)
    assert df.count() == 6 and df.where("day = '07'").count() == 6
    h1, d1 = os.path.join(tmp, "h"), os.path.join(tmp, "d")
    start, stop = dt.datetime(2026, 5, 7), dt.datetime(2026, 5, 8)
    for _ in range(2):
        lc.backfill(spark, raw, h1, d1, TAGS, start, stop)
    h = spark.read.parquet(h1)
    assert h.count() == 4  # 2 hours x 2 tags, one copy after two runs
    d = spark.read.parquet(d1).where("tag_name = 'Temp_Boiler_01'").collect()[0]
    assert d.samples == 6 and d.max_val == 5.0
    s, e = lc.run_slot(spark, raw, h1, d1, TAGS, dt.datetime(2026, 5, 7, 1, 5), "1h")
    assert (s.hour, e.hour) == (0, 1) and spark.read.parquet(h1).count() == 4


def test_compact_expire_partition_diff(spark, tmp):
    raw = os.path.join(tmp, "raw")
    _write_lake(raw)
    out = os.path.join(tmp, "c")
    lc.compact(read_raw_lake(spark, raw, TAGS), out, TAGS)
    c = spark.read.parquet(out)
    assert c.count() == 12 and set(c.columns) >= {"tag_name", "value", "hr"}
    lc.compact(read_raw_lake(spark, raw, TAGS), os.path.join(tmp, "m"), TAGS, layout="map")
    m = spark.read.parquet(os.path.join(tmp, "m")).collect()[0]
    assert set(m.tags) == {"Temp_Boiler_01", "Press_Line_01"}
    plan = lc.expire(spark, raw, keep_days=30, as_of=dt.date(2026, 7, 1))
    assert plan.count() == 1 and os.path.isdir(os.path.join(raw, "year=2026"))
    storage = lc.list_partitions(spark, raw)
    catalog = spark.createDataFrame([("2026", "05", "06")], "year string, month string, day string")
    diff = {(r.day, r.action) for r in lc.partition_diff(storage, catalog, "FULL").collect()}
    assert diff == {("07", "ADD"), ("06", "DROP")}
    lc.expire(spark, raw, keep_days=30, as_of=dt.date(2026, 7, 1), dry_run=False)
    assert lc.list_partitions(spark, raw).count() == 0


def test_export_and_publish_format(spark, tmp):
    t = dt.datetime(2026, 5, 7)
    df = spark.createDataFrame([("A", t, 1.0), ("B", t, 2.0)], "tag_name string, ts timestamp, value double")
    for fmt in ("csv", "json", "parquet"):
        lc.export(df, fmt, os.path.join(tmp, fmt), tags=["A"], start=t, stop=t + dt.timedelta(hours=1))
    assert spark.read.parquet(os.path.join(tmp, "parquet")).count() == 1
    body = lc.to_publish_format(df.where("tag_name = 'A'")).collect()[0].value
    assert json.loads(body)["value"] == 1.0


def test_read_points_filters(spark):
    t = dt.datetime(2026, 5, 7)
    p = spark.createDataFrame([
        ("disk", {"path": "/", "fstype": "ext4"}, "used_percent", t, 50.0),
        ("disk", {"path": "/run", "fstype": "tmpfs"}, "used_percent", t, 1.0),
        ("diskio", {"name": "sda"}, "reads", t, 1.0), ("diskio", {"name": "loop0"}, "reads", t, 1.0),
        ("cpu", {"cpu": "cpu-total"}, "usage_idle", t, 90.0)],
        "measurement string, labels map<string,string>, field string, time timestamp, value double")
    assert read_points(p, mounts=["/"], devices=["sda"]).count() == 3


def test_stream_to_raw_lake_and_ingest_report(spark, tmp):
    from tagstream.operators.rollup import ingest_report
    from tagstream.sources.decode import CORRUPT, decode_flat
    from tagstream.sources.lake import stream_source
    src = os.path.join(tmp, "msgs")
    os.makedirs(src)
    lines = [json.dumps({"timestamp": f"2026-05-0{6 + i % 2}T23:59:5{i}Z", "source_id": "s",
                         "device_id": "d", "tag_count": 3, "bad_count": 1,
                         "Temp_Boiler_01": float(i), "Press_Line_01": None, "Counter": 1})
             for i in range(6)]
    with open(os.path.join(src, "batch1.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    stream = stream_source(spark, {"format": "text", "path": src})
    wide = decode_flat(stream, TAGS).drop("timestamp", CORRUPT)
    wide = wide.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    lake = os.path.join(tmp, "lake")
    q = lc.write_raw_lake(wide, lake, os.path.join(tmp, "ck"), trigger="availableNow")
    q.awaitTermination()
    assert sorted(r.day for r in lc.list_partitions(spark, lake).collect()) == ["06", "07"]
    raw = read_raw_lake(spark, lake, TAGS)
    assert raw.count() == 6 and raw.where("day = '07'").count() == 3
    tall = rs.unpivot_tags(raw.select("*", "_metadata.file_path", "_metadata.file_size"), TAGS,
                           ["source_id", "device_id", "ts", "file_path", "file_size"], drop_null=False)
    rep = ingest_report(tall.withColumnRenamed("source_id", "src"), source="src",
                        bytes_col="file_size", file_col="file_path").orderBy("day_ts").collect()
    # three messages a day with three tags each, two of them good
    assert [(r.messages, r.tag_values) for r in rep] == [(3, 6), (3, 6)]
    for r in rep:
        day = os.path.join(lake, "year=2026", "month=05", f"day={r.day_ts:%d}")
        sizes = [os.path.getsize(os.path.join(day, f)) for f in os.listdir(day) if f.endswith(".json")]
        assert (r.files, r.bytes, r.bytes_per_file) == (len(sizes), sum(sizes), sum(sizes) / len(sizes))


def test_rollup_reader_keeps_string_partitions_under_type_inference(spark, tmp):
    from tagstream.operators.rollup import rollup_1h
    from tagstream.sources.lake import read_rollup
    rd = spark.createDataFrame([("Temp_Boiler_01", dt.datetime(2026, 5, 7, 9, 30), 1.0)],
                               "tag_name string, ts timestamp, value double")
    path = os.path.join(tmp, "h")
    lc.write_rollup(rollup_1h(rd).withColumn("hr", F.date_format("hour", "HH")), path,
                    lc.HOURLY_PARTS)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        r = read_rollup(spark, path, "1h", extra_parts=["hr"]).collect()[0]
    finally:
        spark.conf.set(key, old)
    assert (r.year, r.month, r.day, r.hr) == ("2026", "05", "07", "09")


def test_partition_sync_brings_the_catalog_in_line(spark, tmp):
    from tagstream.operators.rollup import rollup_1h
    from tagstream.sources.lake import ROLLUP_SCHEMA
    rows = [("A", dt.datetime(2026, 5, d, 9, 30), float(d)) for d in range(1, 8)]
    path, table = os.path.join(tmp, "h"), "sync_" + os.path.basename(tmp).replace("-", "_")
    hourly = rollup_1h(spark.createDataFrame(rows, "tag_name string, ts timestamp, value double"))
    lc.write_rollup(hourly.where("day <= '05'"), path)
    lc.register_lake(spark, table, path, ROLLUP_SCHEMA["1h"])

    def listed():
        return sorted(r.day for r in lc.catalog_partitions(spark, table).collect())
    assert listed() == [] and spark.table(table).count() == 0
    assert {r.action for r in lc.sync_partitions(spark, table, path, "ADD").collect()} == {"ADD"}
    assert listed() == ["01", "02", "03", "04", "05"] and spark.table(table).count() == 5
    lc.write_rollup(hourly.where("day > '05'"), path)
    lc.expire(spark, path, 3, dt.date(2026, 5, 7), dry_run=False)
    assert lc.sync_partitions(spark, table, path, "ADD").count() == 2 and len(listed()) == 7
    done = [(r.action, r.day) for r in lc.sync_partitions(spark, table, path, batch=2).collect()]
    assert done == [("DROP", "01"), ("DROP", "02"), ("DROP", "03")]
    assert listed() == ["04", "05", "06", "07"] and spark.table(table).count() == 4
    assert lc.sync_partitions(spark, table, path).count() == 0        # once more: nothing left to do
    spark.sql(f"DROP TABLE {table}")


def test_daily_means_do_not_depend_on_the_order_of_rows(spark):
    from tagstream.operators.rollup import rollup_1d, rollup_1h
    t = dt.datetime(2026, 5, 7)
    rows = [("A", t + dt.timedelta(minutes=37 * i), v) for i, v in enumerate([0.1, 0.2, 0.3, 1e9, -1e9, 0.7, 2.5] * 5)]
    rows += [("huge", t, 1e25), ("huge", t, 1.0)]
    for avg in ("weighted", "mean_of_means"):
        got = set()
        for seed in range(3):
            df = spark.createDataFrame(rows, "tag_name string, ts timestamp, value double").orderBy(F.rand(seed)).repartition(3 + seed)
            got.add(tuple(sorted((r.tag_name, r.avg_val) for r in rollup_1d(rollup_1h(df, exact=True), avg=avg).collect())))
        assert len(got) == 1
        means = dict(next(iter(got)))
        assert means["huge"] == 5e24                              # does not fit: the double mean
        if avg == "weighted":
            assert means["A"] == round(sum(x for _, _, x in rows[:35] if abs(x) < 1e8) / 35, 9)


def test_unpivot_makes_rows_for_values_only(spark):
    wide = spark.createDataFrame([("d", 1.0, None, 3.0), ("e", None, float("nan"), None), ("e", None, None, None), (None, 2.0, None, None)],
                                 "device_id string, Temp_Boiler_01 double, Press_Line_01 double, Counter double")
    tall = rs.unpivot_tags(wide, TAGS, ["device_id"])
    assert "Expand" not in tall._jdf.queryExecution().executedPlan().toString()
    old = rs.unpivot_tags(wide, TAGS, ["device_id"], drop_null=False).where("value IS NOT NULL")
    assert tall.columns == old.columns and sorted(map(str, tall.collect())) == sorted(map(str, old.collect()))


def test_pivot_keeps_the_session_partitions(spark):
    tall = spark.range(200).select(F.lit("s").alias("source_id"), F.col("id").alias("device_id"),
                                   F.lit("Counter").alias("tag_name"), F.col("id").cast("double").alias("value"))
    wide = rs.pivot_tags(tall, TAGS, ["source_id", "device_id"])
    assert wide.columns == ["source_id", "device_id", *TAGS]
    assert wide.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert wide.agg(F.sum("Counter")).first()[0] == sum(range(200))
