"""NULL series keys, streams of folder tables, part-hour backfill."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagstream.operators.joins import null_safe_join
from tagstream.operators.rules import cooldown
from tagstream.operators.sequence import running_in_series
from tagstream.plans.stream_queries import events_stream, run_available_now

SF001 = "/root/testdata/sf0.001"


def test_null_safe_join_keeps_null_keys(spark):
    a = spark.createDataFrame([(None, 1, "x"), ("d", 1, "y"), (None, 2, "z")], "k string, t int, v string")
    b = spark.createDataFrame([(None, 1, "p"), ("d", 1, "q")], "k string, t int, w string")
    assert {(r.v, r.w) for r in null_safe_join(a, b, ["k", "t"]).collect()} == {("x", "p"), ("y", "q")}
    assert null_safe_join(a, b, ["k", "t"], "left").columns == ["k", "t", "v", "w"]
    assert [r.v for r in null_safe_join(a, b, ["k", "t"], "left_anti").collect()] == ["z"]


def _rows(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(i, dev, "a", t0 + dt.timedelta(minutes=m)) for dev in ("d1", None)
            for i, m in enumerate((0, 20, 70, 100, 130, 260))]
    return spark.createDataFrame(rows, "event_id long, device_id string, tag_name string, ts timestamp")


def test_cooldown_of_a_null_device_equals_that_of_a_named_one(spark):
    got = cooldown(_rows(spark), 3600, ["device_id", "tag_name"]).groupBy("device_id").agg(
        F.sort_array(F.collect_list("event_id")).alias("ids")).collect()
    assert {r.device_id: r.ids for r in got} == {"d1": [0, 2, 4, 5], None: [0, 2, 4, 5]}


def test_running_sum_of_a_null_series(spark):
    got = running_in_series(_rows(spark).withColumn("one", F.lit(1)), ["device_id"], "ts", "one", "sum", "n")
    assert {r.device_id: r.n for r in got.groupBy("device_id").agg(F.max("n").alias("n")).collect()} == {"d1": 6, None: 6}


def test_stream_reads_a_folder_table_whole(spark, tmp):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp}/events.parquet")
    assert run_available_now(spark, events_stream(spark, tmp), "folder").count() == events.count()
    with pytest.raises(Exception):
        events_stream(spark, f"{tmp}/none")
