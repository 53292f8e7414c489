"""Plan checks: pushdown, pruning, no nested loops, partial aggregation."""

import os

from tagstream.operators import rollup as ro
from tagstream.operators import series as se
from tagstream.plans import checks
from tagstream.plans import lifecycle as lc
from tagstream.sources import fixtures as fx
from tagstream.sources.lake import read_rollup

SF = "/root/testdata/sf0.001"


def test_time_range_reaches_the_parquet_scan(spark):
    q = se.time_range(fx.readings(spark, SF), "2024-01-10 00:00:00", "2024-01-12 00:00:00")
    pushed = " ".join(checks.pushed_filters(q))
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_day_filters_reach_the_parquet_scan(spark):
    from tagstream.functions.timefn import with_date_parts
    day = se.partition_filter(with_date_parts(fx.readings(spark, SF), "ts"), "2024", "01", "07", ts="ts")
    mean = ro.hourly_mean(fx.readings(spark, SF), "click_07", "2024", "01", "15")
    for q in (day, mean):
        pushed = " ".join(checks.pushed_filters(q))
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_notifications_window_over_ticks_not_alerts(spark):
    from tagstream.plans import alert_queries as aq
    plan = checks.physical_plan(aq._notifications(spark, SF))
    # from the points to the notifications: no join, and both group windows lie above sums by (group, tick)
    assert "Join" not in plan and plan.count("Window [") >= 2 and "ExistingRDD" not in plan


def test_projection_prunes_columns(spark):
    q = ro.rollup_1h(fx.readings(spark, SF))
    scan = checks.scans(q)[0]
    assert "event_id" not in scan.split("ReadSchema")[-1]


def test_rollup_table_partition_pruning(spark, tmp):
    h = ro.rollup_1h(fx.readings(spark, SF))
    path = os.path.join(tmp, "h")
    lc.write_rollup(h, path)
    q = se.partition_filter(read_rollup(spark, path), "2024", "01", "07")
    pf = " ".join(checks.partition_filters(q))
    assert "year" in pf and "day" in pf  # plan text abbreviates the literals
    assert q.count() == h.where("day = '07'").count()


def test_sequence_ops_shuffle_readings_once(spark):
    d = se.derivative(fx.good_readings(spark, SF), ["device_id", "tag_name"], tiebreak="event_id")
    plan = checks.physical_plan(d)
    # one exchange on (series, bucket) for the rows; the others carry bucket summaries
    assert plan.count("hashpartitioning(device_id") >= 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_backfill_day_filter_prunes_raw_lake_partitions(spark, tmp):
    import datetime as dt
    from pyspark.sql import functions as F
    from tagstream.sources.lake import read_raw_lake
    path = os.path.join(tmp, "lake")
    rows = [("2024-01-0%dT10:00:00Z" % d, "s", "d", 1, 0, float(d)) for d in (1, 2, 3)]
    (spark.createDataFrame(rows, "timestamp string, source_id string, device_id string, "
                                 "tag_count long, bad_count long, Counter double")
          .withColumn("year", F.lit("2024")).withColumn("month", F.lit("01"))
          .withColumn("day", F.substring("timestamp", 9, 2))
          .write.partitionBy("year", "month", "day").json(path))
    q = lc._day_filter(read_raw_lake(spark, path, ["Counter"]), [dt.date(2024, 1, 2)])
    assert "day" in " ".join(checks.partition_filters(q))
    assert [r.Counter for r in q.collect()] == [2.0]
