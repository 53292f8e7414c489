"""Files in no event-time order: streams lose no row, however the files are cut and wherever a run stops."""

import pytest
from pyspark.sql import functions as F

from tagstream.plans import stream_queries as st
from tagstream.sources import fixtures as fx
from tagstream.sources.admission import Admission
from tagstream.streaming import queries as sq
from tagstream.operators import rules as ru
from tests.conftest import SF001

KEYS = ("source_id", "device_id", "ts", "tag_name")
BUILD = {
    "rollup": lambda r: sq.stream_rollup_1h(r, delay="10 minutes"),
    "evals": st._boiler_evals,
    "cooldown": lambda r: sq.stream_cooldown(ru.violations(r, fx.EVENT_RULES), fx.EVENT_COOLDOWN_SECONDS, cols=("device_id", "value")),
    "dedup": lambda r: sq.dedup(r, keys=KEYS).select("device_id", "tag_name", "ts"),
}


def rows(spark, out):
    path, schema = out
    return sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The events as one file, and shuffled into seven files with every third row delivered twice."""
    base = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{SF001}/events.parquet").where("event_id % 4 = 0")
    events.coalesce(1).write.parquet(f"{base}/one")
    twice = events.union(events.where("event_id % 3 = 0"))
    twice.repartition(7, F.rand(1)).write.parquet(f"{base}/many")
    events.repartition(5, F.rand(2)).write.parquet(f"{base}/five")
    return base, events


def source(tables, name, **more):
    base, events = tables
    return {"path": f"{base}/{name}", "schema": events.schema, **more}


def slices(tables, n):
    """A slice size that cuts ``five`` into about n slices."""
    base, _ = tables
    import os
    size = sum(os.path.getsize(f"{base}/five/{f}") for f in os.listdir(f"{base}/five") if f.endswith(".parquet"))
    return size // n


@pytest.mark.parametrize("name", list(BUILD))
def test_same_rows_for_one_file_and_shuffled_files(spark, tables, tmp, name):
    def build(s):
        return BUILD[name](fx.readings_of(s))
    one = rows(spark, st.stream_to_table(spark, source(tables, "one"), build, name, f"{tmp}/one"))
    cut = rows(spark, st.stream_to_table(spark, source(tables, "five", slice_bytes=slices(tables, 3)), build, name, f"{tmp}/cut"))
    assert one and cut == one
    if name == "dedup":                                     # real duplicates, in other files
        many = rows(spark, st.stream_to_table(spark, source(tables, "many", slice_bytes=slices(tables, 3)), build, name, f"{tmp}/many"))
        assert many == one and spark.read.parquet(f"{tables[0]}/many").count() > len(one)


@pytest.mark.parametrize("pieces", [1, 4])
def test_watchdog_follows_the_clock(spark, tmp, pieces):
    import datetime as dt
    import os
    t0, m = dt.datetime(2024, 1, 1), dt.timedelta(minutes=1)
    seen = {"a": [0, 3, 4, 30, 31], "b": [2, 16, 50], None: [5]}
    rows = [(s, t0 + x * m, False) for s, xs in seen.items() for x in xs] + [(None, t0 + x * m, True) for x in range(0, 91, 5)]
    df = spark.createDataFrame(rows, "source_id string, ts timestamp, clock boolean")
    df.repartition(5, F.rand(3)).write.parquet(f"{tmp}/in")
    size = sum(os.path.getsize(f"{tmp}/in/{f}") for f in os.listdir(f"{tmp}/in") if f.endswith(".parquet"))
    spec = {"path": f"{tmp}/in", "schema": df.schema, "slice_bytes": -(-size // pieces)}
    out = st.stream_to_table(spark, spec, lambda s: sq.clocked_watchdog(
        s.where("NOT clock"), s.where("clock"), "14 minutes"), "dog", f"{tmp}/run")
    got = {(r.source_id, r.status, (r.at - t0) // m, (r.last_seen - t0) // m)
           for r in spark.read.schema(out[1]).parquet(out[0]).collect()}
    want = {("a", "silent", 18, 4), ("a", "resumed", 30, 30), ("a", "silent", 45, 31), ("b", "silent", 30, 16),
            ("b", "resumed", 50, 50), ("b", "silent", 64, 50), (None, "silent", 19, 5)}
    assert got == want


class Stop(Exception):
    pass


@pytest.mark.parametrize("where", ["deal", "publish", "query"])
def test_a_stopped_run_goes_on(spark, tables, tmp, where, monkeypatch):
    def build(s):
        return BUILD["rollup"](fx.readings_of(s))
    spec = source(tables, "five", slice_bytes=slices(tables, 3))
    whole = rows(spark, st.stream_to_table(spark, spec, build, "whole", f"{tmp}/whole"))
    calls = {"n": 0}

    def stop_in(owner, attr, at):
        real = getattr(owner, attr)

        def stopping(self, *a):
            calls["n"] += 1
            if calls["n"] == at:
                if attr == "_deal":
                    real(self, *a)
                    self._fs.delete(self._path(f"{self.root}/sets/{a[0]}/_ready"), False)
                raise Stop
            return real(self, *a)
        monkeypatch.setattr(owner, attr, stopping)

    stop_in(Admission, {"deal": "_deal", "publish": "publish", "query": "stream"}[where], 1 if where == "deal" else 2)
    with pytest.raises(Stop):
        st.stream_to_table(spark, spec, build, "cut", f"{tmp}/cut")
    monkeypatch.undo()
    assert rows(spark, st.stream_to_table(spark, spec, build, "cut", f"{tmp}/cut")) == whole
    # nothing new: nothing more
    assert rows(spark, st.stream_to_table(spark, spec, build, "cut", f"{tmp}/cut")) == whole


def test_a_later_set_follows_the_first(spark, tables, tmp):
    _, events = tables
    half = events.selectExpr("percentile(unix_micros(CAST(ts AS TIMESTAMP)), 0.5) AS m").first()[0]
    late = F.unix_micros(F.col("ts").cast("timestamp")) >= half
    build = lambda s: BUILD["dedup"](fx.readings_of(s))
    spec = {"path": f"{tmp}/in", "schema": events.schema}
    events.where(~late).write.parquet(f"{tmp}/in")
    st.stream_to_table(spark, spec, build, "sets", f"{tmp}/run")
    events.where(late).write.mode("append").parquet(f"{tmp}/in")
    got = rows(spark, st.stream_to_table(spark, spec, build, "sets", f"{tmp}/run"))
    assert got == rows(spark, st.stream_to_table(spark, source(tables, "one"), build, "one", f"{tmp}/one"))
    assert len(Admission(spark, f"{tmp}/in", f"{tmp}/run/admission", events.schema).published()) == 2


def test_missing_and_empty_input(spark, tables, tmp):
    _, events = tables
    with pytest.raises(FileNotFoundError):
        Admission(spark, f"{tmp}/none", f"{tmp}/a", events.schema)
    events.limit(0).write.parquet(f"{tmp}/empty")
    assert rows(spark, st.stream_to_table(spark, {"path": f"{tmp}/empty", "schema": events.schema},
                                          lambda s: BUILD["dedup"](fx.readings_of(s)), "empty", f"{tmp}/run")) == []


def test_stream_source_reads_admitted_files(spark, tables, tmp):
    from tagstream.sources.lake import stream_source
    spec = {"format": "parquet", **source(tables, "five"), "root": f"{tmp}/root"}
    admission = Admission(spark, spec["path"], spec["root"], spec["schema"])
    number = admission.stage()
    assert admission.stage() == number and len(admission.pending(number)) == 1
    admission.publish(number, 0)
    got = st.run_available_now(spark, stream_source(spark, spec), "admitted")
    assert got.count() == tables[1].count() and admission.stage() is None


def test_small_grains_of_a_slice_go_to_several_tasks(spark, tables, tmp_path, monkeypatch):
    """A slice of many small grains is not sorted and written by one task."""
    from tagstream.sources import admission
    monkeypatch.setattr(admission, "FILE_ROWS", 20, raising=False)
    base, events = tables
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = Admission(spark, f"{base}/many", f"{tmp_path}/a", events.schema)
        number = a.stage()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    staged = spark.read.parquet(f"{tmp_path}/a/sets/{number}/staged/slice=0")
    most = staged.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert a.pending(number) == [0] and most < staged.count() / 2
    assert staged.count() == spark.read.parquet(f"{base}/many").count()
