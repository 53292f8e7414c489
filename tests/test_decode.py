"""Envelopes, bad inputs and time parsing (FIXTURES F1-F6)."""

import datetime as dt

from tagstream.functions.timefn import parse_event_time
from tagstream.sources import decode as dc

T = dt.datetime(2026, 5, 7, 5, 0, 0)
ISO = "2026-05-07T05:00:00.000000Z"
MS = 1778130000000  # 2026-05-07T05:00:00Z in ms
V1 = '{"timestamp":"%s","source_id":"s1","device_id":"d1","tag_count":2,"bad_count":0,"Temp_Boiler_01":85.3,"Press_Line_01":120.5}' % ISO
V2 = '{"timestamp":%s,"source_id":"s1","device_id":"d1","tags":{"Temp_Boiler_01":85.3,"Press_Line_01":120.5},"tag_count":2,"bad_count":0}' % (MS / 1000)
V3 = '{"tags":[{"name":"Temp_Boiler_01","value":85.3,"ts":%d},{"name":"Press_Line_01","value":120.5,"ts":%d}]}' % (MS, MS)
V4 = ('{"MessageId":"m1","PublisherId":"s1","Messages":[{"DataSetWriterId":1,"Payload":'
      '{"Temp_Boiler_01":{"Value":85.3,"SourceTimestamp":"%s"}}},{"DataSetWriterId":2,"Payload":'
      '{"Press_Line_01":{"Value":120.5,"SourceTimestamp":"%s"}}}]}') % (ISO, ISO)
V5 = ('{"timestamp":"%s","source_id":"s1","device_id":"d1","readings":{"Temp_Boiler_01":{"value":85.3,'
      '"unit":"C","name":"boiler"},"Press_Line_01":{"value":120.5,"unit":"bar","name":"line"}}}') % ISO


def test_five_envelopes_give_equal_readings(spark):
    raw = spark.createDataFrame([(m, "s1", "d1") for m in (V1, V2, V3, V4, V5)],
                                "value string, source_id string, device_id string")
    out = dc.decode_any(raw).collect()
    by_env = {}
    for r in out:
        by_env.setdefault(r.envelope, set()).add((r.source_id, r.device_id, r.tag_name, r.ts, r.value))
    expect = {("s1", "d1", "Temp_Boiler_01", T, 85.3), ("s1", "d1", "Press_Line_01", T, 120.5)}
    assert set(by_env) == {"V1", "V2", "V3", "V4", "V5"}
    for env, got in by_env.items():
        assert got == expect, env


def test_flat_decode_bad_values(spark):
    msgs = ['{"timestamp":"%s","device_id":"d","Temp_Boiler_01":true,"Press_Line_01":"85","Level_Tank_01":"NaN","Flow_Main_01":3}' % ISO]
    raw = spark.createDataFrame([(m,) for m in msgs], "value string")
    r = dc.decode_flat(raw, ["Temp_Boiler_01", "Press_Line_01", "Level_Tank_01", "Flow_Main_01"]).collect()[0]
    assert (r.Temp_Boiler_01, r.Press_Line_01, r.Level_Tank_01, r.Flow_Main_01) == (None, None, None, 3.0)
    assert r.ts == T
    anyr = dc.decode_any(raw).collect()
    vals = {x.tag_name: x.value for x in anyr}
    assert vals == {"Temp_Boiler_01": None, "Press_Line_01": None, "Level_Tank_01": None, "Flow_Main_01": 3.0}


def test_quarantine_reasons(spark):
    msgs = ["garbage", "{}", '{"timestamp":"x","Temp_Boiler_01":1}', V1,
            '{"timestamp":"%s","Temp_Boiler_01":true}' % ISO]
    raw = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "id int, value string")
    got = {r.id: r.quarantine_reason for r in dc.quarantine(raw).collect()}
    assert got == {0: "unparseable", 1: "no_timestamp", 2: "no_timestamp", 3: None, 4: None}
    good, bad = dc.split_quarantine(dc.quarantine(raw))
    assert (good.count(), bad.count()) == (2, 3)


def test_quarantine_follows_the_envelope(spark):
    msgs = ['{"tags":[{"name":"T","value":1.5,"ts":1746597600000}]}',                 # V3: one top-level field, good
            '{"timestamp":"%s","source_id":"s","device_id":"d"}' % ISO,               # header only
            '{"timestamp":"%s","tags":{}}' % ISO, '{"tags":[]}']
    raw = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "id int, value string")
    got = {r.id: r.quarantine_reason for r in dc.quarantine(raw).collect()}
    assert got == {0: None, 1: "no_tags", 2: "no_tags", 3: "no_tags"}
    assert dc.decode_any(raw).count() == 1


def test_parse_event_time_formats(spark):
    df = spark.createDataFrame([("2026-05-06T09:29:19.113336942Z",), ("1778059011.277",),
                                ("1746597600000",), ("x",), (None,)], "s string")
    got = [r.t for r in df.select(parse_event_time("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2026, 5, 6, 9, 29, 19, 113336)
    assert got[1] == dt.datetime(2026, 5, 6, 9, 16, 51, 277000)
    assert got[2] == dt.datetime(2025, 5, 7, 6, 0, 0)
    assert got[3] is None and got[4] is None


def test_explode_pairs(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1.0, None])], "id int, n array<string>, v array<double>")
    got = [(r.tag_name, r.value) for r in dc.explode_pairs(df, "n", "v", ["id"]).collect()]
    assert got == [("a", 1.0), ("b", None)]
