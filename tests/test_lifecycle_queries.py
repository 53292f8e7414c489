"""Registered queries added with the lifecycle work (write / read back, consumer lag,
stream pending/firing) against their DuckDB twins at sf0.001."""

import pytest

import __spark_entry__ as entry
from test_entry import SF, _duck


@pytest.mark.parametrize("name", ["snk2_src6_rollup_rerun", "snk4_compact_map",
                                  "jon6_partition_diff_full", "jon6_partition_sync", "snk6_export_csv",
                                  "alr7_classify_lag", "str4_stream_pending_firing"])
def test_lifecycle_query_matches_duckdb(spark, name):
    df = entry.queries()[name](spark, SF)
    cols, rows = _duck(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(cols)
    order = [cols.index(c) for c in df.columns]
    norm = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    got = sorted((norm(tuple(r)) for r in df.collect()), key=repr)
    exp = sorted((norm(tuple(r[i] for i in order)) for r in rows), key=repr)
    assert got == exp and len(got) > 0
