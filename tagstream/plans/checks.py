"""Plan inspection helpers for reviews and tests (read the executed plan)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df: DataFrame) -> list[str]:
    """The FileScan lines of the physical plan."""
    return [ln.strip() for ln in physical_plan(df).split("\n") if "FileScan" in ln]


def pushed_filters(df: DataFrame) -> list[str]:
    out = []
    for s in scans(df):
        m = re.search(r"PushedFilters: \[(.*?)\]", s)
        if m:
            out.append(m.group(1))
    return out


def partition_filters(df: DataFrame) -> list[str]:
    out = []
    for s in scans(df):
        m = re.search(r"PartitionFilters: \[(.*?)\]", s)
        if m and m.group(1):
            out.append(m.group(1))
    return out


def count_nodes(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)
