"""Joins whose keys may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` where NULL keys match NULL keys, as windows and groups treat them.

    Messages without ids have a NULL device, which is a series like any other.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    names = {c: f"__right_{c}" for c in on}
    r = right.withColumnsRenamed(names)
    cond = None
    for c in on:
        eq = left[c].eqNullSafe(F.col(names[c]))
        cond = eq if cond is None else cond & eq
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())
