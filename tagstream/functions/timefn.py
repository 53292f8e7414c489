"""Time expressions shared by the operators (all built-in, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000,
    "d": 86_400_000_000, "w": 7 * 86_400_000_000,
}
_WORDS = {
    "microsecond": "us", "millisecond": "ms", "second": "s", "sec": "s",
    "minute": "m", "min": "m", "hour": "h", "day": "d", "week": "w",
}


def duration_micros(text: str | int | float) -> int:
    """Parse ``"2m"``, ``"30s"``, ``"2160h"``, ``"5 minutes"`` or seconds → µs."""
    if isinstance(text, (int, float)):
        return int(round(float(text) * 1_000_000))
    s = text.strip().lower()
    total = 0
    pos = 0
    for m in re.finditer(r"(-?\d+(?:\.\d+)?)\s*([a-z]+)", s):
        if s[pos:m.start()].strip():
            raise ValueError(f"bad duration {text!r}")
        num, unit = float(m.group(1)), m.group(2)
        unit = unit[:-1] if unit.endswith("s") and unit[:-1] in _WORDS else unit
        unit = _WORDS.get(unit, unit)
        if unit not in _UNITS:
            raise ValueError(f"bad duration unit in {text!r}")
        total += int(round(num * _UNITS[unit]))
        pos = m.end()
    if pos == 0 or s[pos:].strip():
        raise ValueError(f"bad duration {text!r}")
    return total


def interval_text(text: str | int | float) -> str:
    """Duration → Spark interval string in seconds (for ``window()``)."""
    us = duration_micros(text)
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    return f"{us} microseconds"


def micros(ts: Column | str) -> Column:
    """Timestamp (LTZ or NTZ) → epoch microseconds (UTC wall clock)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def parse_event_time(raw: Column | str) -> Column:
    """SRC3: ISO-8601 (up to ns), epoch seconds (float) or epoch ms → timestamp.

    Strings go through ``try_to_timestamp`` (digits past µs are dropped);
    numbers above 1e11 are epoch milliseconds, others epoch seconds.
    Anything else gives NULL, never an error.
    """
    c = F.col(raw) if isinstance(raw, str) else raw
    s = F.trim(c.cast("string"))
    num = s.try_cast("double")
    iso = F.coalesce(
        F.try_to_timestamp(F.regexp_replace(s, r"(\.\d{6})\d+", "$1"),
                           F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(s),
    )
    from_num = F.when(F.abs(num) >= 1e11, F.timestamp_micros(F.round(num * 1000).cast("long")))\
        .otherwise(F.timestamp_micros(F.round(num * 1_000_000).cast("long")))
    is_num = s.rlike(r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$")
    return F.when(is_num, from_num).otherwise(iso)


def with_date_parts(df, ts: str = "ts", hour: bool = False):
    """PRJ7: zero-padded ``year``, ``month``, ``day`` (and ``hour``) strings."""
    out = (df.withColumn("year", F.date_format(ts, "yyyy"))
             .withColumn("month", F.date_format(ts, "MM"))
             .withColumn("day", F.date_format(ts, "dd")))
    if hour:
        out = out.withColumn("hour", F.date_format(ts, "HH"))
    return out


def bucket_of(ts: Column | str, width_us: int, origin_us: int = 0) -> Column:
    """Integer time bucket of width ``width_us`` (floor division)."""
    return F.floor((micros(ts) - F.lit(origin_us)) / F.lit(width_us)).cast("long")
