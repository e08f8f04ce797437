"""Duration arguments: ``"5 seconds"``, ``"2.5 s"``, ``"60 minutes"``, ``500`` (ms)."""

from __future__ import annotations

import re

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def millis(d: str | int | float) -> int:
    """Duration in whole milliseconds; bare numbers are milliseconds."""
    if isinstance(d, (int, float)):
        return int(d)
    m = re.fullmatch(r"\s*([0-9]*\.?[0-9]+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"cannot read duration {d!r}")
    return int(round(float(m.group(1)) * _UNITS_MS[m.group(2).lower()]))


def spark_interval(d: str | int | float) -> str:
    """Duration as a Spark interval string (milliseconds precision)."""
    ms = millis(d)
    if ms % 1000 == 0:
        return f"{ms // 1000} seconds"
    return f"{ms} milliseconds"
