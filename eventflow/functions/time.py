"""Time scalars (SC3-SC6, SC9, SC11): epoch conversions and text forms."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "millisecond": 1, "milliseconds": 1, "ms": 1,
    "second": 1000, "seconds": 1000, "s": 1000, "sec": 1000,
    "minute": 60_000, "minutes": 60_000, "min": 60_000,
    "hour": 3_600_000, "hours": 3_600_000, "h": 3_600_000,
    "day": 86_400_000, "days": 86_400_000, "d": 86_400_000,
}


def duration_ms(spec: str | int) -> int:
    """``'1 hour'``, ``'5 seconds'``, ``'30 days'`` or an int of ms -> ms."""
    if isinstance(spec, int):
        return spec
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", spec)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"unsupported duration {spec!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def as_instant(c: Column | str) -> Column:
    """Event-time column as ``timestamp`` (parquet ``timestamp_ntz`` cannot carry a watermark)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def epoch_ms(c: Column | str) -> Column:
    """Timestamp -> epoch milliseconds (long)."""
    return F.unix_millis(as_instant(c))


def seconds_to_instant(c: Column | str) -> Column:
    """Epoch seconds (long) -> timestamp, the ``* 1000L`` of SC4."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_seconds(c)


def millis_to_instant(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_millis(c)


def ms_text(c: Column | str) -> Column:
    """Epoch ms as decimal text (SC6)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def java_timestamp_text(ms: Column | str, whole_seconds: bool = False) -> Column:
    """Epoch ms -> the text ``java.sql.Timestamp.toString`` prints (SC5), in UTC.

    ``yyyy-MM-dd HH:mm:ss.f`` where the fraction has its trailing zeros removed
    but keeps at least one digit (``.0`` on whole seconds). Pass ``whole_seconds``
    when the values are known to be whole seconds (window bounds on a seconds grid).
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    if whole_seconds:
        return F.concat(F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss"), F.lit(".0"))
    frac = F.pmod(ms, F.lit(1000))
    digits = F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", "")
    digits = F.when(frac == 0, F.lit("0")).otherwise(digits)
    return F.concat(F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss"), F.lit("."), digits)


def next_midnight_ms(ms: Column | str) -> Column:
    """Start of the next UTC day for an epoch-ms column (SC9)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    day = F.lit(86_400_000)
    return (F.floor(ms / day) + 1) * day


def interval_lit(ms: int) -> Column:
    """A day-time interval literal of ``ms`` milliseconds (may be negative)."""
    sign = "-" if ms < 0 else ""
    ms = abs(ms)
    days, rem = divmod(ms, 86_400_000)
    hours, rem = divmod(rem, 3_600_000)
    mins, rem = divmod(rem, 60_000)
    secs, millis = divmod(rem, 1000)
    return F.expr(f"INTERVAL '{sign}{days} {hours:02d}:{mins:02d}:{secs:02d}.{millis:03d}' DAY TO SECOND")
