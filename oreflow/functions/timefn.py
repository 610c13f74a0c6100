"""Column functions for time: buckets, calendar parts, differences, shifts.

All of them keep ``TIMESTAMP_NTZ`` input as NTZ so results do not depend on
the session time zone.  Streaming jobs cast to ``TIMESTAMP`` first (a
watermark needs it, gotcha G1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {
    "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400,
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_interval(width: str) -> int:
    """'5 minutes' / '1 hour' / '7 days' / '1 week' -> seconds."""
    n, unit = width.strip().split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"unsupported interval unit in {width!r}")
    return int(n) * _UNIT_SECONDS[unit]


def time_bucket(ts, width: str) -> Column:
    """Start of the fixed-width bucket holding ``ts`` (like time_bucket).

    Buckets are aligned on the Unix epoch, except weeks, which start on
    Monday (gotcha G7: the epoch is a Thursday, so shift by 4 days).
    """
    start = "4 days" if parse_interval(width) % (7 * 86400) == 0 else None
    w = F.window(_c(ts), width, width, start) if start else F.window(_c(ts), width)
    return w.start


def trunc(unit: str, ts) -> Column:
    """date_trunc that returns the input's type (NTZ stays NTZ)."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    """Whole-second difference ``end - start`` (EXTRACT(EPOCH …), G6)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def minutes_between(start, end) -> Column:
    """Fractional minutes ``end - start`` at microsecond precision."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60e6)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 of a wall-clock NTZ timestamp."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts)) / F.lit(1e6)


def calendar_parts(d) -> dict[str, Column]:
    """Date parts of the calendar dimension (ISO week and weekday, G8)."""
    d = _c(d)
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": iso_dow,
        "is_weekend": iso_dow >= 6,
    }


def shift_of(ts, starts=(8, 16)) -> Column:
    """Shift number 1/2/3 from the hour; shift 1 starts at ``starts[0]``,
    shift 2 at ``starts[1]``, the rest of the day is the night shift 3."""
    h = F.hour(_c(ts))
    return (F.when((h >= starts[0]) & (h < starts[1]), F.lit(1))
            .when(h >= starts[1], F.lit(2)).otherwise(F.lit(3)))


def production_date(ts, day_start_hour: int = 8) -> Column:
    """Production day: hours before the day start belong to the previous day
    (the night shift that began the evening before)."""
    return F.to_date(_c(ts) - F.make_dt_interval(F.lit(0), F.lit(day_start_hour)))
