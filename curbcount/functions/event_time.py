"""Event-time expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbcount.schemas import STEP_SECONDS

# Text forms of event time.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"

_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_SHAPES = {
    SECOND_FORMAT: rf"^{_DATE} \d{{1,2}}:\d{{1,2}}:\d{{1,2}}$",
    MINUTE_FORMAT: rf"^{_DATE} \d{{1,2}}:\d{{1,2}}$",
}
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tick_floor(ts: Column | str, step_seconds: int = STEP_SECONDS) -> Column:
    """``ts`` moved back to the start of its step, counted from the Unix epoch."""
    ts = _col(ts)
    since_epoch = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)
    return F.timestamp_add("MICROSECOND", -F.pmod(since_epoch, F.lit(step_seconds * 1_000_000)), ts)


def first_instant_after_tick(bound: Column, step_seconds: int = STEP_SECONDS) -> Column:
    """Lowest raw time whose tick is greater than the tick ``bound``.

    ``tick_floor(ts) > bound`` is the same as ``ts >= first_instant_after_tick(bound)`` when
    ``bound`` lies on a step. The second form compares a stored column, so it reaches the scan.
    """
    return bound + seconds(step_seconds)


def seconds(n: int) -> Column:
    """A constant duration."""
    return F.make_dt_interval(secs=F.lit(n))


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def whole_seconds(interval: Column | str) -> Column:
    """Day-time interval to seconds, fraction cut; 64-bit, so long spans do not overflow."""
    return _col(interval).cast("bigint")


def interval_days(interval: Column | str) -> Column:
    return whole_seconds(interval) / F.lit(60) / F.lit(60) / F.lit(24)


def interval_minutes(interval: Column | str) -> Column:
    return whole_seconds(interval) / F.lit(60)


def steps_between(later: Column | str, earlier: Column | str, step_seconds: int = STEP_SECONDS) -> Column:
    """Time difference counted in steps (quarter hours), with its fraction."""
    micros = F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))
    return micros / F.lit(step_seconds * 1_000_000)


def from_parts(year, month, day, hour, minute, strict: bool = True) -> Column:
    """Timestamp from integer parts. Impossible parts raise, or give null if not ``strict``."""
    build = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    return build(*(_col(c) for c in (year, month, day, hour, minute)), F.lit(0))


def parse_event_time(text: Column | str, fmt: str = SECOND_FORMAT) -> Column:
    """Text to event time; empty or badly shaped text gives null."""
    if fmt not in _SHAPES:
        raise ValueError(f"unknown event-time format {fmt!r}")
    text = F.trim(_col(text))
    return F.when(text.rlike(_SHAPES[fmt]), text.try_cast("timestamp_ntz"))


def format_event_time(ts: Column | str, fmt: str = SECOND_FORMAT) -> Column:
    return F.date_format(_col(ts), fmt)
