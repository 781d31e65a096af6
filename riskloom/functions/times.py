"""Time column helpers. All of them work on zone-free timestamps, so the session zone has no say."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.fixed_values import TIMESTAMP_FORMAT
from riskloom.functions.numeric import as_col


def instant(value: datetime | str | Column) -> Column:
    """A zone-free timestamp from a Python value or a column. A datetime goes in as text: as a
    literal it would pass through the zone of the Python process."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp_ntz")


def clock(as_of: datetime | str | Column | None) -> Column:
    """The job's idea of now: an argument, or the current time when none is given."""
    return F.localtimestamp() if as_of is None else instant(as_of)


def parse_time(c: Column | str, pattern: str = TIMESTAMP_FORMAT) -> Column:
    return F.to_timestamp_ntz(as_col(c), F.lit(pattern))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 on the timestamp's own clock. Built from its date and time parts:
    unlike unix_timestamp it never passes through the session zone, so it always grows with time."""
    ts = as_col(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: Column | str) -> Column:
    second = F.extract(F.lit("SECOND"), as_col(ts))
    return epoch_seconds(ts) * 1_000_000 + (second * 1_000_000).cast("bigint") % 1_000_000


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(1_000_000)


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Difference of the two times on the millisecond clock (boundaries crossed, not elapsed units)."""
    return whole_div(epoch_micros(end), 1000) - whole_div(epoch_micros(start), 1000)


def whole_div(number: Column, width: int) -> Column:
    """Floor division of whole numbers."""
    return ((number - F.pmod(number, F.lit(width))) / F.lit(width)).cast("bigint")


def time_cell(ts: Column | str, seconds: int) -> Column:
    """Number of the fixed-width time cell a timestamp falls into; grows with time."""
    return whole_div(epoch_seconds(ts), seconds)


def shift(ts: Column | str, unit: str, amount: Column | int) -> Column:
    """Add ``amount`` of ``unit`` (SECOND, MINUTE, HOUR, DAY) to a timestamp."""
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit, amount, as_col(ts))


def format_time(ts: Column | str, pattern: str) -> Column:
    return F.date_format(as_col(ts), pattern)
