"""Dates, times and durations. Month arithmetic ends at the last day of a shorter month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"year": "years", "month": "months", "week": "weeks", "day": "days", "hour": "hours", "minute": "mins", "second": "secs"}


def interval(**units) -> Column:
    """A duration of several units at once; numbers or Columns, negative ones too."""
    named = {_UNITS[k.removesuffix("s")]: v if isinstance(v, Column) else F.lit(v) for k, v in units.items()}
    return F.make_interval(**named)


def _shift(moment: Column, sign: int, amount=None, unit: str = "day", **units) -> Column:
    length = interval(**units) if units else interval(**{unit: amount})
    return moment + length if sign > 0 else moment - length


def start_of_day(at: Column, zone: str = "UTC") -> Column:
    """The instant at which the day of an instant began in a zone, whatever the session's zone is."""
    local = F.unix_micros(F.from_utc_timestamp(at, zone))
    return F.to_utc_timestamp(F.timestamp_micros(local - F.pmod(local, F.lit(86_400_000_000))), zone)


FUNCTIONS = {
    "duration": lambda **u: interval(**u),
    "ago": lambda amount=None, unit="day", **u: _shift(F.current_timestamp(), -1, amount, unit, **u),
    "from_now": lambda amount=None, unit="day", **u: _shift(F.current_timestamp(), 1, amount, unit, **u),
    "datetime_add": lambda at, amount=None, unit="day", **u: _shift(at, 1, amount, unit, **u),
    "datetime_sub": lambda at, amount=None, unit="day", **u: _shift(at, -1, amount, unit, **u),
    "date_add": lambda day, amount=None, unit="day", **u: _shift(day, 1, amount, unit, **u).cast("date"),
    "start_of_day": start_of_day,
}
