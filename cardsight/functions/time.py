"""Timestamp column functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column, data_type: T.DataType | None = None) -> Column:
    """Whole epoch seconds, rounded down (sub-second part dropped).

    A ``timestamp_ntz`` value is read as UTC wall-clock time without going
    through the session zone; a zoned ``timestamp`` uses ``unix_seconds``.
    """
    c = _col(ts)
    if isinstance(data_type, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(data_type, (T.StringType, T.DateType)):
        c = c.cast("timestamp_ntz")
    days = F.datediff(F.to_date(c), F.lit(dt.date(1970, 1, 1))).cast("long")
    clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return days * SECONDS_PER_DAY + clock.cast("long")


def epoch_seconds_of(df: DataFrame, ts_col: str) -> Column:
    """``epoch_seconds`` dispatching on the column's declared type."""
    return epoch_seconds(ts_col, df.schema[ts_col].dataType)


def is_weekend(ts: str | Column, mode: str = "reference") -> Column:
    """Weekend flag.

    ``mode="reference"`` keeps ``dayofweek >= 6`` (Sunday = 1 ... Saturday = 7),
    which flags Friday and Saturday. ``mode="sat_sun"`` flags Saturday and Sunday.
    """
    c = _col(ts)
    if mode == "reference":
        return F.dayofweek(c) >= 6
    if mode == "sat_sun":
        return F.weekday(c) >= 5
    raise ValueError(f"unknown weekend mode {mode!r}")


def is_night(ts: str | Column) -> Column:
    """Night flag: hour <= 6, i.e. 00:00:00 to 06:59:59."""
    return F.hour(_col(ts)) <= 6


def to_timestamp_literal(value: str | dt.datetime | dt.date) -> Column:
    """A timestamp literal (no time zone) from a string, date or datetime."""
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None)).cast("timestamp_ntz")
    if isinstance(value, dt.date):
        return F.lit(dt.datetime(value.year, value.month, value.day)).cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")


def add_days(ts: Column, days: int) -> Column:
    """Exact day arithmetic keeping the time of day (not ``date_add``)."""
    return ts + F.make_dt_interval(F.lit(days))


def in_half_open_range(ts: str | Column, start: Column, days: int) -> Column:
    """``start <= ts < start + days``."""
    c = _col(ts)
    return (c >= start) & (c < add_days(start, days))


def day_index(ts: str | Column, origin: str | dt.date) -> Column:
    """Whole days between ``origin`` and the date of ``ts``."""
    if isinstance(origin, str):
        origin = dt.date.fromisoformat(origin)
    return F.datediff(F.to_date(_col(ts)), F.lit(origin))
