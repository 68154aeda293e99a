"""Epoch conversions, windows and bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIVE_MINUTES = 300
HALF_HOUR = 1800


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ns_to_timestamp(origin: Column | str, precise: bool = False) -> Column:
    """Nanoseconds since the epoch -> timestamp.

    The stored tables carry whole seconds: the quotient is taken in double and cut, so the last
    nanoseconds of a second may round up to the next one. ``precise`` keeps microseconds.
    """
    column = _column(origin)
    if precise:
        return F.timestamp_micros(F.call_function("div", column, F.lit(1000)))
    return F.timestamp_seconds((column / F.lit(1_000_000_000)).cast("bigint"))


def window_start(time: Column | str, seconds: int) -> Column:
    """Start of the tumbling window of ``seconds`` aligned to the epoch; null stays null."""
    epoch = F.unix_seconds(_column(time))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def five_min_window(time: Column | str) -> Column:
    return window_start(time, FIVE_MINUTES)


def half_hour_window(time: Column | str) -> Column:
    return window_start(time, HALF_HOUR)


def bin_ns(origin: Column | str, width: int) -> Column:
    """Lower edge of the bin of ``width`` nanoseconds, also right before 1970."""
    column = _column(origin)
    return column - F.pmod(column, F.lit(width).cast("bigint"))


def hour_bucket(time: Column | str) -> Column:
    return F.date_trunc("hour", _column(time))


def format_datetime(time: Column | str) -> Column:
    return F.date_format(_column(time), "yyyy-MM-dd HH:mm:ss")


def minutes_before(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_interval(mins=F.lit(minutes))
