"""Clock texts: six-digit ``HHMMSS`` and twelve-digit tick times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.config import DEFAULT


def pad_time(time: Column) -> Column:
    return F.lpad(F.trim(time.cast("string")), 6, "0")


def time_to_int(text: Column) -> Column:
    """``HH:MM:SS`` or ``HHMMSS`` to an integer, 0 if it is neither."""
    digits = F.regexp_replace(text.cast("string"), ":", "")
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def seconds_of_day(time: Column) -> Column:
    """Seconds since midnight of the first six digits of a padded clock text."""
    part = lambda at: F.substring(time, at, 2).try_cast("int")
    return part(1) * 3600 + part(3) * 60 + part(5)


def clock_text(seconds: Column) -> Column:
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(
        two(F.floor(seconds / 3600)), two(F.floor(seconds / 60) % 60), two(seconds % 60)
    )


def prev_time(time: Column, step: int = DEFAULT.step_seconds) -> Column:
    """``HHMMSS`` one step earlier, wrapping at midnight."""
    return clock_text((seconds_of_day(pad_time(time)) - step + 86400) % 86400)


def tick_clock(tick_time: Column) -> Column:
    """Tick time padded to the twelve digits ``HHMMSSffffff``."""
    return F.lpad(F.trim(tick_time), 12, "0")


def format_tick_time(tick_time: Column) -> Column:
    """``H:MM:SS.mmm`` or ``HH:MM:SS.mmm``; shorter texts stay as they are."""
    text = F.trim(tick_time)
    at = lambda pos, n: F.substring(text, pos, n)
    long = F.concat(at(1, 2), F.lit(":"), at(3, 2), F.lit(":"), at(5, 2), F.lit("."), at(7, 3))
    short = F.concat(at(1, 1), F.lit(":"), at(2, 2), F.lit(":"), at(4, 2), F.lit("."), at(6, 3))
    return (
        F.when(F.length(text) < 11, text)
        .when(F.length(text) == 11, short)
        .otherwise(long)
    )


def display_time(time: Column) -> Column:
    padded = pad_time(time)
    return F.concat_ws(
        ":", F.substring(padded, 1, 2), F.substring(padded, 3, 2), F.substring(padded, 5, 2)
    )
