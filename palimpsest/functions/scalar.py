"""Scalar functions as Column expressions: ticks, boundary-counting date differences, patterns and lenient conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import EPOCH, moment


def ticks_of(ts: Column) -> Column:
    """100 ns since 1970-01-01 of a TIMESTAMP_NTZ, whatever the session's time zone."""
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})".format(_sql(ts))) * 10


def time_of(ticks: Column) -> Column:
    """The microsecond that a tick count lies in."""
    return F.expr("timestampadd(MICROSECOND, {}, TIMESTAMP_NTZ'1970-01-01 00:00:00')".format(_sql(F.floor(ticks / 10).cast("long"))))


def _sql(c: Column) -> str:
    return c._jc.toString() if not isinstance(c, str) else c


#: Units of date_diff: how many of the next smaller unit, down to microseconds.
_UNITS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def micros_of(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1900-01-01 00:00:00', {ts})")


def date_diff(unit: str, start: str, end: str) -> Column:
    """The number of boundaries of `unit` between two TIMESTAMP_NTZ columns (not of whole units)."""
    if unit == "day":
        return F.datediff(F.col(end).cast("date"), F.col(start).cast("date")).cast("long")
    if unit in ("month", "year"):
        months = lambda c: F.year(c).cast("long") * 12 + F.month(c)
        return months(end) - months(start) if unit == "month" else (F.year(end) - F.year(start)).cast("long")
    size = _UNITS[unit]
    whole = lambda c: F.floor(micros_of(c) / F.lit(size)).cast("long")
    return whole(end) - whole(start)


def like_pattern(pattern: str, escape: str | None = None, ignore_case: bool = False) -> str:
    """A LIKE pattern with character classes and an escape character, as a regular expression for rlike."""
    out, i = "(?i)^" if ignore_case else "^", 0
    while i < len(pattern):
        c = pattern[i]
        if escape and c == escape and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        elif c == "%":
            out += ".*"
        elif c == "_":
            out += "."
        elif c == "[" and "]" in pattern[i:]:
            end = pattern.index("]", i)
            out += pattern[i : end + 1]
            i = end
        else:
            out += re.escape(c)
        i += 1
    return out + "$"


def length(c: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(c))


def stuff(c: Column, start: int, size: int, new: str) -> Column:
    return F.overlay(c, F.lit(new), F.lit(start), F.lit(size))


def to_smallint(c: Column) -> Column:
    """A blank string counts as 0, as does one that is no number as null."""
    return F.when(F.trim(c) == "", F.lit(0)).otherwise(F.try_to_number(F.trim(c), F.lit("S99999"))).cast("smallint")


def quoted(name: str, left: str = "[", right: str = "]") -> str:
    return left + name.replace(right, right * 2) + right


def epoch_if_null(c: Column) -> Column:
    return F.coalesce(c, moment(EPOCH))


def end_of_month(c: Column, offset: int = 0) -> Column:
    return F.last_day(F.add_months(c.cast("date"), offset) if offset else c.cast("date"))


def prefix_bytes(lsn: Column, n: int = 6) -> Column:
    """The number in the first bytes of a binary LSN."""
    return F.conv(F.hex(F.substring(lsn, 1, n)), 16, 10).cast("long")
