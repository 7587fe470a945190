"""Names, sentinels and small records that all operators share.

History rows carry `__from`, `__to`, `__load`, `__action` and `__source` before the business columns. A row is valid from
`__from` up to, but not including, `__to`; OPEN in `__to` says that it still is. Time columns are TIMESTAMP_NTZ, or BIGINT
ticks of 100 ns since 1970-01-01 where an order within a microsecond matters; the operators take either.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FROM, TO, LOAD, ACTION, SOURCE = "__from", "__to", "__load", "__action", "__source"
LAKE = (FROM, TO, LOAD, ACTION, SOURCE)
PUBLISHED = (FROM, LOAD, ACTION, SOURCE)

#: What a batch did to a row (I, U or D; null for none), and the part of a history that holds its open rows.
WHAT, OPEN_PART = "__what", "open"

OPEN, EPOCH = datetime(9999, 12, 31), datetime(1900, 1, 1)
TICKS = 10_000_000
_UNIX = datetime(1970, 1, 1)


def ticks(t: datetime) -> int:
    d = t - _UNIX
    return (d.days * 86_400 + d.seconds) * TICKS + d.microseconds * 10


def moment(t: datetime | int | Column, like: T.DataType | None = None) -> Column:
    """A point in time as a literal of the type `like` (TIMESTAMP_NTZ unless BIGINT)."""
    if isinstance(t, Column):
        return t
    if isinstance(like, T.LongType):
        return F.lit(t if isinstance(t, int) else ticks(t)).cast("long")
    return F.lit(f"{t:%Y-%m-%d %H:%M:%S.%f}" if isinstance(t, datetime) else t).cast("timestamp_ntz")


def open_of(df: DataFrame, column: str = TO) -> Column:
    return moment(OPEN, df.schema[column].dataType)


def business(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    """The columns that the source owns."""
    return [c for c in df.columns if c not in LAKE and c not in extra]


def equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & (left[f"`{c}`"] == right[f"`{c}`"])
    return condition


@dataclass
class ChangeSet:
    """What a transition does to its target: `result` is the target afterwards; the rest are its parts, all lazy."""

    result: DataFrame
    inserts: DataFrame
    closes: DataFrame | None = None
    tombstones: DataFrame | None = None
    #: The result with what was done to each row in WHAT, so that a writer counts what it has written.
    tagged: DataFrame | None = None

    def counts(self) -> dict[str, int]:
        """Rows inserted, updated (closed) and deleted; one job for each part."""
        count = lambda df: 0 if df is None else df.count()
        return {"inserted": count(self.inserts), "updated": count(self.closes), "deleted": count(self.tombstones)}
