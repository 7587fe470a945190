"""Maintenance: rollback (B1), retention (B2), sequence check and repair (B3, B4), safe drop."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import FROM, LOAD, OPEN, TO, ChangeSet, moment


def rollback(history: DataFrame, at: datetime | Column, begin: str = "DateFrom", end: str = "DateTo") -> ChangeSet:
    """B1: the history as it was at an instant: what began later goes, what ended later is open again.

    begin, end: DateFrom and DateTo, or __from and __to.
    """
    kind = history.schema[end].dataType
    t = moment(at, kind)
    later = F.col(begin) > t
    # Marks of the far end aren't times at which a row ended.
    reopened = (F.col(end) > t) & (F.col(end) < moment(datetime(9999, 1, 1), kind))
    left = history.where(~later)
    result = left.withColumn(end, F.when(reopened, moment(OPEN, kind)).otherwise(F.col(end)))
    return ChangeSet(result, history.limit(0), left.where(reopened), history.where(later))


def rollback_counts(history: DataFrame, at: datetime | Column, begin: str = "DateFrom", end: str = "DateTo") -> DataFrame:
    """Rows that B1 deletes and reopens, in one pass."""
    kind = history.schema[end].dataType
    t = moment(at, kind)
    reopened = (F.col(begin) <= t) & (F.col(end) > t) & (F.col(end) < moment(datetime(9999, 1, 1), kind))
    return history.agg(F.count_if(F.col(begin) > t).alias("deleted"), F.count_if(reopened).alias("updated"))


def retention_date(complete: datetime, days: int, bound: date | None = None) -> date:
    """B2: the day before which history may go: `days` and one before the completion mark, and no later than the bound."""
    day = (complete - timedelta(days=days + 1)).date()
    return min(day, bound) if bound else day


def retain(history: DataFrame, day: date, key: str = TO) -> DataFrame:
    """B2: rows of the partition (a day of `key`) that holds the date, and of later ones. A filter on the partition column."""
    return history.where(F.col(key) >= moment(datetime(day.year, day.month, day.day), history.schema[key].dataType))


def out_of_sequence(history: DataFrame, keys: list[str], order: str = LOAD) -> DataFrame:
    """Rows whose key's next row, in order of load, doesn't begin later."""
    following = F.lead(FROM).over(W.partitionBy(*keys).orderBy(order))
    return history.withColumn("next_from", following).where(F.col("next_from") <= F.col(FROM))


def fix_sequence(history: DataFrame, keys: list[str], order: str = LOAD) -> DataFrame:
    """Neighbours of a key that stand in the wrong order exchange their intervals.

    A row takes the interval of the row before if that doesn't begin earlier, or else of the one behind if that doesn't
    begin later. By windows over the key, so rows of other keys that begin at the same instant are left alone.
    """
    w = W.partitionBy(*keys).orderBy(order)
    lag, lead = (lambda c: F.lag(c).over(w)), (lambda c: F.lead(c).over(w))
    marked = history.withColumn("__lf", lag(FROM)).withColumn("__lt", lag(TO)).withColumn("__nf", lead(FROM)).withColumn("__nt", lead(TO))
    behind, ahead = F.col("__lf") >= F.col(FROM), F.col("__nf") <= F.col(FROM)
    pick = lambda a, b, own: F.when(behind, F.col(a)).when(ahead, F.col(b)).otherwise(F.col(own)).alias(own)
    return marked.select(*[pick("__lf", "__nf", c) if c == FROM else pick("__lt", "__nt", c) if c == TO else F.col(f"`{c}`") for c in history.columns])


def safe_drop(store, name: str) -> bool:
    """Drops a table if it has no row; whether it did."""
    if not store.read(name).isEmpty():
        return False
    store.drop(name)
    return True
