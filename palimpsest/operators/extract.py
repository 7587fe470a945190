"""Extraction from a history: net and all changes of a window (R1 to R3), current and as-of views (V3, V4)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import ACTION, FROM, SOURCE, TO, moment, open_of


def began(history: DataFrame, begin: datetime | Column, end: datetime | Column, retained: datetime | None = None, retention_key: str = TO) -> DataFrame:
    """Rows that began in the window; rows up to the retention date are left out if that lies in it."""
    kind = history.schema[FROM].dataType
    rows = history.where((F.col(FROM) > moment(begin, kind)) & (F.col(FROM) <= moment(end, kind)))
    if retained is not None and (isinstance(begin, Column) or retained > begin):
        rows = rows.where(F.col(retention_key) > moment(retained, history.schema[retention_key].dataType))
    return rows


def net_changes(history: DataFrame, keys: list[str], begin: datetime | Column, end: datetime | Column, retained: datetime | None = None, retention_key: str = TO) -> DataFrame:
    """Each key's last state in the window, as a delete, an insert (if its first action there is one) or an update."""
    rows = began(history, begin, end, retained, retention_key)
    first = F.first(ACTION).over(W.partitionBy(*keys, SOURCE).orderBy(FROM))
    action = F.when(F.col(ACTION) == "D", "D").when(F.col("__first") == "I", "I").otherwise("U")
    last = rows.withColumn("__first", first).where(F.col(TO) > moment(end, history.schema[TO].dataType))
    return last.withColumn(ACTION, action).select(*history.columns)


def all_changes(history: DataFrame, begin: datetime | Column, end: datetime | Column, retained: datetime | None = None, retention_key: str = TO) -> DataFrame:
    """R2: rows that began in the window, and rows from before it that ended there."""
    f, t = moment(begin, history.schema[FROM].dataType), moment(end, history.schema[TO].dataType)
    ended = history.where((F.col(FROM) <= f) & (F.col(TO) > f) & (F.col(TO) <= t))
    return began(history, begin, end, retained, retention_key).unionByName(ended)


def current(history: DataFrame) -> DataFrame:
    """V3: open rows that aren't tombstones. A filter alone, so that it reaches the scan."""
    return history.where((F.col(TO) == open_of(history)) & (F.col(ACTION) != "D"))


def as_of(history: DataFrame, at: datetime | Column) -> DataFrame:
    """V4: the rows that were valid at an instant."""
    t = moment(at, history.schema[FROM].dataType)
    return history.where((F.col(FROM) <= t) & (F.col(TO) > t) & (F.col(ACTION) != "D"))
