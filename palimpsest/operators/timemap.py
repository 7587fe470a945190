"""The map from log sequence numbers to instants.

Instants are ticks of 100 ns: changes of one commit time are told apart by the last digit, which microseconds would lose.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import prefix_bytes
from ..model import EPOCH, FROM, LOAD, OPEN, moment, ticks
from .rowdiff import row_diff

ZONE = "Europe/London"
HOUR = 36_000_000_000
#: LSN bits that fall into one block when rows are numbered by LSN.
BLOCK_BITS = 16


def _ticks(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) * 10


def utc_ticks(local: Column, zone: str = ZONE) -> Column:
    """Local time, rounded to milliseconds, as UTC ticks; a repeated hour is read as its first pass."""
    rounded = F.timestamp_add("MICROSECOND", F.round(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), local) / 1000).cast("long") * 1000, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return _ticks(F.convert_timezone(F.lit(zone), F.lit("UTC"), rounded).cast("timestamp_ntz"))


def rank_map(mapping: DataFrame, zone: str = ZONE) -> DataFrame:
    """M1: lsn, tran_end_time and the rest of `mapping`, with __from = commit time + its rank among equal times."""
    rank = F.row_number().over(W.partitionBy("tran_end_time").orderBy("lsn"))
    return mapping.withColumn(FROM, utc_ticks(F.col("tran_end_time"), zone) + rank)


def scn_ranges(mapping: DataFrame) -> DataFrame:
    """Ranges that end before the next begins; the window's rows are one for each range, far fewer than the log's."""
    key = ["scn_dt", "min_scn", "max_scn"]
    rest = [F.min(c).alias(c) for c in mapping.columns if c not in key]
    one = mapping.groupBy(*key).agg(*rest) if rest else mapping.distinct()
    return one.withColumn("max_scn", F.coalesce(F.lead(F.col("min_scn") - 1).over(W.orderBy("min_scn")), "max_scn"))


def scn_map(log: DataFrame, ranges: DataFrame, width: int = 1 << 16, zone: str = ZONE) -> DataFrame:
    """M2: log rows (lsn) in the SCN ranges that hold them: scn, scn_dt, min_scn, max_scn, __from.

    The range join is an equality join on blocks of `width` numbers, into which ranges are cut; no nested loop. Ranges are cut
    as far as the log reaches only, so that a last range may be open.
    """
    scn = prefix_bytes(F.col("lsn")) if dict(log.dtypes)["lsn"] == "binary" else F.col("lsn")
    reach = log.select(scn.alias("scn")).agg(F.min("scn").alias("__low"), F.max("scn").alias("__high"))
    inside = scn_ranges(ranges).crossJoin(F.broadcast(reach)).withColumn("__a", F.greatest("min_scn", "__low")).withColumn("__b", F.least("max_scn", "__high"))
    blocks = F.sequence(F.floor(F.col("__a") / width), F.floor(F.col("__b") / width))
    cut = inside.where("__a <= __b AND __low IS NOT NULL").withColumn("__block", F.explode(blocks)).drop("__a", "__b", "__low", "__high")
    points = log.withColumn("scn", scn).withColumn("__block", F.floor(F.col("scn") / width))
    joined = points.join(cut, "__block").where(F.col("scn").between(F.col("min_scn"), F.col("max_scn"))).drop("__block")
    return joined.withColumn(FROM, utc_ticks(F.col("scn_dt"), zone) + (F.col("scn") - F.col("min_scn") + 1))


def pass_through(times: DataFrame, begin, end) -> DataFrame:
    """M3: rows of another map's window."""
    kind = times.schema[FROM].dataType
    return times.where((F.col(FROM) > moment(begin, kind)) & (F.col(FROM) <= moment(end, kind)))


def synthetic(spark: SparkSession, begin: datetime | None, end: datetime | None, now: datetime) -> DataFrame:
    """M4: the one row for sources without a log: the batch's end, numbered by its seconds since 2010."""
    at = end or now
    lsn = int((at.replace(microsecond=0) - datetime(2010, 1, 1)) // timedelta(seconds=1))
    return spark.range(1).select(moment(at).alias(FROM), F.lit(lsn).cast("long").alias("lsn"), moment(begin or EPOCH).alias("tran_begin_time"), moment(at).alias("tran_end_time"))


def numbered(rows: DataFrame, order: str = "lsn", bits: int = BLOCK_BITS) -> DataFrame:
    """Adds __n, the row's number in order of a BIGINT column without repeats.

    Rows are numbered within blocks of numbers, and blocks by their counts, so that only one row for each block meets in
    a task.
    """
    block = F.shiftright(F.col(order), bits)
    blocks = rows.groupBy(block.alias("__block")).agg(F.count("*").alias("__rows"))
    before = blocks.select("__block", (F.sum("__rows").over(W.orderBy("__block")) - F.col("__rows")).alias("__before"))
    inside = rows.withColumn("__block", block).withColumn("__n", F.row_number().over(W.partitionBy("__block").orderBy(order)))
    return inside.join(before, "__block").withColumn("__n", F.col("__n") + F.col("__before")).drop("__block", "__before")


def stamp_load(rows: DataFrame, now: datetime) -> DataFrame:
    """M5: a load time for rows without one: the second of `now`, and a tick more for each row in order of LSN."""
    stamp = F.lit(ticks(now.replace(microsecond=0))) + F.col("__n")
    return numbered(rows).withColumn(LOAD, F.coalesce(LOAD, stamp)).drop("__n")


def _in_overlap(instant: Column) -> Column:
    """Whether ticks lie in the hour after midnight UTC of October's last Sunday."""
    t = F.timestamp_add("MICROSECOND", F.floor(instant / 10).cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return (F.month(t) == 10) & (F.dayofweek(t) == 1) & (F.hour(t) == 0) & (F.datediff(F.last_day(t.cast("date")), t.cast("date")) < 7)


def repair_overlap(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """M6: when clocks go back, the second pass through the hour reads like the first; it is moved an hour on.

    rows: lsn, __from in ticks. known: earlier rows of the map, in which the step back may lie. From the first LSN whose
    time is below its predecessor's, to the overlap's last.
    """
    seen = rows.select("lsn", FROM) if known is None else rows.select("lsn", FROM).unionByName(known.select("lsn", FROM))
    overlap = seen.where(_in_overlap(F.col(FROM))).withColumn("__year", F.year(F.timestamp_add("MICROSECOND", F.floor(F.col(FROM) / 10).cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))))
    # An hour's log of one year in a task.
    steps = overlap.withColumn("__before", F.lag(FROM).over(W.partitionBy("__year").orderBy("lsn")))
    spans = steps.groupBy("__year").agg(F.min(F.when(F.col(FROM) < F.col("__before"), F.col("lsn"))).alias("low"), F.max("lsn").alias("high")).where("low IS NOT NULL")
    # One row a year.
    joined = rows.join(F.broadcast(spans), F.col("lsn").between(F.col("low"), F.col("high")), "left")
    return joined.withColumn(FROM, F.col(FROM) + F.when(F.col("low").isNotNull(), F.lit(HOUR)).otherwise(F.lit(0))).select(*rows.columns)


def backed_off(begin: datetime) -> datetime:
    """M7: a window that begins in the overlap begins an hour earlier; rows that are known already are upserted."""
    last = begin.month == 10 and begin.isoweekday() == 7 and begin.day + 7 > 31
    return begin - timedelta(hours=1) if last and begin.hour == 0 else begin


def classify(source: DataFrame, target: DataFrame, key: str = "lsn") -> DataFrame:
    """M8: rows that differ, with `upsert`: U+ and U- are the new and old side of a change, I is new, D is gone."""
    columns = source.columns
    rows = row_diff(target.select(*columns), source, columns)
    both = F.count("*").over(W.partitionBy(key)) == 2
    new = F.col("n_new") > 0
    return rows.withColumn("upsert", F.when(both & new, "U+").when(both, "U-").when(new, "I").otherwise("D")).select("upsert", *columns)


def upsert(target: DataFrame, differences: DataFrame, key: str = "lsn") -> DataFrame:
    """M9: the target with the differences' new and changed rows. Rows that are gone from the source stay."""
    new = differences.where("upsert IN ('U+', 'I')").select(*target.columns)
    return target.join(new.select(key), key, "left_anti").select(*target.columns).unionByName(new)


def last_marks(differences: DataFrame) -> DataFrame:
    """__from and __load of the row of the latest load, as one row (of nulls without any)."""
    new = differences.where("upsert IN ('U+', 'I')")
    return new.agg(F.max_by(FROM, F.struct(LOAD, FROM)).alias(FROM), F.max(LOAD).alias(LOAD))
