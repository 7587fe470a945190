"""Physical layout: partition boundaries (P1, P2), compression (P3), index blueprints and their differences (P4, P5),
and compaction (P6)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import OPEN, moment
from .rowdiff import row_diff

FIRST_BOUNDARY = datetime(2019, 1, 1)
LAST = datetime(9999, 12, 31, 23, 59, 59, 999000)


def grain(values: DataFrame, column: str = "value") -> DataFrame:
    """P2: 'M' or 'D' by the average distance of the boundaries (whole days, in integer division); 'M' for one or none."""
    known = values.where(F.col(column) < moment(OPEN))
    n = F.count("*")
    days = F.datediff(F.max(column), F.min(column))
    return known.agg(F.when(n <= 1, "M").when(F.floor(days / F.greatest(n - 1, F.lit(1))) > 20, "M").otherwise("D").alias("grain"))


def boundaries(values: DataFrame, by: str, low: datetime | None = None, high: datetime | None = None, gap_fill: bool = False, trim: bool = False, column: str = "value") -> DataFrame:
    """Boundaries to insert or merge away, so that there is one for each day or month and two at the far end.

    The spine is sequence() over the range; it and the existing boundaries differ where a value's group isn't two.
    """
    known = values.where(F.col(column) < moment(OPEN)).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    start = moment(low) if low else F.coalesce("a", moment(FIRST_BOUNDARY))
    end = moment(high) if high else F.coalesce("b", moment(FIRST_BOUNDARY)) - F.expr("INTERVAL 1 DAY")
    first = F.trunc(start.cast("date"), "month") if by == "M" else start.cast("date")
    step = F.expr("INTERVAL 1 MONTH" if by == "M" else "INTERVAL 1 DAY")
    # One beyond the last that the range holds.
    last = F.greatest(first, F.add_months(F.trunc(end.cast("date"), "month"), 1) if by == "M" else F.date_add(end.cast("date"), 1))
    spine = known.select(F.explode(F.sequence(first, last, step)).alias("d"), end.alias("high")).select(F.col("d").cast("timestamp_ntz").alias("Boundary"), "high")
    bound = known.select(end.alias("high"))
    far = bound.select(F.explode(F.array(moment(OPEN), moment(LAST))).alias("Boundary"), "high")
    wanted = spine.unionByName(far).select("Boundary")
    rows = row_diff(values.select(F.col(column).alias("Boundary")), wanted, ["Boundary"])
    action = F.when(F.col("n_old") > 0, "Merge").otherwise("Insert")
    keep = ((F.col("Action") == "Insert") & ((F.col("Boundary") > F.col("high")) | F.lit(gap_fill))) | ((F.col("Action") == "Merge") & F.lit(trim))
    return rows.withColumn("Action", action).crossJoin(F.broadcast(bound)).where(keep).select("Boundary", "Action")


def compression(partitions: DataFrame, recent: int = 4) -> DataFrame:
    """The first partition and the last ones light (ROW), the others dense (PAGE); `rebuild` where that differs."""
    last = F.max("PartitionNumber").over(W.partitionBy("TableName", "IndexName"))
    wanted = F.when((F.col("PartitionNumber") == 1) | (F.col("PartitionNumber") > last - recent), "ROW").otherwise("PAGE")
    return partitions.withColumn("wanted", wanted).withColumn("rebuild", F.col("wanted") != F.col("Compression"))


def blueprint(spark: SparkSession, table: str, form: str, key: list[str], partition_key: str | None = None) -> DataFrame:
    """P5: the indexes that a table of a form should have, a row for each of their columns.

    In Parquet, the clustered one is the order within files; the others say which columns' statistics must prune.
    """
    clustered = [*key, "__$Source", *([partition_key] if partition_key else [])]
    rows = [(table, f"CI_{table}(A)", "CLUSTERED", bool(key), c, i + 1) for i, c in enumerate(clustered)]
    for suffix, column, forms in (("FD", "__$From", ("LAK", "PUB")), ("TD", "__$To", ("LAK",)), ("LD", "__$Load", ("LAK", "PUB"))):
        if form in forms:
            rows.append((table, f"NI_{table}_{suffix}(A)", "NONCLUSTERED", False, column, 1))
    return spark.createDataFrame(rows, "TableName string, IndexName string, IndexType string, UniqueIndex boolean, ColumnName string, ColumnOrder int")


def index_changes(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Indexes to create and to drop, with their columns in order; those alike on both sides don't appear."""
    columns = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ColumnOrder", "ColumnName"))), lambda x: x["ColumnName"]), ",").alias("Columns")
    whole = lambda df: df.groupBy("TableName", "IndexName", "IndexType", "UniqueIndex").agg(columns)
    rows = row_diff(whole(existing), whole(wanted), ["TableName", "IndexName", "IndexType", "UniqueIndex", "Columns"])
    return rows.withColumn("Action", F.when(F.col("n_new") > 0, "CREATE").otherwise("DROP")).drop("n_old", "n_new")


def defragment(stats: DataFrame, rebuild: float = 30, reorganize: float = 5, pages: int = 1000) -> DataFrame:
    """What to do about each partition's fragmentation; small partitions are left alone."""
    f = F.col("Fragmentation")
    return stats.where(F.col("Pages") > pages).withColumn("Action", F.when(f >= rebuild, "Rebuild").when(f >= reorganize, "Reorganize").otherwise("Pass"))


def compact(df: DataFrame, file_bytes: int, total_bytes: int, order: list[str]) -> DataFrame:
    """P6 for files: rows in as many files as their bytes need, each in order of the clustered key."""
    n = max(1, -(-total_bytes // file_bytes))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order) if order else df.coalesce(n)


def month_folder(root: str, database: str, schema: str, year: int, month: int) -> str:
    """Where a month's partition lives."""
    return f"{root}/{database}/{schema}/{year:04d}{month:02d}"


