"""Catalog metadata: forms (H2), ordinals (H4), keys (H5 to H7) and high-water marks.

The catalog rowset has a row for each table and column; a store's or a JDBC source's catalog gives it (H1).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import EPOCH, FROM, TO, moment, open_of

#: Time by which the change log may lag behind the clock.
CDC_LATENCY = timedelta(seconds=1)
# Control tables that aren't replicated, as regular expressions, and columns that each form owns.
IGNORED_TABLES = (r"_SCN_MAPPING_", r"^lsn_time_mapping$", r"^__\$", r"^index_columns$", r"^ddl_history$", r"^change_tables$", r"^captured_columns$", r"^xdbcdc")
COMPLETE = "__$Complete"
FORMS = ("CTL", "XXX", "CDC", "LAK", "PUB", "OLD", "NON")


def catalog(spark: SparkSession, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """H1 for DataFrames: TableName, ColumnId, ColumnName, ColumnType, KeyId."""
    rows = []
    for name, df in tables.items():
        own = (keys or {}).get(name, [])
        rows += [(name, i + 1, f.name, f.dataType.simpleString(), own.index(f.name) + 1 if f.name in own else None) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "TableName string, ColumnId int, ColumnName string, ColumnType string, KeyId int")


def form_of(name: str, columns: list[str], has_key: bool, schema: str) -> str:
    """H2 for one table."""
    import re

    have = set(columns)
    if name == COMPLETE:
        return "CTL"
    if any(re.search(p, name) for p in IGNORED_TABLES):
        return "XXX"
    if "__$start_lsn" in have:
        return "CDC"
    if {"__$From", "__$To"} <= have and has_key:
        return "LAK"
    if "__$From" in have:
        return "PUB"
    return "OLD" if {"DateFrom", "DateTo"} <= have and has_key and schema != "dbo" else "NON"


def classify_forms(rows: DataFrame, schema: str) -> DataFrame:
    """H2 and H3 over a catalog: adds Form, and leaves out ignored tables and columns that the form owns.

    One aggregation by table gives what the decision needs; the join back is on the table's name.
    """
    has = lambda c: F.count_if(F.col("ColumnName") == c)
    t = rows.groupBy("TableName").agg(has("__$start_lsn").alias("lsn"), has("__$From").alias("f"), has("__$To").alias("t"), has("DateFrom").alias("df"), has("DateTo").alias("dt"), F.max("KeyId").isNotNull().alias("key"))
    ignored = F.lit(False)
    for p in IGNORED_TABLES:
        ignored = ignored | F.col("TableName").rlike(p)
    form = (
        F.when(F.col("TableName") == COMPLETE, "CTL").when(ignored, "XXX").when(F.col("lsn") == 1, "CDC")
        .when((F.col("f") + F.col("t") == 2) & F.col("key"), "LAK").when(F.col("f") == 1, "PUB")
        .when((F.col("df") + F.col("dt") == 2) & F.col("key") & F.lit(schema != "dbo"), "OLD").otherwise("NON")
    )
    joined = rows.join(t.select("TableName", form.alias("Form")), "TableName").where("Form <> 'XXX'")
    control = F.col("ColumnName").startswith("__$")
    return joined.where(~(F.col("Form").isin("CDC", "LAK", "PUB") & control) & ~((F.col("Form") == "OLD") & F.col("ColumnName").isin("DateFrom", "DateTo")))


def ordinals(rows: DataFrame) -> DataFrame:
    """H4: ranks of the columns that are left, and of the key columns among them."""
    table = W.partitionBy("TableName")
    key = F.when(F.col("KeyId").isNotNull(), F.rank().over(table.orderBy(F.coalesce("KeyId", F.lit(128)))))
    return rows.withColumn("ColumnOrdinal", F.rank().over(table.orderBy("ColumnId"))).withColumn("KeyOrdinal", key)


def primary_or_clustered(rows: DataFrame) -> DataFrame:
    """H5, H7: KeyId is the primary key's ordinal if the table has one, else the clustered index's (null where that is)."""
    has = F.max("IsPrimary").over(W.partitionBy("TableName")) == 1
    return rows.withColumn("KeyId", F.when(has, F.col("PrimaryOrdinal")).otherwise(F.col("ClusteredOrdinal")))


def pick_key(constraints: DataFrame) -> DataFrame:
    """H6: of a table's unique constraints and indexes (TableName, Name, Kind, ColumnName, Position) the columns of one:
    the one with the fewest columns, a primary key before a unique one before an index, and then by name."""
    kind = F.when(F.col("Kind") == "P", 1).when(F.col("Kind") == "U", 2).otherwise(3)
    size = F.count("*").over(W.partitionBy("TableName", "Name"))
    ranked = constraints.withColumn("__size", size).withColumn("__rank", F.dense_rank().over(W.partitionBy("TableName").orderBy("__size", kind, "Name")))
    return ranked.where("__rank = 1").select("TableName", "Name", "ColumnName", F.col("Position").alias("KeyId"))


def cdc_limit(times: DataFrame, bound: datetime | Column, now: datetime | Column | None = None, latency: timedelta = CDC_LATENCY) -> DataFrame:
    """H8: the last LSN and instant of a log's map up to the bound; with `now`, also no later than the latency before it."""
    kind = times.schema[FROM].dataType
    limit = moment(bound, kind)
    if now is not None:
        limit = F.least(limit, moment(now - latency if isinstance(now, datetime) else now - F.expr(f"INTERVAL {latency.total_seconds()} SECOND"), kind))
    return times.where(F.col(FROM) <= limit).agg(F.max("lsn").alias("lsn"), F.max(FROM).alias(FROM))


def cdc_marks(changes: DataFrame, times: DataFrame, limit: DataFrame) -> DataFrame:
    """H9: each table's last change up to the limit (TableName, __start_lsn), as LSN and instant."""
    last = changes.join(F.broadcast(limit.select(F.col("lsn").alias("__limit"))), F.col("__start_lsn") <= F.col("__limit")).groupBy("TableName").agg(F.max("__start_lsn").alias("lsn"))
    return last.join(times.select("lsn", FROM), "lsn", "left").select("TableName", "lsn", FROM)


def lake_mark(history: DataFrame, bound: datetime | Column, complete: datetime | Column | None = None, open_only: bool = True, column: str = FROM) -> DataFrame:
    """The last instant at which something began, up to the bound and the completion mark. Column: DMLDate.

    open_only: open rows suffice, as each key has one; not if the table is partitioned by the column itself.
    """
    kind = history.schema[column].dataType
    limit = moment(bound, kind) if complete is None else F.least(moment(bound, kind), moment(complete, kind))
    end = "DateTo" if column == "DateFrom" else TO
    inside = F.col(column) <= limit
    if open_only and end in history.columns:
        inside = inside & (F.col(end) == open_of(history, end))
    return history.where(inside).agg(F.max(column).alias("DMLDate"))


def old_mark(history: DataFrame, bound: datetime | Column, zone: str = "Europe/London") -> DataFrame:
    """The same for a history in local time, as UTC."""
    mark = lake_mark(history, bound, column="DateFrom", open_only=False)
    return mark.select(F.convert_timezone(F.lit(zone), F.lit("UTC"), "DMLDate").cast("timestamp_ntz").alias("DMLDate"))


def snapshot_mark(bound: datetime, changed: datetime | None, partition_key: str | None) -> datetime:
    """A snapshot is as new as the bound; one whose layout changed later is read anew from the start."""
    return EPOCH if changed and changed > bound and partition_key == TO else bound


def with_retention(rows: DataFrame, complete: DataFrame) -> DataFrame:
    """The schema's retention date beside each row of the catalog."""
    return rows.crossJoin(F.broadcast(complete.select("RetentionDate").limit(1)))


def origins(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """For change tables (object_id, source_object_id) the origin's names and key ordinals."""
    source = columns.select(F.col("object_id").alias("source_object_id"), F.col("table_name").alias("OriginTableName"), F.col("column_name").alias("ColumnName"), F.col("key_ordinal").alias("KeyId"))
    return tables.join(source, "source_object_id")


