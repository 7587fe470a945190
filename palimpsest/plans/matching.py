"""Matching of source and target tables and columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import EPOCH, moment

#: A source table may be one of a target's monthly pieces: its name, any character or none, and 20YYMM.
PIECE = "20[0-2][0-9][0-1][0-9]"


def match_tables(source: DataFrame, target: DataFrame, forms: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Pairs of tables of one name, or of a target and its monthly pieces, with the piece's number (YYMM; else 0).

    Equality joins on the name that a piece's number is cut from; no pattern is compared row by row. `strict` takes an
    underscore before the month alone, where otherwise any character may stand.
    """
    gap = "_" if strict else "."
    name = F.col("SourceTable")
    s = source.withColumn("__names", F.array_distinct(F.filter(F.array(
        name,
        F.when(name.rlike(f"^.+{gap}{PIECE}$"), F.expr("left(SourceTable, length(SourceTable) - 7)")),
        F.when(name.rlike(f"^.+{PIECE}$"), F.expr("left(SourceTable, length(SourceTable) - 6)")),
    ), lambda x: x.isNotNull())))
    s = s.withColumn("__name", F.explode("__names"))
    joined = s.join(target, F.col("__name") == F.col("TargetTable"))
    if forms is not None:
        joined = joined.join(F.broadcast(forms), ["SourceForm", "TargetForm"], "left_semi")
    return joined.withColumn("Source", source_id("SourceTable", "TargetTable")).drop("__names", "__name")


def source_id(source: str = "SourceTable", target: str = "TargetTable"):
    """The last four characters of what a piece's name has beyond its table's, as a number; 0 for none."""
    rest = F.expr(f"right(replace({source}, {target}, ''), 4)")
    return F.when(rest == "", F.lit(0)).otherwise(rest.try_cast("smallint")).cast("smallint")


def match_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """The columns that both have, key columns first, then in the target's order."""
    t = target.select("TableName", "ColumnName", "ColumnOrdinal", "KeyOrdinal")
    both = source.select("TableName", "ColumnName").join(t, ["TableName", "ColumnName"])
    order = W.partitionBy("TableName").orderBy(F.coalesce("KeyOrdinal", F.lit(999)), "ColumnOrdinal")
    return both.withColumn("Position", F.rank().over(order)).withColumn("KeyColumn", (F.coalesce("KeyOrdinal", F.lit(0)) > 0))


def column_lists(columns: DataFrame) -> DataFrame:
    """The lists that statements are built from, one row for each table.

    Engine code passes Python lists; this is the rowset for audit. Tables of key columns alone assign those.
    """
    ordered = F.array_sort(F.collect_list(F.struct("Position", "ColumnName", "KeyColumn")))
    t = columns.groupBy("TableName").agg(ordered.alias("all")).withColumn("keys", F.filter("all", lambda x: x["KeyColumn"])).withColumn("others", F.filter("all", lambda x: ~x["KeyColumn"]))
    text = lambda c, f, by: F.array_join(F.transform(c, f), by)
    name = lambda x: x["ColumnName"]
    equal = lambda x: F.concat(F.lit("b."), name(x), F.lit(" = a."), name(x))
    return t.select(
        "TableName",
        text("all", name, ", ").alias("ColumnNames"),
        text("all", lambda x: F.concat(F.lit("a."), name(x)), ", ").alias("ColumnPrefixes"),
        text("keys", name, ", ").alias("KeyNames"),
        text("keys", lambda x: F.concat(F.lit("a."), name(x)), ", ").alias("KeyPrefixes"),
        text("keys", equal, " AND ").alias("Conditions"),
        F.when(F.size("others") > 0, text("others", equal, ", ")).otherwise(text("keys", equal, ", ")).alias("Assignments"),
    )


def batch_dates(tables: DataFrame) -> DataFrame:
    """The window of a batch: the first mark of a table with work, and the last marks of either side."""
    work = F.when(F.col("FromDate") != F.col("ToDate"), F.col("FromDate"))
    return tables.agg(F.min(work).alias("MinFromDate"), F.max("FromDate").alias("MaxFromDate"), F.max("ToDate").alias("MaxToDate"))


def complete_date(source: datetime | None, current: datetime | None, bound: datetime | None) -> datetime:
    """The new completion mark: the source's, no later than the bound, and never earlier than the current one."""
    new = source or EPOCH
    return max(min(new, bound) if bound else new, current or EPOCH)


def batch_suffix(dry_run: bool, max_from: datetime, max_to: datetime, new: datetime, current: datetime) -> str:
    if dry_run:
        return " (Dry Run)"
    if max_to <= max_from:
        return " (Waiting)"
    if max_to > new:
        return " (Incomplete)"
    return " (Waiting)" if new <= current else ""


def bounded(tables: DataFrame, bound: datetime) -> DataFrame:
    """Windows cut at a bound."""
    return tables.withColumn("ToDate", F.least("ToDate", moment(bound)))
