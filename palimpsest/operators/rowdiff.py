"""Null-safe difference of whole rows, by grouping: rows that both sides have once fall into groups of two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_diff(old: DataFrame, new: DataFrame, columns: list[str], keep: dict[str, str] | None = None, cluster: list[str] | None = None) -> DataFrame:
    """Groups of equal rows of either side whose number isn't two, with `n_old`, `n_new` and the columns of `keep`.

    keep: column -> SQL aggregate over the union, in which `side` is 'old' or 'new'. Grouping takes nulls as equal, and one
    aggregation with map-side combine replaces an outer join with null-safe conditions.
    cluster: some of the columns, by which rows are dealt once, so that windows over them need no exchange of their own.
    """
    tagged = old.withColumn("side", F.lit("old")).unionByName(new.withColumn("side", F.lit("new")), allowMissingColumns=True)
    tagged = tagged.repartition(*cluster) if cluster else tagged
    counts = [F.count_if(F.col("side") == s).alias(f"n_{s}") for s in ("old", "new")]
    grouped = tagged.groupBy(*columns).agg(*counts, *[F.expr(e).alias(c) for c, e in (keep or {}).items()])
    return grouped.where(F.col("n_old") + F.col("n_new") != 2)
