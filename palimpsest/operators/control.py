"""Control tables: completion marks (C1), the run log (C2), the template registry (C3) and the run views (V1, V2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import EPOCH, moment

RUN_KEY = ["BatchDate", "Batch", "Task", "ServerName", "DatabaseName", "SchemaName", "ObjectName", "Action"]
ENDED = ("Success", "Failure", "Pass")


def merge_complete(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row of marks; a null mark leaves the old one, and EPOCH stands where neither is known."""
    names = ["CompleteDate", "LoadedDate", "RetentionDate"]
    a = old.select(F.lit(1).alias("__one"), *[F.col(c).alias(f"__{c}") for c in names])
    both = new.withColumn("__one", F.lit(1)).join(a, "__one", "full")
    return both.select(*[F.coalesce(c, f"__{c}", moment(EPOCH)).alias(c) for c in names])


def merge_log(events: DataFrame, key: list[str], order: str = "event") -> DataFrame:
    """The log from its events in their order. A run's first start stays, its end is set by an outcome that ends it,
    counts stay until they are given anew, and the error is always the last event's, null or not.

    Folding events by key needs no update in place: writers append, and this is one aggregation.
    """
    rank = F.col(order)
    last = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), rank)).alias(c)
    ended = F.col("Outcome").isin(*ENDED)
    own = [F.min_by("EventTime", rank).alias("StartTime"), F.max_by(F.when(ended, F.col("EventTime")), F.when(ended, rank)).alias("EndTime"), F.max_by("ErrorMessage", rank).alias("ErrorMessage")]
    rest = [c for c in events.columns if c not in (*key, order, "EventTime", "ErrorMessage")]
    return events.groupBy(*key).agg(*own, *[last(c) for c in rest])


def activate(templates: DataFrame) -> DataFrame:
    """Of templates for the same task, action and forms the latest is enabled, and has the first one's creation date."""
    same = W.partitionBy("Task", "Action", "SourceForm", "TargetForm")
    latest = F.max("TemplateId").over(same) == F.col("TemplateId")
    return templates.withColumn("__first", F.min("CreatedDate").over(same)).withColumn("Enabled", F.when(latest, "Y").otherwise("N")).withColumn("CreatedDate", F.when(latest, F.col("__first")).otherwise(F.col("CreatedDate"))).drop("__first")


def run_summary(log: DataFrame) -> DataFrame:
    """V1: a row for each batch, task and schema. Elapsed is in milliseconds and doesn't wrap at a day."""
    count = lambda o: F.count_if(F.col("Outcome") == o)
    total = lambda c: F.sum(c).cast("long")
    columns = log.columns
    dates = [F.max(c).alias(n) for c, n in (("FromDate", "HighestFromDate"), ("ToDate", "HighestToDate")) if c in columns]
    grouped = log.groupBy("BatchDate", "Batch", "Task", "DatabaseName", "SchemaName").agg(
        *dates,
        F.min("StartTime").alias("FirstQueryStart"), F.max("EndTime").alias("__end"), F.count("*").alias("Considered"),
        count("Pass").alias("Passed"), count("Success").alias("Processed"), count("Failure").alias("Failed"), count("Running").alias("Running"),
        total("InsertCount").alias("Inserted"), total("UpdateCount").alias("Updated"), total("DeleteCount").alias("Deleted"),
        F.max(F.when(F.col("Outcome") == "Running", F.col("ObjectName"))).alias("InProgress"),
    )
    millis = lambda c: F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c)) / 1000)
    elapsed = (millis("__end") - millis("FirstQueryStart")).cast("long")
    return grouped.withColumn("Target", F.col("DatabaseName")).withColumn("Subject", F.when(F.col("SchemaName") == "dbo", F.col("DatabaseName")).otherwise(F.col("SchemaName"))).withColumn("Elapsed", elapsed).drop("__end", "DatabaseName", "SchemaName")


def run_latest(log: DataFrame, batches: int = 20, rows: int = 20) -> DataFrame:
    """V2: the rows of V1 that started last, within the last batches."""
    recent = log.select("BatchDate").distinct().orderBy(F.desc("BatchDate")).limit(batches)
    ours = log.join(F.broadcast(recent), "BatchDate", "left_semi")
    return run_summary(ours).orderBy(F.desc("FirstQueryStart"), "Batch", "Task", "Target", "Subject").limit(rows)


def log_event(spark, key: dict, order: int, at: datetime, **values) -> DataFrame:
    """One event for the log, to be appended."""
    row = {**key, "event": order, "EventTime": at, **values}
    return spark.createDataFrame([row])
