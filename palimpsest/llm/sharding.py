"""Sharding by a two-pass external shuffle, in DataFrame operations alone.

Pass 1 scatters the records uniformly into buckets of a size that fits a task's memory, by a seeded hash. One exchange brings
them together: PART_BYTES of neighbouring buckets to a partition, so that the number of partitions stays in the ten thousands
at 100 TB, while a task holds one bucket at a time.
Pass 2 brings each bucket into a fixed order, applies Spark's shuffle() (a Fisher-Yates shuffle with a seed of its own for
each partition) and writes it. The buckets one after the other are a uniform permutation of all rows, which is cut into shards
of equal numbers of rows: the counts of two shards differ by one at most (the law `rows`).

The hash takes the id and the record's place: its file's name and its row there, or its number in the scan where the input is
not a table of files (it must then come in the same order when a task is retried). So a rerun deals the same, and equal rows,
however many, are dealt to all buckets like any others.

Nulls: a null text has no bytes and the CRC of none; null ids are hashed as such. Texts are not cut; a bucket holds one record
at least, whatever its length. There are no ties, as no two records share a place. An empty table gives an empty result.
Records are kept in one struct column, so that columns named like the operator's own don't clash with them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import crc32_text, scratch

#: The text bytes of a bucket, of which two to four times that is in a task's memory, and of a partition of buckets.
BUCKET_BYTES, PART_BYTES = 16 << 20, 1 << 30


def _place(docs: DataFrame) -> list[Column]:
    """What tells a record from all others: its file's name and its row there, else its number in the scan."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def shard_rows(docs: DataFrame, out: str, shards: int = 16, seed: int = 20, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Writes the shuffled records as Parquet under `out`, partitioned by shard, and returns them: record, slot, shard."""
    spark = docs.sparkSession
    hashed = F.xxhash64(F.lit(seed), docs[f"`{id_col}`"], *_place(docs))
    size = F.coalesce(F.octet_length(docs[f"`{text_col}`"]), F.lit(0)).cast("long") + 1
    total = docs.select(size.alias("size")).agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    # As many as fit in memory, and enough for all cores on a small table.
    cores = min(total.n // 100, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(1, -(-total.bytes // bucket_bytes), cores)
    parts = min(buckets, max(1, -(-total.bytes // part_bytes), cores))
    bucket = F.pmod(F.shiftright(hashed, 8), F.lit(buckets))
    part = lambda b: F.expr(f"CAST({b} * {parts} DIV {buckets} AS INT)")

    counts = docs.select(bucket.alias("bucket")).groupBy("bucket").count()
    # One row for each bucket, summed within partitions of them and then over these, so that no task sees all.
    counts = counts.withColumn("part", part("bucket"))
    inside = F.sum("count").over(W.partitionBy("part").orderBy("bucket")) - F.col("count")
    before = counts.groupBy("part").agg(F.sum("count").alias("rows")).withColumn("before", F.sum("rows").over(W.orderBy("part")) - F.col("rows"))
    offsets = counts.withColumn("inside", inside).join(before.select(F.col("part").alias("p"), "before"), F.col("part") == F.col("p")).select("p", F.struct("bucket", (F.col("before") + F.col("inside")).alias("offset")).alias("entry"))
    # 16 bytes for each bucket: some 100 MB at 100 TB.
    offsets = F.broadcast(offsets.groupBy("p").agg(F.map_from_entries(F.collect_list("entry")).alias("offsets")))

    scattered = docs.select(bucket.alias("bucket"), F.struct(hashed.alias("hashed"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")).alias("item"))
    lists = scattered.withColumn("part", part("bucket")).repartitionById(parts, F.col("part")).groupBy("part", "bucket").agg(F.collect_list("item").alias("items"))
    shuffled = (
        lists.join(offsets, F.col("part") == F.col("p"))
        .sortWithinPartitions("bucket")
        .select(F.col("offsets")[F.col("bucket")].alias("offset"), F.shuffle(F.array_sort("items", lambda a, b: F.when(a["hashed"] < b["hashed"], -1).when(a["hashed"] > b["hashed"], 1).otherwise(0)), seed).alias("items"))
    )
    n = max(1, total.n)
    placed = (
        shuffled.select("offset", F.posexplode("items").alias("at", "item"))
        .select(F.col("item.record").alias("record"), (F.col("offset") + F.col("at")).alias("at"))
        .select("record", "at", F.expr(f"CAST(at * {shards} DIV {n} AS INT)").alias("shard"))
        .select("record", F.expr(f"at - (CAST(shard AS BIGINT) * {n} + {shards - 1}) DIV {shards}").alias("slot"), "shard")
    )
    placed.write.partitionBy("shard").parquet(out)
    return spark.read.schema(placed.schema).parquet(out)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark, "shards"))
    text = F.col("record.text")
    return rows.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        crc32_text(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
