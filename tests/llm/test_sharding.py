import zlib

from pyspark.sql import functions as F

from palimpsest.llm.common import scratch
from palimpsest.llm.sharding import op2_sharding, shard_rows


def test_shards_are_even_and_gapless(spark, medium):
    got = op2_sharding(spark, medium).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    by = {}
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = {r.doc_id: (r.shard, r.slot) for r in op2_sharding(spark, medium).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def test_order_is_random_within_and_across_buckets(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
    rows = shard_rows(docs, scratch(spark, "s"), shards=4, bucket_bytes=20_000).select("record.doc_id", "shard", "slot").collect()
    at = sorted((r.shard, r.slot, r.doc_id) for r in rows)
    ids = [x[2] for x in at]
    assert sorted(ids) == list(range(4000))
    close = sum(abs(a - b) < 40 for a, b in zip(ids, ids[1:]))
    assert close < 200
    for s in range(4):
        assert abs(sum(i for sh, _, i in at if sh == s) / 1000 - 2000) < 200
    other = shard_rows(docs, scratch(spark, "s"), shards=4, seed=21, bucket_bytes=20_000).select("record.doc_id", "shard", "slot").collect()
    assert sum(a == b for a, b in zip(sorted(map(tuple, rows)), sorted(map(tuple, other)))) < 100


def test_equal_rows_are_spread(spark, tmp_path):
    """A third of all rows equal: they lie in all shards, and no bucket is much larger than others."""
    rows = [(7, "the same text " * 10)] * 1000 + [(i, f"text {i} " * 20) for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for part_bytes in (1 << 30, 50_000):
        got = shard_rows(docs, scratch(spark, "s"), shards=8, bucket_bytes=10_000, part_bytes=part_bytes).select("record.doc_id", "record.text", "shard", "slot").collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(rows)
        for s in range(8):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(375))
            assert 80 < sum(r.doc_id == 7 and r.text.startswith("the") for r in got if r.shard == s) < 175
    again = shard_rows(docs.repartition(1), scratch(spark, "s"), shards=8, bucket_bytes=10_000).count()
    assert again == 3000


def test_odd_rows(spark, odd, nothing):
    rows = shard_rows(odd, scratch(spark, "s"), shards=5).collect()
    assert len(rows) == odd.count() and rows[0].record.asDict().keys() == set(odd.columns)
    sizes = [sum(r.shard == s for r in rows) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert shard_rows(nothing, scratch(spark, "s")).count() == 0
