"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of `documents`; its decisions take effect on what the stage before has kept:
documents without a known language go; later copies of lines go from the texts, and documents that lose more than four fifths
of their words so; one document of each near-duplicate class stays; the mix repeats or leaves out documents; and the last
stage encodes what is left.

Null and empty texts have no language and go in the first stage. Texts of any length are taken whole. Ties and rows of one id
are settled as each operator says; rows that agree in id and text are one document from near-dedup on. An empty table goes
through all stages as one. Columns beside those of `documents` are carried along to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import written
from palimpsest.llm.langid import fit, held_out, keep_identified
from palimpsest.llm.lines import drop_repeats
from palimpsest.llm.minhash import drop_near
from palimpsest.llm.mixing import mix
from palimpsest.llm.pieces import encode_pieces

#: Only texts without letters in a known language's script, or of no language for most of their letters, are rejected.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, fit(docs.where(~held_out(F.col("doc_id")))), LEAST_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = drop_repeats(docs)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language ID", language), ("line dedup", lines), ("near-dedup", near), ("mixing", weights), ("SentencePiece", encode)]

#: Language models, hashes and tokenizers aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
