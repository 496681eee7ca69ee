"""Documents to token ids in five stages, each on all that its predecessor kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. ``run``
writes each result as Parquet to the staging folder and hands what it reads back to the next one, so
a lost executor costs tasks of one stage. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import compression, decontaminate, merge_dropout, minhash, substring
from tidepanel.llm.text import documents, held_out
from tidepanel.sources.staging import stage

#: Near-duplicates are judged on shingles of five words at a similarity of 0.8.
SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good. Rows without doc_id are judged too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = compression.fit(docs, compression.training_rows(labels, held_out("doc_id", 3, 1)))
    return compression.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id."""
    found = minhash.near_duplicates(docs, size=SHINGLE).filter("not kept").select(F.col("doc_id").alias("_gone"))
    found = stage(found.distinct(), "near-copies")
    return docs.join(found, docs["doc_id"] == found["_gone"], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without passages of twenty words or more that occur earlier; n_chars follows."""
    left = substring.without_repeats(docs)
    if "n_chars" not in left.columns:
        return left
    return left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document and the text that they decode to."""
    return merge_dropout.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encode", encode),
]

#: The classifier and the seeded segmentation cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
