"""The registered queries of this subpackage and the SQL that can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import (
    brown,
    compression,
    decontaminate,
    fill_middle,
    hard_negatives,
    main_text,
    merge_dropout,
    minhash,
    substring,
    toxicity,
    url_tree,
    wavelet,
    weak_rules,
)
from tidepanel.llm.text import documents


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents overlap items of the benchmark."""
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the written shards."""
    return wavelet.encode_and_read(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and class-model score of every document."""
    return brown.score(documents(spark, sf_dir))


def op4_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.classify(documents(spark, sf_dir), labels_of(spark, sf_dir))


def op5_url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url. A page's label is that of the document its path ends in."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    _, path = url_tree.host_and_path()
    number = F.expr("try_cast(regexp_extract(path, '([0-9]{1,18})[^0-9/]*/?$', 1) as bigint)")
    named = pages.select("page_id", path.alias("path")).select("page_id", number.alias("doc_id"))
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    known = labels_of(spark, sf_dir).select("doc_id", good.cast("int").alias("good"))
    return url_tree.judge(pages, named.join(known, "doc_id").select("page_id", "good"))


def op6_fm_index_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that occur earlier."""
    return substring.remove_repeats(documents(spark, sf_dir))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    return compression.classify(documents(spark, sf_dir), labels_of(spark, sf_dir))


def op8_weak_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and posterior verdict for every document."""
    return weak_rules.judge(documents(spark, sf_dir))


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded segmentation of every document and whether it decodes to the text."""
    return merge_dropout.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), full=False)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles."""
    return minhash.near_duplicates(documents(spark, sf_dir), size=2)


def op11_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive among all vectors."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    entries = hard_negatives.whole_entries().alias("entries")
    return hard_negatives.mine(rows.select("vec_id", hard_negatives.shifted_labels().alias("label"), entries))


def op12_block_rules_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_displacement_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's output, and of the text that the output gives back."""
    made = fill_middle.restore(fill_middle.transform(documents(spark, sf_dir)))
    digests = (F.sha2(c, 256).alias(f"{name}_sha256") for c, name in (("output", "output"), ("restored", "restored")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_spaced_seed_decontamination,
        op2_wavelet_token_files,
        op3_brown_class_scores,
        op4_toxicity_automata,
        op5_url_template_tree,
        op6_fm_index_repeats,
        op7_compression_quality,
        op8_weak_quality_rules,
        op9_merge_dropout,
        op10_minhash_near_dedup,
        op11_bond_hard_negatives,
        op12_block_rules_main_text,
        op13_displacement_fill_middle,
    )
}
ORACLE: dict[str, str] = {}
