"""From raw documents to packed sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusengine.llm import alignment, minhash, packing, ranking, rules
from corpusengine.llm.registry import prepare
from corpusengine.session import stage

CAPACITY = 2048


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as well as good ones (ranking); labels of held-out documents are not learned from."""
    prepare(spark)
    return ranking.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep the rules, without the lines that their host repeats (rules)."""
    prepare(spark)
    return recounted(rules.apply_rules(docs), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks they share with earlier ones (alignment); those left without a word go."""
    prepare(spark)
    found = alignment.without_overlaps(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(rules.WORD)
    return recounted(found.where(~F.coalesce(emptied, F.lit(False))), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike in at least 0.8 of their five-word shingles (minhash)."""
    prepare(spark)
    return minhash.without_near_duplicates(docs, width=5, similarity=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces in sequences of CAPACITY tokens (packing)."""
    import public_tokenizers

    prepare(spark)
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, end_id=0)
    return packing.pack(cut, CAPACITY)


def recounted(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the characters of the new text counted."""
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

# Learned scores, hashes and token ids are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; every stage's result is written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
