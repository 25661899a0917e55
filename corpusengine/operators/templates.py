"""Weighted word templates per class, and classification by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W

from corpusengine import constants as C
from corpusengine.functions.solve import SCORE_DIGITS
from corpusengine.functions.text import split_java
from corpusengine.operators.lookup import is_small, join_hot_apart
from corpusengine.operators.tfidf import tfidf
from corpusengine.session import stage


def class_template(
    df: DataFrame,
    class_col: str,
    words_col: str,
    top_n: int = C.TEMPLATE_SIZE,
    keep_pattern: str | None = C.CJK_PATTERN,
) -> DataFrame:
    """(class, word, tfidf): each class' best ``top_n`` words; those that match, with weights that sum to 1."""
    return template_of(tfidf(df, class_col, words_col, "word"), class_col, top_n, keep_pattern)


def template_of(weights: DataFrame, class_col: str, top_n: int, keep_pattern: str | None) -> DataFrame:
    best_first = W.partitionBy(class_col).orderBy(F.desc("tfidf"), "word")
    top = weights.withColumn("r", F.row_number().over(best_first)).where(F.col("r") <= top_n)
    kept = top.where(F.col("word").rlike(keep_pattern)) if keep_pattern else top
    whole = F.sum("tfidf").over(W.partitionBy(class_col))
    return kept.select(
        F.col(class_col).alias("class"), "word", (F.col("tfidf") / F.nullif(whole, F.lit(0.0))).alias("tfidf")
    )


def template_word_map(template: DataFrame) -> DataFrame:
    """(word, classes): the classes a word speaks for, with weights; at most one entry per class."""
    return template.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("class", "tfidf"))).alias("classes"))


def template_classify(
    df: DataFrame, id_col: str, words_col: str, template: DataFrame, unknown: str = C.UNKNOWN_CLASS, out: str = "docClass"
) -> DataFrame:
    """(id, docClass): the class with the largest weight over all word occurrences; ``unknown`` without any."""
    words = df.select(id_col, F.explode_outer(split_java(words_col)).alias("word"))
    entries = stage(template.select("word", F.col("class").alias("_class"), F.col("tfidf").alias("_weight")), "template")
    if is_small(entries):
        joined = words.withColumn("n", F.lit(1)).join(F.broadcast(entries), "word", "left")
    else:
        joined = join_hot_apart(words.groupBy(id_col, "word").agg(F.count("*").alias("n")), entries, "word", "left")
    scored = (
        joined.groupBy(id_col, "_class")
        .agg(F.round(F.sum(F.col("n") * F.col("_weight")), SCORE_DIGITS).alias("_score"))
    )
    # The smallest of (score downwards, class) is the best class; rows without a class do not take part.
    best = F.min(F.when(F.col("_class").isNotNull(), F.struct((-F.col("_score")).alias("down"), "_class")))
    return scored.groupBy(id_col).agg(F.coalesce(best["_class"], F.lit(unknown)).alias(out))


def template_accuracy(
    df: DataFrame, class_col: str, predicted: str = "docClass", unknown: str = C.UNKNOWN_CLASS
) -> DataFrame:
    """One row: share of right classes among the documents with a known one."""
    right = F.count_if(F.col(class_col) == F.col(predicted))
    known = F.count_if(F.col(predicted) != unknown)
    return df.agg((right / F.nullif(known, F.lit(0))).alias("accuracy"))
