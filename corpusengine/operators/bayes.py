"""Multinomial naive Bayes as a table: one row per hashed feature, made by one aggregation, applied by a join and a sum.

The same model as the pipeline of ``models.train_naive_bayes``: features are hashed term counts times
ln((N + 1) / (df + 1)), sums are smoothed by 1. Neither the features of a text nor those of the model are ever one
object in memory, so the number of features is no limit, and every probability can be looked at with SQL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.operators.each import counted, each
from corpusengine.operators.lookup import attach
from corpusengine.session import stage


@dataclass
class BayesTable:
    """``features``: (bucket, idf, logs), with ln(sum + 1) of the bucket's weights by class. A bucket without a row was
    never learned from: its idf is ``unseen`` and its logs are 0. By class, in the order of ``labels``: ``priors``, and
    ``rest``, the log of the smoothed total, which every feature of a text costs."""

    features: DataFrame
    labels: list[str]
    priors: list[float]
    rest: list[float]
    unseen: float
    n_features: int = C.HASH_FEATURES


def buckets(terms: DataFrame, term: str, n_features: int = C.HASH_FEATURES) -> DataFrame:
    """``terms`` with ``bucket``, the feature that Spark ML hashes a term to. Hashed once per different term."""
    once = terms.select(F.col(term).alias("_term")).distinct()
    hashed = HashingTF(inputCol="_terms", outputCol="_hashed", numFeatures=n_features).transform(
        once.withColumn("_terms", F.array("_term"))
    )
    place = F.regexp_extract(F.col("_hashed").cast("string"), r"\[(\d+)\]", 1).cast("int")
    known = stage(hashed.select(F.col("_term").alias(term), place.alias("bucket")), "buckets")
    return attach(terms, known, term)


def term_counts(df: DataFrame, keep: list[str], words: str, n_features: int) -> DataFrame:
    """(keep, bucket, tf): terms are counted in the row, then terms of one bucket together."""
    rows = counted(df.select(*keep, words), words, "_counts")
    terms = each(rows, keep, "_counts", "_count").select(*keep, F.col("_count.item").alias("term"), F.col("_count.n").alias("n"))
    return buckets(terms, "term", n_features).groupBy(*keep, "bucket").agg(F.sum("n").alias("tf"))


def fit_bayes_table(
    df: DataFrame, words: str, label: str, excluded_class: str | None = None, n_features: int = C.HASH_FEATURES
) -> BayesTable:
    """Learn from rows with an array of words and a label; rows without a label, or of the excluded class, are left out.

    Classes go by falling frequency, then by name. Only sums per class come to the driver.
    """
    rows = df.select(F.col(label).alias("class"), F.col(words).alias("words")).where(F.col("class").isNotNull())
    if excluded_class is not None:
        rows = rows.where(F.col("class") != excluded_class)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "labelled-words")
    sizes = rows.groupBy("class").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "class").collect()
    labels, n = [r["class"] for r in sizes], sum(r["n"] for r in sizes)
    terms = term_counts(rows, ["row", "class"], "words", n_features)
    # By bucket and class before anything meets: a term that all rows have is a few rows of each task.
    sums = terms.groupBy("bucket", "class").agg(F.count("*").alias("df"), F.sum("tf").alias("tf")).groupBy("bucket")
    by_class = [F.coalesce(F.sum(F.when(F.col("class") == c, F.col("tf"))), F.lit(0)) for c in labels]
    table = sums.agg(F.sum("df").alias("df"), F.array(*by_class).alias("tf"))
    idf = F.log((n + 1) / (F.col("df") + 1))
    table = table.select("bucket", idf.alias("idf"), F.transform("tf", lambda tf: tf * idf).alias("sums"))
    table = stage(table, "bayes-features")
    totals = table.agg(*[F.sum(F.get("sums", k)).alias(f"t{k}") for k in range(len(labels))]).first() if labels else []
    features = table.select("bucket", "idf", F.transform("sums", lambda s: F.log(s + 1)).alias("logs"))
    return BayesTable(
        features,
        labels,
        [math.log(r["n"] + 1) - math.log(n + len(labels)) for r in sizes],
        [math.log((t or 0.0) + n_features) for t in totals],
        math.log(n + 1),
        n_features,
    )


def apply_bayes_table(df: DataFrame, words: str, model: BayesTable, out: str = "nbClass", scores: str = "scores") -> DataFrame:
    """``df`` with the most likely class and the log probabilities of all classes, up to a constant.

    Equal scores go to the class that comes first. Rows keep their columns, whatever their ids; a row without words
    has the scores of the priors.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    terms = attach(term_counts(rows, ["_row"], words, model.n_features), model.features, "bucket", "left")
    weight = F.col("tf") * F.coalesce("idf", F.lit(model.unseen))
    places = range(len(model.labels))
    found = [F.sum(weight * (F.coalesce(F.get("logs", k), F.lit(0.0)) - model.rest[k])).alias(f"_s{k}") for k in places]
    summed = terms.groupBy("_row").agg(*found)
    values = [F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) + model.priors[k] for k in places]
    scored = rows.join(summed, "_row", "left").select(*df.columns, F.array(*values).alias(scores))
    return scored.withColumn(out, best(F.col(scores), model.labels))


def best(scores: Column, labels: list[str]) -> Column:
    """The label of the highest score, the first one of equals."""
    at = F.array_position(scores, F.array_max(scores)).cast("int") - 1
    return F.get(F.array(*map(F.lit, labels)), at)
