"""Quality of predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, functions as F


def weighted_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: F1 per class, averaged by the class' share of the labels. One pass and one row per class."""
    sides = F.array(
        F.struct(F.col(label).alias("class"), F.lit(1).alias("is_label"), F.lit(0).alias("is_prediction")),
        F.struct(F.col(prediction).alias("class"), F.lit(0).alias("is_label"), F.lit(1).alias("is_prediction")),
    )
    cells = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    counted = cells.select("n", (F.col(label) == F.col(prediction)).alias("hit"), F.explode(sides).alias("side"))
    per_class = counted.groupBy("side.class").agg(
        F.sum(F.when(F.col("hit"), F.col("n") * F.col("side.is_label")).otherwise(0)).alias("hits"),
        F.sum(F.col("n") * F.col("side.is_label")).alias("labels"),
        F.sum(F.col("n") * F.col("side.is_prediction")).alias("predictions"),
    )
    f1 = 2 * F.col("hits") / (F.col("labels") + F.col("predictions"))
    return per_class.agg((F.sum(f1 * F.col("labels")) / F.nullif(F.sum("labels"), F.lit(0))).alias("f1"))


def confusion(df: DataFrame, label: str, predictions: list[str]) -> DataFrame:
    """(model, label, predicted, n): how often each model predicted what, in one pass over the rows."""
    said = F.array(*[F.struct(F.lit(p).alias("model"), F.col(p).alias("predicted")) for p in predictions])
    rows = df.select(F.col(label).alias("label"), F.explode(said).alias("said"))
    return rows.groupBy("said.model", "label", "said.predicted").agg(F.count("*").alias("n"))


def member_scores(df: DataFrame, label: str, predictions: list[str]) -> dict[str, float]:
    """Weighted F1 of each prediction column; rows are read once for all of them. 0 without rows."""
    cells = confusion(df, label, predictions)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("labels"), F.lit(0).cast("long").alias("predicted_as")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("labels"), F.col("n").alias("predicted_as")),
    )
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    rows = cells.select("model", hit.alias("hits"), F.explode(sides).alias("side"))
    # A hit is told twice, once from each side.
    by_class = rows.groupBy("model", "side.class").agg(
        F.sum("hits").alias("twice"), F.sum("side.labels").alias("labels"), F.sum("side.predicted_as").alias("said")
    )
    f1 = F.col("twice") / (F.col("labels") + F.col("said"))
    scores = by_class.groupBy("model").agg((F.sum(f1 * F.col("labels")) / F.sum("labels")).alias("f1"))
    found = {r["model"]: r["f1"] for r in scores.collect()}
    return {p: found.get(p, 0.0) for p in predictions}


def evaluator_f1(df: DataFrame, label: str, prediction: str) -> float:
    """The same by Spark ML's evaluator."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="f1").evaluate(df)
