"""A quality classifier learned from preferences (Bradley-Terry): of two documents, which is the better one.

A document's strength is a weighted sum of its signals, and the odds that one is preferred to another are the
exponential of the difference of their strengths. So the weights come from a logistic loss on differences of
signals, without an intercept. A quantile of the strengths, at the share of bad documents among the labelled ones,
then parts the good from the bad.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import documents, query
from corpusengine.llm.signals import NAMES, signals
from corpusengine.session import stage

# A row of the larger class is paired with so many of the smaller one, or with as many as it takes to get PAIRS in all.
PARTNERS = 4
PAIRS = 60_000
# The weight of the penalty on the squared weights.
PENALTY = 1e-4
# Labels that every task gets, at most; more are joined with the signals of all documents.
SHARED_LABELS = 200_000
ROUNDS = 25


@dataclass
class Ranking:
    """``strength`` of a text with signals x is weights * x; ``threshold`` is the strength that gets a score of 0.5."""

    weights: list[float]
    threshold: float


def with_signals(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``__signals``, an array of doubles, and without ``text`` unless it is to be kept.

    One pass over the whole texts; no other column is looked at. A null text counts as empty and has zeros. Rows,
    repeated ids and other columns stay as they are.
    """
    names = [c for c in docs.columns if keep_text or c != "text"]
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes if name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [signals(one.as_py() or "") for one in batch.column("text")]
            made = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], made], [*names, "__signals"])

    return docs.mapInArrow(run, f"{kinds}, __signals array<double>")


def numbered(rows: DataFrame, *by: Column | str) -> DataFrame:
    """``rows`` with ``__number``, from 0 in the order of ``by``. Only the size of each range comes to the driver."""
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    ranges = stage(ranges, "numbered").withColumn("__range", F.shiftright("__at", 33))
    before, starts = 0, []
    for row in sorted(ranges.groupBy("__range").agg(F.count("*").alias("n")).collect()):
        starts.append((row["__range"], before))
        before += row["n"]
    offsets = rows.sparkSession.createDataFrame(starts, "__range long, __before long")
    number = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return ranges.join(F.broadcast(offsets), "__range").select(*rows.columns, number.alias("__number"))


def added_up(rows: DataFrame, column: str, sums: Callable[[np.ndarray], list[np.ndarray]]) -> list[list[np.ndarray]]:
    """``sums`` of the matrix of an array column, one row of it each, of every task; a task adds up its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                found = sums(flat.reshape(batch.num_rows, -1))
                total = found if total is None else [x + y for x, y in zip(total, found)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x.ravel().tolist() for x in total], pa.list_(pa.float64()))], ["sums"])

    found = [np.array(row["sums"]) for row in rows.select(column).mapInArrow(run, "sums array<double>").collect()]
    size = len(sums(np.zeros((1, len(NAMES)))))
    return [found[i : i + size] for i in range(0, len(found), size)]


def spread(rows: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each signal; the deviation of one that does not vary is infinite."""
    parts = added_up(rows, column, lambda x: [np.full(1, len(x)), x.sum(0)])
    n = sum(float(part[0][0]) for part in parts)
    center = sum(part[1] for part in parts) / n
    squares = added_up(rows, column, lambda x: [((x - center) ** 2).sum(0)])
    scale = np.sqrt(sum(part[0] for part in squares) / n)
    scale[scale < 1e-9] = np.inf
    return center, scale


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str) -> DataFrame:
    """(key, label, ``__signals``) of every row of ``docs`` with a label of 0 or 1."""
    known = stage(labels.select(key, label).where(F.col(label).isin(0, 1)).dropDuplicates([key]), "labels")
    few = known.count() <= SHARED_LABELS
    if "__signals" not in docs.columns:
        # Without texts that have no label, when it is known early which those are.
        texts = docs.select(key, "text")
        docs = with_signals(texts.join(F.broadcast(known.select(key)), key, "left_semi") if few else texts)
    rows = docs.select(key, "__signals").join(F.broadcast(known) if few else known, key)
    return stage(rows.select(key, label, "__signals"), "labelled")


def pairs(known: DataFrame, label: str, key: str, counts: dict[int, int]) -> DataFrame:
    """(gap): the signals of a good row less those of a bad one. All rows take part, about as often as others of their
    class; a row of the larger class has different partners, numbered one after the other, and their number is fixed, so
    there are pairs in proportion to rows."""
    more, fewer = sorted((1, 0), key=lambda value: -counts[value])
    each = min(counts[fewer], max(PARTNERS, -(-PAIRS // counts[more])))
    order = [F.xxhash64(key), F.col(key), F.col("__signals")]
    some, others = (numbered(known.where(F.col(label) == value).select(key, "__signals"), *order) for value in (more, fewer))
    turns = F.explode(F.sequence(F.lit(0), F.lit(each - 1)))
    asked = some.select(F.col("__signals").alias("x"), "__number", turns.alias("turn"))
    asked = asked.select("x", ((F.col("__number") * each + F.col("turn")) % counts[fewer]).alias("__number"))
    met = asked.join(others.select(F.col("__signals").alias("y"), "__number"), "__number")
    sign = 1.0 if more == 1 else -1.0
    return stage(met.select(F.zip_with("x", "y", lambda x, y: (x - y) * sign).alias("gap")), "pairs")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> Ranking:
    """Learn from the rows of ``docs`` with a label, 1 being preferred to 0; other or missing labels are passed over.

    All of them are learned from, in ``pairs``, and the threshold is a quantile of all their strengths. Sums over the
    signals are all that comes to the driver. Without rows of both classes nothing is learned: all weights are 0 and
    every text has the score 0.5, which keeps it. ``docs`` has texts, or ``__signals`` already.
    """
    known = labelled(docs, labels, label, key)
    counts = {row[label]: row["n"] for row in known.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Ranking([0.0] * len(NAMES), 0.0)
    center, scale = spread(known, "__signals")
    gaps = pairs(known, label, key, counts)
    n = gaps.count()
    weights = np.zeros(len(NAMES))
    for _ in range(ROUNDS):

        def bent(x: np.ndarray, weights=weights) -> list[np.ndarray]:
            x = x / scale
            wrong = 1 / (1 + np.exp(np.clip(x @ weights, -500, 500)))
            return [x.T @ wrong, (x * (wrong * (1 - wrong))[:, None]).T @ x]

        parts = added_up(gaps, "gap", bent)
        slope = sum(part[0] for part in parts) / n - PENALTY * weights
        bend = sum(part[1] for part in parts).reshape(len(weights), -1) / n + PENALTY * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break

    raw = weights / scale
    own = strength(Ranking(raw.tolist(), float(center @ raw))).alias("strength")
    at = min(max(counts[0], 1), counts[0] + counts[1] - 1)
    sorted_rows = numbered(known.select(own, key), "strength", F.xxhash64(key))
    middle = sorted_rows.where(F.col("__number").isin(at - 1, at)).agg(F.avg("strength")).first()[0]
    return Ranking(raw.tolist(), float(middle + center @ raw))


def strength(ranking: Ranking) -> Column:
    """The strength above the threshold; a score of 0.5 is a strength of 0."""
    at = F.col("__signals")
    return sum((F.lit(w) * at[i] for i, w in enumerate(ranking.weights)), F.lit(-ranking.threshold))


def with_score(rows: DataFrame, ranking: Ranking) -> DataFrame:
    """``rows`` with ``score``, from 0 to 1 and 0.5 at the threshold, in place of ``__signals``."""
    return rows.withColumn("score", 1 / (1 + F.exp(-strength(ranking)))).drop("__signals")


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(key).cast("string")) % 3 == 1


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score``, learned from ``labels`` of the documents not held out."""
    rows = stage(with_signals(docs), "signals")
    ranking = fit(rows.where(~held_out()), labels)
    return with_score(rows, ranking)


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, with their columns."""
    ranking = fit(docs.where(~held_out()), labels)
    rows = with_signals(docs, keep_text=True)
    return rows.where(strength(ranking) >= 0).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored(documents(spark, sf_dir), labels)
    return rows.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
