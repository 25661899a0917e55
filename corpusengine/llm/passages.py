"""Toxic passages: every segment of a text whose words speak for it more than chance does.

A word's score is its log-odds to stand in a toxic document, with a Dirichlet prior that pulls words seen in few
documents to 0, less a drift that makes long stretches of plain words cost. One scan, linear in the words, finds all
maximal segments: none of them can be made longer or shorter with a larger sum, and they don't overlap. In plain text
the best sum of n words is distributed as the maximum of many: P(sum >= x) = 1 - exp(-K * n * exp(-lambda * x)).
Lambda and K follow from the best sums of plain documents. A segment of sum x has the evidence
lambda * x - log(K * n); it is a passage if chance makes fewer than one such segment in twenty documents. The evidence
of a document's passages is added up, and a logistic curve over the labelled documents makes it a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import documents, query
from corpusengine.session import stage

# Labelled texts of each class that are learned from, at most: those with the smallest hash of their id.
SAMPLE = 5_000
# Words that get a score: their log-odds are so many standard deviations from 0. At most MODEL_WORDS, the surest ones;
# all others only have the drift.
SURE = 3.0
MODEL_WORDS = 1 << 16
# Strength of the prior, in documents, and the cost of a word in nats.
PRIOR = 10.0
DRIFT = 0.25
# A passage's evidence is above this: exp(-3) segments are expected by chance.
SIGNIFICANT = 3.0

# ASCII letters are folded; every other ASCII character stands between words. Bytes of other letters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_words = re.compile(rb"[a-z\x80-\xff]+").finditer
SEGMENTS = "array<struct<start: int, end: int, sum: double, evidence: double>>"


@dataclass
class Model:
    """Scores of words, the two parameters of chance, and the logistic curve over log(1 + evidence)."""

    words: dict[bytes, float]
    scale: float = 1.0
    log_k: float = 0.0
    intercept: float = -math.inf
    slope: float = 0.0

    def evidence(self, total: float, n: int) -> float:
        return self.scale * total - self.log_k - math.log(max(n, 1))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (first, end, sum) of a sequence of scores, in order.

    Segments are put together from positive scores. Each keeps the place of the last one before it that begins below
    it, so that finding where a segment joins in skips all that begin above: the time is linear.
    """
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum behind, last one that begins below
    for at in np.flatnonzero(scores > 0).tolist():
        first, below, behind = at, float(totals[at]), float(totals[at + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= below:
                j = found[j][4]
            if j < 0 or found[j][3] >= behind:
                found.append((first, at + 1, below, behind, j))
                break
            first, below = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, behind - below) for first, end, below, behind, _ in found]


def scan(data: bytes, words: dict[bytes, float]) -> tuple[int, list[tuple[int, int, float]]]:
    """The number of words of a text and its maximal segments."""
    split = data.translate(_FOLD).split()
    scores = np.fromiter(map(words.get, split, repeat(-DRIFT)), float, len(split))
    return len(split), segments(scores)


def passages(data: bytes, model: Model) -> list[tuple[int, int, float, float]]:
    """(start, end, sum, evidence) of the passages of a text, as places of its characters."""
    n, found = scan(data, model.words)
    sure = [(*segment, e) for segment in found if (e := model.evidence(segment[2], n)) > SIGNIFICANT]
    if not sure:
        return []
    spans = [m.span() for m in _words(data.translate(_FOLD))]

    def place(byte: int) -> int:
        return len(data[:byte].decode(errors="replace"))

    return [(place(spans[a][0]), place(spans[b - 1][1]), total, e) for a, b, total, e in sure]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [one.as_py() or b"" for one in batch.column("text").cast(pa.binary())]


def _sample(docs: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, dict[int, int]]:
    """(text, label, fold) of up to SAMPLE different texts of each class, as a stored table, and the size of each class.

    Equal texts are one, toxic if any of them is labelled so, and of texts with the same smallest hash of three words
    one is kept: a text that was copied often, with changes or without, counts about once.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    rows = docs.select("doc_id", F.sha2("text", 256).alias("digest")).join(known, "doc_id")
    texts = rows.groupBy("digest").agg(F.max("label").alias("label"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    texts = stage(texts, "labelled-texts")
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    order = F.xxhash64("doc_id"), F.col("digest")
    chosen = [texts.where(F.col("label") == value).orderBy(*order).limit(SAMPLE) for value in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).select("doc_id", "digest", "label")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.sha2("text", 256) == F.col("digest"))
    found = found.select("text", F.col("label").cast("int")).mapInArrow(_sketched, "text string, label int, sketch long")
    fold = F.pmod("sketch", F.lit(2)).cast("int").alias("fold")
    return stage(found.dropDuplicates(["sketch"]).select("text", "label", fold), "sample"), sizes


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With the smallest hash of three words in a row, or of all words if there are fewer."""
    for batch in batches:
        made = []
        for data in _texts(batch):
            words = data.split()
            runs = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [words]
            made.append(min(xxhash.xxh64_intdigest(b" ".join(run)) for run in runs) >> 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.int64())], ["text", "label", "sketch"])


_COUNTED = pa.schema([("word", pa.string()), ("kind", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, kind, documents); kind is 2 * label + fold."""
    for batch in batches:
        kinds = [2 * y + f for y, f in zip(batch.column("label").to_pylist(), batch.column("fold").to_pylist(), strict=True)]
        found: list[Counter] = [Counter() for _ in range(4)]
        for kind, data in zip(kinds, _texts(batch), strict=True):
            found[kind].update(set(data.translate(_FOLD).split()))
        rows = [(word.decode(errors="replace"), kind, n) for kind in range(4) for word, n in found[kind].items()]
        words, kinds, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(kinds, pa.int32()), pa.array(n, pa.int64())], schema=_COUNTED)


def log_odds(toxic: Column, plain: Column, n_toxic: int, n_plain: int) -> tuple[Column, Column]:
    """Log-odds of a word found in so many documents of each class, and how many standard deviations they are."""
    share = n_toxic / (n_toxic + n_plain)
    a, b = toxic + PRIOR * share, plain + PRIOR * (1 - share)
    odds = F.log(a / b) - math.log(share / (1 - share))
    return odds, odds / F.sqrt(1 / a + 1 / b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learn from the rows of ``docs`` with a label, 1 being toxic; other or missing labels are passed over.

    Two halves of the sample score each other, so chance and curve are measured on texts that the words were not
    learned from; the model's words are learned from both. Only the words of the model, at most MODEL_WORDS, and the
    sums of the sample's texts come to the driver. Without texts of both classes in both halves nothing is learned, and
    every text has the score 0.
    """
    sample, stands_for = _sample(docs, labels, label)
    sizes = {r["kind"]: r["n"] for r in sample.groupBy((2 * F.col("label") + F.col("fold")).alias("kind")).agg(F.count("*").alias("n")).collect()}
    if any(sizes.get(k, 0) == 0 for k in range(4)):
        return Model({})
    counted = sample.mapInArrow(_count, "word string, kind int, n long")

    def of(kind: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    table = counted.groupBy("word").agg(
        *[of(k).alias(f"n{k}") for k in range(4)]
    )
    n = [F.col(f"n{k}") for k in range(4)]
    whole, sure = log_odds(n[2] + n[3], n[0] + n[1], sizes[2] + sizes[3], sizes[0] + sizes[1])
    halves = [log_odds(n[3 - f], n[1 - f], sizes[3 - f], sizes[1 - f])[0] for f in (0, 1)]
    table = table.select("word", *[(o - DRIFT).alias(c) for o, c in zip([*halves, whole], ("w0", "w1", "w"), strict=True)], sure.alias("sure"))
    kept = table.where(F.abs("sure") >= SURE).orderBy(F.abs("sure").desc(), "word").limit(MODEL_WORDS).collect()
    words = {r["word"].encode(): r["w"] for r in kept}
    crossed = [{r["word"].encode(): r[f"w{f}"] for r in kept} for f in (0, 1)]
    model = Model(words)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(d, crossed[f]) for d, f in zip(_texts(batch), batch.column("fold").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([sorted((s for *_, s in found), reverse=True)[:64] for _, found in rows], pa.list_(pa.float64())),
                ],
                ["label", "n", "sums"],
            )

    rows = sample.mapInArrow(sums, "label int, n long, sums array<double>").collect()
    plain = [r for r in rows if r["label"] == 0]
    model.scale, model.log_k = chance([r["sums"][0] if r["sums"] else 0.0 for r in plain], [r["n"] for r in plain])
    evidence = np.array([_total([model.evidence(s, r["n"]) for s in r["sums"]]) for r in rows])
    y = np.array([r["label"] for r in rows], float)
    weight = np.where(y == 1, stands_for[1] / max(y.sum(), 1), stands_for[0] / max((1 - y).sum(), 1))
    model.intercept, model.slope = _logistic(np.log1p(evidence), y, weight)
    return model


def _total(evidence: list[float]) -> float:
    return sum(e for e in evidence if e > SIGNIFICANT)


def chance(best: list[float], n: list[int]) -> tuple[float, float]:
    """Lambda and log(K) of the best sums of plain texts of n words.

    With them lambda * best - log(K * n) has the median and the 0.95 quantile of the distribution of maxima. Lambda is
    found by bisection, since the spread of lambda * best - log(n) grows with it; without any spread it is the largest.
    """
    sums, logs = np.array(best), np.log(np.maximum(np.array(n, float), 1))
    low_mark, high_mark = (-math.log(-math.log(q)) for q in (0.5, 0.95))
    low, high = 0.0, 16.0
    for _ in range(50):
        middle = (low + high) / 2
        a, b = np.quantile(middle * sums - logs, [0.5, 0.95])
        low, high = (low, middle) if b - a > high_mark - low_mark else (middle, high)
    return high, float(np.quantile(high * sums - logs, 0.5)) - low_mark


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not negative) of the weighted logistic curve, lightly penalised."""
    both, at = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    weight = weight / weight.sum() * len(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(both @ at, -30, 30)))
        slope = both.T @ (weight * (y - p)) - 0.01 * at
        step = np.linalg.solve((both * (weight * p * (1 - p))[:, None]).T @ both + 0.01 * np.eye(2), slope)
        at += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), max(float(at[1]), 0.0)


def with_passages(docs: DataFrame, model: Model, out: str = "passages", score: str = "score") -> DataFrame:
    """``docs`` with the passages of every whole text and the document's score from 0 to 1.

    ``start`` and ``end`` count characters. A null or empty text has no passage and the least score. Rows, repeated
    ids and other columns stay as they are; columns of the names given for the results are replaced.
    """
    names = [c for c in docs.columns if c not in (out, score)]
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes if name in names)
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sum", pa.float64()), ("evidence", pa.float64())]))
    keys = ("start", "end", "sum", "evidence")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [passages(data, model) for data in _texts(batch)]
            totals = [model.intercept + model.slope * math.log1p(sum(p[3] for p in row)) for row in rows]
            made = pa.array([[dict(zip(keys, p, strict=True)) for p in row] for row in rows], shape)
            scores = pa.array([1 / (1 + math.exp(-t)) if t > -700 else 0.0 for t in totals], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], made, scores], [*names, out, score])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, f"{kinds}, `{out}` {SEGMENTS}, `{score}` double")


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs.where(~held_out()), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = with_passages(docs, model).drop("text")
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int")
    return rows.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
