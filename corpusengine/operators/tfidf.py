"""TF-IDF over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusengine.functions.text import split_java
from corpusengine.operators import lookup
from corpusengine.operators.each import counted, each
from corpusengine.operators.lookup import is_small
from corpusengine.session import stage


def word_counts(df: DataFrame, id_col: str, words_col: str, unique: bool = False) -> DataFrame:
    """(id, word, n). With ``unique`` ids a document's words are counted in its row and nothing is shuffled; parts of a
    document in several rows meet by id and word."""
    if unique:
        rows = counted(df.select(id_col, split_java(words_col).alias("_words")), "_words", "_counts")
        return each(rows, [id_col], "_counts", "_count").select(id_col, F.col("_count.item").alias("word"), "_count.n")
    words = each(df, [id_col], split_java(words_col), "word")
    return words.groupBy(id_col, "word").agg(F.count("*").alias("n"))


def tfidf(df: DataFrame, id_col: str, words_col: str, word_as: str | None = None) -> DataFrame:
    """(id, word, tfidf) with tf = n / distinct words and idf = ln(ids / ids with the word + 0.01)."""
    n_rows, n_ids = df.agg(F.count("*"), F.countDistinct(id_col)).first()
    counts = stage(word_counts(df, id_col, words_col, n_rows == n_ids), "word-counts")
    spread = stage(counts.groupBy("word").agg(F.count("*").alias("df")), "word-spread")
    n_words = spread.agg(F.count("*")).scalar()
    joined = counts.join(F.broadcast(spread), "word") if is_small(spread) else with_spread(counts, spread)
    weight = F.col("n") / n_words * F.log(n_ids / F.col("df") + F.lit(0.01))
    return joined.select(id_col, F.col("word").alias(word_as or words_col), weight.alias("tfidf"))


def with_spread(counts: DataFrame, spread: DataFrame) -> DataFrame:
    """``counts`` with ``df`` of the word. Most rows are of frequent words, which are sent to the tasks, as many as may be;
    rows of the others are few, and are shuffled. A word that is not sent is in fewer rows than any that is."""
    least = least_sent(spread)
    common = F.broadcast(spread.where(F.col("df") >= least))
    rare = counts.join(common.select("word"), "word", "left_anti").join(spread.where(F.col("df") < least), "word")
    return counts.join(common, "word").unionByName(rare)


def least_sent(spread: DataFrame) -> int:
    """The least ``df``, in steps of an eighth of a power of two, from which all words together are within the bounds of a
    broadcast; beyond every word's if there is none."""
    step = F.floor(F.log2("df") * 8).alias("step")
    size = F.sum(F.octet_length("word") + 8).alias("bytes")
    steps = spread.groupBy(step).agg(F.count("*").alias("rows"), size, F.min("df").alias("least"), F.max("df").alias("most"))
    rows = n_bytes = 0
    least = None
    for row in sorted(steps.collect(), key=lambda row: -row["step"]):
        least = row["most"] + 1 if least is None else least
        rows, n_bytes = rows + row["rows"], n_bytes + row["bytes"]
        if rows > lookup.BROADCAST_ROWS or n_bytes > lookup.BROADCAST_BYTES:
            return least
        least = row["least"]
    return 1
