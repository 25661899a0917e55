"""Extractive summaries: rank sentences by similarity, drop near repeats, fill a length budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.functions.solve import SCORE_DIGITS, distinct_picks, sentence_ranks
from corpusengine.functions.text import clean_text, split_sentences, tokens
from corpusengine.operators.lookup import without_words


def sentence_tokens(
    df: DataFrame,
    text: str,
    stop_words: DataFrame | list[str] | None = None,
    mode: str = "word",
    marks: str = C.SENTENCE_MARKS,
) -> DataFrame:
    """``df`` with ``cleaned``, ``sentences`` and ``tokens``: cleaned text, its sentences and their tokens; none for a
    null text.
    """
    none = F.array().cast("array<string>")
    cleaned = df.withColumn("cleaned", clean_text(text))
    split = cleaned.withColumn("sentences", F.coalesce(split_sentences("cleaned", marks), none))
    segmented = split.withColumn("tokens", F.transform("sentences", lambda sentence: tokens(sentence, mode)))
    return without_words(segmented, "tokens", stop_words)


def sentence_weight_rules(
    sentences: Column | str, scores: Column | str, cue_phrases: list[str] = C.CUE_PHRASES
) -> Column:
    """Scores with cue sentences doubled and, unless it is one, the last sentence lowered."""
    phrases = F.array(*map(F.lit, cue_phrases)) if cue_phrases else F.array().cast("array<string>")
    count = F.size(sentences)

    def weigh(scored: Column, at: Column) -> Column:
        has_cue = F.exists(phrases, lambda phrase: F.contains(scored["sentence"], phrase))
        factor = F.when(has_cue, C.CUE_FACTOR).when(at == count - 1, C.LAST_SENTENCE_FACTOR).otherwise(1.0)
        return F.round(scored["score"] * factor, SCORE_DIGITS)

    return F.transform(F.arrays_zip(_named(sentences, "sentence"), _named(scores, "score")), weigh)


def _named(column: Column | str, name: str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).alias(name)


def candidate_count(cleaned: Column | str, sentences: Column | str, max_length: int = C.SUMMARY_LENGTH) -> Column:
    """How many sentences of mean length fit into the summary."""
    mean = F.floor(F.length(cleaned) / F.nullif(F.size(sentences), F.lit(0)))
    return F.floor(F.lit(max_length) / F.nullif(mean, F.lit(0))).cast("int")


def textrank_sentences(df: DataFrame, tokens_col: str = "tokens", **limits) -> DataFrame:
    """``df`` with ``scores``: array<double>, one per sentence, ranked inside the row.

    Similarities can be negative, so scores can grow without bound, to infinities and what is no number. They are
    kept; ``redundancy_topk`` says how they are ordered.
    """
    limits = {"damping": C.DAMPING, "max_rounds": C.MAX_ROUNDS, "min_diff": C.MIN_DIFF, **limits}
    return df.withColumn("scores", sentence_ranks(F.col(tokens_col), **limits))


def redundancy_topk(
    df: DataFrame,
    tokens_col: str = "tokens",
    weights: str = "weights",
    size: str = "size",
    threshold: float = C.REDUNDANCY_THRESHOLD,
) -> DataFrame:
    """``df`` with ``picks``: array<struct<at, weight>>, sentences in the order taken, near repeats left out.

    Heaviest first and later first when equal; infinities stand where their sign puts them, and a weight that is no
    number comes after all others.
    """
    return df.withColumn("picks", distinct_picks(F.col(tokens_col), F.col(weights), F.col(size), threshold))


def length_budget_pick(ordered: Column | str, max_length: int = C.SUMMARY_LENGTH) -> Column:
    """The entries that fit, in their order: heaviest first, a sentence too long for what is left is passed over.

    ``ordered`` is array<struct<place, sentence, weight>> in text order. An entry without a number as its
    weight, or with minus infinity, is never taken.
    """
    heaviest_first = F.sort_array(
        F.transform(ordered, lambda s, at: F.struct((-s["weight"]).alias("down"), at.alias("at"), s["sentence"].alias("sentence")))
    )
    finite = F.filter(heaviest_first, lambda s: s["down"] < float("inf"))
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<struct<at:int,sentence:string>>").alias("kept"))

    def take(state: Column, s: Column) -> Column:
        used = state["used"] + F.length(s["sentence"])
        entry = F.struct(s["at"].alias("at"), s["sentence"].alias("sentence"))
        taken = F.struct(used.alias("used"), F.concat(state["kept"], F.array(entry)).alias("kept"))
        return F.when(used <= max_length, taken).otherwise(state)

    return F.sort_array(F.aggregate(finite, start, take, lambda state: state["kept"]))


def with_summary(
    df: DataFrame,
    text: str,
    max_length: int = C.SUMMARY_LENGTH,
    stop_words: DataFrame | list[str] | None = None,
    mode: str = "word",
    marks: str = C.SENTENCE_MARKS,
    cue_phrases: list[str] = C.CUE_PHRASES,
    threshold: float = C.REDUNDANCY_THRESHOLD,
    out: str = "summary",
    **ranking,
) -> DataFrame:
    """``df`` with ``out``: null without text, the cleaned text itself when it has no sentence."""
    kept = df.columns
    split = sentence_tokens(df.withColumn("_text", F.nullif(text, F.lit(""))), "_text", stop_words, mode, marks)
    ranked = textrank_sentences(split, "tokens", **ranking)
    size = F.coalesce(candidate_count("cleaned", "sentences", max_length), F.lit(0))
    weights = sentence_weight_rules("sentences", "scores", cue_phrases)
    picked = redundancy_topk(ranked.withColumn("weights", weights).withColumn("size", size), threshold=threshold)

    # Equal sentences share the place of the first of them.
    placed = F.transform(
        "picks",
        lambda pick: F.struct(
            F.array_position("sentences", F.get("sentences", pick["at"])).alias("place"),
            F.get("sentences", pick["at"]).alias("sentence"),
            pick["weight"].alias("weight"),
        ),
    )
    best = F.concat(F.get("sentences", F.get("picks", F.lit(0))["at"]), F.lit(C.FULL_STOP))
    ordered = picked.select(
        *kept, F.col("cleaned").alias("_cleaned"), best.alias("_best"), F.size("picks").alias("_n"), F.array_sort(placed).alias("_ordered")
    )
    within = F.array_join(length_budget_pick("_ordered", max_length)["sentence"], C.FULL_STOP)
    result = F.when(F.col("_n") == 0, F.col("_cleaned")).when(F.col("_n") > 1, F.coalesce(F.nullif(within, F.lit("")), "_best"))
    return ordered.withColumn(out, result.otherwise(F.col("_best"))).drop("_cleaned", "_best", "_n", "_ordered")


def summary(df: DataFrame, id_col: str, text: str, *args, out: str = "summary", **options) -> DataFrame:
    """(id, summary), one row per row of ``df``; options as for ``with_summary``."""
    return with_summary(df.select(id_col, text), text, *args, out=out, **options).select(id_col, out)
