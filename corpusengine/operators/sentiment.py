"""Lexicon sentiment with negations and adverbs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from corpusengine import constants as C
from corpusengine.functions.fold import scorer
from corpusengine.functions.text import round_half_up_2, split_clauses, tokens, trim_control
from corpusengine.operators.each import each
from corpusengine.operators.lookup import attach, is_small
from corpusengine.session import stage


def modifier_dictionary(lexicon: DataFrame, adverbs: DataFrame, negations: DataFrame) -> DataFrame:
    """One row per word: (word, weight, adverb, negates); a word may play several parts."""
    parts = [
        lexicon.select("word", "weight", F.lit(None).cast("double").alias("adverb"), F.lit(False).alias("negates")),
        adverbs.select("word", F.lit(None).cast("double"), F.col("weight"), F.lit(False)),
        negations.select("word", F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(True)),
    ]
    merged = parts[0].union(parts[1]).union(parts[2])
    return merged.groupBy("word").agg(
        F.max("weight").alias("weight"), F.max("adverb").alias("adverb"), F.bool_or("negates").alias("negates")
    )


def with_clauses(
    df: DataFrame,
    title: str,
    content: str,
    lexicon: DataFrame,
    adverbs: DataFrame,
    negations: DataFrame,
    mode: str = "word",
    marks: str = C.CLAUSE_MARKS,
    out: str = "clauses",
) -> DataFrame:
    """``df`` with the scores of the clauses of each row: clause 0 in any case, and those with a sentiment word.

    A sentiment word is changed by the negations and adverbs between it and the sentiment word before it. Before the
    first one they count from position 1, so the token at position 0 changes nothing.

    Rows stay where they are, whatever their ids and however many have the same text: the dictionary, whose size is
    measured first, goes to the tasks and a clause is folded over there. A dictionary that is too large to be sent is
    joined with the tokens instead, by a number that each row gets; there too no two rows meet.
    """
    words = modifier_dictionary(lexicon, adverbs, negations).where(F.col("word").isNotNull())
    clauses = split_clauses(title, content, marks)
    if is_small(words):
        entries = {row["word"]: (row["weight"], row["adverb"], row["negates"]) for row in words.toLocalIterator()}
        lists = F.transform(clauses, lambda text: F.transform(tokens(text, mode), trim_control))
        return df.withColumn(out, scorer(entries)(lists))
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    found = _joined_clauses(rows, "_row", clauses, words, mode)
    listed = found.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct(F.col("clause").cast("int").alias("clause"), "score"))).alias(out)
    )
    return rows.drop(out).join(listed, "_row", "left").select(*[c for c in df.columns if c != out], out)


def clause_sentiment(
    df: DataFrame,
    id_col: str,
    title: str,
    content: str,
    lexicon: DataFrame,
    adverbs: DataFrame,
    negations: DataFrame,
    mode: str = "word",
    marks: str = C.CLAUSE_MARKS,
) -> DataFrame:
    """(id, clause, score) of clauses with a sentiment word, and of clause 0 in any case; scores as in ``with_clauses``.

    Rows of equal ids are parts of one document: different scores of a clause add up, equal ones count once.
    """
    rows = with_clauses(df.select(id_col, title, content), title, content, lexicon, adverbs, negations, mode, marks, "_clauses")
    found = each(rows, [id_col], "_clauses", "_found").select(id_col, "_found.clause", "_found.score")
    return found.groupBy(id_col, "clause").agg(F.sum_distinct("score").alias("score"))


def _joined_clauses(df: DataFrame, id_col: str, clauses: Column, words: DataFrame, mode: str) -> DataFrame:
    parts = each(df, [id_col], clauses, "clause", "text")
    found = parts.select(id_col, "clause", F.posexplode_outer(tokens("text", mode)).alias("pos", "word"))
    known = attach(found.withColumn("word", trim_control("word")), words, "word", "left")
    # Only dictionary words go on, and one row per document, so that none is lost.
    is_anchor = (F.col("clause") == 0) & (F.coalesce("pos", F.lit(0)) == 0)
    known = known.where(F.col("negates").isNotNull() | is_anchor)

    before = W.partitionBy(id_col, "clause").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    is_sentiment = F.col("weight").isNotNull()
    placed = known.withColumn("turn", F.count("weight").over(before)).withColumn(
        "last", F.coalesce(F.max(F.when(is_sentiment, F.col("pos"))).over(before), F.lit(0))
    )
    modifies = ~is_sentiment & (F.col("pos") > F.col("last"))
    negation_at = F.max(F.when(modifies & F.col("negates"), F.col("pos")))
    adverb_at = F.max(F.when(modifies & F.col("adverb").isNotNull(), F.col("pos")))
    factor = F.when(F.col("negates"), -1.0).otherwise(1.0) * F.coalesce("adverb", F.lit(1.0))
    order = (
        F.when(negation_at < adverb_at, C.NEGATION_BEFORE_ADVERB)
        .when(negation_at >= adverb_at, C.ADVERB_BEFORE_NEGATION)
        .otherwise(1.0)
    )
    changed = F.coalesce(F.product(F.when(modifies, factor)), F.lit(1.0))
    words_scored = placed.groupBy(id_col, "clause", "turn").agg((F.max("weight") * changed * order).alias("score"))
    by_clause = words_scored.groupBy(id_col, "clause").agg(F.sum("score").alias("score"))
    weight = F.when(F.col("clause") == 0, C.FIRST_CLAUSE_FACTOR).otherwise(1.0)
    return by_clause.where((F.col("clause") == 0) | F.col("score").isNotNull()).select(
        id_col, "clause", (F.coalesce("score", F.lit(0.0)) * weight).alias("score")
    )


def _shares(clauses: DataFrame, id_col: str) -> DataFrame:
    positive = F.sum(F.when(F.col("score") >= 0, F.col("score")).otherwise(0.0))
    negative = F.sum(F.when(F.col("score") < 0, -F.col("score")).otherwise(0.0))
    return clauses.groupBy(id_col).agg(positive.alias("positive"), negative.alias("negative"))


def _share(part: Column, other: Column) -> Column:
    """The share of ``part``. A sum beyond all doubles outweighs any other; of two such sums, and without a number, the
    share can't be told and is null."""
    whole, endless = part + other, F.lit(float("inf"))
    # The sum of two finite parts may be beyond all doubles; that of their quarters is not.
    quarters = part / 4 / (part / 4 + other / 4)
    return (
        F.when(whole == 0, 0.5)
        .when((part == endless) & (other < endless), 1.0)
        .when((other == endless) & (part < endless), 0.0)
        .when(whole == endless, round_half_up_2(quarters))
        .otherwise(round_half_up_2(part / F.nullif(whole, F.lit(0.0))))
    )


def percent_in_row(clauses: Column | str) -> Column:
    """[positive share, negative share] of an array of clause scores; [0.5, 0.5] without a signal."""

    def total(sign: int) -> Column:
        return F.aggregate(
            clauses, F.lit(0.0), lambda sum_, c: sum_ + F.when((c["score"] >= 0) == (sign > 0), sign * c["score"]).otherwise(0.0)
        )

    return F.array(_share(total(1), total(-1)), _share(total(-1), total(1)))


def sentiment_percent(clauses: DataFrame, id_col: str, out: str = "sentiment") -> DataFrame:
    """(id, [positive share, negative share]) from clause scores; [0.5, 0.5] without a signal."""
    shares = F.array(_share(F.col("positive"), F.col("negative")), _share(F.col("negative"), F.col("positive")))
    return _shares(clauses, id_col).select(id_col, shares.alias(out))


def sentiment_sign(clauses: DataFrame, id_col: str, out: str = "sentiment") -> DataFrame:
    """(id, [1], [-1] or, without a signal, [0])."""
    sign = (
        F.when((F.col("positive") == 0) & (F.col("negative") == 0), 0.0)
        .when(F.col("positive") >= F.col("negative"), 1.0)
        .otherwise(-1.0)
    )
    return _shares(clauses, id_col).select(id_col, F.array(sign).alias(out))
