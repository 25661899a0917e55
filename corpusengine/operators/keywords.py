"""Keywords: rank the words of a document by co-occurrence, choose, merge neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.functions.solve import keyword_tokens, likely_pairs, tagged_parts, word_links, word_ranks
from corpusengine.functions.text import as_column, contains_either_way
from corpusengine.operators.each import each
from corpusengine.operators.lookup import attach, without_words


def tagged_words(df: DataFrame, title: str, content: str) -> DataFrame:
    """``df`` with ``title_words`` and ``words``: the tagged words of the title, and of title and content.

    Words are null without content.
    """
    parsed = df.withColumn("_parsed", tagged_parts(F.col(title), F.col(content)))
    return parsed.select(*df.columns, "_parsed.title_words", "_parsed.words")


def kept_words(
    df: DataFrame, words: str = "words", stop_words: DataFrame | list[str] | None = None, out: str = "kept"
) -> DataFrame:
    """``df`` with the array of words that take part in the ranking, in order."""
    nested = df.withColumn("_content", keyword_tokens(F.col(words))).withColumn(out, F.array("_content")).drop("_content")
    return without_words(nested, out, stop_words).withColumn(out, F.flatten(out))


def sliding_cooccurrence(df: DataFrame, id_col: str, kept: str = "kept", window: int = C.KEYWORD_WINDOW) -> DataFrame:
    """(id, src, dst): unequal words less than ``window`` places apart, both directions.

    A text shorter than the window has no pairs. Pairs are found and told apart inside the row, as one number made of
    the numbers of both words, so the time is in proportion to the tokens, but for the sort; nothing is shuffled.
    """
    rows = df.select(id_col, word_links(F.col(kept), window).alias("_links"))
    return each(rows, [id_col], "_links", "link").select(id_col, "link.src", "link.dst")


def textrank_words(
    df: DataFrame,
    kept: str = "kept",
    window: int = C.KEYWORD_WINDOW,
    damping: float = C.DAMPING,
    max_rounds: int = C.MAX_ROUNDS,
    min_diff: float = C.MIN_DIFF,
) -> DataFrame:
    """``df`` with ``ranked``: array<struct<word, score>> of the kept words, ranked inside the row."""
    return df.withColumn("ranked", word_ranks(F.col(kept), window, damping, max_rounds, min_diff))


def candidate_words(ranked: Column | str, n_keywords: int = C.KEYWORD_COUNT) -> Column:
    """The best words, best first: more than are wanted, since some will be merged."""
    return F.slice(_best_first(ranked), 1, max(C.KEYWORD_CANDIDATES, n_keywords))


def _best_first(words: Column | str) -> Column:
    words = F.col(words) if isinstance(words, str) else words
    ordered = F.sort_array(F.transform(words, lambda w: F.struct((-w["score"]).alias("down"), w["word"].alias("word"))))
    return F.transform(ordered, lambda w: F.struct(w["word"].alias("word"), (-w["down"]).alias("score")))


def title_boost(candidates: Column | str, title_words: Column | str) -> Column:
    """Candidates with the score of title words doubled, best first."""

    def boosted(w: Column) -> Column:
        factor = F.when(F.array_contains(title_words, w["word"]), C.TITLE_BOOST).otherwise(1.0)
        return F.struct(w["word"].alias("word"), (w["score"] * factor).alias("score"))

    return _best_first(F.transform(candidates, boosted))


def select_distinct_keywords(candidates: Column | str, n_keywords: int = C.KEYWORD_COUNT) -> Column:
    """The first candidates of which none is part of another."""

    def choose(chosen: Column, w: Column) -> Column:
        related = F.exists(chosen, lambda c: contains_either_way(c["word"], w["word"]))
        return F.when((F.size(chosen) >= n_keywords) | related, chosen).otherwise(F.concat(chosen, F.array(w)))

    return F.aggregate(candidates, F.array().cast("array<struct<word:string,score:double>>"), choose)


def adjacent_pairs(words: Column | str) -> Column:
    """array<struct<left, right>>: each word of an array with the next one."""
    size = F.size(F.coalesce(words, F.array().cast("array<string>")))
    length = F.greatest(size - 1, F.lit(0))
    return F.arrays_zip(F.slice(words, 1, length).alias("left"), F.slice(words, 2, length).alias("right"))


def merge_adjacent(keywords: Column | str, words: Column | str) -> Column:
    """Keywords that stand next to each other in the text become one, with the larger score.

    ``words`` is the text as a word array. Merges follow the text, and a merged keyword can merge again.
    """
    def merge(now: Column, pair: Column) -> Column:
        left = F.filter(now, lambda k: k["word"] == pair["left"])
        right = F.filter(now, lambda k: k["word"] == pair["right"])
        both = (F.size(left) > 0) & (F.size(right) > 0) & (F.lower(pair["left"]) != F.lower(pair["right"]))
        joined = F.struct(
            F.concat(pair["left"], pair["right"]).alias("word"),
            F.greatest(F.get(left, 0)["score"], F.get(right, 0)["score"]).alias("score"),
        )
        others = F.filter(now, lambda k: (k["word"] != pair["left"]) & (k["word"] != pair["right"]))
        return F.when(both, F.concat(others, F.array(joined))).otherwise(now)

    # A keyword of any later stage begins and ends with one of the first stage.
    return F.aggregate(likely_pairs(as_column(keywords), as_column(words)), keywords, merge)


def remove_word_filter(keywords: DataFrame, remove: DataFrame | None, word: str = "word") -> DataFrame:
    """Keyword rows without listed words and without words that contain a banned part."""
    for banned in C.BANNED_SUBSTRINGS:
        keywords = keywords.where(~F.contains(word, F.lit(banned)))
    if remove is None:
        return keywords
    return attach(keywords, remove.select(F.col(remove.columns[0]).alias(word)).distinct(), word, "left_anti")


def with_keywords(
    df: DataFrame,
    title: str,
    content: str,
    stop_words: DataFrame | list[str] | None = None,
    remove: DataFrame | list[str] | None = None,
    n_keywords: int = C.KEYWORD_COUNT,
    window: int = C.KEYWORD_WINDOW,
    banned: list[str] = C.BANNED_SUBSTRINGS,
    damping: float = C.DAMPING,
    max_rounds: int = C.MAX_ROUNDS,
    min_diff: float = C.MIN_DIFF,
    out: str = "keywords",
) -> DataFrame:
    """``df`` with up to ``n_keywords`` words of the tagged texts, best first, joined by spaces.

    Null without content. Nothing is shuffled: a document stays in its row from scan to result, whatever its size.
    """
    kept = df.columns
    words = kept_words(tagged_words(df, title, content), stop_words=stop_words)
    ranked = textrank_words(words, "kept", window, damping, max_rounds, min_diff)
    candidates = title_boost(candidate_words("ranked", n_keywords), F.col("title_words"))
    chosen = ranked.select(*kept, F.col("words.word").alias("_text"), candidates.alias("_candidates"))
    chosen = chosen.select(*kept, "_text", select_distinct_keywords("_candidates", n_keywords).alias("_chosen"))
    merged = chosen.select(*kept, "_text", _best_first(merge_adjacent(F.col("_chosen"), F.col("_text"))).alias("_merged"))
    if banned:
        parts = F.array(*map(F.lit, banned))
        merged = merged.withColumn("_merged", F.filter("_merged", lambda k: ~F.exists(parts, lambda b: F.contains(k["word"], b))))
    names = merged.select(*kept, F.col("_text").isNotNull().alias("_any"), F.array(F.col("_merged.word")).alias("_names"))
    left = without_words(names, "_names", remove)
    return left.withColumn(out, F.when(F.col("_any"), F.array_join(F.flatten("_names"), " "))).drop("_any", "_names")


def keywords(df: DataFrame, id_col: str, title: str, content: str, *args, out: str = "keywords", **options) -> DataFrame:
    """(id, keywords), one row per row of ``df``; options as for ``with_keywords``."""
    return with_keywords(df.select(id_col, title, content), title, content, *args, out=out, **options).select(id_col, out)
