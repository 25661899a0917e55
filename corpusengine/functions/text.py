"""Row-local text functions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from corpusengine import constants as C


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_control(text: Column | str) -> Column:
    """Cut blanks and control characters at both ends."""
    return F.btrim(as_column(text), F.lit(C.TRIM_CHARACTERS))


def split_java(text: Column | str, pattern: str = C.TOKEN_SEPARATOR) -> Column:
    """Split and drop the empty parts at the end; an empty text is one empty part, a text of separators is none."""
    text = as_column(text)
    body = F.regexp_replace(text, rf"(?:{pattern})+\z", "")
    return (
        F.when((text != "") & (body == ""), F.array().cast("array<string>"))
        .when(text.isNotNull(), F.split(body, pattern))
    )


def tokenize_sep(text: Column | str, pattern: str) -> Column:
    """Lower-case, split, drop empty tokens."""
    return F.filter(F.split(F.lower(as_column(text)), pattern), lambda token: token != "")


def tokenize_space(text: Column | str) -> Column:
    return tokenize_sep(text, C.TOKEN_SEPARATOR)


def tokenize_white(text: Column | str) -> Column:
    """Lower-case and split on single white space characters, keeping inner empty tokens."""
    return split_java(F.lower(as_column(text)), r"\s")


def tokens(text: Column | str, mode: str = "word") -> Column:
    """Segment a text: ``space``, ``word`` (runs of letters and digits) or ``cjk_bigram``."""
    text = as_column(text)
    if mode == "space":
        return F.filter(F.split(text, C.TOKEN_SEPARATOR), lambda token: token != "")
    if mode == "word":
        return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    if mode == "cjk_bigram":
        runs = F.regexp_extract_all(text, F.lit(rf"{C.CJK_PATTERN}+|[\p{{L}}\p{{N}}&&[^一-龥]]+"), F.lit(0))
        return F.flatten(F.transform(runs, _bigrams_of_cjk_run))
    raise ValueError(f"unknown token mode {mode!r}")


def _bigrams_of_cjk_run(run: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1)))
    return F.when(run.rlike(C.CJK_PATTERN), F.transform(starts, lambda at: run.substr(at, F.lit(2)))).otherwise(
        F.array(run)
    )


def parse_tagged(text: Column | str) -> Column:
    """``word/tag word/tag`` as an array of (word, tag); parts without a tag are left out."""

    def split_once(part: Column) -> tuple[Column, Column]:
        word = F.substring_index(part, C.TAG_SEPARATOR, 1)
        return word, part.substr(F.length(word) + 2, F.length(part))

    def pair(part: Column) -> Column:
        word, rest = split_once(part)
        return F.struct(word.alias("word"), F.substring_index(rest, C.TAG_SEPARATOR, 1).alias("tag"))

    parts = F.split(as_column(text), C.TOKEN_SEPARATOR)
    tagged = F.filter(parts, lambda part: F.ltrim(split_once(part)[1], F.lit(C.TAG_SEPARATOR)) != "")
    return F.transform(tagged, pair)


def is_keyword_token(word: Column, tag: Column) -> Column:
    """Long enough and of a content-bearing word kind. Stop words are a table; see ``drop_words``."""
    return ~F.substring(tag, 1, 1).isin(C.EXCLUDED_TAG_INITIALS) & (F.length(trim_control(word)) > 1) & (tag != "")


def contains_cjk(text: Column | str) -> Column:
    return as_column(text).rlike(C.CJK_PATTERN)


def combine(first: Column | str, second: Column | str) -> Column:
    """Both texts with a space between; one alone when the other is null; null when both are."""
    first, second = as_column(first), as_column(second)
    return F.when(first.isNotNull() | second.isNotNull(), F.concat_ws(" ", first, second))


def origin_flag(site: Column | str, source: Column | str) -> Column:
    """'1' when the site is one of the sources named after the label, else '0'."""
    named = F.regexp_replace(as_column(source), C.ORIGIN_LABEL_PATTERN, "")
    sources = split_java(trim_control(named), C.ORIGIN_SPLIT_PATTERN)
    return F.when(F.array_contains(sources, as_column(site)), "1").otherwise("0")


def clean_text(text: Column | str) -> Column:
    spaced = F.regexp_replace(F.regexp_replace(as_column(text), f"{C.IDEOGRAPHIC_SPACE}+", " "), " +", " ")
    return trim_control(F.regexp_replace(F.regexp_replace(spaced, "&nbsp;?", "\n"), "\n+", "\n"))


def split_sentences(text: Column | str, marks: str = C.SENTENCE_MARKS, short: int = C.SHORT_SENTENCE) -> Column:
    """Sentences longer than ``short`` characters, in order."""
    pieces = F.split(as_column(text), f"[{re.escape(C.LINE_BREAKS + marks)}]+")
    return F.filter(F.transform(pieces, _single_spaced), lambda piece: F.length(piece) > short)


def _single_spaced(text: Column) -> Column:
    return trim_control(F.regexp_replace(F.regexp_replace(text, f"{C.IDEOGRAPHIC_SPACE}+", " "), " +", " "))


def split_clauses(title: Column | str, content: Column | str, marks: str = C.CLAUSE_MARKS) -> Column:
    """Clauses of title and content; the title's first clause is element 0 even when the title is empty."""
    empty = F.lit("")
    whole = F.concat(F.coalesce(as_column(title), empty), F.lit(C.FULL_STOP), F.coalesce(as_column(content), empty))
    return F.split(whole, f"[{re.escape(marks)}]")


def round_half_up_2(share: Column) -> Column:
    """A share between 0 and 1 to two decimals, by the exact binary value of the double: 0.075 is just below its tie.

    In units of 2**-60 every double of at least 2**-8 is a whole number, and any smaller one rounds to 0. Null for what
    is no number.
    """
    units = (share * F.lit(float(1 << 60))).try_cast("bigint").cast("decimal(20,0)")
    half, one = (F.lit(n).cast("decimal(20,0)") for n in (1 << 59, 1 << 60))
    return F.call_function("div", units * 100 + half, one) / 100


def contains_either_way(first: Column, second: Column) -> Column:
    return F.contains(first, second) | F.contains(second, first)
