"""Quality rules over documents, and over the lines that the documents of a host share.

Everything is a DataFrame expression. A document's own counts are array expressions on its row. Lines are compared
by the hash of their trimmed lower-case form. A line that stands in many documents of a host is taken out of all of
them, and a document with little left is rejected.

Copies must not make each other's lines look like boilerplate. So a host's documents are told apart by a hash of all their
words in lower case: copies count as one document, and documents that differ in any word count each, however much of
them is shared. Copies are left to the operators that find copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import query
from corpusengine.operators.lookup import attach
from corpusengine.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
KEY = "__rules_key"


@dataclass(frozen=True)
class Limits:
    """A line goes if it stands in more than ``line_documents`` documents of a host and in more than ``line_share``
    of them (as it is, a host's size doesn't matter); a document is rejected if less than ``least_left`` of the characters of its lines stay.
    """

    least_words: int = 50
    most_repeated: float = 0.5
    line_documents: int = 50
    line_share: float = 0.0
    least_left: float = 0.2


def line_key(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(line)))


def filled_lines(text: Column | str) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of COUNTS, ``_words_key`` and ``_lines`` (line, chars), all from the row's own text.

    Words are runs without ASCII white space, and ``word_chars`` their code points. ``n_repeat_words`` counts the
    words that lie in a window of three words found twice or more in the text. Windows are sorted by hash, so the
    time is in proportion to n log n of a text's words. A null or empty text has zeros and no lines.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    lines = filled_lines(text)
    rows = docs.withColumns(
        {
            "_words": F.filter(F.split(text, BLANKS), lambda word: word != ""),
            "_filled": lines,
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        }
    )

    def window(i: Column) -> Column:
        words = [F.get("_words", i + k) for k in range(3)]
        return F.struct(F.xxhash64(*words).alias("h"), i.alias("i"))

    n = F.size("_words")
    windows = F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window)))
    rows = rows.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_words_key": F.xxhash64(F.lower(F.array_join("_words", " "))),
            "n_dup_lines": (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long"),
            "_windows": windows,
            "_lines": F.transform(
                "_filled", lambda line: F.struct(line_key(line).alias("line"), F.octet_length(line).alias("chars"))
            ),
        }
    ).drop("_words", "_filled")

    def again(window: Column, at: Column) -> Column:
        same = [F.get("_windows", at + k)["h"] == window["h"] for k in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    found = F.sort_array(F.transform(F.filter("_windows", again), lambda window: window["i"]))

    def cover(state: Column, at: Column) -> Column:
        new = at + 3 - F.greatest(at, state["end"])
        return F.struct((state["n"] + new).alias("n"), (at + 3).alias("end"))

    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    repeated = F.coalesce(F.aggregate(found, nothing, cover)["n"], F.lit(0)).cast("long")
    return rows.withColumn("n_repeat_words", repeated).drop("_windows")


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > 100 * limits.most_repeated * F.col("n_words")
    )


def frequent_lines(counted: DataFrame, limits: Limits) -> DataFrame:
    """(host, line) of the lines above the limits.

    Equal (host, line, words) are merged before any count, so a line that stands everywhere is counted by document in
    many tasks. Of such lines there are at most 1 / line_documents of all.
    """
    seen = counted.select("host", "_words_key", F.explode(F.array_distinct("_lines.line")).alias("line")).distinct()
    documents = counted.select("host", "_words_key").distinct().groupBy("host").agg(F.count("*").alias("_documents"))
    often = seen.groupBy("host", "line").agg(F.count("*").alias("_n")).where(F.col("_n") > limits.line_documents)
    often = attach(stage(often, "often"), stage(documents, "hosts"), "host")
    return stage(often.where(F.col("_n") > limits.line_share * F.col("_documents")).select("host", "line"), "frequent")


def decide(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """(doc_id, key, COUNTS, base_failed, kept, removed): one row per row of ``docs``.

    ``removed`` has the keys of the lines to be taken out, ``key`` a hash of doc_id, text and host that finds the row
    again. Equal rows get equal decisions. A null host is a host of its own; null and empty texts fail the base
    rules. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    rows = rows.withColumn(KEY, F.xxhash64("doc_id", "text", "host"))
    counted = with_counts(rows).drop("text").withColumn("_row", F.monotonically_increasing_id())
    counted = stage(counted.withColumn("base_failed", base_failed(limits)), "line-counts")
    frequent = frequent_lines(counted, limits)
    lines = counted.select("_row", "host", F.explode("_lines").alias("_line")).select("_row", "host", "_line.*")
    gone = attach(lines, frequent, ["host", "line"]).groupBy("_row")
    gone = gone.agg(F.sum("chars").alias("_gone"), F.collect_set("line").alias("removed"))
    whole = F.aggregate("_lines", F.lit(0).cast("long"), lambda total, line: total + line["chars"])
    left = whole - F.coalesce("_gone", F.lit(0))
    decided = counted.join(gone, "_row", "left")
    return decided.select(
        "doc_id",
        KEY,
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & (left >= limits.least_left * whole)).alias("kept"),
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
    )


def apply_rules(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, their lines above the limits taken out of ``text``.

    A text whose lines all stay is returned as it is. Repeated rows stay repeated.
    """
    decided = decide(docs, limits, host).where(~F.col("kept") | (F.size("removed") > 0)).groupBy(KEY)
    decided = decided.agg(F.any_value("kept").alias("__kept"), F.any_value("removed").alias("__removed"))
    key = F.xxhash64("doc_id", "text", F.coalesce(F.col(host).cast("string"), F.lit("")))
    rows = attach(docs.withColumn(KEY, key), stage(decided, "decided"), KEY, "left")
    rows = rows.where(F.coalesce("__kept", F.lit(True)))
    stays = F.filter(
        F.split("text", "\n", -1),
        lambda line: ~line.rlike(WORD) | ~F.array_contains("__removed", line_key(line)),
    )
    text = F.when(F.size("__removed") > 0, F.array_join(stays, "\n")).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


OP7_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled
  FROM documents),
placed AS (SELECT id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
windows AS (
  SELECT id, i, w, lead(w, 1) OVER words AS x, lead(w, 2) OVER words AS y FROM placed WINDOW words AS (PARTITION BY id ORDER BY i)),
again AS (SELECT id, i, y IS NOT NULL AND count(*) OVER (PARTITION BY id, w, x, y) > 1 AS again FROM windows),
repeated AS (
  SELECT id, count(*) FILTER (covered) AS n FROM (
    SELECT id, bool_or(again) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM again)
  GROUP BY id),
lines AS (
  SELECT id, host, words, lower(trim(line)) AS key, strlen(line) AS size
  FROM (SELECT id, host, lower(array_to_string(words, ' ')) AS words, unnest(filled) AS line FROM docs)),
frequent AS (SELECT host, key FROM lines GROUP BY host, key HAVING count(DISTINCT words) > 50),
left_over AS (
  SELECT id, sum(size) AS whole, coalesce(sum(size) FILTER (f.key IS NULL), 0) AS stays
  FROM lines LEFT JOIN frequent f USING (host, key) GROUP BY id),
counted AS (
  SELECT doc_id, len(words)::bigint AS n_words, length(array_to_string(words, ''))::bigint AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint AS n_symbols, (len(filled) - len(list_distinct(filled)))::bigint AS n_dup_lines,
    coalesce(r.n, 0)::bigint AS n_repeat_words, coalesce(stays, 0) AS stays, coalesce(whole, 0) AS whole
  FROM docs LEFT JOIN repeated r USING (id) LEFT JOIN left_over USING (id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 5 * stays >= whole AS kept
FROM counted"""


@query("op7_rules", OP7_SQL)
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop(KEY, "removed")
