"""Registration of queries, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine import constants as C
from corpusengine.operators.each import each
from corpusengine.session import SETTINGS, apply_settings, stage
from corpusengine.sources import scan_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The texts at hand end sentences and clauses with a full stop of Latin script.
SENTENCE_MARKS = C.SENTENCE_MARKS + "."
CLAUSE_MARKS = C.CLAUSE_MARKS + "."
SENTENCE_SPLIT = r"[\r\n。？?！!；;\t.]+"
CLAUSE_SPLIT = r"[，,。？?！!；;\n\r.]"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where the rows can be checked by value."""

    def register(plan: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if any(spark.conf.get(key, None) != value for key, value in SETTINGS.items()):
                apply_settings(spark)
            return plan(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/documents.parquet", ["doc_id", *(columns or ("text",))], spread_by="doc_id")


def articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """(doc_id, title, content): the first line and all that follows it."""
    rest = F.col("text").substr(F.length("title") + 2, F.length("text"))
    df = documents(spark, sf_dir, "text", *columns).withColumn("title", F.substring_index("text", "\n", 1))
    return df.select("doc_id", "title", rest.alias("content"), *columns)


ARTICLES_SQL = """SELECT *, string_split(text, chr(10))[1] AS title,
  substr(text, length(string_split(text, chr(10))[1]) + 2) AS content FROM documents"""


def tagged(text: Column | str) -> Column:
    """A tagged form of a text: the tag follows from the length of the word."""
    words = F.split(F.regexp_replace(text, r"\s+", " "), " ")
    tags = F.array(*map(F.lit, ["n", "v", "d", "m"]))
    return F.array_join(F.transform(words, lambda w: F.concat(w, F.lit("/"), F.get(tags, F.length(w) % 4))), " ")


def tagged_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, content), tagged, as a stored table; null for empty content."""
    content = F.when(F.col("content") != "", tagged("content"))
    df = articles(spark, sf_dir).select("doc_id", tagged("title").alias("title"), content.alias("content"))
    return stage(df, "tagged-articles")


TAGGED_SQL = f"""SELECT doc_id,
  list_transform(string_split(regexp_replace(title, '\\s+', ' ', 'g'), ' '),
    lambda w: w || '/' || ['n','v','d','m'][length(w) % 4 + 1]) AS title,
  list_transform(string_split(regexp_replace(content, '\\s+', ' ', 'g'), ' '),
    lambda w: w || '/' || ['n','v','d','m'][length(w) % 4 + 1]) AS content
FROM ({ARTICLES_SQL})"""

# (doc_id, pos, word, tag) of title and content; empty content is a document without words.
TAGGED_WORDS_SQL = f"""
SELECT doc_id, in_title, pos, string_split(part, '/')[1] AS word, string_split(part, '/')[2] AS tag
FROM (
  SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos, n_title,
    generate_subscripts(parts, 1) <= n_title AS in_title
  FROM (SELECT doc_id, list_concat(title, content) AS parts, len(title) AS n_title FROM ({TAGGED_SQL})
        WHERE array_to_string(content, '') <> '/n'))
WHERE regexp_matches(part, '^[^/]*/+[^/]')"""

# Words of the texts in at least a quarter of the documents stand in for a list of stop words.
STOP_WORDS_SQL = """
SELECT word FROM (SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word HAVING count(*) * 4 >= (SELECT count(*) FROM documents)"""


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = documents(spark, sf_dir)
    words = each(df, ["doc_id"], F.array_distinct(F.split("text", " ")), "word")
    n = df.agg(F.count("*")).scalar()
    common = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") * 4 >= n)
    return stage(common.select("word"), "stop-words")


def values(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
