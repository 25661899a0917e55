"""All enrichments of a document in one table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpusengine.functions.text import origin_flag
from corpusengine.operators.keywords import with_keywords
from corpusengine.operators.places import with_region
from corpusengine.operators.sentiment import percent_in_row, with_clauses
from corpusengine.operators.summary import with_summary
from corpusengine.plans.classify import Classifier, classify_text


@dataclass
class Columns:
    """Names of the input columns."""

    id: str = "docId"
    site: str = "mediaName"
    source: str = "sourceName"
    tagged_title: str = "allTitle"
    tagged_text: str = "allText"
    title: str = "title"
    text: str = "text"
    title_places: str = "titlePlace"
    text_places: str = "textPlace"
    words: str = "segmentedWords"


@dataclass
class Dictionaries:
    """Word lists and lexicons, as tables."""

    sentiment: DataFrame
    adverbs: DataFrame
    negations: DataFrame
    stop_words: DataFrame | None = None
    remove: DataFrame | None = None


def enrich(
    df: DataFrame,
    words: Dictionaries,
    columns: Columns = Columns(),
    classifier: Classifier | None = None,
    brands: DataFrame | None = None,
    keyword_options: dict | None = None,
    summary_options: dict | None = None,
    sentiment_options: dict | None = None,
    region_options: dict | None = None,
    rules: dict | None = None,
) -> DataFrame:
    """``df`` with ``original``, ``keywords``, ``summary``, ``sentiment`` and ``region``, and the class if asked for.

    Every row keeps its columns and gets new ones, whatever its id; rows are neither lost nor multiplied. Everything is
    computed inside the row: with dictionaries of usual size nothing is shuffled, and equal texts never meet.
    """
    c = columns
    base = df if classifier is None else classify_text(df, c.id, classifier, brands, c.words, **(rules or {}))
    base = base.withColumn("original", origin_flag(c.site, c.source))
    base = with_keywords(base, c.tagged_title, c.tagged_text, words.stop_words, words.remove, **(keyword_options or {}))
    base = with_summary(base, c.text, stop_words=words.stop_words, **(summary_options or {}))
    base = with_region(base, c.title_places, c.text_places, **(region_options or {}))
    base = with_clauses(
        base, c.title, c.text, words.sentiment, words.adverbs, words.negations, out="_clauses", **(sentiment_options or {})
    )
    return base.withColumn("sentiment", percent_in_row("_clauses")).drop("_clauses")
