"""The places a document is mostly about."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.functions.text import trim_control
from corpusengine.operators.each import counted


def _counted(df: DataFrame, title_places: str, content_places: str, best: int | None = None) -> DataFrame:
    title, content = trim_control(title_places), trim_control(content_places)
    repeats = F.when(content.isNotNull(), C.TITLE_REPEATS).otherwise(1)
    text = F.concat_ws(" ", F.array_repeat(title, repeats), content)
    places = F.array_remove(F.split(text, " "), "")
    return counted(df.withColumn("_places", places), "_places", "_counted", "first_at", best).drop("_places")


def place_count(df: DataFrame, id_col: str, title_places: str, content_places: str) -> DataFrame:
    """(id, place, n, first_at): space-separated places, those of the title three times when there is content too.

    A document without places has one row, of a null place. Places are counted inside the row.
    """
    rows = _counted(df, title_places, content_places).select(id_col, F.explode_outer("_counted").alias("_place"))
    return rows.select(id_col, F.col("_place.item").alias("place"), F.col("_place.n").alias("n"), F.col("_place.first_at").alias("first_at"))


def with_region(
    df: DataFrame, title_places: str, content_places: str, n: int = C.PLACE_COUNT, out: str = "region"
) -> DataFrame:
    """``df`` with the ``n`` most frequent places, the earlier first when equal; null without any."""
    rows = _counted(df, title_places, content_places, n)
    return rows.withColumn(out, F.nullif(F.array_join("_counted.item", " "), F.lit(""))).drop("_counted")


def region(
    df: DataFrame, id_col: str, title_places: str, content_places: str, n: int = C.PLACE_COUNT, out: str = "region"
) -> DataFrame:
    """(id, region), one row per row of ``df``."""
    return with_region(df, title_places, content_places, n, out).select(id_col, out)
