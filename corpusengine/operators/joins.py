"""Joining results of separate runs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_results(
    articles: DataFrame, groups: DataFrame, key: str, group_columns: list[str]
) -> DataFrame:
    """All article columns with the group columns of every match; articles without a group are left out."""
    return articles.join(groups.select(key, *group_columns), key, "inner")
