"""One row per array element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusengine.functions.solve import item_counts


def each(df: DataFrame, keep: list[Column | str], items: Column | str, *names: str) -> DataFrame:
    """``keep`` with each element of ``items``, as (element) or (position, element).

    The kept columns are computed before the rows multiply and the array is not carried along. The outer form of the
    generator is used since Spark guards the plain form with a filter that evaluates the array a second time.
    """
    rows = df.select(*keep, (F.col(items) if isinstance(items, str) else items).alias("_items"))
    generator = F.posexplode_outer if len(names) == 2 else F.explode_outer
    return rows.select(*rows.columns[:-1], generator("_items").alias(*names)).where(F.col(names[-1]).isNotNull())


def counted(df: DataFrame, items: str, out: str, first: str | None = None, best: int | None = None) -> DataFrame:
    """``df`` with the different elements of an array as array<struct<item, n>>, or <item, n, ``first``> with the place
    of the first occurrence; counted inside the row by vector operations. Null for a null array, nulls left out.
    With ``best`` only so many, the most frequent first and the earlier first when equal.
    """
    kind = df.schema[items].dataType.elementType.simpleString()
    return df.withColumn(out, item_counts(F.col(items), kind, first, best))
