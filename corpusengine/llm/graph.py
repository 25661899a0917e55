"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusengine.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has a link; component is the smallest id that can be reached.

    Large and small stars by turns: every id is linked to the smallest id it knows of, first its larger neighbours,
    then its smaller ones, until nothing changes; that takes a number of rounds that grows with the logarithm of the
    longest path. Only two numbers per round come to the driver; each round is a stored table. Minima are taken per
    task before the shuffle, so an id with many links is no burden. No links give an empty table.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, known = stage(edges, "links"), None
    while True:
        # Large star: of each id's neighbours, the larger ones are linked to the smallest of all of them and the id.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: of each id's smaller neighbours and the id itself, all are linked to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == known:
            break
        known = now
    roots = edges.select(F.col("v").alias("u"), "v")
    return edges.unionByName(roots).distinct().select(F.col("u").alias("id"), F.col("v").alias("component"))
