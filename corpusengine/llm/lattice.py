"""Near-duplicate vectors by lattice hashing: cells of the E8 lattice, probing of neighbouring cells, exact cosines.

A table projects a unit vector at random into a few spaces of eight dimensions and takes the nearest point of the E8
lattice in each; all points together name the vector's cell. A vector lives in its own cell of every table and
visits the neighbouring cells it is nearest to. Vectors that meet are compared by cosine in double precision.

Equal vectors are one class from the start. Meeting places with the same vectors are used once, large ones are cut
into blocks (see minhash.blocks), and links are passed on as spanning forests. Links are then counted inside of each
component, in blocks, so no table of all pairs is ever made.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusengine.llm.graph import components
from corpusengine.llm.minhash import BLOCK, blocks, by_task, forest, outsiders
from corpusengine.llm.registry import query
from corpusengine.llm.shingles import mixed
from corpusengine.session import stage

# At a cosine of 0.95 a table brings a pair together with a chance of 0.4 or more, so 16 miss fewer than 1 in 3000.
# Each further space of eight dimensions makes about 1400 times as many cells, for tables of many more vectors.
TABLES = 16
SPACES = 2
PROBES = 8
SCALE = 0.6
COUNTED = 512
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 lattice points nearest to the origin."""
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    wholes = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            point = [0.0] * 8
            point[i], point[j] = a, b
            wholes.append(point)
    return np.array(wholes + halves)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-numbered points with an even sum."""
    whole = np.rint(x)
    rest = x - whole
    worst = np.abs(rest).argmax(1)
    odd = np.flatnonzero(whole.sum(1) % 2 != 0)
    whole[odd, worst[odd]] += np.where(rest[odd, worst[odd]] >= 0, 1, -1)
    return whole


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: even sums of whole numbers, or the same moved by a half in every dimension."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def _hashed(points: np.ndarray, seed: int) -> np.ndarray:
    out = np.full(points.shape[:-1], seed, np.uint64)
    for k in range(8):
        out = mixed(out * _FACTOR + np.rint(2 * points[..., k]).astype(np.int64).view(np.uint64))
    return out


@functools.lru_cache(maxsize=4)
def projections(size: int, tables: int, spaces: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([size, 8])
    return random.normal(size=(tables, spaces, size, 8)) * SCALE, random.uniform(0, 2, (tables, spaces, 8))


def cells(vectors: np.ndarray, tables: int = TABLES, spaces: int = SPACES, probes: int = PROBES) -> np.ndarray:
    """Names of each unit vector's own cell and then the nearest other ones, of every table: (row, table, cell)."""
    project, offset = projections(vectors.shape[1], tables, spaces)
    out = np.zeros((len(vectors), tables, 1 + probes), np.uint64)
    rows = np.arange(len(vectors))[:, None]
    for t in range(tables):
        cost, names = np.zeros((len(vectors), 1)), np.full((len(vectors), 1), t + 1, np.uint64)
        for s in range(spaces):
            at = vectors @ project[t, s] + offset[t, s]
            own = nearest(at)
            further = 2 - 2 * ((at - own) @ neighbours().T)
            best = np.argsort(further, 1, kind="stable")[:, :probes]
            points = np.concatenate([own[:, None], own[:, None] + neighbours()[best]], 1)
            costs = np.concatenate([np.zeros((len(at), 1)), further[rows, best]], 1)
            # The cells of all spaces so far, nearest first.
            cost = (cost[:, :, None] + costs[:, None, :]).reshape(len(at), -1)
            names = mixed(names[:, :, None] * _FACTOR + _hashed(points, s)[:, None, :]).reshape(len(at), -1)
            order = np.argsort(cost, 1, kind="stable")[:, : 1 + probes]
            cost, names = cost[rows, order], names[rows, order]
        out[:, t] = names
    return out


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length one, or none if it is null or zero or has a component that is null or not finite."""
    if not values:
        return None
    vector = np.array(values, np.float64)
    largest = np.abs(vector).max()
    if not np.isfinite(vector).all() or largest == 0:
        return None
    vector = vector / largest
    return vector / np.sqrt((vector**2).sum()) + 0.0


def _table(columns: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def placed(vectors: DataFrame) -> DataFrame:
    """(row, id, digest, vector, own, visits) of (id, embedding); stored. An unusable vector has nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [unit(values) for values in batch.column("embedding").to_pylist()]
            rows: list[tuple] = [(None, None, [], [])] * len(found)
            for size in {len(x) for x in found if x is not None}:
                at = [i for i, x in enumerate(found) if x is not None and len(x) == size]
                alike = np.stack([found[i] for i in at])
                names = cells(alike).view(np.int64)
                for i, x, name in zip(at, alike, names, strict=True):
                    rows[i] = (xxhash.xxh3_128_hexdigest(x.tobytes()), x, name[:, 0], name[:, 1:].reshape(-1))
            if rows:
                types = [pa.string(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *made], ["id", "digest", "vector", "own", "visits"])

    found = vectors.mapInArrow(run, "id long, digest string, vector array<double>, own array<long>, visits array<long>")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "cells")


def meetings(nodes: DataFrame) -> DataFrame:
    """(bucket, node, size, first): who meets in cells that someone lives in, each set of vectors once; stored."""
    lives = nodes.select("node", F.explode("own").alias("bucket"), F.lit(1).alias("lives"))
    visits = nodes.select("node", F.explode("visits").alias("bucket"), F.lit(0).alias("lives"))
    members = lives.unionByName(visits)
    sizes = members.groupBy("bucket").agg(
        F.count("*").alias("size"),
        F.sum(F.xxhash64("node") % (1 << 40)).alias("who"),
        F.min("node").alias("first"),
        F.sum("lives").alias("lives"),
    )
    once = sizes.where("size > 1 AND lives > 0").groupBy("size", "who", "first").agg(F.min("bucket").alias("bucket"))
    return stage(members.drop("lives").join(stage(once.drop("who"), "cell-sizes"), "bucket"), "meetings")


def compared(tasks: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(a, b): links between the nodes of each task, as a spanning forest; ``tasks`` has (task, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (found, vectors) in by_task(batches, "node", "vector"):
            links = []
            lists = [v.values.to_numpy() for v in vectors]
            for size in {len(v) for v in lists}:
                at = [i for i, v in enumerate(lists) if len(v) == size]
                alike = np.stack([lists[i] for i in at])
                near = alike @ alike.T >= cosine
                np.fill_diagonal(near, False)
                links += [(found[at[i]].as_py(), found[at[j]].as_py()) for i, j in forest(near)]
            if links:
                yield _table(list(zip(*links, strict=True)), ["a", "b"], [pa.int64()] * 2)

    rows = tasks.distinct().join(nodes.select("node", "vector"), "node")
    rows = rows.repartition("task").sortWithinPartitions("task")
    return stage(rows.mapInArrow(run, "a long, b long"), "near")


def link_counts(grouped: DataFrame, cosine: float) -> DataFrame:
    """(node, links): how many vectors each one is linked with, itself not counted; copies count one by one.

    ``grouped`` has (component, node, vector, copies). A component is compared in pairs of blocks.
    """
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    rows = grouped.join(sizes, "component").withColumn("parts", F.ceil(F.col("size") / COUNTED).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.struct(F.least("part", "other"), F.greatest("part", "other"))
    rows = rows.select(
        F.xxhash64("component", pair).alias("task"), "node", "vector", "copies", (F.col("part") <= F.col("other")).alias("left"),
        (F.col("part") == F.col("other")).alias("same"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (found, vectors, copies, left, same) in by_task(batches, "node", "vector", "copies", "left", "same"):
            table = np.stack([v.values.to_numpy() for v in vectors])
            times = np.array([c.as_py() for c in copies])
            near = table @ table.T >= cosine
            np.fill_diagonal(near, True)
            if not same[0].as_py():
                side = np.array([x.as_py() for x in left])
                near &= side[:, None] != side
            links = near @ times - (1 if same[0].as_py() else 0)
            yield _table([[x.as_py() for x in found], links], ["node", "links"], [pa.int64()] * 2)

    counted = rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``vectors``.

    Pairs found with at least the cosine are linked, none below it; vectors of different lengths never are. Null,
    empty and zero vectors, and those with a null or non-finite component, are linked with nothing. n_links counts
    the other rows linked directly, component_id is the smallest key that links lead to, itself included, and one
    row per component is kept: among equal keys the one read first; a null key counts as larger than any other.
    Other columns are not read.
    """
    found = placed(vectors.select(F.col(key).cast("long").alias("id"), F.col(column).alias("embedding")))
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))
    what = F.min_by(F.struct("vector", "own", "visits"), order)
    nodes = found.where("digest IS NOT NULL").groupBy("digest")
    nodes = nodes.agg(F.min(order).alias("least"), F.count("*").alias("copies"), what.alias("what"))
    nodes = stage(nodes.select("digest", "least", "copies", F.col("least.row").alias("node"), "what.*"), "vectors")

    shared = meetings(nodes)
    links = compared(blocks(shared).drop("component"), nodes, cosine)
    groups = components(links)
    if shared.where(F.col("size") > BLOCK).limit(1).count():
        large = shared.where(F.col("size") > BLOCK)
        links = links.unionByName(compared(outsiders(large, groups).drop("component"), nodes, cosine))
        groups = components(links)

    groups = stage(groups.withColumnRenamed("id", "node"), "groups")
    grouped = groups.join(nodes.select("node", "vector", "copies", "least"), "node")
    least = grouped.groupBy("component").agg(F.min("least").alias("_least"))
    counts = link_counts(grouped.select("component", "node", "vector", "copies"), cosine)
    more = groups.join(least, "component").join(counts, "node").select("node", "_least", "links")
    classes = nodes.select("digest", "node", "least", "copies").join(more, "node", "left")
    classes = classes.select(
        "digest", F.coalesce("_least", "least").alias("_least"), F.coalesce("links", F.col("copies") - 1).alias("links")
    )
    rows = found.select("row", "id", "digest").join(classes, "digest", "left")
    return rows.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_least").isNull(), F.col("id")).otherwise(F.col("_least.id")).alias("component_id"),
        F.coalesce(F.col("_least.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


@query("op6_lattice")
def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
