"""Near duplicates by b-bit MinHash, confirmed on whole shingle sets.

1. One pass over the texts keeps, per document, the size and a digest of its shingle set, band keys made of its
   minima, and the two lowest bits of every minimum, packed. Equal sets are one class from here on.
2. Classes that share a band key are in one bucket. Buckets with the same classes are kept once.
3. In a bucket, the similarity of two classes is estimated from the number of equal packed bits, corrected for the
   quarter of the different minima whose bits are equal by chance. Only those that may reach the similarity stay.
4. Their whole sets are made again from the texts and compared. A bucket's links are passed on as a spanning forest.

A quarter of the bands comes first and joins most of what is alike. Large buckets are cut into blocks for that, each
compared within itself and with the bucket's first class. Classes that are joined need no further comparison. Of the
other bands, and of large buckets, only those outside of a bucket's largest group are then compared with every block
of the bucket, so no link is lost, and no task ever holds more than a few hundred documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusengine.llm.graph import components
from corpusengine.llm.registry import documents, query
from corpusengine.llm.shingles import mixed, shingles
from corpusengine.operators.lookup import attach, is_small
from corpusengine.session import stage

MINIMA = 192
BITS = 2
# Documents of a bucket that are compared in one task, and outsiders that are compared with as many.
BLOCK = 256
OUTSIDERS = 128
# A pair at the similarity goes unfound with less than this chance: by its bands, and by its estimate.
MISSED = 1e-6
DEVIATIONS = 5
SHARED_COLUMNS = 8192
# The share of the bands that comes first.
FIRST_BANDS = 0.25


def banding(similarity: float) -> tuple[int, int]:
    """(bands, rows) of the minima: as many rows as the chance of a missed pair allows."""
    fitting = [r for r in range(1, 17) if (1 - similarity**r) ** (MINIMA // r) <= MISSED]
    rows = max(fitting, default=1)
    return MINIMA // rows, rows


def minima(found: np.ndarray) -> np.ndarray:
    """The minimum of the set under each of MINIMA hash functions."""
    seeds = mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    factor, offset = seeds[:MINIMA] | np.uint64(1), seeds[MINIMA:]
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        values = found[at : at + 1024, None] * factor
        values += offset
        np.minimum(out, values.min(0), out=out)
    return out


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    table = least[: bands * rows].reshape(bands, rows)
    for k in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, k])
    return keys.view(np.int64)


def packed(least: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, one plane of bits after the other."""
    low = mixed(least)
    return b"".join(np.packbits((low >> np.uint64(k) & np.uint64(1)).astype(bool)).tobytes() for k in range(BITS))


def may_reach(sketches: list[bytes], similarity: float) -> np.ndarray:
    """Which pairs may have the similarity, by the estimate from equal bits less DEVIATIONS standard deviations."""
    chance = 0.5**BITS
    p = similarity + (1 - similarity) * chance
    least = similarity - DEVIATIONS * math.sqrt(p * (1 - p) / MINIMA) / (1 - chance)
    planes = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), BITS, -1)
    out = np.zeros((len(sketches), len(sketches)), bool)
    for i in range(len(sketches) - 1):
        differ = np.bitwise_or.reduce(planes[i] ^ planes[i + 1 :], axis=1)
        equal = MINIMA - np.bitwise_count(differ).sum(1)
        out[i, i + 1 :] = (equal / MINIMA - chance) / (1 - chance) >= least
    return out


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs."""
    if len(sets) <= 4:
        out = np.zeros((len(sets), len(sets)), np.int64)
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, SHARED_COLUMNS):
        first, last = np.searchsorted(column, [at, at + SHARED_COLUMNS])
        table = np.zeros((len(sets), SHARED_COLUMNS), np.float32)
        table[row[first:last], column[first:last] - at] = 1
        out += table @ table.T
    return np.rint(out).astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join whatever the given ones join, one fewer than there are members of each group."""
    left, out = set(range(len(linked))), []
    linked = linked | linked.T
    while left:
        reached = [left.pop()]
        while reached:
            i = reached.pop()
            for j in [j for j in np.flatnonzero(linked[i]).tolist() if j in left]:
                left.discard(j)
                out.append((i, j))
                reached.append(j)
    return out


def by_task(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[int, list[list]]]:
    """(task, columns) of the runs of equal ``task`` in sorted batches."""
    task, held = None, [[] for _ in names]
    for batch in batches:
        tasks = batch.column("task").to_numpy()
        columns = [batch.column(name) for name in names]
        edges = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)] if len(tasks) else []
        for first, last in zip(edges, edges[1:], strict=False):
            if task is not None and tasks[first] != task:
                yield task, held
                held = [[] for _ in names]
            task = tasks[first]
            for part, column in zip(held, columns, strict=True):
                part.extend(column.slice(first, last - first))
    if task is not None:
        yield task, held


def sketched(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(row, id, tag, n, digest, sketch, bands) of every document; one pass over the texts, stored."""
    bands, rows = banding(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                found = shingles(text.as_py() or "", width)
                least = minima(found)
                digest = xxhash.xxh3_128_hexdigest(found.tobytes())
                out.append((len(found), digest, packed(least), band_keys(least, bands, rows) if len(found) else []))
            types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            if out:
                names = ["id", "tag", "n", "digest", "sketch", "bands"]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), *made], names)

    kinds = "id long, tag long, n long, digest string, sketch binary, bands array<long>"
    found = docs.withColumn("tag", F.xxhash64("id", "text")).mapInArrow(run, kinds)
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "sketches")


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (node, id, digest), made again from one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py() or "", width) for text in batch.column("text")]
            digests = [xxhash.xxh3_128_hexdigest(found.tobytes()) for found in sets]
            made = [pa.array(digests, pa.string()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], ["id", "digest", "shingles"])

    ids = wanted.select(F.col("id").alias("_id")).distinct()
    ids = stage(ids, "asked")
    ids = F.broadcast(ids) if is_small(ids) else ids
    asked = docs.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    made = asked.mapInArrow(run, "id long, digest string, shingles array<long>").alias("m")
    wanted = wanted.select("node", F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return stage(made.join(wanted, same).select("node", "shingles").dropDuplicates(["node"]), "whole-sets")


def compared(tasks: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(a, b): links between the nodes of each task, as a spanning forest.

    ``tasks`` has (task, node, component); nodes of the same component are not compared.
    """
    share = round(similarity * 100)

    def apart(components: list) -> np.ndarray:
        names = np.array([c.as_py() for c in components])
        return names[:, None] != names

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, (found, groups, sketches) in by_task(batches, "node", "component", "sketch"):
            near = may_reach([sketch.as_py() for sketch in sketches], similarity) & apart(groups)
            stays = np.flatnonzero(near.any(0) | near.any(1)).tolist()
            if stays:
                columns = [[task] * len(stays), *([c[i].as_py() for i in stays] for c in (found, groups))]
                made = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(made, ["task", "node", "component"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (found, groups, lists) in by_task(batches, "node", "component", "shingles"):
            sets = [one.values.to_numpy(zero_copy_only=False) for one in lists]
            sizes = np.array([len(s) for s in sets])
            both = intersections(sets)
            linked = (100 * both >= share * (sizes[:, None] + sizes - both)) & apart(groups)
            links = [(found[i].as_py(), found[j].as_py()) for i, j in forest(linked)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

    rows = tasks.join(nodes.select("node", "sketch"), "node")
    near = rows.repartition("task").sortWithinPartitions("task").mapInArrow(estimate, "task long, node long, component long")
    near = stage(near, "near")
    sets = whole_sets(docs, near.select("node").distinct().join(nodes.select("node", "id", "digest"), "node"), width)
    rows = near.join(sets, "node").repartition("task").sortWithinPartitions("task")
    return stage(rows.mapInArrow(confirm, "a long, b long"), "confirmed")


def buckets(nodes: DataFrame, first: int, count: int) -> DataFrame:
    """(bucket, node, size, first) of the classes that share a key of some bands, each set of classes once; stored."""
    members = nodes.select("node", F.explode(F.slice("bands", 1 + first, count)).alias("bucket"))
    who = F.sum(F.xxhash64("node") % (1 << 40))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), who.alias("who"), F.min("node").alias("first"))
    once = sizes.where("size > 1").groupBy("size", "who", "first").agg(F.min("bucket").alias("bucket")).drop("who")
    return stage(members.join(stage(once, "bucket-sizes"), "bucket"), "buckets")


def blocks(shared: DataFrame) -> DataFrame:
    """(task, node, component): each bucket's blocks, with the bucket's first class in all of them."""
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), count).cast("int")
    is_first = F.col("node") == F.col("first")
    block = F.when(is_first, F.sequence(F.lit(0), count - 1)).otherwise(F.array(own))
    rows = shared.select("bucket", "node", F.explode(block).alias("block"))
    return rows.select(F.xxhash64("bucket", "block").alias("task"), "node", F.col("node").alias("component"))


def outsiders(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(task, node, component): blocks of those outside their bucket's largest group with blocks of the whole bucket."""
    large = shared.join(groups.withColumnRenamed("id", "node"), "node", "left")
    large = stage(large.withColumn("component", F.coalesce("component", "node")), "grouped-buckets")
    counted = large.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), (F.sum("n") - F.max("n")).alias("out")
    )
    large = large.join(main.where("out > 0"), "bucket")
    of_out = F.ceil(F.col("out") / OUTSIDERS).cast("int")
    of_all = F.ceil(F.col("size") / BLOCK).cast("int")
    hashed = F.xxhash64("node", "bucket")
    alone = large.where("component <> main").select(
        "bucket",
        "node",
        "component",
        F.pmod(hashed, of_out).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), of_all - 1)).alias("j"),
    )
    rows = large.select(
        "bucket",
        "node",
        "component",
        F.explode(F.sequence(F.lit(0), of_out - 1)).alias("i"),
        F.pmod(hashed, of_all).cast("int").alias("j"),
    )
    return rows.unionByName(alone).select(F.xxhash64("bucket", "i", "j").alias("task"), "node", "component").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept, tag) of every row of ``docs``.

    Documents are linked if 100 * intersection >= 100 * similarity * union of their shingle sets (similarity counts
    in hundredths), component_id is the smallest key that links lead to, itself included, and one row per component
    is kept. A null or empty text, or one without words, has no shingles and is linked with nothing. Among rows with
    equal keys the one read first is kept; a null key counts as larger than any other. ``tag`` is a hash of key and
    text. Other columns are not read.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), "text")
    sketches = sketched(docs, width, similarity)
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))
    first = F.min_by(F.struct("sketch", "bands"), order)
    nodes = sketches.where("n > 0").groupBy("digest").agg(F.min(order).alias("least"), first.alias("kept"))
    nodes = stage(
        nodes.select("digest", "least", F.col("least.row").alias("node"), F.col("least.id").alias("id"), "kept.*"),
        "classes",
    )

    bands, _ = banding(similarity)
    early = math.ceil(bands * FIRST_BANDS)
    shared = buckets(nodes, 0, early)
    links = compared(blocks(shared), nodes, docs, width, similarity)
    others = buckets(nodes, early, bands - early).unionByName(shared.where(F.col("size") > BLOCK))
    more = compared(outsiders(others, components(links)), nodes, docs, width, similarity)
    groups = components(links.unionByName(more))

    found = groups.withColumnRenamed("id", "node").join(nodes.select("node", "least"), "node")
    least = found.groupBy("component").agg(F.min("least").alias("_least"))
    found = found.select("node", "component").join(least, "component").select("node", "_least")
    classes = nodes.select("digest", "node", "least").join(found, "node", "left")
    classes = classes.select("digest", F.coalesce("_least", "least").alias("_least"))
    rows = sketches.select("row", "id", "tag", "n", "digest").join(classes, "digest", "left")
    return rows.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("_least").isNull(), F.col("id")).otherwise(F.col("_least.id")).alias("component_id"),
        F.coalesce(F.col("_least.row") == F.col("row"), F.lit(True)).alias("kept"),
        "tag",
    )


def without_near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their columns; of rows alike in key and text, one."""
    tag = F.xxhash64(F.col(key).cast("long"), F.coalesce("text", F.lit("")))
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    found = near_duplicates(rows, width, similarity, key).groupBy("tag")
    found = found.agg(F.max("kept").alias("__kept"), F.count("*").alias("__rows"), F.count_if("kept").alias("__n"))
    found = found.where("NOT __kept OR __n < __rows").withColumnRenamed("tag", "__tag")
    marked = attach(docs.withColumn("__tag", tag), stage(found.drop("__n", "__rows"), "dropped"), "__tag", "left")
    once = marked.where("__kept").dropDuplicates(["__tag"])
    return marked.where("__kept IS NULL").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3, similarity=0.85).drop("tag")
