"""Line deduplication by pairwise alignment of documents that share lines.

1. Every line with a word is hashed. A line that stands in several documents has a first one, in order of doc_id.
2. Documents overlap if they share a line. A line of up to ``rare`` documents pairs them all; a more frequent one
   pairs each document with the line's first document, which every later copy of the line can be aligned with. So
   frequent lines cost one pair per document, and none is left out.
3. Each pair is aligned by patience diff: lines found once in both, in the longest order common to both, hold the
   alignment; it is carried on to equal lines beside them and, between them, to what is found once there.
4. A run of aligned lines that is consecutive in both documents is a common block. Blocks of ``least_words`` words or
   more are deleted from the later document.
5. A pair's alignment leaves what stands in another order or twice, and a frequent line pairs a document with one other
   only. So the shortest runs of lines that reach ``least_words`` words, from each line on and up to each line, are
   looked up too: a run that an earlier document has is deleted. Every line of a common block lies in such a run of it,
   so no block is left, in whichever earlier document it stands. This takes one row per run and document.

Lines found in one document only cannot be aligned and are not sent anywhere.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import query
from corpusengine.operators.lookup import attach
from corpusengine.session import stage

RARE = 8
LEAST_WORDS = 40
NODE = "__alignment_node"
LINES = pa.list_(pa.struct([("at", pa.int32()), ("rank", pa.int32()), ("line", pa.int64()), ("words", pa.int32())]))


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, rising in both, by patience diff."""
    out: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        i, m, j, n = ranges.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        where = {a[k]: k for k in range(i, m) if in_a[a[k]] == 1 and in_b[a[k]] == 1}
        found = [(where[b[k]], k) for k in range(j, n) if b[k] in where]
        if not found:
            continue
        # The longest run of rising places, by piles of smallest last places.
        piles: list[int] = []
        tops: list[int] = []
        before = [-1] * len(found)
        for k, (place, _) in enumerate(found):
            pile = bisect_left(piles, place)
            piles[pile:] = [place, *piles[pile + 1 :]]
            tops[pile:] = [k, *tops[pile + 1 :]]
            before[k] = tops[pile - 1] if pile else -1
        held, k = [], tops[-1]
        while k >= 0:
            held.append(found[k])
            k = before[k]
        edges = [(m, n), *held, (i - 1, j - 1)]
        for (x, y), (u, v) in zip(edges[1:], edges, strict=False):
            if x >= i:
                out.append((x, y))
            ranges.append((x + 1, u, y + 1, v))
    return sorted(out)


def common_blocks(earlier: list[dict], later: list[dict], least_words: int) -> list[tuple[int, int]]:
    """(first, last) line of each common block in the later document; lines have at, rank, line and words."""
    pairs = patience([x["line"] for x in earlier], [x["line"] for x in later])
    out, run = [], []

    def close() -> None:
        if run and sum(later[j]["words"] for _, j in run) >= least_words:
            out.append((later[run[0][1]]["at"], later[run[-1][1]]["at"]))
        run.clear()

    for i, j in pairs:
        if run:
            u, v = run[-1]
            if earlier[i]["rank"] != earlier[u]["rank"] + 1 or later[j]["rank"] != later[v]["rank"] + 1:
                close()
        run.append((i, j))
    close()
    return out


def windows(lines: list[dict], least_words: int) -> list[tuple[int, int]]:
    """(first, last) index of the shortest runs of consecutive lines with ``least_words`` words, from and up to each line."""
    out = set()
    for step in (1, -1):
        order = range(len(lines))[::step]
        end, words = 0, 0  # of the run, which goes on in the direction of step
        for k, i in enumerate(order):
            if end <= k:
                end, words = k, 0
            while end < len(order) and words < least_words:
                if end > k and abs(lines[order[end]]["rank"] - lines[order[end - 1]]["rank"]) != 1:
                    break
                words += lines[order[end]]["words"]
                end += 1
            if words >= least_words:
                out.add((min(i, order[end - 1]), max(i, order[end - 1])))
            words -= lines[i]["words"]
    return sorted(out)


def repeated_runs(shapes: DataFrame, least_words: int) -> DataFrame:
    """(node, source, first, last) of the runs of ``windows`` that an earlier document, the first one with it, has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for row, lines in enumerate(batch.column("lines")):
                lines = lines.as_py()
                names = b"".join((line["line"]).to_bytes(8, "little", signed=True) for line in lines)
                for i, j in windows(lines, least_words):
                    rows.append(row)
                    out.append((xxhash.xxh64_intdigest(names[8 * i : 8 * j + 8]) - (1 << 63), lines[i]["at"], lines[j]["at"]))
            if out:
                made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.int32()], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("place").take(pa.array(rows)), *made], ["place", "run", "first", "last"])

    place = shapes.schema["place"].dataType.simpleString()
    found = stage(shapes.select("place", "lines").mapInArrow(run, f"place {place}, run long, first int, last int"), "runs")
    known = found.groupBy("run").agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    known = stage(known.where(F.col("earliest.node") != F.col("latest.node")).drop("latest"), "shared-runs")
    found = found.join(known, "run").where(F.col("place.node") != F.col("earliest.node"))
    return found.select(F.col("place.node").alias("node"), F.col("earliest.id").alias("source"), "first", "last")


def node() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def line_table(docs: DataFrame) -> DataFrame:
    """(node, id, lines) of each document: place, rank among the lines with a word, hash and words of those lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                lines = []
                for at, line in enumerate((text.as_py() or "").split("\n")):
                    words = line.encode().split()
                    if words:
                        name = xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)
                        lines.append({"at": at, "rank": len(lines), "line": name, "words": len(words)})
                rows.append(lines)
            made = pa.array(rows, LINES)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("id"), made], ["node", "id", "lines"])

    rows = docs.select(node().alias("node"), F.col("doc_id").cast("long").alias("id"), "text")
    kinds = "node long, id long, lines array<struct<at:int,rank:int,line:long,words:int>>"
    return stage(rows.mapInArrow(run, kinds).dropDuplicates(["node"]), "lines")


def overlaps(docs: DataFrame, least_words: int = LEAST_WORDS, rare: int = RARE) -> DataFrame:
    """(node, spans, sources): for each document with common blocks, their lines and the ids of the earlier documents."""
    lines = line_table(docs)
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("node").alias("node"))
    named = lines.select("node", order.alias("place"), F.explode(F.array_distinct("lines.line")).alias("line"))
    known = named.groupBy("line").agg(F.count("*").alias("documents"), F.min("place").alias("first"))
    known = stage(known.where("documents > 1"), "shared-lines")

    rows = lines.select("node", order.alias("place"), F.explode("lines").alias("l")).select("node", "place", "l.*")
    shared = stage(rows.join(known, "line"), "shared-places")
    shapes = shared.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("at", "rank", "line", "words"))).alias("lines"), F.any_value("place").alias("place")
    )
    shapes = stage(shapes, "shapes")

    few = shared.where(F.col("documents") <= rare).select("line", "node", "place").distinct()
    later, earlier = few.alias("b"), few.alias("a")
    pairs = later.join(earlier, (F.col("a.line") == F.col("b.line")) & (F.col("a.place") < F.col("b.place")))
    pairs = pairs.select(F.col("b.node").alias("node"), F.col("a.place").alias("source"))
    many = shared.where((F.col("documents") > rare) & (F.col("first.node") != F.col("node")))
    pairs = pairs.unionByName(many.select("node", F.col("first").alias("source"))).distinct()
    pairs = pairs.select("node", F.col("source.node").alias("other"), F.col("source.id").alias("source"))
    pairs = pairs.join(shapes.select(F.col("node").alias("other"), F.col("lines").alias("earlier")), "other")
    pairs = pairs.join(shapes.select("node", F.col("lines").alias("later")), "node").select("node", "source", "earlier", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("node", "source", "earlier", "later")]
            for name, source, earlier, later in zip(*columns, strict=True):
                for first, last in common_blocks(earlier.as_py(), later.as_py(), least_words):
                    out.append((name.as_py(), source.as_py(), first, last))
            if out:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(made, ["node", "source", "first", "last"])

    found = pairs.mapInArrow(run, "node long, source long, first int, last int")
    found = found.unionByName(repeated_runs(shapes, least_words))
    spans = F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")
    found = found.groupBy("node").agg(spans, F.sort_array(F.collect_set("source")).alias("sources"))
    return stage(found, "overlaps")


def without_overlaps(docs: DataFrame, least_words: int = LEAST_WORDS, rare: int = RARE) -> DataFrame:
    """``docs`` without the common blocks in ``text``, and ``n_lines``, ``n_removed`` and ``sources`` as new columns.

    ``n_lines`` counts the lines of the text, ``n_removed`` those deleted, empty lines inside of a block included;
    ``sources`` has the ids of the earlier documents. A document comes later if its doc_id is larger; a null doc_id is
    larger than any other, and equal ones are told apart by their texts. Rows with equal doc_id and text are one
    document, and all of them come out alike. Null and empty texts stay as they are. Columns of the new names are
    replaced, all others are kept.
    """
    found = overlaps(docs.select("doc_id", "text"), least_words, rare)
    found = found.select(
        F.col("node").alias(NODE), F.col("spans").alias("__spans"), F.col("sources").alias("__sources")
    )
    rows = attach(docs.withColumn(NODE, node()), found, NODE, "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)

    def stays(_: Column, at: Column) -> Column:
        return ~F.exists("__spans", lambda span: at.between(span["first"], span["last"]))

    left = F.when(F.col("__spans").isNotNull(), F.filter(lines, stays))
    rows = rows.withColumns({"__n": F.size(lines).cast("long"), "__left": left})
    removed = F.coalesce(F.col("__n") - F.size("__left"), F.lit(0)).cast("long")
    made = {
        "text": F.when(F.col("__left").isNull(), F.col("text")).otherwise(F.array_join("__left", "\n")),
        "n_lines": F.col("__n"),
        "n_removed": removed,
        "sources": F.coalesce("__sources", F.array().cast("array<bigint>")),
    }
    kept = [c for c in docs.columns if c not in made or c == "text"]
    names = [*kept, *[c for c in made if c != "text"]]
    return rows.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in names])


@query("op5_alignment")
def op5_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_overlaps(docs).select("doc_id", "n_lines", "n_removed", "sources", "text")
