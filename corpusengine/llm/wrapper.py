"""The main text of pages, by a wrapper that is induced from the pages of a host.

Each page's tree is aligned by simple tree matching with the layouts that most different pages of its host have, and
takes the one that it matches best, so that parts which play the same role meet in one slot. A slot whose content
stays the same from article to article is template, one whose content varies may hold the article. Elements that name
what they are (menus, forms, comments and the like) are left out on any page, so that hosts with a single page are
served too.

Copies of a page say nothing about what stays the same: a host's pages are counted once per content. Neither do copies
of an article among other notes and dates: a slot's contents are counted against those of the slot with most text. All
counts are added up before they are shuffled, and no task holds the pages of a host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from corpusengine.llm.dom import Part, align, blocks, from_skeleton, layout, numbered, parse, skeleton
from corpusengine.llm.registry import query
from corpusengine.operators.lookup import attach
from corpusengine.session import stage

# A slot is template if it was seen on this many different pages, and the slot of its layout with most text, each content
# taken once, has so many times its contents.
LEAST_PAGES = 4
TIMES_CONTENTS = 2
# Layouts of a host that its pages are aligned with: those of most different pages.
LAYOUTS = 4
LAYOUT_BITS = 20

_host = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s]*)", re.I).match


def host(url: str | None) -> str:
    """The host that a url names, or an empty name."""
    found = _host(url or "")
    return found[1].rpartition("@")[2].lower() if found else ""


def induce(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, templates) of a table with (page_id, url, html).

    ``rows`` has (page_id, url, host, blocks) of every page, with the text of each block and the slots it stands in;
    ``templates`` has (host, template) with the slots that are template. Both are stored tables.
    """
    pages = pages.select("page_id", "url", "html")

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, pages = batch.column("url").to_pylist(), batch.column("html")
            roots = [layout([parse(page.as_py() or "")]) for page in pages]
            columns = [list(map(host, urls)), [skeleton(root) for root in roots], [root.content for root in roots]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["host", "shape", "page"]
            )

    shapes = pages.select("url", "html").mapInArrow(outline, "host string, shape string, page long")
    shapes = shapes.distinct().groupBy("host", "shape").agg(F.count("*").alias("n"))
    order = W.partitionBy("host").orderBy(F.desc("n"), F.length("shape").desc(), "shape")
    best = shapes.withColumn("at", F.row_number().over(order)).where(F.col("at") <= LAYOUTS)
    shape = F.transform(F.sort_array(F.collect_list(F.struct("at", "shape"))), lambda x: x["shape"])
    layouts = stage(best.groupBy("host").agg(shape.alias("shapes")), "layouts")

    name = F.coalesce(F.lower(F.regexp_extract("url", r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#\s]*@)?([^/?#\s]*)", 1)), F.lit(""))
    aligned = attach(pages.withColumn("host", name), layouts, "host", "left").select("page_id", "url", "host", "html", "shapes")
    kinds = dict(pages.dtypes)
    found = f"page_id {kinds['page_id']}, url {kinds['url']}, host string, page long, slots array<struct<slot:int,content:long,size:long>>"
    found += ", blocks array<struct<text:string,slots:array<int>>>"

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            rows = []
            for page, shapes in zip(batch.column("html"), batch.column("shapes").to_pylist(), strict=True):
                root = parse(page.as_py() or "")
                ours = layout([root])
                at, pairs = closest(ours, shapes or ["#root"], known)
                slots = []
                for part, number in pairs:
                    slot = at << LAYOUT_BITS | number
                    slots.append({"slot": slot, "content": part.content, "size": part.size})
                    for node in part.nodes:
                        node.slot = slot
                rows.append((ours.content, slots, [{"text": t, "slots": s} for t, s in blocks(root)]))
            types = [pa.int64(), SLOTS, BLOCKS]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            kept = [batch.column(c) for c in ("page_id", "url", "host")]
            if rows:
                yield pa.RecordBatch.from_arrays([*kept, *made], ["page_id", "url", "host", "page", "slots", "blocks"])

    rows = stage(aligned.mapInArrow(meet, found), "blocks")
    seen = rows.select("host", "page", F.explode("slots").alias("s")).select("host", "page", "s.*").distinct()
    contents = seen.groupBy("host", "slot", "content").agg(F.count("*").alias("pages"), F.max("size").alias("size"))
    slots = contents.groupBy("host", "slot").agg(
        F.sum("pages").alias("pages"), F.count("*").alias("contents"), F.sum("size").alias("size")
    )
    slots = stage(slots.withColumn("layout", F.shiftright("slot", LAYOUT_BITS)), "slots")
    largest = slots.groupBy("host", "layout").agg(F.max_by("contents", F.struct("size", "contents")).alias("articles"))
    fixed = (F.col("pages") >= LEAST_PAGES) & (F.col("contents") * TIMES_CONTENTS <= F.col("articles"))
    found = slots.join(largest, ["host", "layout"]).where(fixed)
    templates = found.groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias("template"))
    return rows.drop("page", "slots"), stage(templates, "templates")


def closest(ours: Part, shapes: list[str], known: dict[str, tuple]) -> tuple[int, list[tuple[Part, int]]]:
    """The place of the layout that matches best, the first one of equals, and the matched parts with its numbers."""
    name = skeleton(ours)
    tried = [shapes.index(name)] if name in shapes else range(len(shapes))
    best: tuple[int, list] = (0, [])
    for at in tried:
        shape = shapes[at]
        if shape not in known:
            if len(known) >= 1000:
                known.clear()
            theirs = from_skeleton(shape)
            known[shape] = theirs, numbered(theirs)
        theirs, numbers = known[shape]
        pairs = align(ours, theirs)
        if len(pairs) > len(best[1]):
            best = at, [(part, numbers[id(other)]) for part, other in pairs]
    return best


SLOTS = pa.list_(pa.struct([("slot", pa.int32()), ("content", pa.int64()), ("size", pa.int64())]))
BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("slots", pa.list_(pa.int32()))]))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page, its blocks joined by line ends.

    A null or empty page, and one without a block outside of the template, has an empty text. A null url is a host of
    its own. Rows stay as they are, whatever their keys; other columns are dropped. White space inside a block is one
    space, character references are decoded, and nothing is capped: pages of any length are read whole.
    """
    rows, templates = induce(pages)
    rows = attach(rows, templates, "host", "left")
    template = F.coalesce("template", F.array().cast("array<int>"))
    kept = F.filter("blocks", lambda block: ~F.arrays_overlap(block["slots"], template))
    text = F.array_join(F.transform(kept, lambda block: block["text"]), "\n")
    rows = rows.select("page_id", "url", text.alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


@query("op8_extraction")
def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
