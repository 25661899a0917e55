"""How filters of documents interact: what each removes in any order, what it shares with others, and its fair part.

A document is only known by the set of filters that it fails. A table of the 2**n sets per part holds all there is to
know, and from it the number v(S) that any coalition S of filters removes. What a step of an order removes is a
difference of two coalitions. A filter's Shapley value is the solution of a least squares problem: numbers, one per
filter, whose sums over coalitions are closest to v(S) under the kernel's weights and equal to v of all filters for all
of them. The normal equations are solved in rationals, once for all parts, since only v differs between parts.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from corpusengine.llm.registry import query
from corpusengine.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
# Failure conditions of the filters A to D, on a whole text; E looks at the whole table.
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
COUNTS = ["n", "good", "toxic"]


def shapley_solution(n: int) -> list[list[Fraction]]:
    """W with W[i][S] for n players and coalitions S as bit sets: the Shapley value of i is the sum of W[i][S] * v(S).

    Minimises the sum of k(S) * (v(S) - sum of the values of S)**2 over all S but the empty and the full one, with
    k(S) = (n - 1) / (binomial(n, |S|) * |S| * (n - |S|)), such that all values add up to v(full). v(empty) is 0.
    """
    full = (1 << n) - 1
    kernel = {}
    for s in range(1, full):
        size = s.bit_count()
        kernel[s] = Fraction(n - 1, math.comb(n, size) * size * (n - size))
    has = [[Fraction(s >> i & 1) for s in range(full + 1)] for i in range(n)]
    # Rows of the normal equations with a multiplier for the constraint; to the right, one column per coalition.
    rows = []
    for i in range(n):
        left = [sum((k * has[i][s] * has[j][s] for s, k in kernel.items()), Fraction(0)) for j in range(n)]
        right = [kernel.get(s, Fraction(0)) * has[i][s] for s in range(full + 1)]
        rows.append([*left, Fraction(1), *right])
    rows.append([Fraction(1)] * n + [Fraction(0)] + [Fraction(int(s == full)) for s in range(full + 1)])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [row[n + 1 :] for row in rows[:n]]


def own_failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3. Words are case-sensitive; a text without any has none."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    fails = [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n,
        100 * capitals.cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask): a row's own failures and a digest of its text; no other column is looked at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    return rows.select("doc_id", "part", F.sha2("text", 256).alias("digest"), own_failures(F.col("text")).alias("mask"))


def tabulate(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail.

    E fails for a text that a row with a smaller doc_id has too, in any part. Rows that share the smallest doc_id pass
    it, and so does a row without a doc_id, which is never the smaller one either. A document is good (toxic) if any
    label row of its doc_id says so. Only (doc_id, part, digest, mask) is shuffled, and of equal texts no more than the
    first ones of each task; the rest is counted where it is.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    said = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    rows = failures(docs, part).join(known, "doc_id", "left").select("doc_id", "part", "digest", "mask", *said)
    rows = stage(rows, "failures")
    first = F.rank().over(W.partitionBy("digest").orderBy("doc_id"))
    originals = rows.where(F.col("doc_id").isNotNull()).withColumn("_rank", first).where(F.col("_rank") == 1)

    def counted(table: DataFrame) -> DataFrame:
        return table.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    passing = counted(originals.drop("_rank").unionByName(rows.where(F.col("doc_id").isNull())))
    gone = passing.select("part", (F.col("mask") + 16).alias("mask"), *[(-F.col(c)).alias(c) for c in COUNTS])
    all_as_copies = counted(rows).withColumn("mask", F.col("mask") + 16)
    return passing.unionByName(all_as_copies).unionByName(gone).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def coalitions(table: DataFrame) -> DataFrame:
    """(part, n, good, toxic, total): per part, v(S) for each coalition S in order of its bits, and all documents."""
    counts = table.groupBy("part").agg(
        *[
            F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in range(ALL + 1)]).alias(c)
            for c in COUNTS
        ]
    )
    masks = F.sequence(F.lit(0), F.lit(ALL))

    def removed(by_mask: str) -> Column:
        def add(at: Column, s: Column) -> Column:
            return F.when(at.bitwiseAND(s) != 0, F.get(by_mask, at)).otherwise(0)

        return F.transform(masks, lambda s: F.aggregate(masks, F.lit(0).cast("long"), lambda total, at: total + add(at, s)))

    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    return counts.select("part", *[removed(c).alias(c) for c in COUNTS], total.alias("total"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order and step, zeros included: 600 a part. Without documents there are no parts and no rows.
    """
    orders = " ".join("".join(p) for p in permutations(FILTERS))
    times = math.factorial(len(FILTERS))
    weights = [[times * x for x in row] for row in shapley_solution(len(FILTERS))]
    if any(x.denominator != 1 for row in weights for x in row):
        raise ArithmeticError("values over all orders are whole numbers")

    def value(row: list[Fraction]) -> Column:
        terms = F.zip_with("n", F.array(*[F.lit(int(x)).cast("long") for x in row]), lambda v, x: v * x)
        return F.aggregate(terms, F.lit(0).cast("long"), lambda a, x: a + x)

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))

    rows = coalitions(tabulate(docs, labels, part)).withColumn("values", F.array(*[value(row) for row in weights]))
    rows = rows.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    rows = rows.withColumns(
        {"own": bits(letter), "before": bits(F.col("filter_order").substr(F.lit(1), F.col("step") - 1)), "at": F.ascii(letter) - ord("A")}
    )

    def v(counts: str, s: Column) -> Column:
        return F.get(counts, s)

    after = F.col("before") + F.col("own")
    removed = v("n", after) - v("n", F.col("before"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - v("n", after)).alias("kept"),
        removed.alias("removed"),
        (v("n", F.col("own")) - removed).alias("redundant"),
        (v("n", F.lit(ALL)) - v("n", ALL - F.col("own"))).alias("unique_fails"),
        (v("good", after) - v("good", F.col("before"))).alias("good_lost"),
        (v("toxic", after) - v("toxic", F.col("before"))).alias("toxic_lost"),
        F.get("values", F.col("at")).alias("shapley"),
    )


OP12_SQL = r"""
WITH facts AS (
  SELECT d.doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(d.doc_id) OVER (PARTITION BY coalesce(text, '')) < d.doc_id AS copy,
    coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
masked AS (
  SELECT part, good, toxic,
    (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * copy::int AS mask
  FROM facts),
tabled AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masked GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS own),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS fs, [a.own, b.own, c.own, d.own, e.own] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.own | b.own | c.own | d.own | e.own = 31),
steps AS (
  SELECT array_to_string(fs, '') AS filter_order, step::int AS step, fs[step] AS f, bits[step] AS own,
    coalesce(list_sum(bits[1:step - 1]), 0)::int AS before
  FROM orders, range(1, 6) AS r(step)),
counted AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER ((mask & (before | own)) = 0), 0)::bigint AS kept,
    coalesce(sum(n) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0)::bigint AS removed,
    coalesce(sum(n) FILTER ((mask & own) <> 0 AND (mask & before) <> 0), 0)::bigint AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0)::bigint AS unique_fails,
    coalesce(sum(good) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0)::bigint AS good_lost,
    coalesce(sum(toxic) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0)::bigint AS toxic_lost
  FROM tabled, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::bigint AS shapley
FROM counted"""


@query("op12_audit", OP12_SQL)
def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
