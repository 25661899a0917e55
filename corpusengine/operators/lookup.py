"""Joining rows with a dictionary, whatever the size of the dictionary and however uneven the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusengine.operators.each import each
from corpusengine.session import stage

# A dictionary below both bounds is broadcast; any other goes through a shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A word list up to this length may become part of an expression.
LITERAL_WORDS = 20_000
# A key is hot when it holds more than one part in HOT_PARTS of the rows, so there are fewer than HOT_PARTS of them.
HOT_PARTS = 500
# Tasks that share the rows of one hot key.
SALTS = 64


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table is within both bounds. Counted where its rows are; only the counts are moved."""
    width = sum((F.octet_length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in df.columns), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(width.cast("long"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def attach(
    rows: DataFrame, dictionary: DataFrame, on: str | list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``rows`` joined with ``dictionary``: by broadcast when its measured size allows, else by key."""
    if is_small(dictionary, max_rows):
        return rows.join(F.broadcast(dictionary), on, how)
    return join_hot_apart(rows, dictionary, on, how)


def hot_keys(counted: DataFrame, count: str) -> DataFrame:
    """Keys with more than one part in ``HOT_PARTS`` of all rows; ``counted`` holds one row per key."""
    total = counted.agg(F.sum(count)).scalar()
    return counted.where(F.col(count) * HOT_PARTS > total).drop(count)


def join_hot_apart(
    rows: DataFrame, dictionary: DataFrame, on: str | list[str], how: str = "inner", hot: DataFrame | None = None
) -> DataFrame:
    """Shuffled join that spreads each hot key over ``SALTS`` tasks.

    ``hot`` lists the hot keys, fewer than ``HOT_PARTS`` by definition, so it is broadcast. Their rows get a salt
    from the row itself and their dictionary entries are repeated once per salt: every row still meets each entry
    of its key exactly once.
    """
    keys = [on] if isinstance(on, str) else on
    if hot is None:
        hot = hot_keys(rows.groupBy(*keys).agg(F.count("*").alias("_rows")), "_rows")
    hot = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    row_salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(0).cast("int")
    entry_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_rows = rows.join(hot, keys, "left").withColumn("_salt", row_salt).drop("_hot")
    salted_entries = dictionary.join(hot, keys, "left").withColumn("_salt", F.explode(entry_salts)).drop("_hot")
    return salted_rows.join(salted_entries, [*keys, "_salt"], how).drop("_salt")


def drop_words(tokens: DataFrame, words: DataFrame, word: str = "word") -> DataFrame:
    """Token rows whose word is not in the list."""
    return attach(tokens, words.select(F.col(words.columns[0]).alias(word)).distinct(), word, "left_anti")


def without_words(df: DataFrame, lists: str, words: DataFrame | list[str] | None) -> DataFrame:
    """``df`` with the words taken out of an array of token arrays; rows stay as they are, whatever their ids.

    A list of measured small size is tested inside the row. A longer one is joined: rows are stored with a number of
    their own, their tokens are filtered, and put back in place by that number.
    """
    if words is None or (isinstance(words, list) and not words):
        return df
    literal = _literal_words(words)
    if literal is not None:
        kept = F.transform(lists, lambda part: F.filter(part, lambda token: ~token.isin(literal)))
        return df.withColumn(lists, kept if literal else F.col(lists))
    if isinstance(words, list):
        words = df.sparkSession.createDataFrame([(word,) for word in words], "word string")
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    parts = each(rows, ["_row"], lists, "_part", "_tokens")
    tokens = each(parts, ["_row", "_part"], "_tokens", "_at", "_word")
    kept = drop_words(tokens, words, "_word").groupBy("_row", "_part").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_word"))).alias("_kept")
    )
    by_row = kept.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_part", "_kept"))).alias("_parts"))
    emptied = F.array().cast("array<string>")

    def rest(part: Column, at: Column) -> Column:
        return F.when(part.isNotNull(), F.coalesce(F.try_element_at("_parts", at)["_word"], emptied))

    joined = rows.join(by_row, "_row", "left")
    return joined.withColumn(lists, F.transform(lists, rest)).select(*df.columns)


def _literal_words(words: DataFrame | list[str]) -> list[str] | None:
    if isinstance(words, list):
        return words if len(words) <= LITERAL_WORDS else None
    if not is_small(words, LITERAL_WORDS):
        return None
    return [row[0] for row in words.distinct().limit(LITERAL_WORDS).toLocalIterator()]
