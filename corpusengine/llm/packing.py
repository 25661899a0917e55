"""Packing documents into sequences of a fixed number of tokens, with a proof of how few can do.

Pieces are dealt to partitions and packed there by best fit in order of falling length. Dual feasible functions give
a lower bound on the sequences of any set of lengths: such a function maps a length to a share of a sequence so that
lengths which fit together have shares of at most one in sum, so the sum of all shares can't be more than the number
of sequences. A partition that meets its bound is certified. The pieces in half-empty sequences of all other
partitions, and those of each partition's emptiest sequence, are exchanged: dealt anew together and packed again.
That goes on until all sequences together meet the bound of all lengths, or until nothing is gained.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import documents, query
from corpusengine.llm.tokens import unit_ids
from corpusengine.session import stage

# Pieces in a partition: enough that best fit wastes next to nothing, and a second's work.
PARTITION_PIECES = 50_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, sequence_id long, offset long, again boolean, bins long"


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """A number of sequences that no packing of these lengths can do without; counts[n] pieces have length n."""
    sizes = np.flatnonzero(counts)
    n, x = counts[sizes].astype(object), sizes.astype(np.int64)

    def needed(shares: np.ndarray, whole: int) -> int:
        return -(-int((shares.astype(object) * n).sum()) // whole)

    if not len(x):
        return 0
    best = needed(x, capacity)
    for k in range(1, 33):  # rounding to k-ths
        times = (k + 1) * x
        best = max(best, needed(np.where(times % capacity == 0, x * k, times // capacity * capacity), k * capacity))
    for e in x[x * 2 <= capacity]:  # small pieces left out, and large ones counted whole
        best = max(best, needed(np.where(x > capacity - e, capacity, np.where(x < e, 0, x)), capacity))
        k = capacity // int(e)
        shares = np.where(2 * x > capacity, k - (capacity - x) // e, np.where(x < e, 0, 1))
        best = max(best, needed(shares, k))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece and the free room of each sequence, by best fit in order of falling length."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some sequence has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, place = capacity, len(free)
            free.append(capacity)
        sequence[i], offset[i] = place, capacity - room
        free[place] = room = room - length
        if room:
            by_room[room].append(place)
            rooms |= 1 << room
    return sequence, offset, np.array(free, np.int64)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, cut only where they exceed ``capacity``.

    The cut leaves full pieces behind a first one that may be shorter. A null or empty text has the end id alone,
    and no piece if there is none.
    """
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = units.encode(text.as_py() or "") + end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                edges = [0, *range(first, total + 1, capacity)] if total else []
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in PIECE.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """``cut``, a table as ``pieces`` makes it, with (sequence_id, offset): sequences of at most ``capacity``.

    Rows are told apart by their place, so equal and null doc_ids are kept apart. Full pieces are sequences of their
    own. An empty table gives an empty table. A piece longer than ``capacity`` is an error.
    """
    cut = stage(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    lengths = cut.groupBy("length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in lengths.toLocalIterator():  # one row per length, at most capacity
        counts[row["length"]] = row["n"]
    whole = cut.where(F.col("length") == capacity)
    whole = whole.withColumns({"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("long")}).drop("_row")
    bound = lower_bound(counts, capacity) - int(counts[capacity])
    rest = cut.where(F.col("length") < capacity)
    n = int(counts[:capacity].sum())

    placed, used = _round(rest, n, capacity, 0)
    settled = []
    k = 0
    while used > bound:
        k += 1
        pool = placed.where("again").drop("sequence_id", "offset", "again", "bins")
        n, before = placed.where("again").agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if not n:
            break
        dealt = pool.withColumn("_row", F.monotonically_increasing_id())
        packed, now = _round(dealt, n, capacity, k)
        if now >= before:
            break
        settled.append(placed.where("NOT again"))
        placed, used = packed, used - before + now
    for table in [whole, *settled]:
        placed = placed.select(*whole.columns).unionByName(table.select(*whole.columns))
    return placed.select(*whole.columns)


def _round(rest: DataFrame, n: int, capacity: int, number: int) -> tuple[DataFrame, int]:
    """Deal ``n`` pieces, pack each partition, and count the sequences."""
    groups = max(1, -(-n // PARTITION_PIECES))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        sequence, offset, free = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        emptiest = free == free.max()
        again = free > 0 if len(free) > bound else emptiest & (free > 0)
        first = np.zeros(len(lengths), np.int64)
        first[0] = len(free)
        ids = (number << 50) + (key[0].as_py() << 26) + sequence
        made = {"sequence_id": ids, "offset": offset, "again": again[sequence], "bins": first}
        for name, values in made.items():
            table = table.append_column(name, pa.array(values))
        return table.drop_columns(["_group", "_row"])

    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(groups)).cast("long"))
    placed = stage(dealt.groupBy("_group").applyInArrow(run, PLACED), "packed")
    return placed, placed.agg(F.sum("bins")).first()[0] or 0


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    capacity = 2048
    cut = pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity, end_id=0)
    return pack(cut, capacity)
