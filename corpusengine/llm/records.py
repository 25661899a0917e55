"""Token ids as length-delimited binary records, with checksums and a separate offset index.

A data file is a run of frames, one per document, in ascending order of (doc_id, text):

    length of the payload   8 bytes, little-endian
    masked CRC-32 of those  4 bytes
    payload                 flags 1 byte, doc_id 8 bytes, ids of 2 or 4 bytes each, all little-endian
    masked CRC-32 of it     4 bytes
    end mark                1 byte, 0x0A

Flags: bit 0, there is a doc_id; bit 1, ids take 4 bytes. A checksum c is masked as (c rotated right by 15) +
0xA282EAD8, so that a file of frames may itself be framed. Files are numbered by name in document order.

Spark's text writer puts out the bytes of a frame and the end mark as they are. So files are written to whatever
file system the folder names, and committed by task: a lost executor or a repeated task leaves no half files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusengine.llm.registry import documents, query
from corpusengine.llm.tokens import unit_ids
from corpusengine.operators.lookup import attach
from corpusengine.session import scratch_path, stage

# Bytes of text in a data file, about; the ids of a text take about as many.
FILE_BYTES = 256 << 20

HEAD = struct.Struct("<QI")
BODY = struct.Struct("<Bq")
CHECK = struct.Struct("<I")
END = b"\n"
HAS_ID, WIDE = 1, 2

INDEX = "doc_id long, shard string, row long, offset long, length long, n_tokens long, ids_crc32 long, before long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """The frame of one document, but for the end mark."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    flags = (HAS_ID if doc_id is not None else 0) | (WIDE if wide else 0)
    payload = BODY.pack(flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = HEAD.pack(len(payload), masked(struct.pack("<Q", len(payload))))
    return length + payload + CHECK.pack(masked(payload))


def unframe(data: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, place of the next frame) of the frame at a place. Raises ValueError if a byte is wrong."""
    length, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"wrong length at byte {at}")
    start = at + HEAD.size
    payload = data[start : start + length]
    end = start + length + CHECK.size
    if len(payload) != length or CHECK.unpack_from(data, end - CHECK.size)[0] != masked(payload):
        raise ValueError(f"wrong payload at byte {at}")
    if data[end : end + 1] != END:
        raise ValueError(f"no end mark at byte {end}")
    flags, doc_id = BODY.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=BODY.size)
    return doc_id if flags & HAS_ID else None, ids, end + len(END)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1) -> None:
    """Encode the column ``text`` of every row and write the frames under ``folder``/data.

    A null or empty text has no ids but the end id. Rows with equal doc_id are ordered by text, a null doc_id comes
    first; both keep their rows. An empty table writes no frame. Columns other than doc_id and text are not written.
    A task holds a batch of texts, so a very long text costs memory in proportion to itself only.
    """
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            frames = [
                frame(key, np.frombuffer(units.encode(text.as_py() or "") + end, "<u4"))
                for key, text in zip(keys, texts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # As many files as shuffles have partitions, and more where they would be too large to be read back whole.
    parts = -(-size // FILE_BYTES)
    more = [parts] if parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(*more, "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
    )
    frames = ordered.mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("frame"))
    frames.write.option("lineSep", END.decode()).text(f"{folder}/data")


def write_index(spark: SparkSession, folder: str) -> DataFrame:
    """Read all files back, check every frame, and write where each document is under ``folder``/index.

    Gives (doc_id, shard, row, offset, length, n_tokens, ids_crc32, before): ``offset`` and ``length`` are the bytes
    of the frame in its file, ``row`` its number there, ``before`` the ids of all earlier rows of the file, and
    ``ids_crc32`` the checksum of the ids as unsigned 32-bit integers.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data, rows, at, before = content.as_py(), [], 0, 0
                while at < len(data):
                    doc_id, ids, then = unframe(data, at)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((doc_id, shard, len(rows), at, then - at, len(ids), crc, before))
                    at, before = then, before + len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names)

    names = [field.split()[0] for field in INDEX.split(", ")]
    index = files(spark, folder).mapInArrow(scan, INDEX)
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content) of the data files, one row per file; a file is as large as a partition of the writer."""
    table = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
    return table.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all documents before this one; a running sum over files, not documents."""
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    # Names grow longer from the hundred thousandth file on, so they are ordered by their number.
    number = F.regexp_extract("shard", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number, "shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # One row per file of the writer.
    return attach(index, stage(shards, "shard-starts"), "shard").withColumn("start", F.col("_before") + F.col("before")).drop("_before")


def read_records(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids) of the rows of an index in any order, for instance of a shuffled part; all of it by default.

    Rows are looked up by (shard, offset). Many rows of one file are read in that file's task.
    """
    wanted = read_index(spark, folder) if wanted is None else wanted
    places = wanted.groupBy("shard").agg(F.sort_array(F.collect_list("offset")).alias("_at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, places in zip(batch.column("content"), batch.column("_at").to_pylist(), strict=True):
                data = content.as_py()
                for at in places:
                    doc_id, ids, _ = unframe(data, at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), pa.array([ids.astype("i8")], pa.list_(pa.int64()))],
                        ["doc_id", "ids"],
                    )

    joined = files(spark, folder).join(places, "shard").select("content", "_at")
    return joined.mapInArrow(read, "doc_id long, ids array<long>")


@query("op1_records")
def op1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "records")
    write_records(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    index = starts(write_index(spark, folder))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset", "length")
