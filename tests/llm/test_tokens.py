"""Records, byte-pair encoding and packing against the libraries."""

import random
import zlib

import base64
import hashlib
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusengine.llm import bytepair, packing, records
from corpusengine.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def documents(table):
    return [(r.doc_id, r.text) for r in table.collect()]


def test_records_round_trip(spark, odd):
    folder = scratch_path(spark, "records")
    records.write_records(odd, folder, WORDS, end_id=1)
    index = records.starts(records.write_index(spark, folder))
    rows = sorted(index.collect(), key=lambda r: r.start)
    encode = library(WORDS)
    wanted = sorted((i is not None, i or 0, [*encode(text), 1]) for i, text in documents(odd))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in rows) == sorted((a, b, len(c)) for a, b, c in wanted)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [x[:2] for x in wanted]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    read = {(r.doc_id, tuple(r.ids)) for r in records.read_records(spark, folder).collect()}
    assert read == {(i, (*encode(text), 1)) for i, text in documents(odd)}
    some = index.where("doc_id IN (4, 6)").orderBy(F.rand(1))
    assert sorted(r.doc_id for r in records.read_records(spark, folder, some).collect()) == [4, 4, 6]
    crcs = {zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in read}
    assert {r.ids_crc32 for r in rows} == crcs


@pytest.mark.parametrize("seed", range(3))
def test_packing_is_within_one_of_the_best(spark, seed):
    """Against the fewest sequences of all ways to pack a few pieces, and the bound for many in many partitions."""
    rng = random.Random(seed)

    def fewest(lengths, capacity):
        best = len(lengths)

        def place(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(lengths):
                best = len(rooms)
                return
            for i in {room: i for i, room in enumerate(rooms) if room >= lengths[k]}.values():
                place(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1 :]])
            place(k + 1, [*rooms, capacity - lengths[k]])

        place(0, [])
        return best

    def used(lengths, capacity):
        rows = [(k, 0, 0, n, k) for k, n in enumerate(lengths)]
        placed = packing.pack(spark.createDataFrame(rows, packing.PIECE), capacity).collect()
        rooms = {}
        for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == rooms.get(r.sequence_id, 0)
            rooms[r.sequence_id] = r.offset + r.length
        assert len(placed) == len(lengths) and max(rooms.values()) <= capacity
        return len(rooms)

    few = sorted((rng.randint(5, 60) for _ in range(11)), reverse=True)
    best = fewest(few, 100)
    assert packing.lower_bound(np.bincount(few, minlength=101), 100) <= best <= used(few, 100) <= best + 1


def test_pieces_in_many_partitions_reach_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_PIECES", 1000)
    rng = random.Random(5)
    lengths = [rng.choice([rng.randint(1, 1999), rng.randint(1, 300)]) for _ in range(4000)]
    rows = [(k, 0, 0, n, k) for k, n in enumerate(lengths)]
    placed = packing.pack(spark.createDataFrame(rows, packing.PIECE), 2048)
    bound = packing.lower_bound(np.bincount(lengths, minlength=2049), 2048)
    assert bound <= placed.select("sequence_id").distinct().count() <= bound + 2


def test_files_follow_their_numbers(spark):
    rows = [(k, f"part-{99_998 + k:05d}-x.txt", 0, 0, 9, 10 + k, 7, 0) for k in range(4)]
    index = spark.createDataFrame(rows, records.INDEX)
    assert [r.start for r in records.starts(index).orderBy("doc_id").collect()] == [0, 10, 21, 33]


def test_files_are_dealt_by_size(spark, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 1000)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40).alias("text"))
    folder = scratch_path(spark, "records")
    records.write_records(docs, folder, WORDS, end_id=1)
    assert records.files(spark, folder).count() >= 10
    rows = records.starts(records.write_index(spark, folder)).orderBy("doc_id").collect()
    assert [r.start for r in rows] == [41 * k for k in range(60)]


def test_a_wrong_byte_is_found():
    ids = np.arange(70_000, 70_010, dtype=np.uint32)
    data = records.frame(5, ids) + records.END + records.frame(None, ids[:0]) + records.END
    doc_id, found, then = records.unframe(data, 0)
    assert doc_id == 5 and found.tolist() == ids.tolist() and records.unframe(data, then)[0] is None
    for at in range(then):
        with pytest.raises(ValueError):
            records.unframe(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :], 0)


def test_no_documents(spark, empty):
    folder = scratch_path(spark, "records")
    records.write_records(empty, folder, WORDS)
    assert records.starts(records.write_index(spark, folder)).count() == 0
    assert bytepair.encode(empty, RANKS, public_tokenizers.PATTERN, ["doc_id"]).count() == 0
    assert packing.pack(packing.pieces(empty, BYTES, 64), 64).count() == 0


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs_equal_the_library(spark, odd, tik):
    got = bytepair.encode(odd, RANKS, public_tokenizers.PATTERN, ["doc_id", "id"])
    assert got.columns == ["doc_id", "id", "n_tokens", "ids"]
    decoded = bytepair.decode(got, RANKS, ["doc_id", "ids"]).collect()
    assert sorted(((r.doc_id or 0, r.ids) for r in decoded)) == sorted((i or 0, tik.encode_ordinary(t or "")) for i, t in documents(odd))
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for _, t in documents(odd))
    digests = bytepair.encode(odd, RANKS, public_tokenizers.PATTERN, ["doc_id"], digest=True).collect()
    wanted = {hashlib.sha256(np.array(tik.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest() for _, t in documents(odd)}
    assert {r.ids_sha256 for r in digests} == wanted


def test_prefixes_are_exact_under_appends_and_edits(tik):
    ranks = bytepair.load(RANKS)
    rng = random.Random(3)
    piece = tik._core_bpe.encode_single_piece
    for _ in range(400):
        data = bytes(rng.choice(b"aabehinrt  .-=0") for _ in range(rng.randint(1, 80)))
        cut = rng.randint(0, len(data))
        table = bytepair.Prefixes(ranks, data[:cut])
        table.append(data[cut:])
        assert table.ids() == piece(data)
        start = rng.randint(0, len(data))
        end, new = rng.randint(start, len(data)), bytes(rng.choice(b"aet -") for _ in range(rng.randint(0, 5)))
        table.replace(start, end, new)
        assert table.data == data[:start] + new + data[end:] and table.ids() == (piece(table.data) if table.data else [])
    text = b" the cat sat on the mat" * 400
    table = bytepair.Prefixes(ranks, text)
    assert table.replace(50, 51, b"o") < 2000 and table.ids() == piece(table.data)


def test_packing_is_gapless_and_near_the_bound(spark, odd):
    encode = library(BYTES)
    placed = packing.pack(packing.pieces(odd, BYTES, 64), 64).collect()
    assert len(placed) == sum(-(-(len(encode(t)) + 1) // 64) for _, t in documents(odd))
    sequences = {}
    for r in placed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    ids = np.array([*encode(documents(odd)[7][1]), 0], "<u4")
    own = sorted((r for r in placed if r.doc_id == 6), key=lambda r: r.piece)
    assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)


def test_bounds_hold_and_exchanges_help(spark, monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        lengths = [rng.choice([5, 6, 7, 10, 11]) for _ in range(rng.randint(1, 9))]
        bound = packing.lower_bound(np.bincount(lengths, minlength=21), 20)

        def fewest(left, rooms, limit):
            if not left:
                return len(rooms)
            if len(rooms) >= limit:
                options = {r for r in rooms if r >= left[0]}
            else:
                options = {r for r in rooms if r >= left[0]} | {20}
            best = 99
            for room in options:
                now = list(rooms)
                if room in now:
                    now.remove(room)
                best = min(best, fewest(left[1:], sorted([*now, room - left[0]]), limit))
            return best

        assert bound <= fewest(sorted(lengths, reverse=True), [], len(lengths))
    # Halves and thirds: dealt to small partitions, they only fit after an exchange.
    rows = [(k, 0, 0, rng.choice([300, 340, 500, 700]), 0) for k in range(4000)]
    cut = spark.createDataFrame(rows, packing.PIECE)
    monkeypatch.setattr(packing, "PARTITION_PIECES", 100)
    placed = packing.pack(cut, 1000)
    assert placed.count() == 4000
    counts = np.bincount([r[3] for r in rows], minlength=1001)
    assert placed.select("sequence_id").distinct().count() <= packing.lower_bound(counts, 1000) * 1.05 + 2


def test_borders_and_frequent_units_are_asked_once(tik, monkeypatch):
    known = bytepair.load(RANKS)
    ranks = bytepair.Ranks(known.tokens, known.halves)
    asked = []
    monkeypatch.setattr(ranks, "stays", lambda left, right: asked.append((left, right)) or bytepair.Ranks.stays(ranks, left, right))
    words = [f"{a}erthandin{b}" for a in ("th", "an", "ou") for b in ("er", "at", "ing")]
    assert [ranks.encode(w.encode()) for w in words] == [tik.encode_ordinary(w) for w in words]
    assert len(asked) == len(set(asked))
    monkeypatch.setattr(bytepair, "KEPT_BORDERS", 5)
    ranks.borders.clear()
    assert [ranks.encode(w.encode()) for w in words] == [tik.encode_ordinary(w) for w in words] and len(ranks.borders) <= 5

    # A word that comes again and again is kept while rare ones fill the memory.
    monkeypatch.setattr(bytepair, "KEPT_UNITS", 20)
    monkeypatch.setattr(bytepair, "KEPT_PARTS", 20)
    units, pieces = bytepair.UnitIds(ranks, public_tokenizers.PATTERN), []
    encode = ranks.encode
    monkeypatch.setattr(ranks, "encode", lambda data: pieces.append(data) or encode(data))
    text = " ".join(f"rare{k} oftenseenword" for k in range(300))
    assert units.encode(text).tolist() == tik.encode_ordinary(text)
    assert pieces.count(b" oftenseenword") == 1 and len(units) <= 20 and len(units.older) <= 20
