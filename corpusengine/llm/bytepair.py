"""Byte-level byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a byte string there is one token that the encoding of the prefix ends with. It is stored. A
token t that ends at place i is that token exactly if the encoding of the prefix before t, extended by t, is what
merging would have given, and that only depends on the last token before t: no merge may have reached over the
border between the two while they were built up (``Ranks.stays``). So each place is settled by the tokens that end
there, bytes can be appended without a look at what is more than a token's length away, and after an edit only the
places up to the next agreement are settled anew.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from corpusengine.llm.registry import documents, query
from corpusengine.llm.tokens import KEPT_PARTS, KEPT_UNITS, Memory, cut

# Borders of two tokens whose answers a worker keeps.
KEPT_BORDERS = 500_000


class Ranks:
    """A vocabulary of ranks: ``tokens[i]`` is the byte string of id i, lower ids merge first.

    ``halves`` has the two tokens each token is merged from, or none for single bytes. It follows from the ranks,
    and may be given so that it is worked out only once.
    """

    def __init__(self, tokens: list[bytes], halves: list[tuple[int, int] | None] | None = None):
        self.tokens = tokens
        self.ids = {token: i for i, token in enumerate(tokens)}
        self.lengths = list(map(len, tokens))
        self.longest = max(self.lengths)
        self.borders: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int] | None] = [None] * len(tokens)
        for i, token in enumerate(tokens):
            if len(token) > 1 and (pair := halves[i] if halves else self._halves_of(i, token)):
                self.halves[i] = pair
                self.pairs[pair] = i
        self.singles = [self.ids.get(bytes([byte])) for byte in range(256)]
        # A place where none of the longer tokens stays has the token of its byte, so those are not looked for.
        self.finder = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            if self.halves[i]:  # a token that no merge leads to never appears
                self.finder.add_word(token.decode("latin-1"), i)
        self.finder.make_automaton()

    def _halves_of(self, rank: int, token: bytes) -> tuple[int, int] | None:
        for at in range(1, len(token)):
            left, right = self.ids.get(token[:at], rank), self.ids.get(token[at:], rank)
            if left < rank and right < rank and self.stays(left, right):
                return left, right
        return None

    def stays(self, left: int, right: int) -> bool:
        """Whether no merge reaches over the border of two tokens that stand side by side.

        The younger of the two is taken apart again and again. A merge over the border, of the parts that then
        touch it, would have come first if its rank is below that of the part just undone; among equal ranks the
        merge further left comes first.
        """
        before = len(self.tokens) + 1
        while True:
            merged = self.pairs.get((left, right))
            if merged is not None and merged < before:
                return False
            of_left, of_right = self.halves[left], self.halves[right]
            if of_left and (left > right or not of_right):
                before, left = left, of_left[1]
            elif of_right:
                before, right = right + 1, of_right[0]
            else:
                return True

    def asked(self, left: int, right: int) -> bool:
        """``stays``, whose answer is noted in ``borders`` as ``left << 32 | right``."""
        if len(self.borders) >= KEPT_BORDERS:
            self.borders.clear()
        found = self.borders[left << 32 | right] = self.stays(left, right)
        return found

    def encode(self, data: bytes) -> list[int]:
        whole = self.ids.get(data)
        if whole is not None and (self.halves[whole] or len(data) == 1):
            return [whole]
        return Prefixes(self, data).ids()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """A byte string with the last token of each of its prefixes; it can be extended and edited."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string: the places before it stay as they are."""
        at = len(self.data)
        self.data += more
        self._settle(at, [])

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:end]; returns how many places were settled anew."""
        later = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        return self._settle(start, later)

    def _settle(self, at: int, later: list[int]) -> int:
        """Settle the places from ``at`` on.

        ``later`` has what the last places held before. Once as many of them as the longest token has bytes have
        come out as before, everything that later places depend on is as before, and so are they.
        """
        ranks, data, last = self.ranks, self.data, self.last
        lengths, longest, borders, singles = ranks.lengths, ranks.longest, ranks.borders, ranks.singles
        back = max(0, at - longest)
        kept, same, place = len(data) - len(later), 0, at
        found = ranks.finder.iter(data[back:].decode("latin-1")) if len(ranks.finder) else ()
        for end, token in found:
            end += back
            if end < place:
                continue  # settled already
            while place < end and same < longest:
                last.append(singles[data[place]])
                if later:
                    same = same + 1 if place >= kept and later[place - kept] == last[place] else 0
                place += 1
            if same >= longest:
                break
            before = end - lengths[token]
            if before >= 0:
                left = last[before]
                stays = borders.get(left << 32 | token)
                if not (ranks.asked(left, token) if stays is None else stays):
                    continue
            last.append(token)
            if later:
                same = same + 1 if end >= kept and later[end - kept] == token else 0
            place += 1
        if same < longest:
            last.extend([singles[byte] for byte in data[place:]])
        settled = len(last) - at
        last.extend(later[len(last) - kept :] if len(last) < len(self.data) else [])
        return settled

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        last, lengths = self.last, self.ranks.lengths
        while end:
            token = last[end - 1]
            out.append(token)
            end -= lengths[token]
        return out[::-1]


@functools.lru_cache(maxsize=4)
def load(path: str) -> Ranks:
    """The vocabulary of a file of base64 tokens and their ranks, on the driver."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"ranks of {path} are not 0 to {len(ranked) - 1}")
    return Ranks([token for _, token in ranked])


class UnitIds(Memory):
    """unit of a text -> the ids of its pieces as 4 bytes each; a piece is one match of the pattern."""

    def __init__(self, ranks: Ranks, pattern: str):
        super().__init__(KEPT_UNITS)
        self.ranks, self.pieces, self.parts = ranks, regex.compile(pattern).findall, Memory(KEPT_PARTS)

    def piece(self, piece: str) -> bytes:
        found = self.parts.get(piece) or self.parts.recall(piece)
        if found is None:
            ids = self.ranks.encode(piece.encode())
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= 64:
                self.parts.note(piece, found)
        return found

    def __missing__(self, unit: str) -> bytes:
        """``unit`` behind a space."""
        found = self.recall(unit)
        if found is None:
            known = self.parts.get
            found = b"".join([known(piece) or self.piece(piece) for piece in self.pieces(" " + unit)])
            if len(unit) <= 64:
                self.note(unit, found)
        return found

    def encode(self, text: str) -> np.ndarray:
        first, *rest = cut(text)
        start = b"".join(map(self.piece, self.pieces(first)))
        return np.frombuffer(start + b"".join(map(self.__getitem__, rest)), "<u4")


_LOADED: dict[object, UnitIds] = {}


def _unit_ids(shared, pattern: str) -> UnitIds:
    """The worker's vocabulary and its memory of units, kept from task to task."""
    key = (shared.value["key"], pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = UnitIds(Ranks(shared.value["tokens"], shared.value["halves"]), pattern)
    return _LOADED[key]


def _shared(spark: SparkSession, path: str):
    """The vocabulary as a broadcast: as large as its file, whatever the documents."""
    ranks = load(path)
    return spark.sparkContext.broadcast({"key": path, "tokens": ranks.tokens, "halves": ranks.halves})


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], digest: bool = False) -> DataFrame:
    """``keep`` and, for the whole column ``text``, (n_tokens, ids); with ``digest``, hashes in place of ids.

    Each match of ``pattern`` is encoded by itself with the ranks in ``path``; special tokens are ordinary text. A
    null or empty text has no ids. Rows stay as they are, whatever their keys; other columns are dropped. A text of
    any length is encoded whole, in time proportional to its length. The pattern must not match over a space that
    stands between two characters that are no white space, other than as first character.

    With ``digest`` the ids are decoded again and the result is (n_tokens, ids_sha256, decoded_sha256): lowercase
    hex of the ids as little-endian unsigned 32-bit integers, and of the decoded bytes.
    """
    shared = _shared(docs.sparkSession, path)
    columns = docs.select(*keep, "text")
    kinds = ", ".join(f"`{c}` {t}" for c, t in columns.dtypes if c != "text")
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit_ids(shared, pattern)
        for batch in batches:
            ids = [units.encode(text.as_py() or "") for text in batch.column("text")]
            counts = pa.array([len(x) for x in ids], pa.int64())
            if digest:
                decoded = [units.ranks.decode(x.tolist()) for x in ids]
                hashes = [[hashlib.sha256(x).hexdigest() for x in what] for what in (ids, decoded)]
                made = [counts, *(pa.array(x, pa.string()) for x in hashes)]
            else:
                made = [counts, pa.array([x.astype("i4") for x in ids], pa.list_(pa.int32()))]
            kept = [batch.column(c) for c in keep]
            names = [*keep, *[field.split()[0] for field in out.split(", ")]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    return columns.mapInArrow(run, f"{kinds}, {out}")


def decode(encoded: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and the bytes that the column ``ids`` stands for, as ``decoded``; null ids are null."""
    shared = _shared(encoded.sparkSession, path)
    columns = encoded.select(*dict.fromkeys([*keep, "ids"]))
    kinds = ", ".join(f"`{c}` {dict(columns.dtypes)[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value["tokens"]
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            decoded = [None if ids is None else b"".join(map(tokens.__getitem__, ids)) for ids in rows]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(decoded, pa.binary())], [*keep, "decoded"])

    return columns.mapInArrow(run, f"{kinds}, decoded binary")


@query("op2_bytepair")
def op2_bytepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, ["doc_id"], digest=True)
