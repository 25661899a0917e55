"""Token ids of whole texts by the tokenizers library, with the ids of repeated words kept.

Both vocabularies cut a text into pieces before any merge, and no piece reaches over a single space that stands
between two other characters (the space begins the next piece, or is dropped). So a text is the sequence of its
units, cut at such spaces, and the ids of the text are the ids of its units one after the other. Units repeat, so
the library sees each of them once per worker and not once per occurrence.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

# Entries of a generation of a worker's memory of units, and of their parts.
KEPT_UNITS = 250_000
KEPT_PARTS = 350_000

# The letters a word is put together from without asking how the library normalises it: composed Latin ones.
LAST_LATIN = "\u024f"
MARKS = ".,;:!?"

# White space to Python but not to the library.
_separators = re.compile("[\x1c-\x1f]").search


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else one of 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


class Memory(dict):
    """What was found out, in two generations: a full one becomes the older one, whose entries come back as they are
    met again, and what the older one still holds by then is forgotten. So frequent entries stay."""

    def __init__(self, kept: int):
        super().__init__()
        self.kept, self.older = kept, {}

    def recall(self, key: str) -> bytes | None:
        """An entry of the older generation, which is young again by that."""
        found = self.older.get(key)
        if found is not None:
            self.note(key, found)
        return found

    def note(self, key: str, found: bytes) -> None:
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        self[key] = found


class UnitIds(Memory):
    """unit -> its ids as little-endian unsigned 32-bit integers; a unit not yet seen is asked of the library.

    A word of Latin letters is one piece, and closing marks behind it are another: the merges of such a word are
    asked of the library's model without its normaliser and splitter, which would leave the word as it is.
    ``spaced``: units stand for themselves behind a space (byte-level vocabularies); else white space is dropped and
    case is folded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__(KEPT_UNITS)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.encode_special_tokens = True
        self.spaced = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        self.letters = byte_letters()
        self.parts = Memory(KEPT_PARTS)

    def ask(self, unit: str) -> bytes:
        return array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def part(self, part: str, letters: bool) -> bytes:
        """The ids of a piece: of letters, with their space if there is one, or of marks."""
        found = self.parts.get(part) or self.parts.recall(part)
        if found is None:
            if letters:
                if part.isascii():
                    spelt = part.replace(" ", self.letters[32])
                else:
                    spelt = part.encode().decode("latin-1").translate(self.letters)
                found = array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()
            else:
                found = self.ask(part)
            self.parts.note(part, found)
        return found

    def made(self, unit: str) -> bytes:
        if "\n" in unit and self.spaced:
            head, _, tail = unit.partition("\n")
            if head and tail and not head[-1].isspace() and not tail[0].isspace():
                return self.made(head) + self.part("\n", False) + self.made(tail)
        word = unit.rstrip(MARKS)
        letters = word[1:] if self.spaced and word[:1] == " " else word
        folded = word if self.spaced else word.lower()
        if len(unit) <= 64 and letters.isalpha() and (letters.isascii() or max(letters) <= LAST_LATIN) and len(folded) == len(word):
            marks = unit[len(word) :]
            return self.part(folded, True) + (self.part(marks, False) if marks else b"")
        return self.ask(unit)

    def plain(self, unit: str) -> bytes:
        """As ``made``, but a unit that is a word with marks behind it, or without, is put together here at once."""
        word = unit.rstrip(MARKS)
        if len(unit) < 64 and word.isalpha() and (word.isascii() or max(word) <= LAST_LATIN):
            key = " " + word if self.spaced else word.lower()
            if self.spaced or len(key) == len(word):
                found = self.parts.get(key) or self.part(key, True)
                if len(word) == len(unit):
                    return found
                marks = unit[len(word) :]
                return found + (self.parts.get(marks) or self.part(marks, False))
        return self.made(" " + unit if self.spaced else unit)

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            found = self.plain(unit)
            if len(unit) > 64:
                return found
        if len(self) >= self.kept:
            self.note(unit, found)
        else:
            self[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, 4 bytes each."""
        if self.spaced:
            first, *units = cut(text)
            return self.made(first) + b"".join(map(self.__getitem__, units))
        if _separators(text):
            return self.ask(text)
        return b"".join(map(self.__getitem__, text.split()))


def cut(text: str) -> list[str]:
    """The text cut at each single space between two characters that are no white space."""
    units = text.split(" ")
    if len(text.split()) == len(units) + text.count("\n"):
        return units  # every white space is one space or one line end, and stands between two others
    joined = [units[0]]
    for unit in units[1:]:
        last = joined[-1]
        if not unit or not last or unit[0].isspace() or last[-1].isspace():
            joined[-1] = f"{last} {unit}"
        else:
            joined.append(unit)
    return joined


@functools.lru_cache(maxsize=2)
def unit_ids(path: str) -> UnitIds:
    """One memory of units per vocabulary and worker."""
    return UnitIds(path)
