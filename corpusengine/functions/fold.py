"""Scores of clauses, folded over the tokens of a row inside a task.

A clause is read once from left to right. What is kept on the way is the product of the modifiers since the last
sentiment word and the places of the last negation and adverb, so the time is in proportion to the tokens.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql.functions import arrow_udf

from corpusengine.constants import ADVERB_BEFORE_NEGATION, FIRST_CLAUSE_FACTOR, NEGATION_BEFORE_ADVERB

# The functions below travel with the query: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Of a word: sentiment weight, adverb factor, and whether it negates.
Entry = tuple[float | None, float | None, bool]
SCORES = "array<struct<clause: int, score: double>>"


def clause_score(tokens: list[str], entries: dict[str, Entry]) -> float | None:
    """The sum of a clause's sentiment words, each changed by the modifiers between it and the one before; None without
    any. Before the first one they count from position 1.

    A product is kept with a power of two apart, so that only its result can leave the range of a double, whatever the
    order of its factors. The sum is rounded once: a large term takes nothing from small ones, in any order.
    """
    return _score((at, entries[token]) for at, token in enumerate(tokens) if token in entries)


def _score(found: Iterable[tuple[int, Entry]]) -> float | None:
    scores, factor, power, negation, adverb = [], 1.0, 0, -1, -1
    for at, (weight, strength, negates) in found:
        if weight is not None:
            order = 1.0
            if negation >= 0 and adverb >= 0:
                order = NEGATION_BEFORE_ADVERB if negation < adverb else ADVERB_BEFORE_NEGATION
            scores.append(_scaled(weight * factor * order, power))
            factor, power, negation, adverb = 1.0, 0, -1, -1
        elif at > 0:
            if negates:
                factor, negation = -factor, at
            if strength is not None:
                factor, adverb = factor * strength, at
                if factor and not 1e-99 < abs(factor) < 1e99:
                    factor, shift = math.frexp(factor)
                    power += shift
    return _total(scores) if scores else None


def _total(numbers: list[float]) -> float:
    """The sum, rounded once; that of opposite infinities is no number."""
    try:
        return math.fsum(numbers)
    except ValueError:
        return math.nan
    except OverflowError:
        # Finite numbers that leave the range of a double on the way.
        return _scaled(math.fsum(math.ldexp(x, -64) for x in numbers), 64)


def _scaled(number: float, power: int) -> float:
    """``number * 2 ** power``, infinite beyond the range of a double."""
    try:
        return math.ldexp(number, power) if power else number
    except OverflowError:
        return math.copysign(math.inf, number)


def scorer(entries: dict[str, Entry]) -> Callable:
    """A column function from the token lists of a row's clauses to the scores of clause 0 and of those with a sentiment
    word. Null for null."""

    @arrow_udf(SCORES)
    def fold(rows: pa.Array) -> pa.Array:
        def lengths(lists: pa.Array) -> np.ndarray:
            return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

        sizes, clauses = lengths(rows), rows.flatten()
        words = lengths(clauses)
        encoded = clauses.flatten().dictionary_encode()
        # Different words are few, and only the places of those with an entry are looked at one by one.
        of_word = [*map(entries.get, encoded.dictionary.to_pylist()), None]
        known = np.array([entry is not None for entry in of_word], dtype=bool)
        code = pc.fill_null(encoded.indices, len(of_word) - 1).to_numpy(zero_copy_only=False)
        hits = np.flatnonzero(known[code])
        clause = np.repeat(np.arange(len(words)), words)[hits]
        at = hits - (np.cumsum(words) - words)[clause]
        found = list(zip(at.tolist(), [of_word[c] for c in code[hits].tolist()]))
        edges = np.flatnonzero(np.diff(clause, prepend=-1))
        scores = np.zeros(len(words))
        scored = np.zeros(len(words), dtype=bool)
        for one, begin, end in zip(clause[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(hits)]):
            score = _score(found[begin:end])
            if score is not None:
                scores[one], scored[one] = score, True
        owner = np.repeat(np.arange(len(sizes)), sizes)
        turn = np.arange(len(words)) - (np.cumsum(sizes) - sizes)[owner]
        # A score of 0 has no sign, and a product beyond the range of a double is endless.
        with np.errstate(over="ignore"):
            scores = np.where(turn == 0, FIRST_CLAUSE_FACTOR * np.where(scores == 0, 0.0, scores), scores)
        kept = scored | (turn == 0)
        columns = [pa.array(turn[kept].astype(np.int32)), pa.array(scores[kept])]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=len(sizes)))]).astype(np.int32)
        made = pa.StructArray.from_arrays(columns, ["clause", "score"])
        return pa.ListArray.from_arrays(pa.array(offsets), made, mask=rows.is_null())

    return fold
