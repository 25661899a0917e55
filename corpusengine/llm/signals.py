"""Numbers that describe how a text is written, whatever it is about."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

NAMES = [
    "log_chars",
    "log_words",
    "word_length",
    "letters",
    "upper",
    "digits",
    "spaces",
    "symbols",
    "bars",
    "exclaims",
    "stops",
    "other_ascii",
    "wide",
    "byte_entropy",
    "distinct_words",
    "top_word",
    "doubled",
    "distinct_pairs",
    "long_words",
    "short_words",
    "capital_words",
    "marked_words",
    "word_entropy",
    "word_growth",
    "longest_word",
    "log_lines",
    "line_length",
    "repeated_lines",
    "short_lines",
    "sentence_length",
    "tail_letters",
    "tail_distinct",
]

# Byte classes: which sums of the byte counts make a share.
_CLASSES = np.zeros((9, 256))
for _row, _bytes in enumerate(
    [
        [*range(65, 91), *range(97, 123), *range(128, 256)],
        range(65, 91),
        range(48, 58),
        [32, *range(9, 14)],
        b"#*$%&<>@~^_=+\\{}[]",
        b"|",
        b"!",
        b".",
        b"?,;:'\"()-/`",
    ]
):
    _CLASSES[_row, list(_bytes)] = 1
_WIDE = np.arange(256) >= 128


def signals(text: str) -> list[float]:
    """The numbers of a whole text, in the order of NAMES; an empty text has zeros only."""
    data = text.encode()
    if not data:
        return [0.0] * len(NAMES)
    size = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = _CLASSES @ counts / size
    seen = counts[counts > 0] / size
    entropy = float(-(seen * np.log2(seen)).sum())
    words = data.split()
    n = len(words)
    lines = data.split(b"\n")
    out = [math.log1p(size), math.log1p(n), (size - counts[32]) / max(n, 1) / 10, *share.tolist()]
    out += [float(counts[_WIDE].sum()) / size, entropy]
    if n:
        tally = Counter(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        times = np.fromiter(tally.values(), np.int64, len(tally)) / n
        pairs = n - 1
        out += [
            len(tally) / n,
            float(times.max()),
            sum(map(bytes.__eq__, words, words[1:])) / max(pairs, 1),
            len(set(zip(words, words[1:], strict=False))) / max(pairs, 1),
            float((lengths > 12).mean()),
            float((lengths <= 2).mean()),
            sum(map(bytes.istitle, words)) / n,
            sum(not w[-1:].isalpha() and w[-1] < 128 for w in words) / n,
            float(-(times * np.log2(times)).sum()) / 10,
            math.log1p(len(tally)) / math.log1p(n),
            math.log1p(int(lengths.max())),
        ]
    else:
        out += [0.0] * 11
    filled = [line for line in lines if line.strip()]
    out += [
        math.log1p(len(lines)),
        math.log1p(size / len(lines)),
        1 - len(set(filled)) / max(len(filled), 1),
        sum(len(line) < 40 for line in lines) / len(lines),
        math.log1p(n / (1 + int(counts[33] + counts[46] + counts[63]))),
    ]
    tail = data[size // 2 :]
    tail_counts = np.bincount(np.frombuffer(tail, np.uint8), minlength=256)
    tail_words = tail.split()
    out += [float(_CLASSES[0] @ tail_counts) / len(tail), len(set(tail_words)) / max(len(tail_words), 1)]
    return out
