"""Language-model scores by context-tree weighting over bytes.

The next byte is coded as eight binary decisions. For each decision, every context of up to ``depth`` earlier bytes
has a Krichevsky-Trofimov estimate from its counts. A context's weighted probability is the mean of its own
estimate's and of the product of its extensions', so estimates of all depths are mixed by how well they code what
was counted. Every context that was seen is kept.

Counts come from all training bytes. They are gathered as runs of depth + 1 bytes, added up per task before the
shuffle. Contexts that end in the same ``NEAR`` bytes meet in one task, which mixes all lengths from there on; shorter
ones are tables of sums that are joined with each other. So the tree is nowhere held as a whole. What comes of it is a
table with the probability of each run of the texts. A text takes the frequent ones from an array that every task
has, and the others by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusengine.llm.registry import documents, query
from corpusengine.session import stage

DEPTH = 6
# Contexts with this many latest bytes in common are worked on by one task.
NEAR = 3
# Words whose counts, and runs whose probabilities every task gets, the most frequent ones, at most. All others are joined.
SHARED_WORDS = 1 << 20
SHARED_RUNS = 1 << 20
END = b"\n"
# Bytes or words that a task holds before it adds up what is equal.
CHUNK = 4 << 20
# Contexts of a tree in memory, and runs of a stored one, that are worked on at once.
BLOCK = 2048
ROWS = 1 << 18
WORD, RUN, ASKED = 0, 1, 2
# Texts that are looked up together, by their number as a byte, and their characters, unless one has more.
TOGETHER = 256
TOGETHER_CHARS = 1 << 20

_ONE = {n: np.arange(256) >> (7 - n) & 1 for n in range(8)}
_NODE = {n: (1 << n) - 1 + (np.arange(256) >> (8 - n)) for n in range(8)}


def tokens(text: str) -> list[bytes]:
    """Lower case (A-Z only) words between ASCII white space, then the end."""
    return [*text.encode().lower().split(), END]


def word_keys(words: list[bytes]) -> np.ndarray:
    """64-bit hashes; two of a corpus' words share one with a chance of about words squared in 2**65."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def spelled(words: list[bytes]) -> bytes:
    """The bytes that are coded: words with one space between them, and the end, which no word contains."""
    return b" ".join(words[:-1]) + END


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Tally:
    """Counts of 64-bit keys, added up whenever many are held."""

    def __init__(self):
        self.fresh: list[np.ndarray] = []
        self.counted = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        self.fresh.append(keys)
        self.held += len(keys)
        if self.held >= CHUNK:
            self.held = len(self.total()[0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.fresh:
            # Sorted bare, which is much faster than with counts; only different keys are sorted again.
            keys, self.fresh = np.concatenate(self.fresh), []
            keys.sort()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(keys)))
            both = zip(self.counted, (keys[first], times), strict=True)
            self.counted = added(*(np.concatenate(pair) for pair in both))
        return self.counted


def in_order(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys in rising order, each with its row, a number below 256."""
    if len(keys) and keys.min() >= 0 and keys.max() < 1 << 56:
        # Both fit in one number, which is sorted much faster than an order is found.
        both = keys.astype(np.uint64) << np.uint64(8) | rows
        both.sort()
        return (both >> np.uint64(8)).astype(np.int64), both.astype(np.uint8)
    order = np.argsort(keys)
    return keys[order], rows[order]


def look_up(
    table: tuple[np.ndarray, np.ndarray], found: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """For each array of keys, at most 256: how many are in ``table`` (rising keys, values), the sum of their values,
    and the other keys."""
    known, values = table
    size = len(found)
    keys, rows = np.concatenate(found), np.repeat(np.arange(size, dtype=np.uint8), [len(x) for x in found])
    counts, sums, others = np.zeros(size, np.int64), np.zeros(size), []
    for at in range(0, len(keys), CHUNK):
        asked, row = in_order(keys[at : at + CHUNK], rows[at : at + CHUNK])
        if len(known):
            first = np.flatnonzero(np.concatenate([[True], asked[1:] != asked[:-1]]))
            times = np.diff(first, append=len(asked))
            place = np.minimum(np.searchsorted(known, asked[first]), len(known) - 1)
            hit = known[place] == asked[first]
            sums += np.bincount(row, np.repeat(np.where(hit, values[place], 0.0), times), size)
            hit = np.repeat(hit, times)
            counts += np.bincount(row[hit], minlength=size)
            asked, row = asked[~hit], row[~hit]
        others.append((asked, row))
    keys, rows = (np.concatenate(column) for column in zip(*others, strict=True)) if others else (keys, rows)
    ends = np.cumsum(np.bincount(rows, minlength=size))
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return counts, sums, pa.ListArray.from_arrays(offsets, pa.array(keys[np.argsort(rows, kind="stable")]))


def runs(data: bytes, depth: int) -> np.ndarray:
    """For each byte the number of the ``depth`` bytes before it and itself; ends stand before the first byte."""
    padded = np.frombuffer(END * depth + data, np.uint8).astype(np.int64)
    out = np.zeros(len(data), np.int64)
    for k in range(depth + 1):
        out = out << 8 | padded[k : k + len(data)]
    return out


def paths(data: bytes, depth: int) -> np.ndarray:
    """As ``runs``, but the bytes before are in turned order, the latest one highest."""
    padded = np.frombuffer(END * depth + data, np.uint8).astype(np.int64)
    out = np.zeros(len(data), np.int64)
    for k in [*range(depth - 1, -1, -1), depth]:
        out = out << 8 | padded[k : k + len(data)]
    return out


def count_corpus(docs: DataFrame, depth: int) -> DataFrame:
    """(kind, key, n, times) of each word (by hash) and each run of depth + 1 bytes (as ``paths`` has it).

    ``n`` is how often it occurs in the texts where ``_train`` holds; ``times``, for runs, how often in all texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {kind: Tally() for kind in (WORD, RUN, ASKED)}

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = tallies[kind].total()
            tallies[kind], times = Tally(), n
            if kind == RUN:
                more, asked = tallies[ASKED].total()
                tallies[ASKED] = Tally()
                together = np.concatenate([keys, more])
                learned = np.concatenate([n, np.zeros(len(more), np.int64)])
                keys, times = added(together, np.concatenate([n, asked]))
                n = added(together, learned)[1]
            kinds = np.full(len(keys), kind, np.int32)
            yield from _batches([kinds, keys, n, times], ["kind", "key", "n", "times"])

        for batch in batches:
            for text, train in zip(batch.column("text"), batch.column("_train").to_pylist(), strict=True):
                words = tokens(text.as_py() or "")
                if train:
                    tallies[WORD].add(word_keys(words))
                tallies[RUN if train else ASKED].add(paths(spelled(words), depth))
            for kind, also in ((WORD, WORD), (RUN, ASKED)):
                if max(len(tallies[k].counted[0]) for k in (kind, also)) > CHUNK // 2:  # mostly different: pass it on
                    yield from out(kind)
        yield from out(WORD)
        yield from out(RUN)

    counted = docs.select("text", "_train").mapInArrow(run, "kind int, key long, n long, times long")
    # A task has added up its own already, so rows are dealt as they are and only added up where they meet.
    return counted.repartition("key").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))


def most_frequent(counts: DataFrame, limit: int, count: str = "n") -> Column:
    """A condition on ``count`` that at most ``limit`` rows meet, and nearly as many as that if there are more."""
    step = F.floor(F.log2(count) * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"))  # at most 64 * 64 of them
    held, least = 0, None
    for row in sorted(steps.collect(), key=lambda row: -row["step"]):
        held += row["rows"]
        if held > limit:
            break
        least = row["step"]
    return step >= least if least is not None else F.lit(False)


@dataclass
class Tree:
    """A tree in memory, that may have some of the contexts only.

    ``child[d][i, c]``: the kept context made of context i of length d and an earlier byte of column c, or -1.

    ``logs[d][i, c]``: log10 probability that a byte of column c follows the kept context i of length d and no
    longer kept one. ``column[b]`` is the column of byte b; bytes that were never counted share the last column.
    """

    depth: int
    column: np.ndarray
    child: list[np.ndarray]
    logs: list[np.ndarray]

    def score(self, data: bytes) -> float:
        """log10 of the probability of the bytes."""
        total = 0.0
        for at in range(0, len(data), CHUNK):
            before = (END * self.depth + data[:at])[-self.depth :]
            total += self._score(before, data[at : at + CHUNK])
        return total

    def _score(self, before: bytes, data: bytes) -> float:
        columns = self.column[np.frombuffer(before + data, np.uint8)]
        size = len(data)
        coded = columns[self.depth :]
        state = np.zeros(size, np.int32)
        logs = self.logs[0][0, coded]
        live = np.arange(size)
        for d in range(self.depth):
            earlier = columns[live + self.depth - 1 - d]
            state = self.child[d][state, earlier]
            kept = state >= 0
            live, state = live[kept], state[kept]
            if not len(live):
                break
            logs[live] = self.logs[d + 1][state, coded[live]]
        return float(logs.sum(dtype=np.float64))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma of positive numbers, by Stirling's series after seven steps up."""
    z = x + 7
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(steps)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any one sequence with these counts."""
    out = np.zeros(zeros.shape)
    seen = (zeros + ones) > 0
    a, b = zeros[seen], ones[seen]
    out[seen] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)
    return out


class Level:
    """The kept contexts of one length: their bytes, the context each one extends, and their counts of next bytes."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray, length: int, shorter: Level | None):
        names, row = np.unique(context, return_inverse=True)
        known, parents = np.ones(len(names), bool), np.zeros(len(names), np.int64)
        if shorter is not None:
            ending = names & ((1 << 8 * (length - 1)) - 1)
            known = np.isin(ending, shorter.names)
            parents = np.searchsorted(shorter.names, ending)
        use = known[row]
        order = np.argsort(row[use], kind="stable")
        self.names, self.parents = names[known], parents[known]
        self.row = (np.cumsum(known) - 1)[row[use]][order]
        self.byte, self.n = byte[use][order], n[use][order]
        self.size = len(self.names)
        self.extended = np.zeros(self.size, bool)
        # What of the counts is left to extensions that are not kept.
        self.rest = self.n.astype(np.float64)
        # Any weights between 0 and 1 mix to probabilities that add up to one, so few digits do.
        self.weights = np.ones((self.size, 255), np.float16)
        if shorter is not None and self.size:
            shorter.extended[np.unique(self.parents)] = True
            key = shorter.row * 256 + shorter.byte
            at = np.searchsorted(key, self.parents[self.row] * 256 + self.byte)
            np.subtract.at(shorter.rest, at, self.n)

    def blocks(self) -> Iterator[slice]:
        for at in range(0, self.size, BLOCK):
            yield slice(at, min(at + BLOCK, self.size))

    def decisions(self, block: slice, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of zeros and ones at the 255 decisions that spell out a byte, for a block of contexts."""
        first, last = np.searchsorted(self.row, [block.start, block.stop])
        width = np.zeros((block.stop - block.start, 256))
        width[self.row[first:last] - block.start, self.byte[first:last]] = counts[first:last]
        zeros, ones = (np.zeros((len(width), 255)) for _ in "01")
        for n in range(7, -1, -1):
            at = (1 << n) - 1
            zeros[:, at : at + (1 << n)], ones[:, at : at + (1 << n)] = width[:, 0::2], width[:, 1::2]
            width = width[:, 0::2] + width[:, 1::2]
        return zeros, ones


def build(counted: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """The tree of kept contexts; counted[d] has (context, byte, count) of those of length d, each pair once.

    A context is the number of its bytes, the latest one lowest. A context is kept only with all its endings.
    """
    if not len(counted[0][0]):
        return Tree(0, np.zeros(256, np.int32), [], [np.full((1, 1), -8 * np.log10(2), np.float32)])
    levels: list[Level] = []
    for d, (context, byte, n) in enumerate(counted):
        order = np.lexsort([byte, context])
        level = Level(context[order], byte[order], n[order], d, levels[-1] if levels else None)
        if not level.size:
            break
        levels.append(level)

    # From the longest contexts up: the weight of each context's own estimate against its extensions'.
    below = np.zeros((levels[-1].size, 255))
    for level in reversed(levels):
        above = np.zeros((int(level.parents.max()) + 1 if level is not levels[0] else 1, 255))
        for block in level.blocks():
            own = log_kt(*level.decisions(block, level.n))
            kept = level.extended[block]
            if kept.any():
                split = below[block] + log_kt(*level.decisions(block, level.rest))
                mixed = np.logaddexp(own, split) - np.log(2)
                level.weights[block][kept] = np.exp(own - np.log(2) - mixed)[kept]
                own[kept] = mixed[kept]
            np.add.at(above, level.parents[block], own)
        if level is not levels[0]:
            shorter = levels[levels.index(level) - 1]
            below = np.zeros((shorter.size, 255))
            below[: len(above)] = above

    # From the shortest down: what the contexts up to this length give, and the weight left for longer ones.
    seen = levels[0].byte
    column = np.full(256, len(seen), np.int32)
    column[seen] = np.arange(len(seen))
    unseen = np.setdiff1d(np.arange(256), seen)
    child, logs = [], []
    given, left = np.zeros((1, 255), np.float32), np.ones((1, 255), np.float32)
    for d, level in enumerate(levels):
        given, left = given[level.parents], left[level.parents]
        table = np.empty((level.size, len(seen) + 1), np.float32)
        for block in level.blocks():
            zeros, ones = level.decisions(block, level.n)
            given[block] += left[block] * level.weights[block] * (ones + 0.5) / (zeros + ones + 1)
            left[block] *= 1 - level.weights[block]
            zeros, ones = level.decisions(block, level.rest)
            chance = given[block] + left[block] * (ones + 0.5) / (zeros + ones + 1)
            chance = np.clip(chance, 1e-9, 1 - 1e-9)
            both = np.concatenate([np.log10(1 - chance), np.log10(chance)], 1)
            spelt = sum(both[:, _NODE[n] + 255 * _ONE[n]] for n in range(8))
            table[block, :-1] = spelt[:, seen]
            table[block, -1] = np.log10((10 ** spelt[:, unseen]).sum(1) / max(len(unseen), 1) + 1e-300)
        logs.append(table)
        if d + 1 < len(levels):
            longer = levels[d + 1]
            links = np.full((level.size, len(seen) + 1), -1, np.int32)
            links[longer.parents, column[longer.names >> 8 * d]] = np.arange(longer.size)
            child.append(links)
    return Tree(len(levels) - 1, column, child, logs)


def nodes(keys: np.ndarray, n: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, zeros, ones, row) of the decisions after ``bits`` bits of the next byte: a context with those bits, the
    counts of either decision, and for each of the rising ``keys`` (context and next byte) the decision it passes.
    """
    names = keys >> (8 - bits)
    new = np.concatenate([[True], names[1:] != names[:-1]])
    first = np.flatnonzero(new)
    ones = np.add.reduceat(n * (keys >> (7 - bits) & 1), first)
    return names[first], np.add.reduceat(n, first) - ones, ones, np.cumsum(new) - 1


class Branch:
    """All contexts of ``near`` to ``depth`` bytes of whole groups of runs that have the ``near`` latest bytes in common."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, near: int):
        self.levels, self.weights, self.next = [], [], keys & 255
        for d in range(near, depth + 1):
            shorter = keys >> 8 * (depth - d + 1) << 8 | keys & 255
            counted = added(shorter, n)
            self.levels.append([nodes(*counted, bits) for bits in range(8)])
        self.row = np.searchsorted(counted[0], keys)
        # ln of the weighted probability of each decision of the shortest contexts.
        self.mixed = []
        for bits in range(8):
            below, weights = None, []
            for d in range(len(self.levels) - 1, -1, -1):
                name, zeros, ones, _ = self.levels[d][bits]
                own = log_kt(zeros.astype(np.float64), ones.astype(np.float64))
                mixed = own if below is None else np.logaddexp(own, below) - np.log(2)
                weights.insert(0, np.ones(len(own)) if below is None else np.exp(own - np.log(2) - mixed))
                if d:
                    below = np.bincount(self.parents(d, bits), mixed, len(self.levels[d - 1][bits][0]))
            self.mixed.append(mixed)
            self.weights.append(weights)

    def parents(self, d: int, bits: int) -> np.ndarray:
        name = self.levels[d][bits][0]
        shorter = name >> 8 + bits << bits | name & (1 << bits) - 1
        return np.searchsorted(self.levels[d - 1][bits][0], shorter)

    def top(self) -> list[np.ndarray]:
        """context, node, zeros, ones, mixed of the decisions of the shortest contexts; a node is 1 and the bits before."""
        parts = []
        for bits, (name, zeros, ones, _) in enumerate(self.levels[0]):
            node = (1 << bits | name & (1 << bits) - 1).astype(np.int32)
            parts.append((name >> bits, node, zeros, ones, self.mixed[bits]))
        return [np.concatenate(column) for column in zip(*parts, strict=True)]

    def logs(self, context: np.ndarray, node: np.ndarray, given: np.ndarray, left: np.ndarray) -> np.ndarray:
        """log10 of the probability of each key's next byte, from what shorter contexts give and leave each top decision."""
        order = np.argsort(context << 8 | node)
        place, given, left = (context << 8 | node)[order], given[order], left[order]
        logs = np.zeros(len(self.row))
        for bits in range(8):
            name = self.levels[0][bits][0]
            at = np.searchsorted(place, name >> bits << 8 | 1 << bits | name & (1 << bits) - 1)
            chance, rest = given[at], left[at]
            for d, weight in enumerate(self.weights[bits]):
                _, zeros, ones, row = self.levels[d][bits]
                if d:
                    up = self.parents(d, bits)
                    chance, rest = chance[up], rest[up]
                chance = chance + rest * weight * (ones + 0.5) / (zeros + ones + 1)
                rest = rest * (1 - weight)
            chance = chance[row[self.row]]
            logs += np.log10(np.where(self.next >> (7 - bits) & 1, chance, 1 - chance))
        return logs


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of rows in order of ``near``, many at a time, and always all that have the same one."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        near = batch.column("near").to_numpy()
        cut = 0
        if size >= ROWS:
            cut = int(np.searchsorted(near, last, "right"))
            if cut < len(near):
                held.append(batch.slice(0, cut))
                yield _columns(held)
                held, size, batch = [], 0, batch.slice(cut)
        held.append(batch)
        size, last = size + batch.num_rows, near[-1]
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(batches)
    return {name: table.column(name).to_numpy() for name in table.column_names}


def mixed_with(below: DataFrame) -> DataFrame:
    """``below`` (context, node, zeros, ones, below) with ``mixed`` for below, and the ``weight`` of the own estimate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, node, zeros, ones, under = batch.columns
            own = log_kt(zeros.to_numpy().astype(np.float64), ones.to_numpy().astype(np.float64))
            mixed = np.logaddexp(own, under.to_numpy()) - np.log(2)
            weight = np.exp(own - np.log(2) - mixed)
            names = ["context", "node", "zeros", "ones", "mixed", "weight"]
            yield pa.RecordBatch.from_arrays([context, node, zeros, ones, pa.array(mixed), pa.array(weight)], names)

    return below.mapInArrow(run, "context long, node int, zeros long, ones long, mixed double, weight double")


def run_logs(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, times, log) of each run of ``count_corpus``: log10 of the probability of its last byte after the others.

    A context that was never learned from has chances of one half, and adds nothing to shorter ones.
    """
    near = min(NEAR, depth)
    rows = counts.where(F.col("kind") == RUN).select(
        F.shiftright("key", 8 * (depth - near + 1)).alias("near"), "key", "n", "times"
    )

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            made = Branch(group["key"], group["n"], depth, near).top()
            yield from _batches(made, ["context", "node", "zeros", "ones", "mixed"])

    together = rows.repartition("near").sortWithinPartitions("near")
    top = stage(together.mapInArrow(tops, "context long, node int, zeros long, ones long, mixed double"), "tops")
    levels, level = [], top
    for _ in range(near):
        sums = [F.sum(c).alias(c) for c in ("zeros", "ones")]
        shorter = F.shiftright("context", 8).alias("context")
        level = level.groupBy(shorter, "node").agg(*sums, F.sum("mixed").alias("below"))
        level = stage(mixed_with(level), "shorter")
        levels.insert(0, level)
    own = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    given, left = F.lit(0.0), F.lit(1.0)
    above = None
    for level in [*levels, top.withColumn("weight", F.lit(0.0))]:
        if above is not None:
            above = above.select(F.col("context").alias("shorter"), "node", "given", "left")
            level = level.withColumn("shorter", F.shiftright("context", 8)).join(above, ["shorter", "node"])
            given, left = F.col("given"), F.col("left")
        above = level.select(
            "context", "node",
            (given + left * F.col("weight") * own).alias("given"), (left * (1 - F.col("weight"))).alias("left"),
        )

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            top = group["node"] > 0
            runs = ~top
            branch = Branch(group["key"][runs], group["n"][runs], depth, near)
            found = branch.logs(*(group[c][top] for c in ("near", "node", "given", "left")))
            yield from _batches([group["key"][runs], group["times"][runs], found], ["key", "times", "log"])

    nothing = F.lit(0).cast("long")
    above = above.select(
        F.col("context").alias("near"), nothing.alias("key"), nothing.alias("n"), nothing.alias("times"), "node", "given", "left"
    )
    both = rows.select("*", F.lit(0).alias("node"), F.lit(0.0).alias("given"), F.lit(0.0).alias("left")).unionByName(above)
    both = both.repartition("near").sortWithinPartitions("near")
    return stage(both.mapInArrow(logs, "key long, times long, log double"), "run-logs")


def _batches(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 18)]) for c in columns], names)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))


def scored(docs: DataFrame, training: Column, depth: int = DEPTH) -> DataFrame:
    """All columns of ``docs`` but ``text``, with token counts, a word model's score and the context tree's score.

    Learns from the rows where ``training`` holds. Adds (n_tokens, n_known, train_tokens, base_score, score): see
    ``tokens`` for the tokens; base_score is the sum of log10((c + 1) / (N + V + 1)) over them, with c the token's
    count, N all and V the distinct training tokens; score is the tree's log10 probability of the words, with one
    space between them, and the end. A null or empty text is its end alone. Rows are kept apart whatever their keys.
    Without training rows every decision has a chance of one half.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("_train", F.coalesce(training, F.lit(False)))
    counts = stage(count_corpus(docs, depth), "counts")
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    n_train, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    chances = run_logs(counts, depth)

    def array(rows: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
        table = rows.select("key", value).toArrow()
        keys, values = (table.column(c).to_numpy() for c in ("key", value))
        order = np.argsort(keys)
        return keys[order], values[order]

    frequent, often = most_frequent(words, SHARED_WORDS), most_frequent(chances, SHARED_RUNS, "times")
    known = words.where(frequent).withColumn("log", F.log10(F.col("n") + 1))
    shared = spark.sparkContext.broadcast({WORD: array(known, "log"), RUN: array(chances.where(often), "log")})
    kept = [c for c in docs.columns if c not in ("text", "_train")]
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c in kept)
    made = "n_tokens long, _known long, _logs double, _score double, _words array<long>, _runs array<long>"

    def together(texts: pa.Array) -> Iterator[tuple[int, int]]:
        start, chars = 0, 0
        for at, size in enumerate(pc.utf8_length(texts).to_pylist()):
            chars += size or 0
            if at > start and (at - start == TOGETHER or chars > TOGETHER_CHARS):
                yield start, at
                start, chars = at, size or 0
        if len(texts):
            yield start, len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*kept, *[field.split()[0] for field in made.split(", ")]]
        for batch in batches:
            for start, end in together(batch.column("text")):
                rows = batch.slice(start, end - start)
                words = [tokens(text.as_py() or "") for text in rows.column("text")]
                found, logs, rare = look_up(shared.value[WORD], [word_keys(x) for x in words])
                _, score, runs = look_up(shared.value[RUN], [paths(spelled(x), depth) for x in words])
                counts = [pa.array([len(x) for x in words], pa.int64()), pa.array(found), pa.array(logs), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *counts, rare, runs], names)

    partly = docs.select(*kept, "text").mapInArrow(run, f"{kinds}, {made}" if kinds else made)
    partly = stage(partly.withColumn("_row", F.monotonically_increasing_id()), "scores")
    entries = words.where(~frequent).select(F.lit(WORD).alias("_kind"), "key", F.log10(F.col("n") + 1).alias("log"))
    entries = entries.unionByName(chances.where(~often).select(F.lit(RUN).alias("_kind"), "key", "log"))
    asked = [
        partly.select("_row", F.lit(kind).alias("_kind"), F.explode(keys).alias("key"))
        for kind, keys in ((WORD, "_words"), (RUN, "_runs"))
    ]
    rare = asked[0].unionByName(asked[1]).join(entries.hint("shuffle_hash"), ["_kind", "key"]).groupBy("_row")
    word, log = F.col("_kind") == WORD, F.col("log")
    rare = rare.agg(
        F.sum(F.when(word, log)).alias("_more"), F.count_if(word).alias("_found"), F.sum(F.when(~word, log)).alias("_rest")
    )
    base = F.col("_logs") + F.coalesce("_more", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(n_train + distinct + 1.0))
    return partly.join(rare, "_row", "left").select(
        *kept,
        "n_tokens",
        (F.col("_known") + F.coalesce("_found", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("_score") + F.coalesce("_rest", F.lit(0.0))).alias("score"),
    )


@query("op9_weighting")
def op9_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", held_out())
    return scored(docs, ~F.col("held_out"))
