"""Collocations: phrases whose words stand together more often than apart, by dynamic itemset counting.

The documents are dealt into shards that are read in turn, again and again. Words are counted from the first shard on.
As soon as both parts of a longer phrase (all but its last word, all but its first) have reached the threshold, the
phrase is counted too, from the next shard on, while its parts are still being counted. Each phrase is counted over one
full cycle of the shards, wherever in the cycle it began, so its count is exact; then it leaves. A frequent phrase has
frequent parts, so none is missed, and most longer phrases are never counted at all.

Which phrases have reached the threshold in a step is told to all tasks by a Bloom filter of these phrases, of bounded
size. What it takes for one of them by mistake is counted for nothing: its count over the cycle is below the threshold.
A filter is never changed, so all tasks of all steps agree on when a phrase began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from corpusengine.llm.registry import query
from corpusengine.operators.lookup import attach
from corpusengine.session import scratch_path, stage

SHARDS = 2
LONGEST = 3
# A filter has at least BITS bits for each phrase, as long as it is not larger than FILTER_BITS (64 MB).
BITS = 12
FILTER_BITS = 1 << 29
BLOCK_BITS = 1 << 16
PROBES = 3
# A task counts so many words at once, and hands on its counts when it holds so many phrases or words.
CHUNK = 2_000_000
HELD = 3_000_000
PLACES = 21
NEVER = 255

# A-Z are folded, marks and line ends part pieces, a tab is a blank.
_FOLD = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
PHRASES = "k int, lang string, phrase string, since int, n long"
_PHRASES = pa.schema([("k", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("since", pa.int32()), ("n", pa.int64())])


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) ^ (b << np.uint64(31) | b >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return h ^ h >> np.uint64(32)


def place(h: np.ndarray, j: int, bits: int) -> np.ndarray:
    """The j-th place of each hash in a filter of so many bits, a power of two. A phrase has PROBES places."""
    step = h >> np.uint64(32) | np.uint64(1)
    return (h + np.uint64(j) * step & np.uint64(bits - 1)).astype(np.int64)


class Steps:
    """The step after which a phrase began: the first one whose filter has it."""

    def __init__(self, filters: list[tuple[int, np.ndarray]]):
        self.filters = filters

    def of(self, h: np.ndarray) -> np.ndarray:
        found = np.full(len(h), NEVER, np.int16)
        for step, bits in sorted(self.filters, key=lambda f: -f[0]):
            has = np.arange(len(h))
            for j in range(PROBES):
                # Only what all places before speak for is looked up again.
                at = place(h[has] if j else h, j, 8 * len(bits))
                has = has[np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)]
            found[has] = step
        return found


class Ids(dict):
    """Numbers of a language's words, from the list that all languages share. 0 is no word, 1 the end of a piece."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        super().__init__({b"": 0, b"\n": 1})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return at


class Counts:
    """Counts of the phrases of a task's texts that are counted in this step."""

    def __init__(self, step: int, shards: int, words: Steps, pairs: Steps):
        self.step, self.shards, self.word_steps, self.pair_steps = step, shards, words, pairs
        self.start()

    def start(self) -> None:
        self.words, self.langs = [b"", b""], ["", ""]
        self.ids: dict[str, Ids] = {}
        self.hashes, self.since = np.zeros(2, np.uint64), np.full(2, NEVER, np.int16)
        self.single = np.zeros(2, np.int64)
        self.longer: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {2: [], 3: []}
        self.texts: list[np.ndarray] = []
        self.waiting, self.full = 0, False

    def add(self, lang: str, text: bytes) -> bool:
        """Whether so much is held that it should be handed on."""
        if lang not in self.ids:
            self.ids[lang] = Ids(lang, self.words, self.langs)
        tokens = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        self.texts.append(np.fromiter(map(self.ids[lang].__getitem__, tokens), np.int64, len(tokens)))
        self.waiting += len(tokens)
        return self.count() if self.waiting >= CHUNK or len(self.words) >= 1 << PLACES - 1 else False

    def now(self, since: np.ndarray) -> np.ndarray:
        return (since < self.step) & (self.step <= since + self.shards)

    def count(self) -> bool:
        if self.texts:
            a = np.concatenate(self.texts)
            a = a[a != 0]
            self.texts, self.waiting = [], 0
            self._learn()
            if self.step < self.shards:
                self.single = np.pad(self.single, (0, len(self.words) - len(self.single)))
                self.single += np.bincount(a, minlength=len(self.words))
            if self.step > 0 and len(a) > 1:
                begun = self.since[a]
                pair = np.maximum(begun[:-1], begun[1:])
                on = np.flatnonzero(self.now(pair))
                self._keep(2, a[on] << PLACES | a[on + 1])
                if self.pair_steps.filters and len(a) > 2:
                    known = np.flatnonzero(pair < NEVER)
                    pair = np.full(len(a) - 1, NEVER, np.int16)
                    pair[known] = self.pair_steps.of(pair_hash(self.hashes[a[known]], self.hashes[a[known + 1]]))
                    on = np.flatnonzero(self.now(np.maximum(pair[:-1], pair[1:])))
                    self._keep(3, (a[on] << PLACES | a[on + 1]) << PLACES | a[on + 2])
        return len(self.words) >= 1 << PLACES - 1 or self.full

    def _learn(self) -> None:
        known = len(self.hashes)
        if known < len(self.words):
            h = np.fromiter(map(word_hash, self.langs[known:], self.words[known:]), np.uint64, len(self.words) - known)
            self.hashes = np.concatenate([self.hashes, h])
            self.since = np.concatenate([self.since, self.word_steps.of(h)])

    def _keep(self, k: int, keys: np.ndarray) -> None:
        self.longer[k].append(np.unique(keys, return_counts=True))
        if sum(len(u) for u, _ in self.longer[k]) >= HELD:
            self.longer[k] = [merged(self.longer[k])]
            self.full |= len(self.longer[k][0][0]) >= HELD // 2

    def phrases(self) -> Iterator[pa.RecordBatch]:
        """Everything counted so far."""
        self.count()
        if self.step < self.shards:
            at = np.flatnonzero(self.single[2:]) + 2
            yield from self._batches(1, [at], np.full(len(at), -1), self.single[at])
            langs = dict.fromkeys(self.langs[2:], 0)
            for lang, n in zip(self.langs[2:], self.single[2:].tolist(), strict=False):
                langs[lang] += n
            columns = [[0] * len(langs), [*langs], [""] * len(langs), [-1] * len(langs), [*langs.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PHRASES, strict=True)], schema=_PHRASES)
        mask = (1 << PLACES) - 1
        if self.longer[2]:
            keys, n = merged(self.longer[2])
            at = [keys >> PLACES, keys & mask]
            yield from self._batches(2, at, np.maximum(self.since[at[0]], self.since[at[1]]), n)
        if self.longer[3]:
            keys, n = merged(self.longer[3])
            at = [keys >> 2 * PLACES, keys >> PLACES & mask, keys & mask]
            h = [self.hashes[x] for x in at]
            pairs = [self.pair_steps.of(pair_hash(x, y)) for x, y in ((h[0], h[1]), (h[1], h[2]))]
            yield from self._batches(3, at, np.maximum(*pairs), n)
        self.start()

    def _batches(self, k: int, at: list[np.ndarray], since: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, names = self.words, list(self.ids)
        number = {lang: i for i, lang in enumerate(names)}
        lang_of = np.fromiter(map(number.get, self.langs[2:]), np.int32, len(words) - 2) if names else np.zeros(0, np.int32)
        for i in range(0, len(n), 1 << 16):
            part = slice(i, i + (1 << 16))
            first, *rest = (x[part].tolist() for x in at)
            phrases = [words[x] for x in first]
            for more in rest:
                phrases = [phrase + b" " + words[x] for phrase, x in zip(phrases, more, strict=True)]
            langs = pa.array(names, pa.string()).take(pa.array(lang_of[at[0][part] - 2]))
            columns = [pa.array(np.full(len(first), k), pa.int32()), langs, pa.array(phrases, pa.string())]
            columns += [pa.array(since[part], pa.int32()), pa.array(n[part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_PHRASES)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys = np.concatenate([u for u, _ in parts])
    n = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def counted(shard: DataFrame, step: int, shards: int, words: list, pairs: list) -> DataFrame:
    """(k, lang, phrase, since, n) of a shard's texts, of what is counted in this step; several rows a phrase.

    The phrase of length 0 stands for all words of a language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(step, shards, *(Steps([(t, np.frombuffer(b.value, np.uint8)) for t, b in part]) for part in (words, pairs)))
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                if counts.add(lang, text):
                    yield from counts.phrases()
        yield from counts.phrases()

    return shard.mapInArrow(run, PHRASES)


def bloom(phrases: DataFrame, n: int) -> bytes:
    """A filter of ``n`` phrases of one length. Its blocks are put together in tasks; only they come to the driver."""
    bits = max(BLOCK_BITS, min(FILTER_BITS, 1 << (BITS * n - 1).bit_length()))

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [word_hash(lang, word) for word in phrase.split(b" ")]
                for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").cast(pa.binary()).to_pylist(), strict=True)
            ]
            if rows:
                h = np.array(rows, np.uint64)
                h = h[:, 0] if h.shape[1] == 1 else pair_hash(h[:, 0], h[:, 1])
                at = np.concatenate([place(h, j, bits) for j in range(PROBES)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at // BLOCK_BITS, pa.int32()), pa.array(at % BLOCK_BITS, pa.int32())], ["block", "at"]
                )

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        flags = np.zeros(BLOCK_BITS, np.uint8)
        flags[rows.column("at").to_numpy()] = 1
        return pa.table({"block": [key[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]}, pa.schema([("block", pa.int32()), ("bits", pa.binary())]))

    found = phrases.select("lang", "phrase").mapInArrow(spots, "block int, at int").distinct()
    whole = bytearray(bits // 8)
    for row in found.groupBy("block").applyInArrow(fill, "block int, bits binary").toLocalIterator():
        whole[row["block"] * BLOCK_BITS // 8 : (row["block"] + 1) * BLOCK_BITS // 8] = row["bits"]
    return bytes(whole)


def frequent_phrases(docs: DataFrame, threshold: int, shards: int = SHARDS, lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(k, lang, phrase, n) of the phrases of up to LONGEST words found at least ``threshold`` times, and (lang, n) of
    all words. A null language is ``und``, a null text empty; only these two columns and ``doc_id`` are looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"),
    )
    path = scratch_path(spark, "shards")
    rows.write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)
    filters: dict[int, list] = {1: [], 2: []}
    going, done = None, []
    step, last = 0, shards - 1
    while step <= last:
        shard = dealt.where(F.col("shard") == step % shards).drop("shard")
        found = counted(shard, step, shards, filters[1], filters[2]).withColumn("hit", F.lit(None).cast("int"))
        found = found if going is None else found.unionByName(going)
        # Tasks have added up what they read, so rows are dealt as they are and added up once.
        found = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(
            F.max("k").alias("k"), F.max("since").alias("since"), F.sum("n").alias("n"), F.min("hit").alias("hit")
        )
        hit = F.coalesce("hit", F.when(F.col("n") >= threshold, F.lit(step)))
        complete = F.col("since") + shards <= step
        kept = ~complete | (F.col("n") >= threshold) | (F.col("k") == 0)
        found = stage(found.withColumns({"hit": hit, "complete": complete}).where(kept), f"phrases-{step}")
        done.append(found.where("complete").select("k", "lang", "phrase", "n"))
        going = found.where("NOT complete").drop("complete")
        fresh = found.where((F.col("hit") == step) & F.col("k").isin(list(filters)))
        for k, n in sorted((r["k"], r["n"]) for r in fresh.groupBy("k").agg(F.count("*").alias("n")).collect()):
            bits = bloom(fresh.where(F.col("k") == k), n)
            filters[k].append((step, spark.sparkContext.broadcast(bits)))
            last = step + shards
        step += 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    whole = stage(whole, "frequent-phrases")
    return whole.where("k > 0"), whole.where("k = 0").select("lang", "n")


def collocations(
    docs: DataFrame, threshold: int = 10, top: int = 2000, covered: int = 50, shards: int = SHARDS, lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two or three words of each language.

    A phrase of count a is cut where floor(1000000 * a * a / (l * r)) is lowest, first if equal, with l and r the counts
    of both sides. It is left out if a longer candidate that contains it has at least ``covered`` percent of its count.
    Best are those of high score, then of high count, then in order of their bytes. Arithmetic is in decimals.
    """
    phrases, totals = frequent_phrases(docs, threshold, shards, lang)
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = phrases.where("k > 1").select("k", "lang", "phrase", F.col("n").alias("a"), cut)
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', cut)"), "tail": F.expr("substring_index(phrase, ' ', cut - k)")})
    for side, count in (("head", "l"), ("tail", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(count))
        cuts = stage(attach(cuts, counts, ["lang", side]), f"cuts-{side}")
    wide = "cast({} as decimal(14,0))".format
    score = F.expr(f"({wide('a')} * {wide('a')} * cast(1000000 as decimal(7,0))) div ({wide('l')} * {wide('r')})")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "phrase", "k", "a").agg(lowest).select("lang", "phrase", "k", "a", "low.l", "low.r", "low.score")
    longer = cuts.where("k > 2").select("lang", "a", F.explode(F.array("head", "tail")).alias("phrase")).where(F.contains("phrase", F.lit(" ")))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = scored.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("longer") >= covered * F.col("a"), F.lit(False)))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return attach(best, totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS x, generate_subscripts(w, 1) AS place FROM numbered),
runs AS (
  SELECT lang, x, lead(x, 1) OVER piece AS y, lead(x, 2) OVER piece AS z FROM words WINDOW piece AS (PARTITION BY id ORDER BY place)),
f AS (
  SELECT lang, 1 AS k, x AS phrase, count(*) AS n FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, x || ' ' || y AS phrase, count(*) FROM runs WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z AS phrase, count(*) FROM runs WHERE z IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n)::bigint AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
parts AS (
  SELECT lang, phrase, k, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM candidates, (VALUES (1), (2)) AS v(cut) WHERE cut < k),
cuts AS (
  SELECT p.lang, p.phrase, p.k, p.a, cut, x.n AS l, y.n AS r,
    ((1000000::hugeint * p.a * p.a) // (x.n::hugeint * y.n))::bigint AS score
  FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covers AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, t.n, score
FROM lowest LEFT JOIN covers USING (lang, phrase) JOIN totals t USING (lang)
WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
