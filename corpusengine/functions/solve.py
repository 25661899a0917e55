"""Ranking to convergence inside a task, many documents at a time.

Each document is one row and its graph is independent of all others, so a batch of rows is one block-diagonal system:
a round is a few vector operations over the batch and no round needs a shuffle. Spark decides which rows meet here.
There is no other way of ranking: a text, its words and their scores are one row in any case.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from corpusengine.constants import BM25_B, BM25_K1, EXCLUDED_TAG_INITIALS, TOKEN_SEPARATOR, TRIM_CHARACTERS

# The functions below travel with the query: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores closer than this many decimals count as equal: a sum's last bits depend on the order of its terms.
SCORE_DIGITS = 9
# Tokens solved at a time, so that the arrays of a block stay in the processor's cache.
BLOCK_TOKENS = 100_000
# Pairs of sentences made at a time.
BATCH_PAIRS = 1 << 18


def settle(
    flow: Callable[[np.ndarray], np.ndarray],
    start: np.ndarray,
    owner: np.ndarray,
    damping: float,
    max_rounds: int,
    min_diff: float,
    narrowed: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]] | None = None,
) -> np.ndarray:
    """Repeat ``score = 1 - d + d * flow(score)``, each owner until its own largest change is within ``min_diff``.

    ``owner`` is sorted and names the document of every score. ``narrowed`` gives the flow among the scores at some places, all
    those of some documents: with it, the rounds go on without the settled documents whenever they hold half of the scores.
    """
    done, score, places = start.copy(), start, np.arange(len(start))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    open_nodes = np.ones(len(score), dtype=bool)
    spans = np.diff(first, append=len(score))
    # Negative similarities can drive a document's scores beyond all bounds; that is its result.
    with np.errstate(over="ignore", invalid="ignore"):
        for _ in range(max_rounds if len(score) else 0):
            fresh = np.where(open_nodes, (1 - damping) + damping * flow(score), score)
            settled = np.maximum.reduceat(np.abs(fresh - score), first) <= min_diff
            open_nodes &= np.repeat(~settled, spans)
            score = fresh
            left = np.count_nonzero(open_nodes)
            if not left:
                break
            if narrowed and 2 * left <= len(score):
                done[places] = score
                score, places = score[open_nodes], places[open_nodes]
                flow, first = narrowed(places), np.flatnonzero(np.diff(owner[places], prepend=-1))
                open_nodes, spans = np.ones(len(score), dtype=bool), np.diff(first, append=len(score))
        done[places] = score
        # A finite score may be too large to be rounded in units of its last decimal.
        rounded = np.round(done, SCORE_DIGITS)
    return np.where(np.isfinite(rounded), rounded, done)


def _numbered(places: np.ndarray, n: int) -> np.ndarray:
    """The turn of each of ``n`` places among ``places``, -1 for the others."""
    turn = np.full(n, -1)
    turn[places] = np.arange(len(places))
    return turn


def _blocks(weights: np.ndarray) -> Iterator[slice]:
    """Consecutive rows of about ``BLOCK_TOKENS`` together."""
    block = np.cumsum(weights) // BLOCK_TOKENS
    edges = np.flatnonzero(np.diff(block, prepend=-1, append=block[-1] + 1 if len(block) else 0))
    for begin, end in zip(edges[:-1], edges[1:]):
        yield slice(int(begin), int(end))


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _as_lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _once(udf):
    """Keep the optimizer from copying the call into the expressions that use its result."""
    return udf.asNondeterministic()


def _codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def word_ranks(
    kept: Column, window: int, damping: float, max_rounds: int, min_diff: float
) -> Column:
    """array<struct<word, score>> of the words that co-occur in windows of ``window`` tokens of ``kept``."""

    @arrow_udf("array<struct<word:string,score:double>>")
    def rank(lists: pa.Array) -> pa.Array:
        parts = [_rank_words(lists[rows], window, damping, max_rounds, min_diff) for rows in _blocks(_lengths(lists))]
        return pa.concat_arrays(parts) if parts else _rank_words(lists, window, damping, max_rounds, min_diff)

    return _once(rank)(kept)


def word_links(kept: Column, window: int) -> Column:
    """array<struct<src, dst>>: unequal words less than ``window`` places apart in ``kept``, each pair once each way.

    A text shorter than the window has none. A null is a word without links.
    """

    @arrow_udf("array<struct<src:string,dst:string>>")
    def link(lists: pa.Array) -> pa.Array:
        def solve(rows: pa.Array) -> pa.Array:
            lengths = _lengths(rows)
            doc = np.repeat(np.arange(len(lengths)), lengths)
            encoded = rows.flatten().dictionary_encode()
            code = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            span = max(len(encoded.dictionary), 1)
            linked = [np.empty(0, dtype=np.int64)]
            for gap in range(1, window):
                left, right, owner = code[:-gap], code[gap:], doc[:-gap]
                near = (owner == doc[gap:]) & (left != right) & (left >= 0) & (right >= 0) & (lengths[owner] >= window)
                left, right, base = left[near], right[near], owner[near] * span
                linked += [(base + left) * span + right, (base + right) * span + left]
            pairs = np.unique(np.concatenate(linked))
            ends = [encoded.dictionary.take(pa.array(at)) for at in (pairs // span % span, pairs % span)]
            return _as_lists(pa.StructArray.from_arrays(ends, ["src", "dst"]), np.bincount(pairs // span // span, minlength=len(rows)))

        return pa.concat_arrays([solve(lists[rows]) for rows in _blocks(_lengths(lists))] or [solve(lists)])

    return _once(link)(kept)


def term_totals(sentences: Column) -> Column:
    """array<struct<term, df, tf>>: sentences with each term, and occurrences of it, in sentences given as tokens."""

    @arrow_udf("array<struct<term:string,df:bigint,tf:bigint>>")
    def totals(documents: pa.Array) -> pa.Array:
        def solve(rows: pa.Array) -> pa.Array:
            sizes, lists = _lengths(rows), rows.flatten()
            lengths = _lengths(lists)
            encoded = lists.flatten().dictionary_encode()
            code = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            span = max(len(encoded.dictionary), 1)
            sentence = np.repeat(np.arange(len(lengths)), lengths)[code >= 0]
            keys, n = np.unique(sentence * span + code[code >= 0], return_counts=True)
            owner = np.repeat(np.arange(len(sizes)), sizes)[keys // span]
            terms, at, df = np.unique(owner * span + keys % span, return_inverse=True, return_counts=True)
            tf = np.bincount(at, n, minlength=len(terms)).astype(np.int64)
            columns = [encoded.dictionary.take(pa.array(terms % span)), pa.array(df.astype(np.int64)), pa.array(tf)]
            return _as_lists(pa.StructArray.from_arrays(columns, ["term", "df", "tf"]), np.bincount(terms // span, minlength=len(rows)))

        return pa.concat_arrays([solve(documents[rows]) for rows in _blocks(_token_counts(documents))] or [solve(documents)])

    return _once(totals)(sentences)


def _rank_words(lists: pa.Array, window: int, damping: float, max_rounds: int, min_diff: float) -> pa.Array:
    lengths = _lengths(lists)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    code, words = _codes(lists.flatten())
    keys, node = np.unique(doc * max(len(words), 1) + code, return_inverse=True)
    owner = keys // max(len(words), 1)
    sizes = np.bincount(owner, minlength=len(lengths))

    linked = []
    for gap in range(1, window):
        left, right = node[:-gap], node[gap:]
        near = (doc[:-gap] == doc[gap:]) & (left != right) & (lengths[doc[:-gap]] >= window)
        linked += [left[near] * len(keys) + right[near], right[near] * len(keys) + left[near]]
    # Sorted, since numpy finds different numbers by a slower hash.
    pairs = np.sort(np.concatenate(linked)) if linked else np.empty(0, dtype=np.int64)
    pairs = pairs[np.diff(pairs, prepend=-1) != 0]
    source, target = pairs // max(len(keys), 1), pairs % max(len(keys), 1)
    degree = np.maximum(np.bincount(source, minlength=len(keys)), 1)

    def narrowed(places: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        turn = _numbered(places, len(keys))
        kept = turn[source] >= 0
        begin, end, share = turn[source[kept]], turn[target[kept]], degree[places]
        return lambda score: np.bincount(end, (score / share)[begin], minlength=len(places))

    score = settle(narrowed(np.arange(len(keys))), 1.0 / sizes[owner], owner, damping, max_rounds, min_diff, narrowed)
    ranked = pa.StructArray.from_arrays([words.take(pa.array(keys % max(len(words), 1))), pa.array(score)], ["word", "score"])
    return _as_lists(ranked, sizes)


class Postings:
    """Sentence-term weights of a block of documents given as array<array<string>>."""

    def __init__(self, documents: pa.Array):
        self.sizes = _lengths(documents)
        sentences = documents.flatten()
        lengths = _lengths(sentences)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        n = len(self.doc)
        code, words = _codes(sentences.flatten())
        sentence = np.repeat(np.arange(n), lengths)
        span = max(len(words), 1)
        keys, tf = np.unique(sentence * span + code, return_counts=True)
        self.sentence, self.tf = keys // span, tf
        _, self.term = np.unique(self.doc[self.sentence] * span + keys % span, return_inverse=True)
        self.n_terms = int(self.term.max()) + 1 if len(keys) else 0
        df = np.bincount(self.term, minlength=self.n_terms)[self.term]
        d = self.sizes[self.doc[self.sentence]]
        total = np.bincount(self.doc, lengths, minlength=len(self.sizes))
        mean = (total / np.maximum(self.sizes, 1))[self.doc[self.sentence]]
        idf = np.log(d - df + 0.5) - np.log(df + 0.5)
        damp = BM25_K1 * (1 - BM25_B + BM25_B * lengths[self.sentence] / mean)
        self.gain = idf * tf * (BM25_K1 + 1) / (tf + damp)

    def spread(self, places: np.ndarray, share: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """The flow among the sentences at ``places``, all those of some documents: the score each receives from the others
        when every sentence passes its own on, times its ``share``, by similarity.

        A similarity is a sum over shared terms, so scores go from sentences to terms and from terms to sentences;
        no pair of sentences is formed.
        """
        turn = _numbered(places, len(self.doc))
        kept = turn[self.sentence] >= 0
        sentence, tf, gain = turn[self.sentence[kept]], self.tf[kept], self.gain[kept]
        used = np.zeros(self.n_terms, dtype=bool)
        used[self.term[kept]] = True
        term, n_terms = (np.cumsum(used) - 1)[self.term[kept]], int(np.count_nonzero(used))
        share = share[places]

        def flow(score: np.ndarray) -> np.ndarray:
            passed = tf * (score * share)[sentence]
            at_term = np.bincount(term, passed, minlength=n_terms)[term]
            return np.bincount(sentence, gain * (at_term - passed), minlength=len(score))

        return flow

    def out_sums(self) -> np.ndarray:
        """Similarity of each sentence to all others together."""
        at_term = np.bincount(self.term, self.gain, minlength=self.n_terms)[self.term]
        return np.bincount(self.sentence, self.tf * (at_term - self.gain), minlength=len(self.doc))

    def rank(self, damping: float, max_rounds: int, min_diff: float) -> np.ndarray:
        out = self.out_sums()
        share = np.divide(1.0, out, out=np.zeros_like(out), where=out != 0)

        def narrowed(places: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
            return self.spread(places, share)

        start, every = np.ones(len(self.doc)), np.arange(len(self.doc))
        return settle(narrowed(every), start, self.doc, damping, max_rounds, min_diff, narrowed)

    def similarity_to(self, picked: np.ndarray) -> np.ndarray:
        """Similarity of every sentence to the one sentence of its document in ``picked``."""
        chosen = picked[self.sentence]
        at_term = np.zeros(self.n_terms)
        at_term[self.term[chosen]] = self.gain[chosen]
        return np.bincount(self.sentence, self.tf * at_term[self.term], minlength=len(self.doc))


    def similarity_of(self, sent: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Similarity of each sentence in ``sent`` to the one beside it in ``other``, by their numbers in the block.

        Each term of ``sent`` is looked up in ``other``, so the time follows the terms of the sentences asked for.
        """
        span = max(self.n_terms, 1)
        keys = self.sentence * span + self.term
        order = np.argsort(keys)
        keys = keys[order]
        first, last = (np.searchsorted(self.sentence, sent, side) for side in ("left", "right"))
        size = last - first
        pair = np.repeat(np.arange(len(sent)), size)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + first[pair]
        wanted = other[pair] * span + self.term[at]
        found = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = keys[found] == wanted if len(keys) else np.zeros(0, dtype=bool)
        return np.bincount(pair[hit], self.tf[at[hit]] * self.gain[order[found[hit]]], minlength=len(sent))


def pair_similarities(sentences: Column, pairs: Column) -> Column:
    """array<double>: for each of the row's pairs, array<struct<sent, other>>, the score of ``other`` for the terms of
    ``sent``, 0 without a shared one or for a sentence that is not there."""

    @arrow_udf("array<double>")
    def similar(documents: pa.Array, asked: pa.Array) -> pa.Array:
        def solve(rows: slice) -> pa.Array:
            postings, lists = Postings(documents[rows]), asked[rows]
            n = _lengths(lists)
            doc = np.repeat(np.arange(len(n)), n)
            sent, other = (lists.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            size, first = postings.sizes[doc], (np.cumsum(postings.sizes) - postings.sizes)[doc]
            inside = (sent >= 0) & (sent < size) & (other >= 0) & (other < size)
            sims = np.zeros(len(doc))
            sims[inside] = postings.similarity_of((first + sent)[inside], (first + other)[inside])
            return _as_lists(pa.array(sims), n)

        weights = _token_counts(documents) + _lengths(asked)
        return pa.concat_arrays([solve(rows) for rows in _blocks(weights)] or [solve(slice(0, 0))])

    return _once(similar)(sentences, pairs)


def all_similarities(name: str, digits: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (``name``, sentences), a row for each text given as token arrays, to (``name``, sent, other, sim): the score of
    each sentence for the terms of each, itself included, 0 without a shared one; rounded if ``digits`` are given.

    Pairs leave in batches of about ``BATCH_PAIRS`` and are nowhere held as a whole: the pairs of ``BATCH_PAIRS``, or those
    of one sentence, are in memory at a time.
    """

    def solve(ids: pa.Array, documents: pa.Array) -> Iterator[pa.RecordBatch]:
        postings = Postings(documents)
        n, doc = len(postings.doc), postings.doc
        size = postings.sizes[doc]
        first_of_doc = (np.cumsum(postings.sizes) - postings.sizes)[doc]
        by_term = np.argsort(postings.term, kind="stable")
        df = np.bincount(postings.term, minlength=postings.n_terms)
        first_of_term = np.cumsum(df) - df
        meets = df[postings.term]
        # Of each sentence: its pairs and the postings that its own meet, whichever are more.
        work = np.maximum(size, np.bincount(postings.sentence, meets, minlength=n).astype(np.int64))
        edges = np.flatnonzero(np.diff(np.cumsum(work) // BATCH_PAIRS, prepend=-1))
        for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), n]):
            sizes = size[begin:end]
            base = np.cumsum(sizes) - sizes
            total = int(sizes.sum())
            left, right = np.searchsorted(postings.sentence, [begin, end])
            reps = meets[left:right]
            own = np.repeat(np.arange(left, right), reps)
            turn = np.arange(len(own)) - np.repeat(np.cumsum(reps) - reps, reps)
            met = by_term[first_of_term[postings.term[own]] + turn]
            asked = postings.sentence[own]
            place = base[asked - begin] + postings.sentence[met] - first_of_doc[asked]
            # Of nothing, numpy counts whole numbers.
            sims = np.bincount(place, postings.tf[own] * postings.gain[met], minlength=total).astype(np.float64)
            if digits is not None:
                sims = np.round(sims, digits) + 0.0
            sent = np.repeat(np.arange(begin, end) - first_of_doc[begin:end], sizes)
            other = np.arange(total) - np.repeat(base, sizes)
            columns = [ids.take(pa.array(np.repeat(doc[begin:end], sizes))), pa.array(sent.astype(np.int32)), pa.array(other.astype(np.int32)), pa.array(sims)]
            yield pa.RecordBatch.from_arrays(columns, [name, "sent", "other", "sim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, documents = batch.columns
            for rows in _blocks(_token_counts(documents)):
                yield from solve(ids[rows], documents[rows])

    return run


def similarity_totals(sentences: Column) -> Column:
    """array<struct<sent, to_self, to_others>> of the sentences with a term: row sums of the similarity matrix."""

    @arrow_udf("array<struct<sent:int,to_self:double,to_others:double>>")
    def totals(documents: pa.Array) -> pa.Array:
        def solve(rows: pa.Array) -> pa.Array:
            postings = Postings(rows)
            n = len(postings.doc)
            worded = np.flatnonzero(np.bincount(postings.sentence, minlength=n))
            to_self = np.bincount(postings.sentence, postings.tf * postings.gain, minlength=n)[worded]
            doc = postings.doc[worded]
            at = (worded - (np.cumsum(postings.sizes) - postings.sizes)[doc]).astype(np.int32)
            sums = [pa.array(at), pa.array(to_self), pa.array(postings.out_sums()[worded])]
            made = pa.StructArray.from_arrays(sums, ["sent", "to_self", "to_others"])
            return _as_lists(made, np.bincount(doc, minlength=len(rows)))

        return pa.concat_arrays([solve(documents[rows]) for rows in _blocks(_token_counts(documents))] or [solve(documents)])

    return _once(totals)(sentences)


def sentence_ranks(sentences: Column, damping: float, max_rounds: int, min_diff: float) -> Column:
    """array<double>: rank of each sentence, given as tokens, among those of its document."""

    @arrow_udf("array<double>")
    def rank(documents: pa.Array) -> pa.Array:
        def solve(rows: pa.Array) -> pa.Array:
            postings = Postings(rows)
            return _as_lists(pa.array(postings.rank(damping, max_rounds, min_diff)), postings.sizes)

        return pa.concat_arrays([solve(documents[rows]) for rows in _blocks(_token_counts(documents))] or [solve(documents)])

    return _once(rank)(sentences)


def distinct_picks(
    sentences: Column, weights: Column, size: Column, threshold: float
) -> Column:
    """array<struct<at, weight>>: sentences by falling weight, later first when equal, without those too similar to one taken before.

    ``size - 1`` sentences are taken, at least one.
    """

    @arrow_udf("array<struct<at:int,weight:double>>")
    def pick(documents: pa.Array, weight_lists: pa.Array, limits: pa.Array) -> pa.Array:
        def solve(rows: slice) -> pa.Array:
            return _pick(Postings(documents[rows]), weight_lists[rows], limits[rows], threshold)

        return pa.concat_arrays([solve(rows) for rows in _blocks(_token_counts(documents))] or [solve(slice(0, 0))])

    return _once(pick)(sentences, weights, size)


def _pick(postings: Postings, weight_lists: pa.Array, limits: pa.Array, threshold: float) -> pa.Array:
    doc, n_docs = postings.doc, len(postings.sizes)
    weight = weight_lists.flatten().to_numpy(zero_copy_only=False)
    limit = np.maximum(np.minimum(limits.to_numpy(zero_copy_only=False), postings.sizes) - 1, 1)
    index = np.arange(len(doc))
    order = np.lexsort((-index, -weight, doc))
    first = np.concatenate([[0], np.cumsum(postings.sizes)])[:-1]
    open_sentences = np.ones(len(doc), dtype=bool)
    taken, taken_by = [], []
    count = np.zeros(n_docs, dtype=np.int64)
    while open_sentences.any():
        waiting = order[open_sentences[order]]
        best = waiting[np.flatnonzero(np.diff(doc[waiting], prepend=-1))]
        taken.append(best)
        taken_by.append(doc[best])
        count[doc[best]] += 1
        picked = np.zeros(len(doc), dtype=bool)
        picked[best] = True
        alike = postings.similarity_to(picked) >= threshold
        open_sentences &= ~alike & ~picked & (count < limit)[doc]
    by_doc = np.argsort(np.concatenate([[], *taken_by]), kind="stable")
    best = np.concatenate([[], *taken]).astype(np.int64)[by_doc]
    at = (best - first[doc[best]]).astype(np.int32)
    picks = pa.StructArray.from_arrays([pa.array(at), pa.array(weight[best])], ["at", "weight"])
    return _as_lists(picks, count)


def item_counts(items: Column, kind: str, first: str | None = None, best: int | None = None) -> Column:
    """array<struct<item, n>> or <item, n, ``first``>: the different items of an array, in their order, with how often they
    occur and the place of the first occurrence. Null for a null array, nulls left out.

    With ``best`` only that many, the most frequent first, the earlier first when equal."""
    names = ["item", "n", *([first] if first else [])]
    shape = f"array<struct<item:{kind},n:bigint{f',`{first}`:int' if first else ''}>>"

    @arrow_udf(shape)
    def count(lists: pa.Array) -> pa.Array:
        lengths = _lengths(lists)
        encoded = lists.flatten().dictionary_encode()
        known = encoded.indices.is_valid().to_numpy(zero_copy_only=False)
        code = pc.fill_null(encoded.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        span = max(len(encoded.dictionary), 1)
        order = pc.sort_indices(encoded.dictionary).to_numpy(zero_copy_only=False)
        rank = np.empty(span, dtype=np.int64)
        rank[order] = np.arange(len(order))
        row = np.repeat(np.arange(len(lengths)), lengths)
        found = np.flatnonzero(known)
        keys, at, n = np.unique(row[found] * span + rank[code[found]], return_index=True, return_counts=True)
        owner = keys // span
        if best is not None:
            order_of_row = np.lexsort((at, -n, owner))
            turn = np.arange(len(keys)) - np.searchsorted(owner, owner)
            chosen = order_of_row[turn < best]
            keys, at, n, owner = keys[chosen], at[chosen], n[chosen], owner[chosen]
        columns = [encoded.dictionary.take(pa.array(order[keys % span])), pa.array(n.astype(np.int64))]
        if first:
            columns.append(pa.array((found[at] - (np.cumsum(lengths) - lengths)[owner]).astype(np.int32)))
        made = pa.StructArray.from_arrays(columns, names)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lengths)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), made, mask=lists.is_null())

    return _once(count)(items)


def tagged_parts(title: Column, content: Column) -> Column:
    """struct<title_words, words>: the words of the title, and the words with tags of title and content, of texts of
    ``word/tag`` parts as ``parse_tagged`` reads them. Words are null without content."""

    def parsed(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        lists = pc.split_pattern(pc.fill_null(texts, ""), TOKEN_SEPARATOR)
        lengths = _lengths(lists)
        encoded = lists.flatten().dictionary_encode()
        # Different parts are few, and only they are looked into.
        parts = pc.extract_regex(encoded.dictionary, r"\A(?P<word>[^/]*)/(?P<tag>[^/]*)")
        tagged = pc.match_substring_regex(encoded.dictionary, r"\A[^/]*/+[^/]").to_numpy(zero_copy_only=False)
        code = encoded.indices.to_numpy(zero_copy_only=False)
        kept = tagged[code]
        row = np.repeat(np.arange(len(lengths)), lengths)[kept]
        return parts.take(pa.array(code[kept])), np.bincount(row, minlength=len(lengths))

    @arrow_udf("struct<title_words:array<string>,words:array<struct<word:string,tag:string>>>")
    def parse(titles: pa.Array, contents: pa.Array) -> pa.Array:
        (of_title, n_title), (of_content, n_content) = parsed(titles), parsed(contents)
        empty = pc.fill_null(pc.equal(contents, ""), True)
        # A row's parts of the title, then those of the content.
        starts = [np.cumsum(n) - n for n in (n_title, n_content)]
        both, n = pa.concat_arrays([of_title, of_content]), n_title + n_content
        row, ends = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
        at = np.arange(len(row)) - ends[row]
        in_title = at < n_title[row]
        place = np.where(in_title, starts[0][row] + at, len(of_title) + starts[1][row] + at - n_title[row])
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        words = pa.ListArray.from_arrays(offsets, both.take(pa.array(place)), mask=empty)
        return pa.StructArray.from_arrays([_as_lists(of_title.field(0), n_title), words], ["title_words", "words"])

    return _once(parse)(title, content)


def keyword_tokens(words: Column) -> Column:
    """array<string>: the words of array<struct<word, tag>> that ``is_keyword_token`` takes, each different one looked at
    once; null for a null array."""

    @arrow_udf("array<string>")
    def choose(lists: pa.Array) -> pa.Array:
        lengths, parts = _lengths(lists), lists.flatten()
        word, tag = (parts.field(k).dictionary_encode() for k in (0, 1))
        long = pc.greater(pc.utf8_length(pc.utf8_trim(word.dictionary, TRIM_CHARACTERS)), 1)
        initial = pc.utf8_slice_codeunits(tag.dictionary, 0, 1)
        named = pc.invert(pc.is_in(initial, value_set=pa.array([*EXCLUDED_TAG_INITIALS, ""])))
        good = []
        for encoded, taken in ((word, long), (tag, named)):
            code = pc.fill_null(encoded.indices, len(encoded.dictionary)).to_numpy(zero_copy_only=False)
            good.append(np.append(taken.to_numpy(zero_copy_only=False).astype(bool), False)[code])
        kept = good[0] & good[1]
        n = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[kept], minlength=len(lengths))
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, parts.field(0).filter(pa.array(kept)), mask=lists.is_null())

    return _once(choose)(words)


def _cut(items: list, ends: np.ndarray) -> Iterator[list]:
    """``items`` in consecutive parts that end before ``ends``."""
    begin = 0
    for end in ends.tolist():
        yield items[begin:end]
        begin = end


def likely_pairs(keywords: Column, words: Column) -> Column:
    """array<struct<left, right>>: neighbours among ``words`` that both begin and end with a keyword; null for null."""

    @arrow_udf("array<struct<left:string,right:string>>")
    def find(keyword_lists: pa.Array, lists: pa.Array) -> pa.Array:
        keys = keyword_lists.flatten().field(0)
        every = pc.unique(keys.drop_null())
        sizes = pc.utf8_length(every).to_numpy(zero_copy_only=False)

        def may_match(words: pa.Array) -> np.ndarray:
            begins, ends = np.zeros((2, len(words)), dtype=bool)
            for size in np.unique(sizes).tolist():
                same = every.filter(pa.array(sizes == size))
                first = pc.utf8_slice_codeunits(words, 0, size)
                last = pc.utf8_slice_codeunits(words, -size) if size else first
                begins |= pc.is_in(first, value_set=same).to_numpy(zero_copy_only=False)
                ends |= pc.is_in(last, value_set=same).to_numpy(zero_copy_only=False)
            return begins & ends

        # Most words match no keyword of any row of the batch. The few that do are held against those of their row.
        lengths, flat = _lengths(lists), lists.flatten()
        encoded = flat.dictionary_encode()
        matches = np.append(may_match(encoded.dictionary), False)
        matches = matches[pc.fill_null(encoded.indices, len(encoded.dictionary)).to_numpy(zero_copy_only=False)]
        row = np.repeat(np.arange(len(lengths)), lengths)
        at = np.flatnonzero(matches[:-1] & matches[1:] & (row[:-1] == row[1:]))
        ends, row = np.cumsum(_lengths(keyword_lists)), row[at]
        left, right = (flat.take(pa.array(place)) for place in (at, at + 1))
        texts = [tuple(k for k in one if k is not None) for one in _cut(keys.to_pylist(), ends)]
        kept = [
            all(word.startswith(texts[i]) and word.endswith(texts[i]) for word in pair)
            for i, *pair in zip(row.tolist(), left.to_pylist(), right.to_pylist())
        ]
        kept = np.array(kept, dtype=bool)
        made = pa.StructArray.from_arrays([part.filter(pa.array(kept)) for part in (left, right)], ["left", "right"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(lengths)))]).astype(np.int32)
        missing = pc.or_(lists.is_null(), keyword_lists.is_null())
        return pa.ListArray.from_arrays(pa.array(offsets), made, mask=missing)

    return _once(find)(keywords, words)


def _token_counts(documents: pa.Array) -> np.ndarray:
    sizes = _lengths(documents)
    lengths = _lengths(documents.flatten())
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), lengths + 1, minlength=len(sizes))
