"""Collocations, the filter audit and toxic passages against plain versions."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusengine.llm import audit, collocations, passages

# --- collocations ---------------------------------------------------------------------------------------------


def mined(rows, threshold, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = []
    for (lang, phrase), a in f.items():
        if len(phrase) < 2 or a < threshold:
            continue
        longer = [n for (other, p), n in f.items() if other == lang and len(p) == 3 and len(phrase) == 2 and n >= threshold and phrase in (p[:2], p[1:])]
        if any(100 * n >= 50 * a for n in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        found.append((lang, -score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]], total[lang]))
    out = []
    for lang in sorted({r[0] for r in found}):
        own = sorted(r for r in found if r[0] == lang)[:top]
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (_, s, a, p, l, r, n) in enumerate(own)]
    return out


def talk(seed, n):
    rng = random.Random(seed)
    pool = ["new", "York", "york", "city", "the", "of", "ça", "日本", "a", "b"]
    made = []
    for k in range(n):
        words = rng.choices(pool, weights=[5, 4, 4, 4, 6, 5, 1, 1, 2, 2], k=rng.randint(0, 40))
        made.append((k, rng.choice([None, "en", "en", "fr"]), "".join(w + rng.choice([" ", " ", " ", "  ", ", ", "\t", ".\n"]) for w in words)))
    return made


@pytest.mark.parametrize("shards", [1, 2, 4])
def test_collocations_equal_brute_force(spark, shards):
    rows = talk(7, 90)
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = [tuple(r) for r in collocations.collocations(frame, threshold=6, top=25, shards=shards).collect()]
    assert sorted(got) == mined([r[1:] for r in rows], 6, 25)


def test_filters_that_take_everything_for_frequent_change_nothing(spark, monkeypatch):
    rows = talk(8, 60)
    monkeypatch.setattr(collocations, "bloom", lambda phrases, n: b"\xff" * 8192)
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in collocations.collocations(frame, threshold=4, top=500).collect()) == mined([r[1:] for r in rows], 4, 500)


def test_counts_handed_on_early_are_the_same(monkeypatch):
    rows = talk(9, 80)
    everything = [(0, np.full(8192, 255, np.uint8))]

    def counted():
        counts, found, early = collocations.Counts(1, 2, collocations.Steps(everything), collocations.Steps(everything)), Counter(), 0
        batches = []
        for _, lang, text in rows:
            if counts.add(lang or "und", text.encode()):
                early += 1
                batches += counts.phrases()
        for batch in [*batches, *counts.phrases()]:
            for row in batch.to_pylist():
                found[row["k"], row["lang"], row["phrase"], row["since"]] += row["n"]
        return found, early

    whole, early = counted()
    assert early == 0 and {k for k, *_ in whole} == {0, 1, 2, 3}
    monkeypatch.setattr(collocations, "CHUNK", 40)
    monkeypatch.setattr(collocations, "HELD", 30)
    parts, early = counted()
    assert early > 3 and parts == whole


def test_collocations_of_odd_rows(spark, odd, empty):
    table = odd.withColumn("lang", F.when(F.col("source") == "a", "x")).withColumn("phrase", F.lit("clash"))
    got = [tuple(r) for r in collocations.collocations(table, threshold=2).collect()]
    assert sorted(got) == mined([(r.lang, r.text) for r in table.collect()], 2, 2000)
    nothing = collocations.collocations(empty.withColumn("lang", F.lit("x")))
    assert nothing.count() == 0 and nothing.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# --- filter audit ---------------------------------------------------------------------------------------------


def audited(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = [(d, s or "", t or "") for d, s, t in rows]
    failing = []
    for d, part, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and any(e is not None and e < d and t == text for e, _, t in texts),
        }
        failing.append((d, part, {f for f, bad in fails.items() if bad}))
    out = []
    for part in {p for _, p, _ in failing}:
        own = [(d, fails) for d, p, fails in failing if p == part]
        removed_by = Counter()
        made = []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                here = [(d, fails) for d, fails in left if letter in fails]
                left = [(d, fails) for d, fails in left if letter not in fails]
                all_failing = sum(letter in fails for _, fails in own)
                removed_by[letter] += len(here)
                unique = sum(fails == {letter} for _, fails in own)
                counts = (len(left), len(here), all_failing - len(here), unique, sum(d in good for d, _ in here), sum(d in toxic for d, _ in here))
                made.append((part, order, step, *counts, letter))
        out += [(*row[:-1], removed_by[row[-1]]) for row in made]
    return sorted(out)


def test_audit_equals_brute_force(spark, odd):
    rng = random.Random(2)
    rows = []
    for k in range(120):
        words = [rng.choice(["One", "two", "THREE", "four#", "fünf"]) + str(rng.randint(0, rng.choice([5, 400]))) for _ in range(rng.choice([3, 60, 80]))]
        rows.append((k, rng.choice(["s", "t", None]), " ".join(words)))
    rows += [(200 + k, rng.choice("st"), rows[k % 7][2]) for k in range(30)] + [(None, "s", rows[0][2]), (3, "s", rows[3][2])]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 230, 2)] + [(4, 1, 1), (None, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert sorted(tuple(r) for r in audit.audit(frame, said).collect()) == audited(rows, labels)
    strange = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    assert sorted(tuple(r) for r in audit.audit(odd, said).collect()) == audited(strange, labels)


def test_audit_of_nothing(spark, empty):
    said = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, said).count() == 0


def test_least_squares_give_shapley_values():
    for n in (2, 3, 5):
        weights = audit.shapley_solution(n)
        rng = random.Random(n)
        v = [0] + [rng.randint(0, 99) for _ in range((1 << n) - 1)]
        orders = list(permutations(range(n)))
        for i in range(n):
            total = 0
            for order in orders:
                before = sum(1 << j for j in order[: order.index(i)])
                total += v[before | 1 << i] - v[before]
            assert len(orders) * sum(w * x for w, x in zip(weights[i], v, strict=True)) == total


# --- toxic passages -------------------------------------------------------------------------------------------


def maximal(scores):
    """The best segment (the shortest of equals), then the same to the left and right of it."""
    best = max(((sum(scores[a:b]), a - b, -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    *_, a, b = best
    right = [(x + b, y + b, s) for x, y, s in maximal(scores[b:])]
    return maximal(scores[:a]) + [(a, b, best[0])] + right


def test_segments_are_the_maximal_ones():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-3.0, -2.0, -1.0, 1.0, 2.0, 4.0]) + rng.random() / 8 for _ in range(rng.randint(0, 25))]
        found = passages.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in maximal(scores)]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in maximal(scores)])


def test_segments_take_linear_time():
    import time

    def seconds(n):
        # Rising and falling levels, the worst case of a search through all segments before.
        scores = np.tile([1.0, -1.5], n)
        start = time.perf_counter()
        passages.segments(scores)
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(200_000) < 8 * seconds(50_000) + 0.2


def test_chance_fits_the_distribution_of_maxima():
    random_ = np.random.default_rng(1)
    n = random_.integers(50, 2000, 4000)
    best = (random_.gumbel(size=4000) + np.log(n) + 0.7) / 2.5
    scale, log_k = passages.chance(best.tolist(), n.tolist())
    assert scale == pytest.approx(2.5, rel=0.08) and log_k == pytest.approx(0.7, abs=0.15)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    rows = []
    for k in range(900):
        toxic = int(k % 6 == 0)
        words = [f"w{rng.randint(0, 800)}" for _ in range(rng.randint(15, 120))]
        for _ in range(toxic * rng.randint(1, 3)):
            words[rng.randrange(len(words))] = rng.choice(["Vile!", "nasty", "gross,"])
        rows.append((k, " ".join(words), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.drop("toxic"), frame.select("doc_id", "toxic")


def test_held_out_passages_are_found(spark, labelled):
    docs, labels = labelled
    model = passages.fit(docs.where(~passages.held_out()), labels)
    assert sorted(w for w, s in model.words.items() if s > 1) == [b"gross", b"nasty", b"vile"]
    rows = passages.with_passages(docs.where(passages.held_out()), model).join(labels, "doc_id").collect()
    assert all((r.score >= 0.7) == (r.toxic == 1) for r in rows)
    for r in rows:
        assert all(re.search("vile|nasty|gross", r.text[p.start : p.end].lower()) for p in r.passages)
        assert all(0 <= r.score <= 1 for r in rows)


def test_copies_count_once(spark, labelled):
    docs, labels = labelled
    copies = spark.range(2000).select((F.col("id") + 5000).alias("doc_id"), F.lit("w1 w2 w3 odd words copied often").alias("text"))
    marked = copies.select("doc_id", F.lit(1).alias("toxic"))
    model = passages.fit(docs.unionByName(copies), labels.unionByName(marked))
    assert b"copied" not in model.words and b"vile" in model.words


def test_scores_of_odd_rows(spark, odd, empty, labelled):
    docs, labels = labelled
    model = passages.fit(docs, labels)
    rows = passages.with_passages(odd, model).collect()
    # ``score`` is one of the clashing names and is replaced; all others stay.
    kept = [c for c in odd.columns if c not in ("score", "passages")]
    assert sorted(map(repr, ([r[c] for c in kept] for r in rows))) == sorted(map(repr, ([r[c] for c in kept] for r in odd.collect())))
    assert {r.score for r in rows if not r.text} == {min(r.score for r in rows)}
    assert passages.with_passages(empty, model).count() == 0
    nothing = passages.fit(empty, labels)
    assert {r.score for r in passages.with_passages(odd, nothing).collect()} == {0.0}
