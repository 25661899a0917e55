import math
import random

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import model
from corpusengine import constants as C
from corpusengine.functions import fold, solve, text, votes
from corpusengine.operators import bm25, brands, each, evaluate, joins, keywords, lookup, places, sentiment, summary, templates
from corpusengine.operators.tfidf import least_sent, tfidf, word_counts
from corpusengine.plans.workload import QUERIES
from corpusengine.session import stage


def random_docs(seed, n, vocabulary, longest):
    rng = random.Random(seed)
    return [(i, [rng.choice(vocabulary) for _ in range(rng.randint(0, longest))]) for i in range(n)]


WORDS = ["spark", "sparks", "join", "plan", "data", "lake", "shuffle", "sort", "hash", "key", "keys", "row"]


# --- TF-IDF and templates -------------------------------------------------------------------------------------


def test_tfidf(spark, monkeypatch):
    docs = spark.createDataFrame([("d1", "a a b"), ("d2", "a c")], "id string, words string")
    expected = {("d1", "a"): 0.00663355, ("d2", "a"): 0.00331678, ("d1", "b"): 0.23271157, ("d2", "c"): 0.23271157}
    for bound in (lookup.BROADCAST_ROWS, 0):
        monkeypatch.setattr("corpusengine.operators.tfidf.is_small", lambda df: lookup.is_small(df, bound))
        got = {(r.id, r.word): round(r.tfidf, 8) for r in tfidf(docs, "id", "words", "word").collect()}
        assert got == expected


def test_tfidf_shuffles_neither_documents_nor_frequent_words(spark, monkeypatch):
    """counts of one row's document don't meet others, and only rows of rare words go to a join by word."""
    rows = [(i, " ".join(["a"] * (i % 3 + 1) + ["b"] * (i % 2) + [f"c{i // 2}", f"d{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, words string")
    once = word_counts(df, "id", "words", unique=True)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    whole = sorted(tfidf(df, "id", "words").collect())
    n_words, spread = 62, {"a": 40, "b": 20} | {f"c{i}": 2 for i in range(20)} | {f"d{i}": 1 for i in range(40)}
    assert whole == sorted(
        (i, w, pytest.approx(text.split(" ").count(w) / n_words * math.log(40 / spread[w] + 0.01), rel=1e-12))
        for i, text in rows for w in set(text.split(" "))
    )
    words = stage(word_counts(df, "id", "words").groupBy("word").agg(F.count("*").alias("df")), "spread")
    for bound, least in ((100, 1), (25, 2), (2, 20), (1, 40), (0, 41)):
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", bound)
        monkeypatch.setattr("corpusengine.operators.tfidf.is_small", lambda df: False)
        assert least_sent(words) == least
        assert sorted(tfidf(df, "id", "words").collect()) == whole
    halves = spark.createDataFrame([(1, "a b"), (1, "a"), (2, "a")], "id int, words string")
    assert {tuple(r) for r in word_counts(halves, "id", "words").collect()} == {(1, "a", 2), (1, "b", 1), (2, "a", 1)}
    assert len(tfidf(halves, "id", "words").collect()) == 3


def test_class_template(spark):
    weights = spark.createDataFrame([("x", "p", 3.0), ("x", "q", 1.0), ("x", "r", 0.5)], "class string, word string, tfidf double")
    got = {r.word: r.tfidf for r in templates.template_of(weights, "class", 2, None).collect()}
    assert got == {"p": 0.75, "q": 0.25}
    # The pattern applies after the cut.
    assert [r.word for r in templates.template_of(weights, "class", 2, "q").collect()] == ["q"]


def test_template_classify(spark):
    template = spark.createDataFrame(
        [("x", "p", 0.6), ("y", "p", 0.5), ("y", "q", 0.4)], "class string, word string, tfidf double"
    )
    docs = spark.createDataFrame([(1, "p q", "y"), (2, "z", "x"), (3, "p", "y"), (4, " ", "x")], "id int, words string, class string")
    got = templates.template_classify(docs, "id", "words", template)
    assert {r.id: r.docClass for r in got.collect()} == {1: "y", 2: "Unknown", 3: "x", 4: "Unknown"}
    assert templates.template_accuracy(docs.join(got, "id"), "class").first().accuracy == 0.5
    listed = {r.word: [(c["class"], c.tfidf) for c in r.classes] for r in templates.template_word_map(template).collect()}
    assert listed == {"p": [("x", 0.6), ("y", 0.5)], "q": [("y", 0.4)]}


def test_attach_agrees_with_and_without_broadcast(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"w{i}", i) for i in range(30)], "word string, i int")
    entries = spark.createDataFrame([("hot", 1), ("hot", 2), ("w3", 3)], "word string, weight int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small, large = (lookup.attach(rows, entries, "word", how, max_rows=m) for m in (100, 0))
        assert sorted(small.collect()) == sorted(large.collect())


def test_without_words_agrees_for_any_list_length(spark, monkeypatch):
    docs = spark.createDataFrame([(1, [["a", "b", "a"], ["b"], ["c", "a"]]), (2, []), (3, [[]])], "id int, t array<array<string>>")
    stop = spark.createDataFrame([("b",), ("c",)], "word string")
    more = [(1, [["b"], None, ["x"]]), (None, [["c", "y"]]), (4, None), (1, [["b"], None, ["x"]])]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    expected = [(1, [["a", "a"], [], ["a"]]), (2, []), (3, [[]]), (1, [[], None, ["x"]]), (None, [["y"]]), (4, None), (1, [[], None, ["x"]])]
    for bound in (lookup.LITERAL_WORDS, 0):
        monkeypatch.setattr(lookup, "LITERAL_WORDS", bound)
        assert sorted(map(tuple, lookup.without_words(docs, "t", stop).collect()), key=repr) == sorted(expected, key=repr)


# --- votes, labels, evaluation --------------------------------------------------------------------------------


def one(spark, column, **cells):
    return spark.createDataFrame([tuple(cells.values())], list(cells)).select(column.alias("x")).first().x


def test_votes(spark):
    for given, expected in [([1.0, 2.0, 1.0, 2.0, 3.0], 1.0), ([3.0, 3.0, 0.0, 1.0, 3.0], 3.0)]:
        assert one(spark, votes.majority_vote(F.col("p")), p=given) == expected
        assert one(spark, votes.majority_vote(F.col("p")), p=given[::-1]) == expected


def test_label_rules(spark):
    labels = ["军事", "娱乐", "时事", "汽车"]

    def elected(predictions, brand):
        ranked = votes.vote_labels_ranked(F.col("p"), F.col("l"))
        return one(spark, votes.label_vote_rules(ranked, F.col("b")), p=predictions, l=labels, b=brand)

    assert elected([0.0, 0.0, 0.0, 1.0, 2.0], False) == "军事 时事"
    assert elected([3.0] * 5, False) == "时事"
    assert elected([3.0] * 5, True) == "汽车"
    assert elected([1.0, 1.0, 0.0, 0.0, 1.0], False) == "娱乐 军事"


def test_weighted_f1_equals_the_evaluator(spark):
    rng = random.Random(5)
    rows = [(float(rng.randint(0, 3)), float(rng.randint(0, 4))) for _ in range(200)]
    frame = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate.weighted_f1(frame, "label", "prediction").first().f1
    assert ours == pytest.approx(evaluate.evaluator_f1(frame, "label", "prediction"), abs=1e-12)


def test_brand_contains_agrees_for_any_list_length(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "my audi car"), (2, "audio"), (3, "b"), (4, None), (5, "xbmwx bm")], "id int, t string")
    names = spark.createDataFrame([("audi ",), ("bmw",), ("b",)], "brand string")
    docs = docs.unionByName(spark.createDataFrame([(1, "none"), (None, "audi tt"), (None, "none")], docs.schema))
    expected = [(1, True), (2, False), (3, True), (4, False), (5, True), (1, False), (None, True), (None, False)]
    for small in (True, False):
        monkeypatch.setattr(brands, "is_small", lambda found, small=small: small)
        got = [(r.id, r.has_brand) for r in brands.brand_contains(docs, "t", names).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        blank = spark.createDataFrame([("",), (None,)], "brand string")
        got = {r.t: r.has_brand for r in brands.brand_contains(docs.where("t IS NULL OR t = 'b'"), "t", blank).collect()}
        assert got == {None: False, "b": True}


def test_any_number_of_brands_is_found_as_by_contains(spark):
    rng = random.Random(3)
    letters = "abäß日😀"
    names = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(3000)] + ["x" * 400]
    rows = ["".join(rng.choices(letters + "cdefgh", k=rng.randint(0, 60))) for _ in range(300)] + ["x" * 399, "x" * 401, "", None]
    few = spark.createDataFrame([(n,) for n in names if len(n) > 4], "brand string")
    kept = [n for n in names if len(n) > 4]
    texts = spark.createDataFrame([(t,) for t in rows], "t string")
    got = [(r.t, r.has_brand) for r in brands.brand_contains(texts, "t", few).collect()]
    expected = [(t, t is not None and any(n in t for n in kept)) for t in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert {flag for _, flag in expected} == {True, False}


def test_join_results(spark):
    articles = spark.createDataFrame([(1, "a"), (2, "b")], "docId int, text string")
    groups = spark.createDataFrame([(1, "g1", "s"), (1, "g2", "s"), (3, "g3", "s")], "docId int, groupId string, signature string")
    got = joins.join_results(articles, groups, "docId", ["groupId", "signature"])
    assert sorted(got.collect()) == [(1, "a", "g1", "s"), (1, "a", "g2", "s")]


def test_counts_in_rows(spark):
    frame = spark.createDataFrame([(1, ["b", "a", None, "b"]), (2, []), (3, None)], "id int, t array<string>")
    got = {r.id: r.n and [tuple(x) for x in r.n] for r in each.counted(frame, "t", "n", "at").collect()}
    assert got == {1: [("a", 1, 1), ("b", 2, 0)], 2: [], 3: None}


def test_counts_and_regions_need_no_interpreted_lambdas(spark):
    """as lambdas over the row, sorting and counting took most of the time."""
    rng = random.Random(5)
    lists = [[rng.choice([*WORDS, None]) for _ in range(rng.randint(0, 60))] for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(lists)), "id int, t array<string>")
    got = {r.id: [tuple(x) for x in r.n] for r in each.counted(frame, "t", "n", "at", best=4).collect()}
    for i, words in enumerate(lists):
        found = [(w, words.count(w), words.index(w)) for w in set(words) - {None}]
        assert got[i] == sorted(found, key=lambda x: (-x[1], x[2]))[:4]
    docs = spark.createDataFrame([(1, "A", "B B")], "id int, t string, c string")
    for df in (each.counted(frame, "t", "n"), places.region(docs, "id", "t", "c")):
        assert "lambdafunction" not in df._jdf.queryExecution().executedPlan().toString()


def test_region(spark):
    docs = spark.createDataFrame([(1, "A", "B B B B C"), (2, None, "B"), (3, None, None), (4, " ", "  "), (5, "X Y", None)],
                                 "id int, t string, c string")
    got = {r.id: r.region for r in places.region(docs, "id", "t", "c", n=2).collect()}
    assert got == {1: "B A", 2: "B", 3: None, 4: None, 5: "X Y"}


# --- sentiment ------------------------------------------------------------------------------------------------


def lexicons(spark):
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0), ("odd", 0.5)], "word string, weight double")
    adverbs = spark.createDataFrame([("very", 2.0), ("odd", 3.0), ("not", 1.5)], "word string, weight double")
    negations = spark.createDataFrame([("not",), ("never",)], "word string")
    return lexicon, adverbs, negations


def test_clause_sentiment_cases(spark):
    lexicon, _, negations = lexicons(spark)
    adverbs = spark.createDataFrame([("very", 2.0)], "word string, weight double")
    cases = [("it not good", -1.0), ("not good", 1.0), ("it very not good", -1.0), ("it not very good", -4.0)]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "id int, c string").withColumn("t", F.lit(None).cast("string"))
    got = sentiment.clause_sentiment(docs, "id", "t", "c", lexicon, adverbs, negations)
    assert {r.id: r.score for r in got.where("clause = 1").collect()} == {i: score for i, (_, score) in enumerate(cases)}


def test_clause_sentiment_against_model(spark):
    lexicon, adverbs, negations = lexicons(spark)
    as_dicts = [{r.word: r.weight for r in table.collect()} for table in (lexicon, adverbs)]
    docs = random_docs(3, 120, ["good", "bad", "odd", "very", "not", "never", "it", "the"], 12)
    frame = spark.createDataFrame([(i, " ".join(words), "it") for i, words in docs], "id int, t string, c string")
    got = sentiment.clause_sentiment(frame, "id", "t", "c", lexicon, adverbs, negations, mode="space")
    found = {r.id: r.score for r in got.where("clause = 0").collect()}
    assert found == {i: pytest.approx(2 * model.clause_score(words, *as_dicts, ["not", "never"])) for i, words in docs}


def test_clauses_folded_and_joined_are_the_same(spark, monkeypatch):
    lexicon = spark.createDataFrame([("good", 1.5), ("bad", -1.0), ("very", 0.25)], "word string, weight double")
    adverbs = spark.createDataFrame([("very", 2.0), ("so", 0.5), ("not", 3.0)], "word string, weight double")
    negations = spark.createDataFrame([("not",), ("no",), (None,)], "word string")
    pool = ["good", "bad", "very", "so", "not", "no", "x", "y"]
    texts = [" ".join(words) for _, words in random_docs(11, 60, pool, 12)]
    rows = [(k % 50, t, None if k % 9 == 0 else f"{t}。{texts[-k]}") for k, t in enumerate(texts)] + [(None, None, None), (7, "", "")]
    frame = spark.createDataFrame(rows, "id int, t string, c string").withColumn("clauses", F.lit("clash"))
    results = []
    for small in (True, False):
        monkeypatch.setattr(sentiment, "is_small", lambda words, small=small: small)
        found = sentiment.with_clauses(frame, "t", "c", lexicon, adverbs, negations, mode="space")
        assert found.columns == frame.columns
        results.append(sorted((str(r.id), str(r.t), str(r.c), [(c.clause, round(c.score, 9)) for c in r.clauses]) for r in found.collect()))
    assert results[0] == results[1] and len(results[0]) == len(rows)


def test_sentiment_of_a_row_needs_no_exchange(spark):
    one = [spark.createDataFrame([("good", 1.0)], "word string, weight double")] * 2 + [spark.createDataFrame([("no",)], "word string")]
    frame = spark.range(1000).select("id", F.lit("").alias("t"), F.lit(None).cast("string").alias("c"))
    found = sentiment.with_clauses(frame, "t", "c", *one).withColumn("sentiment", sentiment.percent_in_row("clauses"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r.sentiment) for r in found.collect()} == {(0.5, 0.5)}


def test_sentiment_totals(spark):
    clauses = spark.createDataFrame([(1, 2.0), (1, -1.0), (2, 0.0), (3, 1.0), (3, -2.0)], "id int, score double")
    shares = {r.id: r.sentiment for r in sentiment.sentiment_percent(clauses, "id").collect()}
    assert shares == {1: [0.67, 0.33], 2: [0.5, 0.5], 3: [0.33, 0.67]}
    signs = {r.id: r.sentiment for r in sentiment.sentiment_sign(clauses, "id").collect()}
    assert signs == {1: [1.0], 2: [0.0], 3: [-1.0]}


# --- words and keywords ---------------------------------------------------------------------------------------


def test_cooccurrence(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c", "a"]), (2, ["a", "b"])], "id int, kept array<string>")
    got = {(r.id, r.src, r.dst) for r in keywords.sliding_cooccurrence(docs, "id").collect()}
    assert got == {(1, a, b) for a in "abc" for b in "abc" if a != b}


def test_cooccurrence_of_nulls_repeats_and_short_texts(spark):
    docs = [(1, ["b", None, "a", "b"]), (2, []), (3, None), (4, ["x", "x", "x"]), (5, ["z", "y", "z", "y"])]
    frame = spark.createDataFrame(docs, "id int, kept array<string>")
    for window in (2, 3):
        expected = set()
        for i, words in docs:
            if words and len(words) >= window:
                pairs = {(x, y) for k, x in enumerate(words) for y in words[k + 1 : k + window] if x and y and x != y}
                expected |= {(i, *p) for x, y in pairs for p in ((x, y), (y, x))}
        rows = [tuple(r) for r in keywords.sliding_cooccurrence(frame, "id", window=window).collect()]
        assert sorted(rows) == sorted(expected)


def test_cooccurrence_time_follows_the_tokens(spark):
    def seconds(n):
        words = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: (k * k % 7919).cast("string"))
        start = time.perf_counter()
        keywords.sliding_cooccurrence(spark.range(1).select("id", words.alias("kept")), "id").count()
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(40_000) < 4 * seconds(10_000) + 1


@pytest.mark.parametrize("window", [2, 5])
def test_word_ranks_agree_with_model(spark, window):
    docs = random_docs(window, 40, WORDS, 30)
    frame = spark.createDataFrame(docs, "id int, kept array<string>")
    expected = {i: {w: pytest.approx(s, abs=2e-9) for w, s in model.rank_words(words, window).items()} for i, words in docs}
    got = {r.id: {w.word: w.score for w in r.ranked} for r in keywords.textrank_words(frame, window=window).collect()}
    assert {i: s for i, s in got.items() if s} == {i: s for i, s in expected.items() if s}


def test_path_graph_rank(spark):
    frame = spark.createDataFrame([(0, ["a", "b", "c"])], "id int, kept array<string>")
    ranked = keywords.textrank_words(frame, window=2, max_rounds=5, min_diff=0.0).first().ranked
    assert {w.word: round(w.score, 6) for w in ranked} == {"a": 0.520436, "b": 1.071717, "c": 0.520436}


def test_select_and_merge(spark):
    def pairs(column, **cells):
        kinds = "k array<struct<word:string,score:double>>, t array<string>"
        return [(w.word, w.score) for w in spark.createDataFrame([tuple(cells.values())], kinds).select(column.alias("x")).first().x]

    chosen = pairs(keywords.select_distinct_keywords("k", 2), k=[("spark", 3.0), ("sparks", 2.0), ("query", 1.0)], t=[])
    assert chosen == [("spark", 3.0), ("query", 1.0)]
    merged = keywords.merge_adjacent(F.col("k"), F.col("t"))
    both = [("data", 2.0), ("lake", 1.0)]
    assert pairs(merged, k=both, t=["the", "data", "lake"]) == [("datalake", 2.0)]
    assert pairs(merged, k=both, t=["data", "data", "x", "lake"]) == both
    three = [("data", 1.0), ("lake", 3.0), ("key", 2.0)]
    assert pairs(merged, k=three, t=["data", "lake", "key", "datalake"]) == [("keydatalake", 3.0)]
    assert pairs(merged, k=three, t=["data", "lake", "x", "datalake"]) == [("key", 2.0), ("datalake", 3.0)]
    assert pairs(merged, k=three, t=["data", "lake", "datalake", "key"]) == [("datalakekey", 3.0)]


def test_tagged_words_are_parsed_and_chosen_as_by_columns(spark):
    """parts are read by vector operations, with the same words and tags as column by column."""
    rng = random.Random(9)
    marks = ["", "/", "//", "/n", "a/n", "ab/n", "ab//v", "ab/d", "cd/n/x", "\u00a0b/n", "\x1fb/n", "b\x00/v", "某b/nr", "ab/", "ab", "//n", "xyz/v/"]
    rows = [(None, "ab/n"), ("ab/n", None), ("ab/n", ""), ("", "ab/n cd/n"), (None, None)]
    rows += [tuple(" ".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(2)) for _ in range(400)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, t string, c string")
    got = keywords.kept_words(keywords.tagged_words(df, "t", "c")).withColumn("near", keywords.adjacent_pairs("kept"))
    title = text.parse_tagged(F.coalesce("t", F.lit("")))
    words = F.when(F.col("c") != "", F.concat(title, text.parse_tagged("c")))
    kept = F.transform(F.filter(words, lambda w: text.is_keyword_token(w["word"], w["tag"])), lambda w: w["word"])
    expected = df.select("id", title["word"].alias("title_words"), words.alias("words"), kept.alias("kept")).collect()
    assert sorted(got.select("id", "title_words", "words", "kept").collect()) == sorted(expected)
    plan = keywords.tagged_words(df, "t", "c")._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan


def test_pairs_that_may_merge_are_those_of_their_row(spark):
    """neighbours that begin and end with a keyword of their own row, nulls and empty lists included."""
    rng = random.Random(3)
    parts = ["a", "b", "ab", "ba", "aab", "é", "aé", "", None]
    rows = [(None, ["a"]), (["a"], None), ([], ["a", "a"]), (["a"], []), ([""], ["x", "y"]), ([None, "a"], ["a", None, "a", "a"])]
    rows += [([rng.choice(parts[:-2]) for _ in range(rng.randint(0, 3))], [rng.choice(parts) for _ in range(rng.randint(0, 9))]) for _ in range(300)]
    shape = "id int, k array<struct<word:string,score:double>>, t array<string>"
    df = spark.createDataFrame([(i, k and [(w, 1.0) for w in k] if k is not None else None, t) for i, (k, t) in enumerate(rows)], shape)
    got = {r.id: r.p for r in df.select("id", solve.likely_pairs(F.col("k"), F.col("t")).alias("p")).collect()}
    for i, (keys, words) in enumerate(rows):
        def may(w):
            return w is not None and any(k is not None and w.startswith(k) for k in keys) and any(k is not None and w.endswith(k) for k in keys)

        none = keys is None or words is None
        assert got[i] == (None if none else [(a, b) for a, b in zip(words, words[1:]) if may(a) and may(b)])


def test_keywords_against_model(spark):
    rng = random.Random(11)
    tags = ["n", "v", "d", "ns", "m"]

    def tagged(words):
        return " ".join(f"{w}/{rng.choice(tags)}" if rng.random() < 0.9 else w for w in words)

    docs = [(i, tagged(words[:4]), tagged(words[4:])) for i, words in random_docs(12, 60, WORDS + ["a", "datalake", "某key"], 60)]
    frame = spark.createDataFrame(docs + [(100, "x/n", None), (101, None, "spark/n join/n plan/n")], "id int, t string, c string")
    got = {r.id: r.keywords for r in keywords.keywords(frame, "id", "t", "c", ["sort"], banned=[]).collect()}
    for i, title, content in docs:
        assert got[i] == (model.keywords(title, content, {"sort"}) if content else None)
    assert got[100] is None and got[101] is not None and len(got) == len(docs) + 2
    twice = frame.unionByName(frame).unionByName(frame.where("id = 3").withColumn("id", F.lit(None).cast("int")))
    again = keywords.with_keywords(twice, "t", "c", ["sort"], banned=[]).collect()
    assert len(again) == 2 * len(got) + 1 and all(r.keywords == got[3 if r.id is None else r.id] for r in again)
    kept = keywords.keywords(frame, "id", "t", "c", ["sort"], ["spark", "datalake"]).collect()
    assert not any(w in ("spark", "datalake") or "某" in w for r in kept for w in (r.keywords or "").split(" "))


def test_remove_word_filter(spark):
    words = spark.createDataFrame([("a",), ("某a",), ("记者x",), ("b",)], "word string")
    remove = spark.createDataFrame([("b",)], "word string")
    assert [r.word for r in keywords.remove_word_filter(words, remove).collect()] == ["a"]


# --- sentences and summaries ----------------------------------------------------------------------------------


def test_pair_similarity(spark):
    docs = spark.createDataFrame([(0, [["a", "b"], ["a", "c"], ["d", "e"]])], "id int, tokens array<array<string>>")
    posted = bm25.postings(docs, "id", "tokens")
    pairs = spark.createDataFrame([(0, 0, 1), (0, 0, 2)], "id int, sent int, other int")
    got = {r.other: r.sim for r in bm25.pair_similarity(posted, pairs, "id").collect()}
    assert got == {1: pytest.approx(math.log(1.5) - math.log(2.5)), 2: 0.0}


def random_sentences(seed, n):
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(25)]
    docs = []
    for i in range(n):
        lines = [[rng.choice(names) for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(1, 14))]
        docs.append((i, lines + [list(lines[0])] * rng.randint(0, 2)))
    return docs


def test_sums_and_neighbours_against_model(spark):
    docs = random_sentences(21, 20)
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>")
    sums = bm25.similarity_sums(bm25.postings(frame, "id", "tokens"), "id").collect()
    near = bm25.neighbour_similarity(frame, "id", "tokens").collect()
    sims = {i: model.similarities(lines) for i, lines in docs if any(lines)}
    for r in sums:
        row = sims[r.id][r.sent]
        assert r.to_self == pytest.approx(row[r.sent]) and r.to_others == pytest.approx(sum(row) - row[r.sent], abs=1e-9)
    for r in near:
        assert abs(r.sent - r.other) == 1
        assert r.sim == pytest.approx(sims[r.id][r.sent][r.other] if r.id in sims else 0.0)
    assert len(near) == sum(2 * (len(lines) - 1) for _, lines in docs)


@pytest.mark.parametrize("rounds", [6, 200])
def test_sentence_ranks_agree_with_model(spark, rounds):
    docs = [(i, lines) for i, lines in random_sentences(22, 25) if any(lines)]
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>")
    got = {r.id: r.scores for r in summary.textrank_sentences(frame, max_rounds=rounds, min_diff=0.0).collect()}
    for i, lines in docs:
        expected = model.rank_sentences(model.similarities(lines), max_rounds=rounds, min_diff=0.0)
        assert got[i] == pytest.approx(expected, rel=1e-6, abs=1e-6 * max(1, *map(abs, expected)), nan_ok=True)


def test_picks_order_numbers_and_what_is_none(spark):
    nan, inf = float("nan"), float("inf")
    lines = [["a"], ["b"], ["c"], ["d"], ["e"]]
    rows = [(1, lines, [1.0, nan, 3.0, -inf, inf], 6), (2, [], [], 3), (1, lines, [nan] * 5, 2)]
    frame = spark.createDataFrame(rows, "id int, tokens array<array<string>>, weights array<double>, size int")
    got = [[p.at for p in r.picks] for r in summary.redundancy_topk(frame, threshold=100.0).collect()]
    assert got == [[4, 2, 0, 3], [], [4]]


def test_picks_agree_with_model(spark):
    rng = random.Random(31)
    docs = [(i, lines, [float(rng.randint(0, 5)) for _ in lines], rng.randint(0, 9)) for i, lines in random_sentences(23, 30) if any(lines)]
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>, weights array<double>, size int")
    got = summary.redundancy_topk(frame, threshold=3.0).collect()
    assert {r.id: [p.at for p in r.picks] for r in got} == {i: model.pick(model.similarities(t), w, size, 3.0) for i, t, w, size in docs}


def test_budget_and_rules(spark):
    kinds = "s array<string>, w array<double>"
    entries = [(1, "x" * 50, 3.0), (2, "y" * 60, 2.0), (3, "z" * 40, 1.0)]
    rows = spark.createDataFrame([(entries,)], "e array<struct<place:int,sentence:string,weight:double>>")
    assert [e.at for e in rows.select(summary.length_budget_pick("e", 100).alias("x")).first().x] == [0, 2]
    rules = spark.createDataFrame([(["综上所述 a", "b", "c"], [1.0, 1.0, 1.0])], kinds)
    assert rules.select(summary.sentence_weight_rules("s", "w").alias("x")).first().x == [2.0, 1.0, 0.9]


@pytest.mark.parametrize("max_rounds", [200, 6])
def test_summary_against_model(spark, max_rounds):
    rng = random.Random(41)
    names = [f"word{i}" for i in range(40)]
    docs = []
    for i in range(30):
        lines = [" ".join(rng.choice(names) for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 15))]
        docs.append((i, "。".join(lines) + rng.choice(["", "。综上所述 " + names[0], "\n" + lines[0]])))
    frame = spark.createDataFrame(docs + [(100, None), (101, ""), (102, "tiny")], "id int, text string")
    split = {r.id: r for r in summary.sentence_tokens(frame, "text").collect()}
    got = {r.id: r.summary for r in summary.summary(frame, "id", "text", max_rounds=max_rounds).collect()}
    for i, _ in docs:
        assert got[i] == model.summary(split[i].cleaned, split[i].sentences, split[i].tokens, max_rounds=max_rounds)
    assert (got[100], got[101], got[102]) == (None, None, "tiny")


def test_search(spark):
    docs = random_docs(51, 30, WORDS, 12)
    queries = [(0, ["spark", "join", "spark"]), (1, ["row"]), (2, ["none"])]
    found = bm25.bm25_search(
        spark.createDataFrame(docs, "id int, t array<string>"), "id", "t", spark.createDataFrame(queries, "q int, t array<string>"), "q", "t", 5
    ).collect()
    texts = [words for _, words in docs]
    for q, tokens in queries:
        n, mean = len(texts), sum(map(len, texts)) / len(texts)
        scores = {}
        for i, words in docs:
            for t in tokens:
                if t in words:
                    df = sum(t in other for other in texts)
                    tf = words.count(t)
                    idf = math.log(n - df + 0.5) - math.log(df + 0.5)
                    scores[i] = scores.get(i, 0) + idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(words) / mean))
        best = sorted(((-round(s, 6), i) for i, s in scores.items()))[:5]
        assert [(r.id, r.score) for r in sorted(found, key=lambda r: r.place) if r.q == q] == [(i, pytest.approx(-s)) for s, i in best]


def test_shares_of_endless_sums(spark):
    """One endless sum outweighs the other; of two, and without a number, no share can be told."""
    inf, nan = math.inf, math.nan
    rows = [("a", [inf, -3.0]), ("b", [2.0, -inf]), ("c", [inf, -inf]), ("d", [nan, -1.0]), ("e", [1.5e308, -1.5e308])]
    df = spark.createDataFrame(rows, "id string, scores array<double>")
    clauses = each.each(df, ["id"], "scores", "score")
    expected = {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [None, None], "d": [None, None], "e": [0.5, 0.5]}
    assert {r.id: r.sentiment for r in sentiment.sentiment_percent(clauses, "id").collect()} == expected
    in_row = sentiment.percent_in_row(F.transform("scores", lambda x: F.struct(x.alias("score"))))
    assert {r.id: r.s for r in df.select("id", in_row.alias("s")).collect()} == expected


def test_products_leave_no_range_on_the_way():
    entries = {"good": (1.0, None, False), "very": (None, 4.0, False), "little": (None, 0.25, False)}
    assert fold.clause_score(["x"] + ["very"] * 600 + ["little"] * 600 + ["good"], entries) == 1.0
    assert fold.clause_score(["x"] + ["little"] * 600 + ["very"] * 601 + ["good"], entries) == 4.0
    assert fold.clause_score(["x"] + ["very"] * 600 + ["good"], entries) == math.inf


def test_large_scores_take_nothing_from_small_ones():
    """after a score of 2 ** 54, added one by one, scores of 1 were lost."""
    entries = {"good": (1.0, None, False), "bad": (-1.0, None, False), "much": (None, 4.0, False)}
    large = ["x", *["much"] * 27, "good"]
    assert fold.clause_score([*large, *["good"] * 8], entries) == 2**54 + 8
    assert fold.clause_score([*["good"] * 9, *large[1:]], entries) == 2**54 + 9 - 1
    assert fold.clause_score(["x"], entries) is None and fold.clause_score(["good", "bad"], entries) == 0.0
    assert math.isnan(fold._total([math.inf, -math.inf])) and fold._total([math.inf, 1.0]) == math.inf
    assert fold._total([1e308, 1e308, -1e308]) == 1e308 and fold._total([1e308, 1e308]) == math.inf


def test_ranks_beyond_rounding():
    """A finite score stays finite, however large; what has no bound is endless."""
    start, owner = np.array([1e305, 1.0]), np.array([0, 1])
    assert solve.settle(lambda score: score, start, owner, 1.0, 1, 0.0).tolist() == [1e305, 1.0]


def test_endless_ranks_have_no_power(spark, sf, monkeypatch):
    scores = F.array(*map(F.lit, [12.34567, math.inf, -math.inf, math.nan, 0.0]))
    monkeypatch.setattr("corpusengine.operators.summary.textrank_sentences", lambda df: df.withColumn("scores", scores))
    got = QUERIES["textrank_sentences"](spark, sf).where("doc_id = 0").orderBy("sent").collect()
    assert [r.power for r in got] == [1, None, None, None, 0]
    assert [str(r.score) for r in got] == ["1.2346", "inf", "-inf", "nan", "0.0"]


def test_similarities_in_row_and_by_join_are_the_same(spark):
    """Also for texts without sentences, sentences without words, pairs that repeat or are not there, and null texts."""
    docs = [*random_sentences(22, 20), (90, []), (91, [[], []]), (92, None)]
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>")
    asked = F.transform("tokens", lambda _, at: F.struct(at.alias("sent"), F.lit(2).alias("other")))
    pairs = each.each(frame, ["id"], asked, "pair").select("id", "pair.*")
    posted = bm25.postings(frame, "id", "tokens")
    joined = {(r.id, r.sent, r.other): pytest.approx(r.sim, abs=1e-9) for r in bm25.pair_similarity(posted, pairs, "id").collect()}
    in_row = bm25.similarity_in_row(frame, "id", "tokens", asked)
    assert {(r.id, r.sent, r.other): r.sim for r in in_row.collect()} == joined
    sums = {(r.id, r.sent): pytest.approx((r.to_self, r.to_others), abs=1e-9) for r in bm25.similarity_sums(posted, "id").collect()}
    got = bm25.similarity_sums_in_row(frame, "id", "tokens")
    assert {(r.id, r.sent): (r.to_self, r.to_others) for r in got.collect()} == sums
    near = bm25.neighbour_similarity(frame, "id", "tokens")
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df in (in_row, got, near))


def test_all_sentences_meet_all_of_their_text(spark, monkeypatch):
    """the whole matrix of each row, rows with equal ids apart, whatever the number of pairs made at a time."""
    docs = [*random_sentences(24, 20), (90, []), (91, [[], []]), (92, None), (None, [["a", "b"], ["a"]]), (3, [["x"], ["x", "y"], []])]
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>").coalesce(1)
    expected = []
    for i, lines in docs:
        sims = model.similarities(lines) if any(lines or []) else [[0.0] * len(lines or [])] * len(lines or [])
        expected += [(i, a, b, sims[a][b]) for a in range(len(sims)) for b in range(len(sims))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    for pairs in (1, 50, 1 << 18):
        monkeypatch.setattr("corpusengine.functions.solve.BATCH_PAIRS", pairs)
        found = bm25.sentence_similarity(frame, "id", "tokens")
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, found.collect()), key=order)
        assert [(*r[:3], pytest.approx(r[3], abs=1e-9)) for r in got] == sorted(expected, key=order)
    rounded = bm25.sentence_similarity(frame, "id", "tokens", digits=2).collect()
    assert {(r.id, r.sent, r.other): r.sim for r in rounded if r.id == 5} == {(i, a, b): pytest.approx(s, abs=0.006) for i, a, b, s in expected if i == 5}


def test_term_stats_in_row_and_by_groups_are_the_same(spark):
    docs = [*random_sentences(23, 20), (90, []), (91, [[], []]), (92, None), (93, [["a", None, "a"], None, ["a"]])]
    frame = spark.createDataFrame(docs, "id int, tokens array<array<string>>")
    got = bm25.term_stats_in_row(frame, "id", "tokens").select("id", "term", "df", "tf")
    assert sorted(got.collect()) == sorted(bm25.term_stats(frame, "id", "tokens").collect())
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_links_need_no_interpreted_lambdas(spark):
    """Pairs are numbered by vector operations; as lambdas over the row they took most of the time."""
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "id int, kept array<string>")
    plan = keywords.sliding_cooccurrence(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "ArrowEvalPython" in plan


def test_settled_documents_leave_the_rounds():
    """rounds go on with what is not settled, to the same scores."""
    owner = np.repeat([0, 1, 2], [40, 5, 3])
    pull = np.repeat([0.0, 0.9, 1.1], [40, 5, 3])
    seen = []

    def narrowed(places):
        return lambda score: (seen.append(len(score)), score * pull[places])[1]

    options = (np.ones(48), owner, 1.0, 30, 1e-3)
    whole = solve.settle(lambda score: score * pull, *options)
    assert solve.settle(narrowed(np.arange(48)), *options, narrowed).tolist() == whole.tolist()
    assert seen[0] == 48 and set(seen[2:]) == {8}


def test_choices_by_different_words_are_the_plain_ones(spark):
    """keyword tokens, likely pairs and clause scores against their definitions, word by word."""
    rng = random.Random(31)
    words = ["", " ", "a", "ab", " b ", "\x00c\x1f", "𝒳y", "𝒳y𝒳", "abab", "xab", None]
    tags = ["n", "v", "d", "zz", "", None, "rn"]
    entries = {"ab": (2.0, None, False), "a": (None, 0.5, False), "abab": (None, None, True), "xab": (-1.0, None, False), "𝒳y": (0.0, 3.0, True)}
    rows = []
    for i in range(300):
        tokens = [(rng.choice(words), rng.choice(tags)) for _ in range(rng.randint(0, 9))]
        keys = [(rng.choice(words[:-1]), 1.0) for _ in range(rng.randint(0, 2))]
        clauses = [[rng.choice(words) for _ in range(rng.randint(0, 6))] if rng.random() < 0.9 else None for _ in range(rng.randint(0, 4))]
        rows.append((i, tokens, keys, [w for w, _ in tokens if w is not None], clauses))
    rows += [(300, None, None, None, None), (301, [("ab", "n")], None, ["ab", "ab"], [])]
    shape = "id int, tokens array<struct<word:string,tag:string>>, keys array<struct<word:string,score:double>>, words array<string>, clauses array<array<string>>"
    df = spark.createDataFrame(rows, shape).coalesce(2).select(
        "id", solve.keyword_tokens(F.col("tokens")).alias("chosen"), solve.likely_pairs(F.col("keys"), F.col("words")).alias("pairs"),
        fold.scorer(entries)(F.col("clauses")).alias("scores"),
    )
    found = {r.id: r for r in df.collect()}
    assert len(found) == len(rows)
    for i, tokens, keys, kept, clauses in rows:
        good = tokens and [w for w, t in tokens if w and t and t[0] not in C.EXCLUDED_TAG_INITIALS and len(w.strip(C.TRIM_CHARACTERS)) > 1]
        assert found[i].chosen == (good if tokens else tokens)
        if keys is None or kept is None:
            assert found[i].pairs is None
        else:
            ends = tuple(k for k, _ in keys)
            both = [w.startswith(ends) and w.endswith(ends) for w in kept]
            assert [tuple(p) for p in found[i].pairs] == [(kept[k], kept[k + 1]) for k in range(len(kept) - 1) if both[k] and both[k + 1]]
        scores = clauses and [(c, fold.clause_score(t or [], entries)) for c, t in enumerate(clauses)]
        expected = scores and [(c, 2.0 * (s or 0.0) if c == 0 else s) for c, s in scores if c == 0 or s is not None]
        assert (found[i].scores and [tuple(s) for s in found[i].scores]) == (expected if clauses else clauses)
