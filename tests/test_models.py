"""Learned models against their formulas, written out."""

import math
import random
import threading
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusengine.functions import skipgram
from corpusengine.operators import bayes, evaluate, forward, models
from corpusengine.plans.workload import QUERIES, learning

TEXTS = [
    (1, "red green red", "a"),
    (2, "blue green  blue", "b"),
    (3, "Red yellow", "a"),
    (4, "", "b"),
    (5, "red", "x"),
    (6, "blue red never seen", None),
    (6, "blue red never seen", None),
    (7, None, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    frame = spark.createDataFrame(TEXTS, "id int, text string, class string")
    return models.spaced_words(frame.where("text IS NOT NULL"), "text").unionByName(
        frame.where("text IS NULL").withColumn("words", F.lit(None).cast("array<string>"))
    )


def test_bayes_table_follows_the_formula(spark, texts):
    model = bayes.fit_bayes_table(texts, "words", "class", excluded_class="x")
    assert model.labels == ["a", "b"]
    found = {r.id: (r.nbClass, list(r.scores)) for r in bayes.apply_bayes_table(texts, "words", model).collect()}
    # Empty words are terms too, as they are to Spark ML.
    words = {i: (t or "").lower().rstrip().split(" ") if t is not None else [] for i, t, _ in TEXTS}
    known = [(i, c) for i, _, c in TEXTS if c in ("a", "b")]
    df = Counter(w for i, _ in known for w in set(words[i]))
    idf = {w: math.log((len(known) + 1) / (df[w] + 1)) for ws in words.values() for w in ws}
    for i, ws in words.items():
        expected = []
        for label in "ab":
            sums = Counter()
            for j, c in known:
                if c == label:
                    for w in words[j]:
                        sums[w] += idf[w]
            total = math.log(sum(sums.values()) + 1_000_000)
            prior = math.log(sum(c == label for _, c in known) + 1) - math.log(len(known) + 2)
            expected.append(prior + sum(idf[w] * (math.log(sums[w] + 1) - total) for w in ws))
        assert found[i][1] == pytest.approx(expected)
        assert found[i][0] == ("a" if expected[0] >= expected[1] else "b")


def test_bayes_table_is_the_stored_model(spark, texts, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    train = texts.where("class IS NOT NULL").drop("words")
    path = str(tmp_path / "bayes")
    models.train_naive_bayes(train, "text", "class", excluded_class="x", path=path)
    raw = PipelineModel.load(path).transform(texts.where("text IS NOT NULL").drop("words"))
    expected = sorted((r.id, r.nbClass, list(r.raw)) for r in raw.select("id", "nbClass", vector_to_array("rawPrediction").alias("raw")).collect())
    model = bayes.fit_bayes_table(texts, "words", "class", excluded_class="x")
    table = bayes.apply_bayes_table(texts.where("text IS NOT NULL"), "words", model)
    got = sorted((r.id, r.nbClass, list(r.scores)) for r in table.collect())
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == [pytest.approx(e[2]) for e in expected]


def test_bayes_table_without_rows(spark, texts):
    model = bayes.fit_bayes_table(texts.where("id = 7"), "words", "class")
    assert model.labels == []
    assert bayes.fit_bayes_table(texts, "words", "class", excluded_class="x").features.where("size(logs) <> 2").isEmpty()


def test_terms_that_all_rows_have_meet_as_sums(spark):
    """A term in every row reaches the exchange as one row per task, class and bucket."""
    rows = spark.range(2000).select(F.array(F.lit("same")).alias("words"), F.lit("a").alias("class"))
    model = bayes.fit_bayes_table(rows, "words", "class")
    assert model.features.count() == 1
    assert model.features.first().logs[0] == pytest.approx(math.log(1 + 2000 * math.log(2001 / 2001)))


def test_forward_is_the_perceptron(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = spark.range(120).select(
        F.array(*[F.sin(F.col("id") * (k + 1)) for k in range(3)]).alias("x"), (F.col("id") % 3).cast("double").alias("label")
    )
    rows = rows.withColumn("features", array_to_vector("x"))
    for layers in ([3, 3], [3, 4, 3], [3, 5, 4, 3]):
        model = models.train_mlp(rows, layers, "features", "label", max_iter=20)
        assert len(model.weights) == sum((n + 1) * m for n, m in zip(layers, layers[1:]))
        applied = forward.with_forward(model.setProbabilityCol("p").transform(rows), F.col("x"), model.weights, layers, "out")
        for r in applied.select("prediction", vector_to_array("p").alias("p"), "out", forward.probabilities(F.col("out")).alias("q"), forward.predicted(F.col("out")).alias("said")).collect():
            assert r.said == r.prediction and r.q == pytest.approx(list(r.p))


def test_forward_is_made_many_rows_at_once(spark):
    """no expression with a step for each weight, and the sums and sigmoids of a plain loop; odd features have no outputs."""
    layers = [4, 3, 2]
    numbers = [((7 * k) % 11 - 5) / 3 for k in range(5 * 3 + 4 * 2)]
    rows = [(k, [((k * j) % 13 - 6) * 1.5 for j in range(1, 5)]) for k in range(50)]
    odd = [(50, None), (51, [1.0, None, 1.0, 1.0]), (52, [1.0]), (53, [1e6, -1e6, 0.0, 2.0])]
    frame = spark.createDataFrame(rows + odd, "id long, x array<double>")
    applied = forward.with_forward(frame, F.col("x"), numbers, layers, "out")
    assert "aggregate(" not in applied._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r.out for r in applied.collect()}
    assert len(got) == 54 and got[50] is got[51] is got[52] is None
    for k, x in [*rows, odd[3]]:
        at = 0
        for n_in, n_out in zip(layers, layers[1:]):
            z = [numbers[at + n_in * n_out + i] + sum(x[j] * numbers[at + j * n_out + i] for j in range(n_in)) for i in range(n_out)]
            at += (n_in + 1) * n_out
            x = z if n_out == layers[-1] else [1 / (1 + math.exp(min(700, -v))) for v in z]
        assert got[k] == pytest.approx(x)
    none = forward.with_forward(frame.where("id in (50, 52)"), F.col("x"), numbers, layers, "out")
    assert [r.out for r in none.collect()] == [None, None] and none.where("id < 0").count() == 0


def test_hinge_slope_is_zero_at_the_optimum_only(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(400).select(
        F.array(F.sin("id"), F.cos(F.col("id") * 2), 5 * F.sin(F.col("id") * 3)).alias("x"),
        (F.sin("id") + 0.3 * F.cos(F.col("id") * 5) > 0).cast("double").alias("label"),
    )
    model = models.train_svm(rows.withColumn("features", array_to_vector("x")), "features", "label", reg=0.01)
    weights = [float(w) for w in model.coefficients]

    def state(numbers, intercept):
        return forward.hinge_optimality(rows, "x", "label", forward.stored_numbers(spark, numbers), intercept, 0.01).first()

    best = state(weights, model.intercept)
    assert best.slope <= 0.05
    for moved, shift in (([w * 1.3 for w in weights], 0.0), ([weights[0], weights[1] + 0.3, weights[2]], 0.0), (weights, 0.4)):
        worse = state(moved, model.intercept + shift)
        assert worse.slope > best.slope + 0.005 and worse.objective > best.objective


def test_member_scores_in_one_pass(spark):
    rows = [(0.0, 0.0, 1.0), (0.0, 1.0, 1.0), (1.0, 1.0, 1.0), (2.0, 0.0, 1.0), (2.0, 2.0, 0.0)]
    frame = spark.createDataFrame(rows, "label double, a double, b double")
    scores = evaluate.member_scores(frame, "label", ["a", "b"])
    for name in ("a", "b"):
        assert scores[name] == pytest.approx(evaluate.evaluator_f1(frame, "label", name))
        assert scores[name] == pytest.approx(evaluate.weighted_f1(frame, "label", name).first().f1)
    assert evaluate.member_scores(frame.where("label > 5"), "label", ["a"]) == {"a": 0.0}


def test_vocabulary_is_bounded_by_measured_counts(spark):
    words = spark.createDataFrame([(["a"] * 5 + ["b"] * 3 + ["c", "d"],), (["b", "c"],), (None,)], "words array<string>")
    assert models.vocabulary_plan(words, max_words=4) == (1, 1)
    # c has two, d one: three words fit with a count of two.
    assert models.vocabulary_plan(words, max_words=3) == (2, 1)
    assert models.vocabulary_plan(words, max_words=1) == (5, 1)
    assert models.vocabulary_plan(words.where("words is null")) == (1, 1)


def test_fits_run_side_by_side(spark):
    """Each waits for the other, and the results come in the order asked for."""
    met = threading.Barrier(2, timeout=20)
    assert models.together(lambda: (met.wait(), "a")[1], lambda: (met.wait(), "b")[1]) == ["a", "b"]


def test_huffman_paths_are_short_and_tell_words_apart():
    rng = random.Random(3)
    for counts in ([5], [3, 1], [1] * 9, sorted((rng.randint(1, 50) for _ in range(40)), reverse=True)):
        first, nodes, sides = skipgram.paths(*skipgram.huffman(counts))
        ways = [tuple(zip(nodes[a:b].tolist(), sides[a:b].tolist()))[::-1] for a, b in zip(first, first[1:])]
        codes = ["".join(str(side) for _, side in way) for way in ways]
        assert all(not b.startswith(a) for i, a in enumerate(codes) for j, b in enumerate(codes) if i != j)
        # The least sum of lengths that any code has: what is joined, step by step.
        rest, cost = list(counts), 0
        while len(rest) > 1:
            low, high, *rest = sorted(rest)
            rest.append(low + high)
            cost += low + high
        assert sum(n * len(code) for n, code in zip(counts, codes)) == cost


def test_skipgram_is_the_plain_loop(monkeypatch):
    """blocks of words at once, against a step for each pair and node."""
    monkeypatch.setattr(skipgram, "BLOCK_WORDS", 5)
    monkeypatch.setattr(skipgram, "STEP_PAIRS", 3)
    rng, size, window = random.Random(4), 6, 3
    ids = [rng.choice([0, 0, 1, 1, 2, 3, 5]) for _ in range(33)]
    text = [0] * 9 + [1] * 1 + [2] * 23
    tree = skipgram.huffman([20, 12, 7, 5, 3, 2])
    words, n, got = skipgram.learn(np.array(ids, np.int32), np.array(text, np.int32), tree, size, window, 0.5, 2, 7, 1)
    assert words.tolist() == [0, 1, 2, 3, 5] and n.tolist() == [ids.count(w) for w in (0, 1, 2, 3, 5)]
    first, nodes, sides = skipgram.paths(*tree)
    vectors = dict(zip(words.tolist(), skipgram.start(words, size, 7).astype(float)))
    inner, draw = np.zeros((5, size)), np.random.default_rng([7, 1])
    for done in range(2):
        for begin in range(0, 33, 5):
            end = min(begin + 5, 33)
            reach, rate = draw.integers(1, window + 1, end - begin), 0.5 * max(1 - (done * 33 + begin) / 67, 1e-4)
            moves, turns, of_word, of_node = {}, {}, Counter(), Counter()
            for i in range(begin, end):
                for j in range(max(i - reach[i - begin], 0), min(i + reach[i - begin] + 1, 33)):
                    if j == i or text[j] != text[i]:
                        continue
                    of_word[ids[j]] += 1
                    for k in range(first[ids[i]], first[ids[i] + 1]):
                        x, w = vectors[ids[j]], inner[nodes[k]]
                        g = rate * (1 - sides[k] - 1 / (1 + math.exp(-x @ w)))
                        moves[ids[j]], turns[nodes[k]] = moves.get(ids[j], 0) + g * w, turns.get(nodes[k], 0) + g * x
                        of_node[nodes[k]] += 1
            for word, move in moves.items():
                vectors[word] = vectors[word] + move * min(1, 3 / of_word[word])
            for node, turn in turns.items():
                inner[node] = inner[node] + turn * min(1, 3 / of_node[node])
    assert got == pytest.approx(np.array([vectors[w] for w in words.tolist()]), abs=1e-5)


def test_word_vectors_are_the_same_in_any_order(spark, tmp_path):
    """learned in three tasks, from every text, and stored; words of the same neighbourhood are alike."""
    rng = random.Random(5)
    kinds = [[f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]]
    texts = [" ".join(rng.choice(kinds[k % 2]) for _ in range(40)) for k in range(300)] + ["only", "Once  a1 unseen", "", "a1 a1"]
    rows = [(text,) for text in texts]
    path, settings = str(tmp_path / "vectors"), {"size": 20, "numPartitions": 3}
    models.train_word2vec(spark.createDataFrame(rows, "text string"), "text", path=path, **settings)
    frame = spark.createDataFrame(rows[::-1], "text string").repartition(7)
    again = models.train_word2vec(frame, "text", **settings).stages[-1].getVectors().collect()
    frame = models.apply_word2vec(spark.createDataFrame([("a1 b2 nowhere",)], "text string"), path)
    row = frame.first()
    from pyspark.ml import PipelineModel

    found = {r.word: r.vector.toArray() for r in PipelineModel.load(path).stages[-1].getVectors().collect()}
    assert set(found) == {w for kind in kinds for w in kind} | {"only", "once", "unseen"}
    assert {r.word: r.vector.toArray().tolist() for r in again} == {w: v.tolist() for w, v in found.items()}
    assert row.words == ["a1", "b2", "nowhere"] and row.wordVec.toArray() == pytest.approx((found["a1"] + found["b2"]) / 3)
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    near = np.mean([unit["a1"] @ unit[f"a{i}"] for i in range(12) if i != 1])
    assert near > 0.3 + np.mean([unit["a1"] @ unit[f"b{i}"] for i in range(12)])
    with pytest.raises(ValueError):
        models.train_word2vec(spark.createDataFrame([("",)], "text string"), "text")


def test_word2vec_learns_from_all_training_rows(spark, tmp_path, monkeypatch):
    """whatever the bound for the classifiers, the query's fits get the whole training part."""
    spark.createDataFrame([(i, f"word{i} and more") for i in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fits, train = [], models.train_word2vec
    monkeypatch.setattr(learning, "FIT_ROWS", 3)
    monkeypatch.setattr(models, "train_word2vec", lambda df, *args, **options: (fits.append(df.count()), train(df, *args, **options))[1])
    got = QUERIES["word2vec"](spark, str(tmp_path)).collect()
    part = models.train_test_split_by_key(spark.range(30).withColumnRenamed("id", "doc_id"), "doc_id")[0].count()
    assert fits == [part, part] and 3 < part < 30
    assert sorted(map(tuple, got)) == sorted((r.doc_id, 0.0, 3, 0.0) for r in got) and len(got) == 30


def test_text_gaps_are_the_gaps_of_words(spark):
    """with the vectors sent, the same as with a row for each word; words that repeat, are null or not known."""
    rng, vocabulary = random.Random(6), [f"w{i}" for i in range(9)]
    vectors = np.array([[rng.random(), rng.random()] for _ in vocabulary], np.float32)
    shared = spark.sparkContext.broadcast((pa.array(vocabulary), vectors))
    rows, expected = [], {}
    for i in range(700):
        words = [rng.choice([*vocabulary, "new", None]) for _ in range(rng.choice([0, 1, 3, 600 if i < 3 else 4]))]
        found, known = [rng.random(), rng.random()], [w for w in words if w is not None]
        sums = [sum(float(vectors[int(w[1:])][k]) for w in known if w != "new") for k in (0, 1)]
        rows.append((i, words, found))
        expected[i] = (len(known), max(abs(f - s / max(len(known), 1)) for f, s in zip(found, sums)))
    df = spark.createDataFrame(rows, "id long, words array<string>, found array<double>")
    got = df.mapInArrow(forward.text_gaps(["id"], shared), "id long, tokens long, gap double").collect()
    assert len(got) == 700 and {r.id: (r.tokens, pytest.approx(r.gap)) for r in got} == expected


def test_mean_gaps_of_rows_over_several_batches(spark):
    """words meet their vectors where they are, in order, and a row's sums go on from batch to batch."""
    rng = random.Random(2)
    rows, expected = [], {}
    for i in range(60):
        n = rng.choice([0, 1, 2, 5, 40])
        found = [rng.random(), rng.random()]
        vectors = [rng.choice([None, [rng.random(), rng.random()]]) for _ in range(n)]
        rows += [(i, i, found if k == 0 else None, "w" if n else None, v) for k, v in enumerate(vectors or [None])]
        mean = [sum(v[k] for v in vectors if v) / max(n, 1) for k in (0, 1)]
        expected[i] = (n, max(abs(f - m) for f, m in zip(found, mean)))
    df = spark.createDataFrame(rows, "id long, _row long, found array<double>, word string, vector array<double>").coalesce(1)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = df.mapInArrow(forward.mean_gaps(["id"]), "id long, tokens long, gap double").collect()
        assert len(got) == 60 and {r.id: (r.tokens, pytest.approx(r.gap)) for r in got} == expected
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
