"""Learned models and the plans that use all operators."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.functions.votes import majority_vote
from corpusengine.operators import bayes, forward, models
from corpusengine.operators.each import each
from corpusengine.operators.evaluate import evaluator_f1, weighted_f1
from corpusengine.operators.lookup import attach, is_small
from corpusengine.plans import classify as plan
from corpusengine.plans.enrich import Columns, Dictionaries, enrich as enrich_plan
from corpusengine.plans.workload.registry import (
    CLAUSE_MARKS,
    SENTENCE_MARKS,
    articles,
    documents,
    query,
    stop_words,
    tagged,
    values,
)
from corpusengine.plans.workload.ranking import KEYWORDS_SQL, SUMMARY_SQL
from corpusengine.plans.workload.scoring import ADVERBS, BRANDS, NEGATIONS, PERCENT_SQL, REGION_SQL, SENTIMENT
from corpusengine.plans.workload.texts import ORIGIN_SQL, origin_line
from corpusengine.session import scratch_path, stage
from corpusengine.sources import load_model, save_model, scan_parquet

# Classifiers and word vectors are learned from at most so many documents, those with the smallest hash of their id, and
# applied to all. Sizes and rounds are the operators' own: 200 numbers a word, five members, 200 rounds.
FIT_ROWS = 2_000
HIDDEN_LAYERS = [[], [8], [12], [16], [16, 8]]
SLOPE = 0.01
RULES = {"evidence_labels": ["de"], "fallback": "en", "exclusions": {"fr": ["es", "de"]}}


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return models.train_test_split_by_key(df, "doc_id")


def _for_fit(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return stage(df.orderBy(F.xxhash64(key), key).limit(FIT_ROWS), "fit")


def _classifier(df: DataFrame) -> plan.Classifier:
    return plan.train(_for_fit(df), "lang", "text", HIDDEN_LAYERS)


def _vectors(spark, sf) -> DataFrame:
    """(vec_id, features, label, positive) of the stored embeddings."""
    df = scan_parquet(spark, f"{sf}/embeddings.parquet", spread_by="vec_id")
    features = array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
    return df.select(
        "vec_id", features.alias("features"), F.col("label").cast("double").alias("label"),
        (F.col("label") >= 5).cast("double").alias("positive"),
    )


def _mean_gap(applied: DataFrame, model: PipelineModel, keys: list[str]) -> DataFrame:
    """(keys, tokens, gap): the largest difference of ``wordVec`` from the mean of the model's vectors of the words.

    A word the model doesn't know counts as a zero vector.
    """
    rows = applied.select(*keys, "words", vector_to_array("wordVec").alias("found"))
    vectors = stage(model.stages[-1].getVectors().select("word", vector_to_array("vector", "float32").alias("vector")), "vocabulary")
    kinds = {name: kind for name, kind in applied.dtypes}
    shape = ", ".join([*(f"`{key}` {kinds[key]}" for key in keys), "tokens bigint", "gap double"])
    # A vocabulary of the usual size is sent to the tasks; else the words of a row stay one after the other and meet their
    # vectors where they are, and the first one has what was found.
    if is_small(vectors.select("word"), C.VOCABULARY_BOUND):
        known = vectors.toArrow().combine_chunks()
        matrix = known.column("vector").chunk(0).flatten().to_numpy().reshape(len(known), -1)
        shared = applied.sparkSession.sparkContext.broadcast((known.column("word").chunk(0), matrix))
        gaps = rows.mapInArrow(forward.text_gaps(keys, shared), shape)
    else:
        rows = stage(rows, "word-vectors").withColumn("_row", F.monotonically_increasing_id())
        words = rows.select(*keys, "_row", "found", F.posexplode_outer("words").alias("at", "word"))
        words = words.withColumn("found", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("found"))).drop("at")
        met = words.join(F.broadcast(vectors), "word", "left")
        gaps = met.select(*keys, "_row", "found", "word", "vector").mapInArrow(forward.mean_gaps(keys), shape)
    return gaps.withColumn("gap", F.round("gap", 6))


SPACE_TOKENS_SQL = "len(list_filter(string_split(lower(text), ' '), lambda x: x <> ''))"


@query("word2vec", f"SELECT doc_id, {SPACE_TOKENS_SQL} AS tokens, 0.0::double AS gap, 0.0::double AS refit FROM documents")
def word2vec(spark, sf):
    """Fit on the training part, store, load, apply to all; a text's vector is the mean of its words', and a second fit
    with the same seed gives the same ones."""
    path = scratch_path(spark, "word2vec")
    df = documents(spark, sf)
    train = _split(df)[0]
    _, again = models.together(
        partial(models.train_word2vec, train, "text", path=path), partial(models.train_word2vec, train, "text", out="again")
    )
    both = again.transform(models.apply_word2vec(df, path).drop("words"))
    apart = F.array_max(F.zip_with(vector_to_array("wordVec"), vector_to_array("again"), lambda x, y: F.abs(x - y)))
    both = both.withColumn("refit", F.round(apart, 3))
    return _mean_gap(both, PipelineModel.load(path), ["doc_id", "refit"])


@query(
    "word2vec_fit_transform",
    f"""SELECT conv_id, turn, ('0x' || left(md5(conv_id::varchar), 8))::bigint % 100 < 80 AS in_train,
  {SPACE_TOKENS_SQL} AS tokens, 0.0::double AS gap FROM conversations""",
)
def word2vec_fit_transform(spark, sf):
    """Short texts: both parts with their vectors, from one model."""
    talk = scan_parquet(spark, f"{sf}/conversations.parquet")
    train, test = models.train_test_split_by_key(talk, "conv_id")
    path = scratch_path(spark, "word2vec")
    parts = models.word2vec_fit_transform(train, test, "text", path=path)
    rows = [part.withColumn("in_train", F.lit(i == 0)) for i, part in enumerate(parts)]
    return _mean_gap(rows[0].unionByName(rows[1]), PipelineModel.load(path), ["conv_id", "turn", "in_train"])


HELD_OUT_SQL = "('0x' || left(md5({}::varchar), 8))::bigint % 100 >= 80"


@query(
    "mlp_ensemble",
    f"""SELECT vec_id, label::double AS label, 5 AS equal_members, true AS majority FROM embeddings
WHERE {HELD_OUT_SQL.format("vec_id")}""",
)
def mlp_ensemble(spark, sf):
    """Five members on the stored embeddings, saved and loaded: how many predict what their stored weights say, and
    whether the vote is the label that most of them predict, the first one of equals."""
    train, test = models.train_test_split_by_key(_vectors(spark, sf), "vec_id")
    layers = [[64, *hidden, 10] for hidden in HIDDEN_LAYERS]
    paths = [scratch_path(spark, "mlp") for _ in layers]
    members = models.train_mlp_ensemble(train, layers, "features", "label", paths)
    scored = models.apply_mlp_ensemble(test, paths)
    said = [f"prediction_{i}" for i in range(len(layers))]
    for i, (member, sizes) in enumerate(zip(members, layers)):
        scored = forward.with_forward(scored, vector_to_array("features"), member.weights, sizes, f"out_{i}")
    equal = sum(((F.col(p) == forward.predicted(F.col(f"out_{i}"))).cast("int") for i, p in enumerate(said)), F.lit(0))
    votes = [sum(((F.col(p) == label).cast("int") for p in said), F.lit(0)) for label in range(10)]
    elected = F.array_position(F.array(*votes), F.greatest(*votes)).cast("double") - 1
    return scored.select(
        "vec_id", "label", equal.alias("equal_members"), (majority_vote(F.array(*said)) == elected).alias("majority")
    )


@query(
    "mlp_fit_predict",
    f"""SELECT vec_id, label::double AS label, true AS same, 1.0::double AS total, 0.0::double AS gap FROM embeddings
WHERE {HELD_OUT_SQL.format("vec_id")}""",
)
def mlp_fit_predict(spark, sf):
    """One perceptron, stored and loaded: prediction and probabilities are those of its stored weights."""
    path = scratch_path(spark, "mlp")
    train, test = models.train_test_split_by_key(_vectors(spark, sf), "vec_id")
    layers = [64, 32, 10]
    models.train_mlp(train, layers, "features", "label", path=path)
    stored = load_model(spark, path)
    applied = stored.setProbabilityCol("probability").transform(test)
    applied = forward.with_forward(applied, vector_to_array("features"), stored.weights, layers, "outputs")
    chances = forward.probabilities(F.col("outputs"))
    gap = F.array_max(F.zip_with(chances, vector_to_array("probability"), lambda x, y: F.abs(x - y)))
    total = F.aggregate(chances, F.lit(0.0), lambda a, x: a + x)
    same = F.col("prediction") == forward.predicted(F.col("outputs"))
    return applied.select("vec_id", "label", same.alias("same"), F.round(total, 6).alias("total"), F.round(gap, 6).alias("gap"))


@query(
    "hashing_tfidf",
    r"""SELECT doc_id, tokens, tokens::double AS tf, 0.0::double AS gap
FROM (SELECT doc_id, len(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) AS tokens FROM documents)""",
)
def hashing_tfidf(spark, sf):
    """Hashed counts add up to the tokens, and each weight is the count times ln((N + 1) / (df + 1)) of its bucket."""
    df = documents(spark, sf)
    pipeline = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="words"), *models.hashing_tfidf()])

    def entries(vector: str, name: str) -> list:
        stored = F.unwrap_udt(vector)
        return [stored["indices"].alias(f"{name}_long"), stored["values"].alias(f"{name}_double")]

    found = pipeline.fit(df).transform(df)
    rows = stage(
        found.select("doc_id", F.size("words").cast("long").alias("tokens"), *entries("tf", "tf"), *entries("tfidf", "weight")), "hashed"
    )
    weights = each(rows, ["doc_id", "tokens"], F.arrays_zip("tf_long", "tf_double", "weight_long", "weight_double"), "w").select("doc_id", "tokens", "w.*")
    spread = weights.groupBy("tf_long").agg(F.count("*").alias("df"))
    n = rows.agg(F.count("*")).scalar()
    off = F.abs(F.col("weight_double") - F.col("tf_double") * F.log((n + 1) / (F.col("df") + 1)))
    same = F.when(F.col("tf_long") == F.col("weight_long"), off).otherwise(F.lit(float("inf")))
    checked = attach(weights, spread, "tf_long").groupBy("doc_id", "tokens")
    return checked.agg(F.sum("tf_double").alias("tf"), F.round(F.max(same), 6).alias("gap"))


# Murmur3 (32 bits, seed 42) of the bytes of a term, as Spark ML hashes it.
def _murmur_sql(term: str, table: str) -> str:
    size = "4294967296::hugeint"

    def turned(x: str, bits: int) -> str:
        return f"({x} * {2**bits} % {size} + {x} // {2 ** (32 - bits)})"

    def mixed(steps: list[tuple[str, str]], inner: str) -> str:
        for name, step in steps:
            inner = f"(SELECT term, h, body, {step} AS {name} FROM {inner})"
        return inner

    byte = "('0x' || substr(h, 2 * ({}) + 1, 2))::hugeint"
    word = " + ".join(f"{byte.format(f'4 * i + {k}')} * {256**k}" for k in range(4))
    tail = " + ".join(f"CASE WHEN len(h) // 2 % 4 > {k} THEN {byte.format(f'len(h) // 8 * 4 + {k}')} * {256**k} ELSE 0 END" for k in range(3))
    first, second = f"3432918353 % {size}", f"461845907 % {size}"
    blocks = f"""(SELECT term, h, list_transform(list_transform(list_transform(
  range(0, len(h) // 8), lambda i: ({word}) * {first}), lambda k: {turned("k", 15)}), lambda k: k * {second}) AS body
FROM (SELECT DISTINCT {term} AS term, hex(encode({term})) AS h FROM {table}))"""
    folded = f"""(SELECT term, h, list_reduce(list_prepend(42::hugeint, body), lambda x, k: ({turned("xor(x, k)", 13)} * 5 + 3864292196) % {size}) AS body
FROM {blocks})"""
    steps = [
        ("t1", f"({tail}) * {first}"),
        ("t2", f"{turned('t1', 15)} * {second}"),
        ("x1", "xor(xor(body, t2), (len(h) // 2)::hugeint)"),
        ("x2", f"xor(x1, x1 // 65536) * 2246822507 % {size}"),
        ("x3", f"xor(x2, x2 // 8192) * 3266489909 % {size}"),
        ("x4", "xor(x3, x3 // 65536)"),
    ]
    return f"SELECT term, (x4 - CASE WHEN x4 >= 2147483648 THEN {size} ELSE 0 END)::bigint AS hash FROM {mixed(steps, folded)}"


# Scores of all classes of the held-out documents, learned from the others without Spanish ones.
BAYES_SQL = rf"""
WITH split AS (
  SELECT doc_id, lang, ('0x' || left(md5(doc_id::varchar), 8))::bigint % 100 < 80 AS train, text FROM documents),
counts AS (
  SELECT doc_id, lang, train, term, count(*) AS n
  FROM (SELECT doc_id, lang, train, unnest(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) AS term FROM split)
  WHERE NOT train OR lang <> 'es' GROUP BY ALL),
hashed AS (SELECT term, (hash % 1000000 + 1000000) % 1000000 AS bucket FROM ({_murmur_sql("term", "counts")})),
tf AS (SELECT doc_id, lang, train, bucket, sum(n)::double AS tf FROM counts JOIN hashed USING (term) GROUP BY ALL),
classes AS (
  SELECT lang AS class, count(*) AS n, ln(count(*) + 1) - ln(sum(count(*)) OVER () + count(*) OVER ()) AS prior,
    sum(count(*)) OVER () AS total, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i
  FROM split WHERE train AND lang <> 'es' GROUP BY lang),
idf AS (SELECT bucket, ln((any_value(total) + 1) / (count(*) + 1)) AS idf FROM tf, (SELECT any_value(total) AS total FROM classes) WHERE train GROUP BY bucket),
sums AS (SELECT lang AS class, bucket, sum(tf * idf) AS s FROM tf JOIN idf USING (bucket) WHERE train GROUP BY ALL),
rest AS (SELECT class, ln(sum(s) + 1000000) AS rest FROM sums GROUP BY class),
weights AS (
  SELECT doc_id, bucket, tf * coalesce(idf, ln((SELECT any_value(total) FROM classes) + 1)) AS w FROM tf LEFT JOIN idf USING (bucket) WHERE NOT train),
scored AS (
  SELECT doc_id, class, any_value(prior) + sum(w * (coalesce(ln(s + 1), 0) - rest)) AS score, any_value(i) AS i
  FROM (SELECT * FROM weights, (SELECT * FROM classes JOIN rest USING (class))) LEFT JOIN sums USING (class, bucket) GROUP BY doc_id, class),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) = 1)
SELECT doc_id, lang, i::double AS prediction_nb, class AS "nbClass", round(score, 3) AS score FROM best JOIN split USING (doc_id)"""


@query("naive_bayes", BAYES_SQL)
def naive_bayes(spark, sf):
    """Trained without one class, stored, loaded, applied to the held-out part."""
    train, test = _split(documents(spark, sf, "text", "lang"))
    path = scratch_path(spark, "naive-bayes")
    models.train_naive_bayes(train, "text", "lang", excluded_class="es", path=path)
    score = F.round(F.array_max(vector_to_array("rawPrediction")), 3).alias("score")
    return PipelineModel.load(path).transform(test).select("doc_id", "lang", "prediction_nb", "nbClass", score)


@query("naive_bayes_table", BAYES_SQL)
def naive_bayes_table(spark, sf):
    """The same classes and scores from a model that is a table."""
    words = models.spaced_words(documents(spark, sf, "text", "lang"), "text")
    train, test = _split(words)
    model = bayes.fit_bayes_table(train, "words", "lang", excluded_class="es")
    found = bayes.apply_bayes_table(test, "words", model)
    at = F.array_position(F.array(*map(F.lit, model.labels)), F.col("nbClass")).cast("double") - 1
    return found.select("doc_id", "lang", at.alias("prediction_nb"), "nbClass", F.round(F.array_max("scores"), 3).alias("score"))


@query(
    "svm",
    f"SELECT vec_id, true AS same, true AS optimal FROM embeddings WHERE {HELD_OUT_SQL.format('vec_id')}",
)
def svm(spark, sf):
    """Predictions are the sides of the margin, and no direction makes the regularised hinge loss of the training rows
    fall by more than SLOPE per standard deviation."""
    train, test = models.train_test_split_by_key(_vectors(spark, sf), "vec_id")
    train = stage(train, "svm-train")
    reg = 0.01
    model = models.train_svm(train, "features", "positive", reg=reg)
    weights = forward.stored_numbers(spark, model.coefficients)
    rows = train.select(vector_to_array("features").alias("x"), "positive")
    state = stage(forward.hinge_optimality(rows, "x", "positive", weights, model.intercept, reg), "svm-state")
    applied = forward.with_margin(model.transform(test), vector_to_array("features"), model.coefficients, model.intercept, "margin")
    same = (F.col("prediction") == 1) == (F.col("margin") > 0)
    optimal = state.select(F.col("slope") <= SLOPE).scalar()
    return applied.select("vec_id", same.alias("same"), optimal.alias("optimal"))


@query(
    "save_load_model",
    """WITH classes AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i FROM documents GROUP BY lang)
SELECT doc_id, i::double AS "indexedClass" FROM documents JOIN classes USING (lang)""",
)
def save_load_model(spark, sf):
    path = scratch_path(spark, "indexer")
    df = documents(spark, sf, "lang")
    save_model(models.train_label_index(df, "lang"), path)
    return load_model(spark, path).transform(df).select("doc_id", "indexedClass")


@query(
    "evaluate_pipeline",
    "SELECT unnest(['member_0', 'member_1', 'member_2', 'member_3', 'member_4', 'ensemble']) AS model, true AS same, true AS good",
)
def evaluate_pipeline(spark, sf):
    """Weighted F1 of members and of their majority on the held-out part, from one pass over the stored predictions: the
    same as SQL and as Spark ML's evaluator make of them, and good."""
    train, test = _split(documents(spark, sf, "text", "lang"))
    classifier = _classifier(train)
    members, ensemble = plan.evaluate(test, classifier)
    scored = models.apply_mlp_ensemble(classifier.indexer.transform(classifier.vectors.transform(test)), classifier.members)
    names = [f"prediction_{i}" for i in range(len(HIDDEN_LAYERS))]
    stored = stage(scored.select("indexedClass", *names, majority_vote(F.array(*names)).alias("prediction")), "predictions")
    rows = []
    for name, column, f1 in zip([*(f"member_{i}" for i in range(len(names))), "ensemble"], [*names, "prediction"], [*members, ensemble]):
        by_sql = weighted_f1(stored, "indexedClass", column).first()[0]
        rows.append((name, abs(f1 - by_sql) < 1e-9 and abs(f1 - evaluator_f1(stored, "indexedClass", column)) < 1e-9, f1 > 0.5))
    return spark.createDataFrame(rows, "model string, same boolean, good boolean")


@query(
    "classify_text",
    f"SELECT doc_id, lang, 5 AS equal_members, true AS elected FROM documents WHERE {HELD_OUT_SQL.format('doc_id')}",
)
def classify_text(spark, sf):
    """Held-out documents with their class: how many members predict what their weights say of the text's vector, and
    whether the class follows from the predictions by counting them in SQL."""
    df = documents(spark, sf, "text", "lang")
    train, test = _split(df)
    classifier = _classifier(train)
    brands = values(spark, "brand string", *BRANDS)
    names = [f"prediction_{i}" for i in range(len(HIDDEN_LAYERS))]
    classified = plan.classify_text(test, "doc_id", classifier, brands, words_col="text", **RULES)
    for i, (member, hidden) in enumerate(zip(classifier.members, HIDDEN_LAYERS)):
        layers = [C.WORD_VECTOR_SIZE, *hidden, len(classifier.indexer.labels)]
        classified = forward.with_forward(classified, vector_to_array("wordVec"), member.weights, layers, f"out_{i}")
    equal = sum(((F.col(p) == forward.predicted(F.col(f"out_{i}"))).cast("int") for i, p in enumerate(names)), F.lit(0))
    rows = stage(
        classified.select("doc_id", "lang", F.array(*names).alias("said"), equal.alias("equal_members"), "docClass", "text"), "classified"
    )
    labels = spark.createDataFrame(list(enumerate(classifier.indexer.labels)), "place int, label string")
    by_hand = spark.sql(
        """
        WITH votes AS (
          SELECT doc_id, place, label, count(*) AS n FROM (SELECT doc_id, explode(said) AS p FROM {rows})
          JOIN {labels} ON p = place GROUP BY doc_id, place, label),
        evidence AS (SELECT doc_id, text RLIKE 'ation|schen|eaux l' AS has_brand FROM {rows}),
        backed AS (
          SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, place) AS r
          FROM votes JOIN evidence USING (doc_id) WHERE label <> 'de' OR has_brand),
        leaders AS (SELECT doc_id, label AS leader FROM backed WHERE r = 1)
        SELECT doc_id, array_join(transform(array_sort(collect_list(struct(r, label))), x -> x.label), ' ') AS counted
        FROM backed JOIN leaders USING (doc_id) WHERE leader <> 'fr' OR label NOT IN ('es', 'de') GROUP BY doc_id""",
        rows=rows,
        labels=labels,
    )
    elected = F.col("docClass") == F.coalesce("counted", F.lit("en"))
    return rows.join(by_hand, "doc_id", "left").select("doc_id", "lang", "equal_members", elected.alias("elected"))


@query(
    "classify_stored",
    """SELECT doc_id, lang, true AS known, true AS same FROM documents
WHERE ('0x' || left(md5(doc_id::varchar), 8))::bigint % 100 >= 80""",
)
def classify_stored(spark, sf):
    """Label index, vectors and members saved, loaded and applied: the same classes as before they were stored."""
    train, test = _split(documents(spark, sf, "text", "lang"))
    classifier, path = _classifier(train), scratch_path(spark, "classifier")
    classifier.save(path)
    stored = plan.Classifier.load(spark, path, len(HIDDEN_LAYERS))
    brands = values(spark, "brand string", *BRANDS)
    ours, theirs = (
        plan.classify_text(test, "doc_id", c, brands, words_col="text", out=out, **RULES).select("doc_id", "lang", out)
        for c, out in ((classifier, "docClass"), (stored, "storedClass"))
    )
    labels = F.array(*map(F.lit, stored.indexer.labels))
    known = F.size(F.array_except(F.split("storedClass", " "), labels)) == 0
    joined = ours.join(theirs.drop("lang"), "doc_id")
    return joined.select("doc_id", "lang", known.alias("known"), (F.col("docClass") == F.col("storedClass")).alias("same"))


def _enrichment_input(spark, sf) -> DataFrame:
    """The documents in the shape of tagged and raw news articles."""
    df = articles(spark, sf, "lang", "source", "text")
    content = F.nullif("content", F.lit(""))
    return stage(
        df.select(
            "doc_id", "lang", "source", "title", "text", origin_line().alias("origin"),
            tagged("title").alias("tagged_title"), tagged(content).alias("tagged_text"),
            F.col("title").alias("title_places"), content.alias("text_places"),
        ),
        "enrichment-input",
    )


def _enriched(spark, sf, classifier=None, df=None):
    df = df if df is not None else _enrichment_input(spark, sf)
    words = Dictionaries(
        values(spark, "word string, weight double", *SENTIMENT),
        values(spark, "word string, weight double", *ADVERBS),
        values(spark, "word string", *NEGATIONS),
        stop_words=stop_words(spark, sf),
    )
    columns = Columns(
        id="doc_id", site="source", source="origin", tagged_title="tagged_title", tagged_text="tagged_text",
        title="title", text="text", title_places="title_places", text_places="text_places", words="text",
    )
    return enrich_plan(
        df, words, columns, classifier, values(spark, "brand string", *BRANDS),
        summary_options={"marks": SENTENCE_MARKS}, sentiment_options={"marks": CLAUSE_MARKS}, rules=RULES,
    )


OUTPUTS = [
    "doc_id", "original", "keywords", "summary", "sentiment[0] AS positive", "sentiment[1] AS negative", "region",
]


_WHOLE_TEXT_SHARES = PERCENT_SQL.replace("title || '。' || content", "title || '。' || text")
_ENRICHED_SQL = f"""SELECT doc_id, original, keywords, summary, positive, negative, region
FROM ({ORIGIN_SQL}) JOIN ({KEYWORDS_SQL}) USING (doc_id) JOIN ({SUMMARY_SQL}) USING (doc_id)
  JOIN ({_WHOLE_TEXT_SHARES}) USING (doc_id) JOIN ({REGION_SQL}) USING (doc_id)"""


def _leader(labels: list[str], names: list[str]) -> Column:
    """The label with the most votes that the rules leave, the one of the lower place if equal."""
    branded = F.col("text").rlike("|".join(brand for (brand,) in BRANDS))
    votes = []
    for place, label in enumerate(labels):
        n = sum(((F.col(p) == place).cast("int") for p in names), F.lit(0))
        allowed = (n > 0) & (F.lit(label not in RULES["evidence_labels"]) | branded)
        votes.append(F.when(allowed, F.struct((-n).alias("down"), F.lit(place).alias("place"), F.lit(label).alias("label"))))
    return F.coalesce(F.array_min(F.array(*votes))["label"], F.lit(RULES["fallback"]))


@query("enrich", f"SELECT lang, true AS leads, e.* FROM ({_ENRICHED_SQL}) e JOIN documents USING (doc_id)")
def enrich(spark, sf):
    """Class, origin, keywords, summary, sentiment and region of every document; the class begins with the label that
    the members' predictions elect."""
    df = _enrichment_input(spark, sf)
    classifier = _classifier(df)
    enriched = _enriched(spark, sf, classifier, df)
    leader = _leader(classifier.indexer.labels, [f"prediction_{i}" for i in range(len(HIDDEN_LAYERS))])
    leads = F.substring_index("docClass", " ", 1) == leader
    return enriched.withColumn("leads", leads).selectExpr("lang", "leads", *OUTPUTS)


@query("enrich_unclassified", _ENRICHED_SQL)
def enrich_unclassified(spark, sf):
    """All enrichments but the learned one."""
    return _enriched(spark, sf).selectExpr(*OUTPUTS)
