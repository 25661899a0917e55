"""Training and applying Spark ML models. Each function is a few stages with the settings that matter here."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    NaiveBayes,
)
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IndexToString,
    RegexTokenizer,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    Word2Vec,
    Word2VecModel,
)
from pyspark.sql import DataFrame, functions as F

from corpusengine import constants as C
from corpusengine.functions import skipgram
from corpusengine.operators.each import each
from corpusengine.operators.evaluate import member_scores
from corpusengine.session import scratch_path, stage
from corpusengine.sources import load_model, save_model


# Rows that a task learns from in each round.
LEARNING_BYTES = 16 << 20
# Words that a task learns vectors from, up to LEARNING_TASKS of them; then tasks learn from more, up to MOST_TOKENS, since each
# sends its vectors.
LEARNING_TOKENS = 250_000
LEARNING_TASKS = 8
MOST_TOKENS = 12_500_000


def together(*fits: Callable) -> list:
    """The results of independent fits, whose jobs run side by side."""
    with ThreadPoolExecutor(max(1, len(fits))) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(fit)) for fit in fits]]


def _saved(model, path: str | None):
    if path:
        save_model(model, path)
    return model


def for_learning(df: DataFrame, row_bytes: int, name: str = "learning") -> DataFrame:
    """``df``, stored, in as many partitions as its rows need and no more: a round of learning is a task for each.

    ``row_bytes`` is what a row takes in memory. With rows counted, small inputs are one partition and large ones grow
    with their size, whatever the partitions before.
    """
    rows = stage(df, name)
    parts = max(1, -(-rows.count() * row_bytes // LEARNING_BYTES))
    return rows.repartition(parts) if parts > 1 else rows.coalesce(1)


def train_label_index(df: DataFrame, label: str, out: str = "indexedClass", path: str | None = None) -> StringIndexerModel:
    """Labels by falling frequency, then by name."""
    indexer = StringIndexer(inputCol=label, outputCol=out, stringOrderType="frequencyDesc", handleInvalid="error")
    return _saved(indexer.fit(df), path)


def space_tokenizer(words_col: str, out: str = "words") -> RegexTokenizer:
    return RegexTokenizer(inputCol=words_col, outputCol=out, pattern=C.TOKEN_SEPARATOR)


def _word_counts(words: DataFrame, words_col: str) -> DataFrame:
    counts = each(words, [], words_col, "word").groupBy("word").agg(F.count("*").alias("n"))
    return stage(counts, "word-counts")


def _plan(counts: DataFrame, max_words: int) -> tuple[int, int]:
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.desc("n")).limit(max_words + 1).agg(F.count("*").alias("words"), F.min("n").alias("least")).first()
    min_count = top["least"] + 1 if top["words"] > max_words else 1
    parts = min(-(-tokens // LEARNING_TOKENS), max(LEARNING_TASKS, -(-tokens // MOST_TOKENS)))
    return min_count, max(1, parts)


def vocabulary_plan(words: DataFrame, words_col: str = "words", max_words: int = C.VOCABULARY_BOUND) -> tuple[int, int]:
    """The least count a word needs so that at most ``max_words`` have it, and the partitions to learn in.

    From the table of all word counts. Words that are as frequent as the first one left out are left out too.
    """
    return _plan(_word_counts(words, words_col), max_words)


def train_word2vec(
    df: DataFrame,
    words_col: str,
    out: str = "wordVec",
    size: int = C.WORD_VECTOR_SIZE,
    path: str | None = None,
    seed: int = C.SPLIT_SEED,
    max_words: int = C.VOCABULARY_BOUND,
    **settings,
) -> PipelineModel:
    """Tokenise and learn word vectors; the model adds ``words`` and the mean vector of a text.

    The driver holds the vocabulary, so it has at most ``max_words`` words, the most frequent ones, whatever the size of
    the corpus: ``minCount`` follows from their counts and ``numPartitions`` from the number of tokens, unless given.

    Texts are dealt out by a hash of their words and sorted by it, tasks learn from them apart, beginning with the same
    vectors, and the means of theirs are the result. So it is the same whenever it is learned from the same texts with the
    same seed and partitions, in whatever order and files they come.
    """
    spark, tokenizer = df.sparkSession, space_tokenizer(words_col)
    words = tokenizer.transform(df.select(words_col)).select("words")
    counts = _word_counts(words, "words")
    min_count, parts = _plan(counts, max_words)
    settings = {
        "minCount": min_count, "numPartitions": parts, "windowSize": 5, "stepSize": 0.025, "maxIter": 1, "maxSentenceLength": 1000,
        **settings,
    }
    ranked = counts.where(F.col("n") >= settings["minCount"]).orderBy(F.desc("n"), "word").toArrow()
    if not len(ranked):
        raise ValueError("no word is frequent enough to learn from")
    tree = skipgram.huffman(ranked.column("n").to_pylist())
    shared = spark.sparkContext.broadcast((ranked.column("word").combine_chunks(), *tree))
    options = [settings[name] for name in ("windowSize", "stepSize", "maxIter", "maxSentenceLength")]
    dealt = words.withColumn("_hash", F.xxhash64("words")).repartition(settings["numPartitions"], "_hash")
    learned = dealt.sortWithinPartitions("_hash", "words").select("words").mapInArrow(
        skipgram.learner(shared, size, *options, seed), "block int, part int, words binary, n binary, vectors binary"
    )
    vectors = learned.groupBy("block").applyInArrow(skipgram.merged(shared, size), "word string, vector array<float>")
    learner = Word2Vec(inputCol="words", outputCol=out, vectorSize=size, seed=seed, **settings)
    return _saved(PipelineModel([tokenizer, _word2vec_model(learner, vectors)]), path)


def _word2vec_model(learner: Word2Vec, vectors: DataFrame) -> Word2VecModel:
    """Spark ML's model of a table (word, vector), stored as Spark ML stores and reads it."""
    spark, path = vectors.sparkSession, scratch_path(vectors.sparkSession, "vectors")
    vectors.write.parquet(f"{path}/data")

    def values(params: dict) -> dict:
        return {param.name: value for param, value in params.items()}

    metadata = {
        "class": "org.apache.spark.ml.feature.Word2VecModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
        "uid": learner.uid, "paramMap": values(learner._paramMap), "defaultParamMap": values(learner._defaultParamMap),
    }
    spark.range(1).select(F.lit(json.dumps(metadata)).alias("value")).write.text(f"{path}/metadata")
    return Word2VecModel.load(path)


def word2vec_fit_transform(
    train: DataFrame, test: DataFrame, words_col: str, path: str | None = None, **settings
) -> tuple[DataFrame, DataFrame]:
    model = train_word2vec(train, words_col, path=path, **settings)
    return model.transform(train), model.transform(test)


def apply_word2vec(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``words`` and ``wordVec`` of a stored model."""
    return PipelineModel.load(path).transform(df)


def train_mlp(
    df: DataFrame, layers: list[int], features: str, label: str, prediction: str = "prediction", path: str | None = None,
    max_iter: int = 200, seed: int = C.SPLIT_SEED,
) -> MultilayerPerceptronClassificationModel:
    """One perceptron. Only the prediction column is added, so that members can follow each other."""
    learner = MultilayerPerceptronClassifier(
        layers=layers, featuresCol=features, labelCol=label, predictionCol=prediction, maxIter=max_iter, seed=seed
    )
    rows = df.select(features, label)
    if not df.storageLevel.useMemory:
        rows = for_learning(rows, 8 * layers[0])
    return _saved(learner.setRawPredictionCol("").setProbabilityCol("").fit(rows), path)


def train_mlp_ensemble(
    df: DataFrame, layer_specs: list[list[int]], features: str, label: str, paths: list[str] | None = None, **settings
) -> list[MultilayerPerceptronClassificationModel]:
    """One perceptron per layer list; member i predicts ``prediction_i``. All learn from the same rows, at the same time:
    a round is a task or a few, which leaves cores for the other members."""
    if paths is not None and len(paths) != len(layer_specs):
        raise ValueError("one path per layer list")
    rows = for_learning(df.select(features, label), 8 * max(sizes[0] for sizes in layer_specs), "members").persist()
    try:
        return together(
            *(
                partial(train_mlp, rows, layers, features, label, f"prediction_{i}", paths[i] if paths else None, **settings)
                for i, layers in enumerate(layer_specs)
            )
        )
    finally:
        rows.unpersist()


def apply_mlp(df: DataFrame, path: str) -> DataFrame:
    return MultilayerPerceptronClassificationModel.load(path).transform(df)


def apply_mlp_ensemble(df: DataFrame, models: list) -> DataFrame:
    """``df`` with ``prediction_0`` and so on; members are models or paths."""
    for i, model in enumerate(models):
        if isinstance(model, str):
            model = load_model(df.sparkSession, model)
        df = model.setPredictionCol(f"prediction_{i}").transform(df)
    return df


def member_f1(df: DataFrame, label: str, members: int) -> list[float]:
    return list(member_scores(df, label, [f"prediction_{i}" for i in range(members)]).values())


def hashing_tfidf(words_col: str = "words", out: str = "tfidf", n_features: int = C.HASH_FEATURES) -> list:
    """Stages: hashed term counts, weighted by inverse document frequency."""
    return [HashingTF(inputCol=words_col, outputCol="tf", numFeatures=n_features), IDF(inputCol="tf", outputCol=out)]


def spaced_words(df: DataFrame, words_col: str, out: str = "words") -> DataFrame:
    """``df`` with the lower-case words of a text, cut at every white space, as ``train_naive_bayes`` cuts it."""
    return Tokenizer(inputCol=words_col, outputCol=out).transform(df)


def train_naive_bayes(
    df: DataFrame, words_col: str, label: str, excluded_class: str | None = None, n_features: int = C.HASH_FEATURES,
    path: str | None = None,
) -> PipelineModel:
    """Multinomial naive Bayes on hashed TF-IDF; the model adds ``prediction_nb`` and ``nbClass``."""
    if excluded_class is not None:
        df = df.where(F.col(label) != excluded_class)
    indexer = train_label_index(df, label)
    stages = [
        Tokenizer(inputCol=words_col, outputCol="words"),
        *hashing_tfidf(n_features=n_features),
        NaiveBayes(featuresCol="tfidf", labelCol="indexedClass", predictionCol="prediction_nb"),
        IndexToString(inputCol="prediction_nb", outputCol="nbClass", labels=indexer.labels),
    ]
    return _saved(Pipeline(stages=stages).fit(indexer.transform(df)), path)


def train_svm(df: DataFrame, features: str, label: str, max_iter: int = 200, reg: float = 0.01) -> LinearSVCModel:
    """A binary linear support vector machine; labels are 1 and 0."""
    rows, first = df.select(features, label), df.select(features).first()
    width = len(first[0]) if first else 1
    return LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg).fit(for_learning(rows, 8 * width))


def run_svm(
    train: DataFrame, test: DataFrame, id_col: str, features: str, label: str, max_iter: int = 200, reg: float = 0.01
) -> DataFrame:
    """(id, prediction) of a machine learned from ``train``."""
    model = train_svm(train, features, label, max_iter, reg)
    return model.transform(test.select(id_col, features)).select(id_col, "prediction")


def train_test_split(df: DataFrame, train_share: float = 0.8, seed: int = C.SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Random rows; the parts depend on the order and partitions of ``df``."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test


def train_test_split_by_key(
    df: DataFrame, key: str, train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Rows by a hash of a key of any type: the same parts on every run and every cluster.

    The bucket is the number of the first eight hex digits of the MD5 of the key as text, modulo 100. Rows with a null
    key are for training.
    """
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    bucket = F.coalesce(F.conv(digits, 16, 10).cast("long") % 100, F.lit(0))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)
