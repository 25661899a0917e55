from pyspark.sql import functions as F

from corpusengine.operators import models
from corpusengine.plans import classify
from corpusengine.session import shared_folder, stage
from corpusengine.sources import bad_lexicon_lines, load_model, save_model, scan_lexicon, scan_word_list


def test_lexicon(spark, tmp_path):
    (tmp_path / "a.txt").write_text("good\t1\nbad\t-1\nlonely\n three \t 3 \t\nx\ty\tz\nodd\tword\n")
    (tmp_path / "b.txt").write_text("bad\t-2.5\n")
    got = {r.word: r.weight for r in scan_lexicon(spark, str(tmp_path)).collect()}
    assert got == {"good": 1.0, "bad": -2.5, "three": 3.0}
    assert bad_lexicon_lines(spark, str(tmp_path)).first().bad_lines == 1


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("a\nb\n")
    assert [r.word for r in scan_word_list(spark, str(tmp_path / "w.txt")).collect()] == ["a", "b"]


def test_stage_uses_the_folder_the_session_names(spark):
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3
    assert shared_folder(spark).removeprefix("file:") in staged.inputFiles()[0]


def test_classifier_survives_storage(spark, tmp_path):
    rows = [(i, f"{w} {w} and", c) for i, (w, c) in enumerate([("ball", "sport"), ("vote", "news")] * 20)]
    df = spark.createDataFrame(rows, "id int, text string, class string")
    trained = classify.train(df, "class", "text", [[], [3]], vector_size=5, max_iter=30)
    trained.save(str(tmp_path / "c"))
    loaded = classify.Classifier.load(spark, str(tmp_path / "c"), 2)
    brands = spark.createDataFrame([("zzz",)], "brand string")
    first, second = (
        classify.classify_text(df, "id", c, brands, words_col="text").orderBy("id") for c in (trained, loaded)
    )
    assert {"wordVec", "prediction_0", "prediction_1", "docClass"} <= set(first.columns) and "words" not in first.columns
    assert [r.docClass for r in first.collect()] == [r.docClass for r in second.collect()]
    members, ensemble = classify.evaluate(df, loaded)
    assert ensemble > 0.9 and len(members) == 2


def test_words_are_built_from_title_and_text(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "segmentedTitle string, segmentedText string")
    assert [r.segmentedWords for r in classify.with_segmented_words(df).collect()] == ["a", "b c"]


def test_stored_models_load_as_what_they_were(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "class string")
    indexer = models.train_label_index(df, "class")
    save_model(indexer, str(tmp_path / "i"))
    assert load_model(spark, str(tmp_path / "i")).labels == ["x", "y"]


def test_ensemble_wants_a_path_per_member(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select(F.col("a"), F.col("b"))
    try:
        models.train_mlp_ensemble(df, [[2, 2]], "a", "b", paths=[])
    except ValueError:
        return
    raise AssertionError("no error")


def test_solver_needs_no_package_on_the_executors(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from corpusengine.functions import solve

    payload = tmp_path / "functions"
    payload.write_bytes(cloudpickle.dumps((solve._rank_words, solve._pick, solve.Postings)))
    load = f"import pickle; print(pickle.load(open({str(payload)!r}, 'rb'))[2].__name__)"
    done = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "Postings", done.stderr
