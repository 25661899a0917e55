"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (optional) the queries, separated by commas.
Every result is computed in full and thrown away by the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusengine.plans.workload import QUERIES  # noqa: E402

HEADLINES = [
    "tokenize_space",
    "tfidf",
    "class_template",
    "template_classify",
    "join_results",
    "label_vote_rules",
    "region",
    "sentiment_percent",
    "bm25_similarity_sums",
    "bm25_search",
    "sliding_cooccurrence",
    "textrank_words",
    "textrank_sentences",
    "keywords",
    "summary",
    "naive_bayes",
    "classify_text",
    "enrich_unclassified",
    "enrich",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusengine-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpusengine-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compiler and the Python workers before the clock runs.
    QUERIES["keywords"](spark, sf_dir.replace("sf0.1", "sf0.001")).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
