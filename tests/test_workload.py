"""Every registered query against its SQL on the smallest tables, and the shape of the plans."""

import math

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpusengine.operators.keywords import keywords, sliding_cooccurrence
from corpusengine.operators.lookup import attach
from corpusengine.operators.places import region
from corpusengine.operators.summary import summary
from corpusengine.plans.workload import ORACLES, QUERIES
from corpusengine.plans.workload.learning import _enriched, _enrichment_input

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return float(f"{value:.9g}") if math.isfinite(value) else str(value)
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    expected = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    ours = sorted((tuple(comparable(row[c]) for c in columns) for row in got.collect()), key=repr)
    at = [expected.columns.index(c) for c in columns]
    theirs = sorted((tuple(comparable(row[i]) for i in at) for row in expected.fetchall()), key=repr)
    assert ours == theirs


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)


def test_enrichment_is_whole(spark, sf):
    """The learned enrichment is in the SQL comparison; here only that no class is empty."""
    df = _enrichment_input(spark, sf)
    got = _enriched(spark, sf, df=df)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.where("original NOT IN ('0', '1') OR abs(sentiment[0] + sentiment[1] - 1) > 0.011").isEmpty()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_stay_in_their_rows(spark, sf):
    """Keywords and summaries are computed without a shuffle and without row-wise Python."""
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("title", F.lit("a/n"))
    for plan in (keywords(df, "doc_id", "title", "text", ["the"]), summary(df, "doc_id", "text", stop_words=["the"])):
        text = physical(plan)
        assert "Exchange" not in text and "BatchEvalPython" not in text and text.count("FileScan") == 1
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_places_and_pairs_stay_in_their_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    words = df.withColumn("kept", F.split("text", " "))
    for plan in (region(df, "doc_id", "lang", "text"), sliding_cooccurrence(words, "doc_id")):
        assert "Exchange" not in physical(plan)


def test_enrichment_keeps_every_row(spark, sf):
    """Rows with equal and with null ids are neither lost nor multiplied, and equal rows come out alike."""
    df = _enrichment_input(spark, sf).where("doc_id < 40")
    twice = df.unionByName(df).unionByName(df.where("doc_id < 5").withColumn("doc_id", F.lit(None).cast("long")))
    once = {r.text: r for r in _enriched(spark, sf, df=df).collect()}
    got = _enriched(spark, sf, df=twice).collect()
    assert len(got) == 2 * df.count() + df.where("doc_id < 5").count()
    made = ["original", "keywords", "summary", "sentiment", "region"]
    assert all([r[c] for c in made] == [once[r.text][c] for c in made] for r in got)


def test_small_dictionaries_are_broadcast_and_large_ones_are_not(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    entries = df.select("lang").distinct()
    assert "BroadcastHashJoin" in physical(attach(df, entries, "lang"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = physical(attach(df, entries, "lang", max_rows=0))
        assert "SortMergeJoin" in text and "_salt" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = physical(QUERIES["scan_parquet"](spark, sf))
    assert "EqualTo(lang,de)" in text and "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in text


def test_python_gets_small_batches(spark):
    """Batches are bounded by rows and by bytes: what a plan's Python steps hold does not follow the partitions."""

    @arrow_udf("int")
    def sizes(rows: pa.Array) -> pa.Array:
        return pa.array([len(rows)] * len(rows), pa.int32())

    short = spark.range(2000, numPartitions=1).select(sizes(F.col("id").cast("string")).alias("n"))
    long = spark.range(64, numPartitions=1).select(sizes(F.repeat(F.col("id").cast("string"), 1 << 20)).alias("n"))
    assert short.agg(F.max("n")).first()[0] == 256
    assert long.agg(F.max("n")).first()[0] <= 16


def test_sentence_similarity_is_the_whole_matrix(spark, tmp_path):
    """not of neighbours only; every sentence of a text against every one, in code and SQL."""
    texts = ["One red house stands here. A red river runs there. Nothing else is seen. The red house again."] * 2 + ["Only one sentence here", *["" for _ in range(8)]]
    rows = [(i, text) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["bm25_sentence_sim"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.sent, r.other) for r in got) == [
        *((d, a, b) for d in (0, 1) for a in range(4) for b in range(4)), (2, 0, 0)
    ]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.sql(ORACLES["bm25_sentence_sim"]).fetchall()
    assert sorted((r.doc_id, r.sent, r.other, r.sim) for r in got) == sorted(expected)
    assert any(r.sim and abs(r.sent - r.other) > 1 for r in got)
