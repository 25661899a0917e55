import pytest

from corpusengine.llm.registry import prepare

# Columns with the names that operators use inside.
CLASHES = {name: str(k) for k, name in enumerate("id ids n row kept digest node lines task tag score label shape host words".split())}


@pytest.fixture(scope="session")
def spark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text, source) with nulls, empty, blank, repeated and very long texts, and clashing columns."""
    long = " ".join(f"w{k * k % 7919}" for k in range(60_000))
    rows = [
        (1, None, "a"),
        (2, "", None),
        (3, " \n\t ", "a"),
        (4, "One two, three.\nFour five", "a"),
        (4, "One two, three.\nFour five", "a"),
        (5, "One two, three.\nFour five", "b"),
        (None, "one TWO, three.\nfour five", "b"),
        (6, long, "a"),
        (7, "naïve Ünïcode 日本語 😀  two  spaces \n\n end ", None),
        (8, "x", "a"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name, value in CLASHES.items():
        from pyspark.sql import functions as F

        table = table.withColumn(name, F.lit(value))
    return table


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("1 = 0")
