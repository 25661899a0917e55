"""Registration of the queries of this package, and the tables they read."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpusengine
from corpusengine.session import SETTINGS, apply_settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows handed to Python at once: a few MB of usual texts, and still one row at a time of the longest.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, as one archive sent by Spark."""
    context = spark.sparkContext
    if getattr(context, "_shipped_package", False):
        return
    package = Path(corpusengine.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='package-')}/corpusengine-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._shipped_package = True


def prepare(spark: SparkSession) -> SparkSession:
    ship(spark)
    for key, value in {**SETTINGS, **BATCH}.items():
        if spark.conf.get(key, None) != value:
            apply_settings(spark)
            spark.conf.set(key, value)
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can express it."""

    def register(plan: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Whole texts, null as empty."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns)
