"""Tables, dictionaries and models at rest."""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusengine.functions.text import split_java, trim_control


def scan_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None, spread_by: str | None = None
) -> DataFrame:
    """The table at ``path``.

    ``spread_by`` names a unique column: a table with fewer splits than there are cores (one small file, one row
    group) is then hashed on it, so that the work behind it is not one task.
    """
    table = spark.read.parquet(path)
    if columns:
        table = table.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and table.rdd.getNumPartitions() < cores:
        table = table.repartition(cores, spread_by)
    return table


def scan_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def scan_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``word<TAB>weight`` lines as (word, weight).

    Lines without exactly two fields are no entries. Of several entries for a word the last line counts, by file
    path and then by place in the file. A weight that is no number drops its line; ``bad_lexicon_lines`` counts them.
    """
    entries = _lexicon_entries(spark, path).where(F.col("weight").isNotNull())
    return entries.groupBy("word").agg(F.max_by("weight", "line").alias("weight"))


def bad_lexicon_lines(spark: SparkSession, path: str) -> DataFrame:
    return _lexicon_entries(spark, path).agg(F.count_if(F.col("weight").isNull()).alias("bad_lines"))


def _lexicon_entries(spark: SparkSession, path: str) -> DataFrame:
    fields = split_java("value", "\t")
    line = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return (
        spark.read.text(path)
        .select(fields.alias("fields"), line.alias("line"))
        .where(F.size("fields") == 2)
        .select(
            trim_control(F.col("fields")[0]).alias("word"),
            trim_control(F.col("fields")[1]).try_cast("double").alias("weight"),
            "line",
        )
    )


def write_parquet(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """Overwrite ``path``. One file per task unless fewer are asked for."""
    (df.coalesce(num_files) if num_files else df).write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def save_model(model, path: str) -> None:
    """Any Spark ML model or pipeline, on whatever file system the path names."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """The model at ``path``, as the class it was saved from."""
    return DefaultParamsReader.loadParamsInstance(path, spark.sparkContext)
