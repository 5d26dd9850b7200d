"""Paths in whatever store Spark reads: existence, size, deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()), held


def exists(spark: SparkSession, path: str) -> bool:
    store, held = _store(spark, path)
    return store.exists(held)


def delete(spark: SparkSession, path: str) -> bool:
    store, held = _store(spark, path)
    return store.delete(held, True)


def load_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options) -> DataFrame:
    """What is stored at ``path``, or a table without rows if nothing is there yet. A store that cannot be reached raises."""
    if exists(spark, path):
        return spark.read.schema(schema).format(fmt).options(**options).load(path)
    return spark.createDataFrame([], schema)
