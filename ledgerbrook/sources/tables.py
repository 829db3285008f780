"""Table scans and appends with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet scan without schema inference."""
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
