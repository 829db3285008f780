"""Text lines out and in: log lines and metric snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write(df: DataFrame, path: str, column: str = "line") -> None:
    df.select(column).write.mode("append").text(path)


def read(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", column)


def stream(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    return spark.readStream.text(path).withColumnRenamed("value", column)
