"""Counter samples: one row per scrape and series, with its labels as a map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.schemas import METRIC_SAMPLE
from ledgerbrook.sources.tables import scan


def read(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, METRIC_SAMPLE)


def stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(METRIC_SAMPLE).parquet(path)


def with_series(samples: DataFrame) -> DataFrame:
    """Add ``series``: job, metric and labels as one text, label names in order."""
    labels = F.transform(
        F.array_sort(F.map_entries("labels")),
        lambda x: F.concat(x["key"], F.lit('="'), x["value"], F.lit('"')),
    )
    return samples.withColumn(
        "series", F.concat(F.col("job"), F.lit(":"), F.col("metric"), F.lit("{"), F.array_join(labels, ","), F.lit("}"))
    )
