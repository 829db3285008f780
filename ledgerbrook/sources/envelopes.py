"""Event bodies: JSON text to envelopes and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import exchange_of, iso_utc, routing_key_of
from ledgerbrook.schemas import CORRUPT, ENVELOPE


def parse(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Parse every body; bad ones keep their text in ``quarantine_reason`` and nulls elsewhere.

    The order id is taken from the payload, or from the top level when the payload
    has none.
    """
    parsed = bodies.withColumn(
        "_e",
        F.from_json(
            column,
            f"{ENVELOPE}, {CORRUPT} string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ),
    )
    return parsed.withColumn("quarantine_reason", _reason(column)).withColumn(
        "order_id", F.coalesce("_e.payload.order_id", "_e.order_id")
    )


def _reason(column: str) -> Column:
    # the text is looked at again only where parsing failed
    broken = F.col("_e").isNull() | F.col(f"_e.{CORRUPT}").isNotNull()
    not_json = F.try_parse_json(F.col(column)).isNull()
    return F.when(broken & not_json, "UNDECODABLE").when(broken, "WRONG_SHAPE").when(
        F.col("_e.event_type").isNull(), "NO_TYPE"
    )


def good(parsed: DataFrame) -> DataFrame:
    """The envelopes that go on, flat."""
    return parsed.where(F.col("quarantine_reason").isNull()).select(
        "_e.event_id",
        "_e.event_type",
        F.to_timestamp("_e.occurred_at").alias("occurred_at"),
        "_e.correlation_id",
        "order_id",
        F.col("_e.payload").alias("payload"),
    )


def quarantine(parsed: DataFrame, column: str = "body") -> DataFrame:
    """The bodies that are dropped, with the reason."""
    return parsed.where(F.col("quarantine_reason").isNotNull()).select(
        F.col(column).alias("body"), "quarantine_reason"
    )


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    return quarantine(parsed).groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n"))


def body(payload: Column) -> Column:
    """JSON text of an envelope around ``payload``; null payload fields are left out."""
    return F.to_json(
        F.struct("event_id", "event_type", iso_utc(F.col("occurred_at")).alias("occurred_at"), "correlation_id",
                 payload.alias("payload"))
    )


def published(events: DataFrame, payload: Column) -> DataFrame:
    """Events ready for a topic: exchange, routing key, body."""
    return events.select(
        exchange_of(F.col("event_type")).alias("exchange"),
        routing_key_of(F.col("event_type")).alias("routing_key"),
        body(payload).alias("body"),
    )


def write_published(messages: DataFrame, path: str) -> None:
    """Append message bodies as text, one folder per exchange and routing key."""
    messages.write.mode("append").partitionBy("exchange", "routing_key").text(path)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "body")


def stream_bodies(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same folder as a stream, oldest file first."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
        .withColumnRenamed("value", "body")
    )
