"""First-wins selection: repeated deliveries, repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key.

    ``row_number() = 1`` is cut to one row per key and task before the shuffle
    (window group limit), so a key with many copies does not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def once_per_event(
    events: DataFrame, order: Sequence[str], scope: Sequence[str] = (), event_id: str = "event_id"
) -> DataFrame:
    """Drop repeated deliveries of an event, per ``scope`` (the consumer).

    Events without id are never repeats of each other: each one forms a key of
    its own, which also spreads them over the tasks.
    """
    id_column = F.col(event_id)
    lone = F.when(id_column.isNull() | (id_column == ""), F.struct(*order))
    keyed = events.withColumn("_lone", lone)
    return first_per_key(keyed, [*scope, event_id, "_lone"], order).drop("_lone")


def not_seen(events: DataFrame, processed: DataFrame, scope: Sequence[str] = ("consumer",)) -> DataFrame:
    """Leave out events already in the table of processed ids."""
    return events.join(processed.select(*scope, "event_id"), [*scope, "event_id"], "left_anti")


def markers(events: DataFrame, consumer: str) -> DataFrame:
    """The rows to add to the table of processed ids."""
    return events.where(F.col("event_id").isNotNull()).select(
        F.lit(consumer).alias("consumer"), "event_id", F.current_timestamp().alias("processed_at")
    )
