"""Lookups and who may read or change what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import derived_id, first_filled


def lookup(keys: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """Bulk point lookup: every key row with its record, and ``found``."""
    side = table.withColumn("_hit", F.lit(True))
    return (
        keys.join(side, keys[key] == side[table_key], "left")
        .withColumn("found", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def order_access(reads: DataFrame, orders: DataFrame) -> DataFrame:
    """200 for the owner, 403 for another actor, 404 for an order that is not there."""
    owners = orders.select(F.col("order_id").alias("_order"), F.col("customer_id").alias("_owner"))
    status = (
        F.when(F.col("_order").isNull(), 404)
        .when(F.coalesce(F.col("_owner") != F.col("actor"), F.lit(True)), 403)
        .otherwise(200)
        .cast("bigint")
    )
    code = F.when(F.col("status_code") == 404, "ORDER_NOT_FOUND").when(F.col("status_code") == 403, "FORBIDDEN")
    return (
        reads.join(owners, reads["order_id"] == owners["_order"], "left")
        .withColumn("status_code", status)
        .withColumn("error_code", code)
        .drop("_order", "_owner")
    )


def requires_role(required: str, role: str = "role") -> Column:
    """Status of an action that only ``required`` may take."""
    return F.when(F.coalesce(F.col(role) == required, F.lit(False)), 200).otherwise(403).cast("bigint")


def known_actors(actions: DataFrame, users: DataFrame, actor: str = "actor_id") -> DataFrame:
    """401 for an actor without a user row, else 200."""
    found = lookup(actions, users.select(F.col("id").alias("_user")), actor, "_user")
    return found.withColumn("status_code", F.when(F.col("found"), 200).otherwise(401).cast("bigint")).drop(
        "_user", "found"
    )


def with_trace_ids(requests: DataFrame, *row_key: str) -> DataFrame:
    """Fill request and correlation ids from the headers or from the row key.

    The order API falls back to the request id for the correlation id, the edge
    makes a new one. An empty header counts as absent.
    """
    keys = [F.col(k).cast("string") for k in row_key]
    request_id = first_filled(F.col("request_header"), derived_id(F.lit("request"), *keys))
    return (
        requests.withColumn("request_id", request_id)
        .withColumn("correlation_id", first_filled(F.col("correlation_header"), F.col("request_id")))
        .withColumn(
            "edge_correlation_id",
            first_filled(F.col("correlation_header"), derived_id(F.lit("correlation"), *keys)),
        )
    )
