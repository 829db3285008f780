"""Topic routing, queue unions and handler dispatch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import exchange_of, routing_key_of, topic_regex

# fixed values: queue, exchange, pattern
BINDINGS = (
    ("order-created", "order-events", "order.created"),
    ("inventory-payment-failed-queue", "payment-events", "payment.failed"),
    ("payment-inventory-queue", "inventory-events", "inventory.reserved"),
    ("inventory-results", "inventory-events", "inventory.*"),
    ("inventory-results", "payment-events", "payment.*"),
)

# fixed values: which consumer reads a queue
CONSUMER_OF_QUEUE = {
    "order-created": "inventory",
    "inventory-payment-failed-queue": "inventory",
    "payment-inventory-queue": "payment",
    "inventory-results": "order",
}


def addressed(events: DataFrame) -> DataFrame:
    """Add the exchange and routing key an event is published with."""
    return events.withColumn("exchange", exchange_of(F.col("event_type"))).withColumn(
        "routing_key", routing_key_of(F.col("event_type"))
    )


def route(events: DataFrame, rules: Iterable[tuple[str, str, str]] = BINDINGS) -> DataFrame:
    """One row per event and matching binding (queue, exchange, pattern), with the ``queue``.

    Bindings are configuration, so they are literals of the plan: each event is
    tested in place and nothing is shuffled.
    """
    tests = [
        F.when((F.col("exchange") == exchange) & F.col("routing_key").rlike(topic_regex(pattern)), queue)
        for queue, exchange, pattern in rules
    ]
    return events.select("*", F.explode(F.array_compact(F.array(*tests))).alias("queue"))


def workflow_events(inventory_topic: DataFrame, payment_topic: DataFrame) -> DataFrame:
    """Both topics in the queue of the order worker, as a bag, with their ``topic``."""
    return inventory_topic.withColumn("topic", F.lit("inventory")).unionByName(
        payment_topic.withColumn("topic", F.lit("payment"))
    )


def dispatch(deliveries: DataFrame) -> DataFrame:
    """Handler of the stock worker: PaymentFailed releases, anything else reserves."""
    failed = (F.col("routing_key") == "payment.failed") | (F.col("event_type") == "PaymentFailed")
    return deliveries.withColumn(
        "handler", F.when(F.coalesce(failed, F.lit(False)), "release").otherwise("reserve")
    )
