"""Order status folded from workflow events, and the whole choreography in one plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import (
    DECLINED_AMOUNTS,
    INITIAL_STATUS,
    TERMINAL_STATUSES,
    payment_status,
    present_id,
    status_of,
)
from ledgerbrook.operators.admission import admit
from ledgerbrook.operators.dedupe import once_per_event
from ledgerbrook.operators.inventory import with_releases, worker_lines
from ledgerbrook.operators.running import ROWS_PER_SLICE, previous


def status_events(events: DataFrame, order: list[str], deduped: bool = False) -> DataFrame:
    """Deduped events that name an order and change its status, with ``new_status``.

    The event types that change nothing are dropped after the dedupe: every event
    with an id uses that id up.
    """
    once = events if deduped else once_per_event(events, order)
    return once.where(present_id(F.col("order_id"))).withColumn(
        "new_status", status_of(F.col("event_type"))
    ).where(F.col("new_status").isNotNull())


def fold_status(changes: DataFrame, order: list[str], guarded: bool = False) -> DataFrame:
    """Last status per order; with ``guarded`` the first terminal status stays.

    One aggregate with map-side combine: an order with very many events sends one
    partial row per task.
    """
    at = F.struct(*order)
    status = F.max_by("new_status", at)
    if guarded:
        terminal = F.col("new_status").isin(*TERMINAL_STATUSES)
        status = F.coalesce(F.min_by("new_status", F.when(terminal, at)), status)
    return changes.groupBy("order_id").agg(status.alias("status"), F.count(F.lit(1)).alias("n_changes"))


def order_status(events: DataFrame, order: list[str], guarded: bool = False) -> DataFrame:
    return fold_status(status_events(events, order), order, guarded)


def current_status(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """Every known order with its status; PENDING when nothing happened to it."""
    return orders.join(statuses.select("order_id", "status"), "order_id", "left").withColumn(
        "status", F.coalesce("status", F.lit(INITIAL_STATUS))
    )


def orphan_events(events: DataFrame, known_orders: DataFrame, order: list[str]) -> DataFrame:
    """Status-bearing events with ``matched``: false when there is no such order."""
    known = known_orders.select("order_id").distinct().withColumn("_known", F.lit(True))
    return (
        status_events(events, order)
        .join(known, "order_id", "left")
        .withColumn("matched", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def status_transitions(events: DataFrame, order: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Each status change with the status before it."""
    changes = status_events(events, order)
    return previous(
        changes, ["order_id"], order, {"_old": "new_status"}, rows_per_slice=rows_per_slice
    ).select(*changes.columns, F.coalesce("_old", F.lit(INITIAL_STATUS)).alias("old_status"))


def saga_outcomes(
    orders: DataFrame,
    items: DataFrame,
    inventory: DataFrame,
    declined: Iterable[float] = DECLINED_AMOUNTS,
    delay: str = "INTERVAL 1 HOUR",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """OrderCreated -> stock -> payment -> status, for all orders at once.

    ``orders``: event_key, arrival, amount. A payment that fails gives the stock back
    ``delay`` after the arrival, where orders that arrive later can have it. Which
    payments would fail is known from the amount, so the release lines take part in
    the admission and share the verdict of their order.
    """
    paid = orders.select("event_key", "arrival", payment_status(F.col("amount"), declined).alias("_pay"))
    releases = paid.where("_pay = 'FAILED'").select(
        "event_key", (F.col("arrival") + F.expr(delay)).alias("released_at")
    )
    lines = with_releases(worker_lines(items, inventory), releases)
    verdicts = admit(lines, "event_key", "product_id", ["arrival", "event_key"], rows_per_slice)
    accepted = F.coalesce("accepted", F.lit(True))
    return (
        paid.join(verdicts, "event_key", "left")
        .withColumn("_ok", accepted)
        .select(
            "event_key",
            F.when(F.col("_ok"), "InventoryReserved").otherwise("InventoryRejected").alias("stock_event"),
            F.when(F.col("_ok") & (F.col("_pay") == "FAILED"), "PaymentFailed")
            .when(F.col("_ok"), "PaymentCompleted")
            .alias("payment_event"),
            F.when(F.col("_ok") & (F.col("_pay") != "FAILED"), "CONFIRMED").otherwise("CANCELLED").alias("status"),
            (F.col("_ok") & (F.col("_pay") == "FAILED")).alias("released"),
        )
    )
