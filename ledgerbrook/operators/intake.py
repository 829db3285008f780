"""Order intake: roll-up, pricing, errors, idempotency, order documents and events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.errors import http_status_of, message_of
from ledgerbrook.functions.scalars import money
from ledgerbrook.operators.admission import admit
from ledgerbrook.operators.dedupe import first_per_key
from ledgerbrook.operators.running import ROWS_PER_SLICE, running
from ledgerbrook.operators.validation import checked_requests
from ledgerbrook.session import cut_lineage, scratch


def requested_quantities(items: DataFrame) -> DataFrame:
    """Repeated lines of a product inside a request, added up."""
    return items.groupBy("request_id", "product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.max("quantity").alias("largest"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def price_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Every line with its unit price; ``found`` is false for an unknown product."""
    catalog = products.select(F.col("id").alias("_id"), F.col("price").alias("unit_price"))
    return (
        items.join(catalog, items["product_id"] == F.col("_id"), "left")
        .withColumn("found", F.col("_id").isNotNull())
        .withColumn("line_total", (money(F.col("unit_price")) * F.col("quantity")).cast("double"))
        .drop("_id")
    )


def order_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Total and line count per request, summed exactly."""
    priced = price_lines(items, products)
    return priced.groupBy("request_id").agg(
        F.sum(money(F.col("unit_price")) * F.col("quantity")).cast("double").alias("total_amount"),
        F.count(F.lit(1)).alias("n_items"),
    )


def first_failure(rolled: DataFrame, products: DataFrame, position: str = "product_id") -> DataFrame:
    """The failing line that decides the error of a request, against the stock as given.

    ``position`` says which failing line counts: ``product_id`` on intake, the place
    in the payload in the stock worker. ``rolled`` carries ``asked``, the amount to test.
    """
    stock = products.select(F.col("id").alias("_id"), F.col("quantity").alias("_available"))
    code = F.when(F.col("_id").isNull(), "PRODUCT_NOT_FOUND").when(
        F.col("asked") > F.col("_available"), "INSUFFICIENT_INVENTORY"
    )
    failing = (
        rolled.join(stock, rolled["product_id"] == F.col("_id"), "left")
        .withColumn("code", code)
        .where(F.col("code").isNotNull())
    )
    return (
        failing.groupBy("request_id")
        .agg(F.min(F.struct(F.col(position).alias("_place"), "product_id", "code")).alias("_f"))
        .select("request_id", "_f.product_id", "_f.code")
    )


def order_errors(failures: DataFrame) -> DataFrame:
    """The error envelope and status of each failed request."""
    return failures.select(
        "request_id",
        "code",
        message_of(F.col("code"), F.col("product_id")).alias("message"),
        http_status_of(F.col("code")).alias("status_code"),
    )


def idempotency_first_wins(requests: DataFrame) -> DataFrame:
    """One row per (customer, key) with its first request, when every request succeeds."""
    return (
        requests.where(F.col("idempotency_key").isNotNull())
        .groupBy("customer_id", "idempotency_key")
        .agg(
            F.min(F.struct("arrival", "request_id")).alias("_first"),
            F.count(F.lit(1)).alias("n_requests"),
        )
        .select("customer_id", "idempotency_key", F.col("_first.request_id").alias("order_id"), "n_requests")
    )


def idempotent_replays(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Every repeat of a (customer, key) with the first order, and whether its payload differs.

    Nothing in intake compares payloads; the flag is a report. Lines are matched by
    place, so the comparison is an equi-join on (order, place).
    """
    canonical = idempotency_first_wins(requests).where("n_requests > 1")
    repeats = (
        requests.join(canonical, ["customer_id", "idempotency_key"])
        .where(F.col("request_id") != F.col("order_id"))
        .select("request_id", "customer_id", "idempotency_key", "order_id")
    )
    counts = items.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"))
    sent = items.join(repeats.select("request_id", "order_id"), "request_id").select(
        "request_id", "order_id", "pos", "product_id", "quantity"
    )
    held = items.select(
        F.col("request_id").alias("order_id"),
        "pos",
        F.col("product_id").alias("_product"),
        F.col("quantity").alias("_quantity"),
    )
    same = (
        sent.join(held, ["order_id", "pos"])
        .where((F.col("product_id") == F.col("_product")) & (F.col("quantity") == F.col("_quantity")))
        .groupBy("request_id")
        .agg(F.count(F.lit(1)).alias("_same"))
    )
    firsts = counts.select(F.col("request_id").alias("order_id"), F.col("_n").alias("_held"))
    n_sent = F.coalesce("_n", F.lit(0))
    n_held = F.coalesce("_held", F.lit(0))
    n_same = F.coalesce("_same", F.lit(0))
    return (
        repeats.join(counts, "request_id", "left")
        .join(firsts, "order_id", "left")
        .join(same, "request_id", "left")
        .withColumn("payload_differs", (n_sent != n_held) | (n_sent != n_same))
        .select("request_id", "customer_id", "idempotency_key", "order_id", "payload_differs")
    )


@dataclass
class _Decided:
    """What the requests came to: the check of each, the priced lines, the verdicts, who answers a key."""

    checked: DataFrame
    priced: DataFrame
    verdicts: DataFrame
    answered: DataFrame


def _decide(
    requests: DataFrame, items: DataFrame, products: DataFrame, rows_per_slice: int, priced_again: bool = False
) -> _Decided:
    """For use in a block: what is read more than once is cut, the priced lines only where they are ``priced_again``."""
    checked = cut_lineage(checked_requests(requests, items).drop("n_items"))
    valid = checked.where("error_code IS NULL").select(
        "request_id", "customer_id", "idempotency_key", "arrival"
    )
    catalog = products.select(F.col("id").alias("_id"), "price", F.col("quantity").alias("capacity"))
    rolled = requested_quantities(items).join(valid, "request_id")
    priced = rolled.join(catalog, rolled["product_id"] == F.col("_id"), "left").select(
        "request_id",
        "product_id",
        "arrival",
        "quantity",
        "capacity",
        (money(F.col("price")) * F.col("quantity")).alias("_worth"),
    )
    if priced_again:
        priced = cut_lineage(priced)
    stock_lines = priced.select(
        "request_id",
        F.concat(F.lit("p"), F.col("product_id")).alias("resource"),
        "arrival",
        F.col("quantity").alias("test"),
        F.col("quantity").alias("add"),
        "capacity",
    )
    key_lines = valid.select(
        "request_id",
        F.concat_ws(":", F.lit("k"), "customer_id", "idempotency_key").alias("resource"),
        "arrival",
        F.lit(1).alias("test"),
        F.lit(1).alias("add"),
        F.lit(1).alias("capacity"),
    )
    verdicts = admit(
        stock_lines.unionByName(key_lines),
        "request_id",
        "resource",
        ["arrival", "request_id"],
        rows_per_slice,
    )
    judged = valid.join(verdicts, "request_id")
    holders = judged.where("accepted").select(
        "customer_id",
        "idempotency_key",
        F.struct("arrival", "request_id").alias("_holder"),
    )
    answered = judged.join(holders, ["customer_id", "idempotency_key"], "left").select(
        "request_id",
        "accepted",
        F.when(F.col("_holder") <= F.struct("arrival", "request_id"), F.col("_holder.request_id")).alias(
            "order_id"
        ),
    )
    return _Decided(checked, priced, verdicts, answered)


def _outcome() -> Column:
    return (
        F.when(F.col("_bad").isNotNull(), "INVALID")
        .when(F.col("accepted"), "CREATED")
        .when(F.col("order_id").isNotNull(), "REPLAYED")
        .otherwise("FAILED")
    )


def order_outcomes(
    requests: DataFrame, items: DataFrame, products: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """``take_orders`` without totals and errors: request_id, outcome, order_id."""
    with scratch(requests.sparkSession) as hand_on:
        made = _decide(requests, items, products, rows_per_slice)
        rows = made.checked.select("request_id", F.col("error_code").alias("_bad")).join(made.answered, "request_id", "left")
        return hand_on(rows.select("request_id", _outcome().alias("outcome"), "order_id"))


def take_orders(
    requests: DataFrame, items: DataFrame, products: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Full intake: one outcome per request.

    ``outcome`` is INVALID (bad request), CREATED, REPLAYED (the key already made an
    order) or FAILED. A failed request does not use up its key. The key is one more
    resource of the admission, with room for one accepted request, so keys and stock
    are decided together in arrival order.
    """
    with scratch(requests.sparkSession) as hand_on:
        return hand_on(_taken_orders(_decide(requests, items, products, rows_per_slice, priced_again=True), rows_per_slice))


def _taken_orders(made: _Decided, rows_per_slice: int) -> DataFrame:
    checked, priced, verdicts, answered = made.checked, made.priced, made.verdicts, made.answered
    # written, so that the shuffles of the lines are gone when the requests meet
    errors = cut_lineage(_errors_in_order(priced, verdicts, rows_per_slice))
    totals = priced.groupBy("request_id").agg(F.sum("_worth").cast("double").alias("total_amount"))
    return (
        checked.select("request_id", F.col("error_code").alias("_bad"))
        .join(answered, "request_id", "left")
        .join(errors, "request_id", "left")
        .join(totals, "request_id", "left")
        .withColumn("outcome", _outcome())
        .select(
            "request_id",
            "outcome",
            "order_id",
            F.when(F.col("outcome") == "CREATED", F.col("total_amount")).alias("total_amount"),
            F.when(F.col("outcome") == "INVALID", F.col("_bad"))
            .when(F.col("outcome") == "FAILED", F.col("_code"))
            .alias("error_code"),
            F.when(F.col("outcome") == "FAILED", message_of(F.col("_code"), F.col("_product"))).alias(
                "error_message"
            ),
            F.when(F.col("outcome") == "INVALID", 422)
            .when(F.col("outcome") == "FAILED", http_status_of(F.col("_code")))
            .otherwise(201)
            .cast("bigint")
            .alias("status_code"),
        )
    )


def _errors_in_order(priced: DataFrame, verdicts: DataFrame, rows_per_slice: int) -> DataFrame:
    """First failing product, by ascending id, of each request that was not accepted."""
    told = priced.join(verdicts, "request_id").withColumn(
        "_took", F.when(F.col("accepted"), F.col("quantity")).otherwise(0)
    )
    ran = running(
        told,
        ["product_id"],
        ["arrival", "request_id"],
        {"_gone": ("sum", "_took")},
        inclusive=False,
        rows_per_slice=rows_per_slice,
    )
    code = F.when(F.col("capacity").isNull(), "PRODUCT_NOT_FOUND").when(
        F.col("quantity") > F.col("capacity") - F.col("_gone"), "INSUFFICIENT_INVENTORY"
    )
    return (
        ran.where(~F.col("accepted"))
        .withColumn("_code", code)
        .where(F.col("_code").isNotNull())
        .groupBy("request_id")
        .agg(F.min(F.struct("product_id", "_code")).alias("_f"))
        .select("request_id", F.col("_f.product_id").alias("_product"), F.col("_f._code").alias("_code"))
    )


def business_counters(outcomes: DataFrame, products: DataFrame) -> DataFrame:
    """Created orders (replays left out), failed orders, created products."""
    orders = outcomes.agg(
        F.count_if(F.col("outcome") == "CREATED").alias("created"),
        F.count_if(F.col("outcome") == "FAILED").alias("failed"),
    )
    made = products.agg(F.count_if(F.col("faults") == "").alias("made"))
    return orders.select(
        F.expr("stack(2, 'orders_created_total', created, 'orders_failed_total', failed) AS (metric, value)")
    ).unionByName(made.select(F.lit("products_created_total").alias("metric"), F.col("made").alias("value")))


def order_documents(requests: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Each order with its items as one nested value, items in payload order.

    The result holds one order per value, as the response does; money is in cents
    so that the text is the same everywhere.
    """
    priced = price_lines(items, products)
    cents = (money(F.col("unit_price")) * 100).cast("bigint")
    nested = priced.groupBy("request_id").agg(
        F.sum(cents * F.col("quantity")).alias("total_cents"),
        F.sort_array(
            F.collect_list(F.struct("pos", "product_id", "quantity", cents.alias("unit_cents")))
        ).alias("_items"),
    )
    return requests.join(nested, "request_id").select(
        F.col("request_id").alias("id"),
        "customer_id",
        F.lit("PENDING").alias("status"),
        "total_cents",
        F.transform(
            "_items",
            lambda x: F.struct(
                x.product_id.alias("product_id"),
                x.quantity.alias("quantity"),
                x.unit_cents.alias("unit_cents"),
            ),
        ).alias("items"),
    )


def orders_without_event(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders whose OrderCreated event never went out (publishing follows the commit)."""
    sent = events.where("event_type = 'OrderCreated'").select("order_id")
    return orders.join(sent, "order_id", "left_anti")


def first_requests(requests: DataFrame) -> DataFrame:
    """The rows that make the table of idempotency keys."""
    return first_per_key(
        requests.where(F.col("idempotency_key").isNotNull()),
        ["customer_id", "idempotency_key"],
        ["arrival", "request_id"],
    )
