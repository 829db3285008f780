"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

import re

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: event type -> order status
STATUS_OF_EVENT = {
    "InventoryReserved": "PAYMENT_PENDING",
    "InventoryRejected": "CANCELLED",
    "PaymentCompleted": "CONFIRMED",
    "PaymentFailed": "CANCELLED",
}
INITIAL_STATUS = "PENDING"
TERMINAL_STATUSES = ("CONFIRMED", "CANCELLED")

# fixed values: amounts the payment rule declines besides non-positive ones
DECLINED_AMOUNTS = (9999.0,)

# fixed values: severity ranks of log levels
LEVEL_RANKS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}

# fixed values: where each event type is published (exchange, routing key)
ROUTE_OF_EVENT = {
    "OrderCreated": ("order-events", "order.created"),
    "InventoryReserved": ("inventory-events", "inventory.reserved"),
    "InventoryRejected": ("inventory-events", "inventory.rejected"),
    "InventoryReleased": ("inventory-events", "inventory.released"),
    "PaymentCompleted": ("payment-events", "payment.completed"),
    "PaymentFailed": ("payment-events", "payment.failed"),
}


def choose(key: Column, table: dict, otherwise: Column | None = None) -> Column:
    """``table[key]`` as one CASE expression."""
    chain = None
    for name, value in table.items():
        chain = F.when(key == name, value) if chain is None else chain.when(key == name, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def status_of(event_type: Column) -> Column:
    """New order status of an event; null for events that change nothing."""
    return choose(event_type, STATUS_OF_EVENT)


def exchange_of(event_type: Column) -> Column:
    return choose(event_type, {k: v[0] for k, v in ROUTE_OF_EVENT.items()})


def routing_key_of(event_type: Column) -> Column:
    return choose(event_type, {k: v[1] for k, v in ROUTE_OF_EVENT.items()})


def present_id(order_id: Column) -> Column:
    """False for the ids that count as missing: null and zero."""
    return F.coalesce(order_id != 0, F.lit(False))


def amount_or_default(*amounts: Column) -> Column:
    """First amount present, else 0.0."""
    return F.coalesce(*amounts, F.lit(0.0))


def payment_status(amount: Column, declined: Iterable[float] = DECLINED_AMOUNTS) -> Column:
    """FAILED for a non-positive or declined amount, else COMPLETED."""
    return F.when((amount <= 0) | amount.isin(*declined), "FAILED").otherwise("COMPLETED")


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def derived_id(*parts: Column) -> Column:
    """A uuid-shaped id that is the same on every recomputation of the row."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in spans])


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def duration_ms(seconds: Column) -> Column:
    return F.round(seconds * 1000, 2)


def severity(level: Column) -> Column:
    return choose(F.upper(level), LEVEL_RANKS)


def route_template(path: Column) -> Column:
    """Endpoint label with ids folded into one series."""
    return F.regexp_replace(path, r"/\d+", "/{id}")


def topic_regex(pattern: str) -> str:
    """Anchored regex of a topic pattern: ``*`` is one word, ``#`` any number of words, also none."""
    one, out, glued = r"[^.]*", "", True
    words = pattern.split(".")
    for i, word in enumerate(words):
        if word == "#":
            # takes its dot along: before the next word at the head, else behind the last one
            if glued:
                out += rf"(?:{one}(?:\.{one})*)?" if i == len(words) - 1 else rf"(?:{one}\.)*"
            else:
                out += rf"(?:\.{one})*"
        else:
            out += ("" if glued else r"\.") + (r"[^.]+" if word == "*" else re.escape(word))
            glued = False
    return f"^{out}$"


def email_ok(email: Column) -> Column:
    return F.coalesce(email.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.lit(False))


def money(value: Column) -> Column:
    """Exact form used while summing; cast back to double at the edge."""
    return value.cast("decimal(18,2)")
