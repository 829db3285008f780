"""Every query by name, as an operator over the adapted tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.functions.defaults import with_defaults
from ledgerbrook.functions.scalars import choose, duration_ms, payment_status, present_id
from ledgerbrook.operators import (
    access,
    admission,
    catalog,
    dedupe,
    intake,
    inventory,
    logs,
    metrics,
    payments,
    routing,
    saga,
    validation,
)
from ledgerbrook.plans.adapters import ARRIVAL, Entities
from ledgerbrook.schemas import PRODUCTS
from ledgerbrook.session import run_dir
from ledgerbrook.sources import bodies, envelopes, samples, tables
from ledgerbrook.streaming import queries as streams

Query = Callable[[Entities], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone at the edge, so that no session zone shows through."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    """Integer columns that may be null, as text: drivers disagree on how to carry them."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# sources and sinks


def parse_envelopes(e: Entities) -> DataFrame:
    rows = envelopes.good(envelopes.parse(e.raw_bodies()))
    return rows.select(
        "event_id", "event_type", "occurred_at", "correlation_id", "order_id", F.col("payload.amount").alias("amount")
    )


def quarantine_counts(e: Entities) -> DataFrame:
    return envelopes.quarantine_counts(envelopes.parse(e.raw_bodies()))


def emit_order_created(e: Entities) -> DataFrame:
    """Sent after the order is made: created orders only."""
    made = intake.order_outcomes(e.requests(), e.items(), e.gappy_products()).where("outcome = 'CREATED'")
    # the other lines need not travel on
    items = e.placed_items().join(made.select("request_id"), "request_id", "left_semi")
    docs = intake.order_documents(e.requests(), items, e.products())
    docs = docs.join(made.select(F.col("request_id").alias("id")), "id").withColumns(
        {
            "event_type": F.lit("OrderCreated"),
            "event_id": F.concat(F.lit("order-"), F.col("id").cast("string")),
            "correlation_id": F.concat(F.lit("corr-"), F.col("id").cast("string")),
            "occurred_at": F.lit("2024-01-01").cast("timestamp_ntz"),
        }
    )
    items = F.transform(
        "items", lambda x: F.struct(x.product_id.alias("product_id"), x.quantity.alias("quantity"))
    )
    payload = F.struct(
        F.col("id").alias("order_id"),
        "customer_id",
        (F.col("total_cents") / 100).cast("decimal(18,2)").alias("total_amount"),
        items.alias("items"),
    )
    return envelopes.published(docs, payload)


def round_trip_events(e: Entities) -> DataFrame:
    """The bodies sent for created orders, read back by the parser of the next stage."""
    rows = envelopes.good(envelopes.parse(emit_order_created(e).select("body")))
    return rows.select(
        "event_id", "event_type", "order_id", "payload.customer_id", "payload.total_amount",
        F.size("payload.items").cast("bigint").alias("n_items"),
    )


def emit_inventory_events(e: Entities) -> DataFrame:
    """What the stock worker sends: reserved with amount and items, rejected with the reason, released."""
    verdicts = inventory.reserve(e.event_items(placed=True), e.stock(gappy=True)).withColumnRenamed("emitted", "event_type")
    lines = F.sort_array(F.collect_list(F.struct("pos", "product_id", "quantity")))
    items = e.placed_items().groupBy(F.col("request_id").alias("event_key")).agg(lines.alias("_items"))
    told = verdicts.join(e.order_events(), "event_key")
    key = F.col("event_key").cast("string")
    yes = F.col("event_type") == "InventoryReserved"
    # every event with a verdict has items
    answers = told.join(items, "event_key").select(
        F.concat(F.lit("stock-"), key).alias("event_id"),
        "event_type",
        F.col("arrival").alias("occurred_at"),
        F.concat(F.lit("corr-"), key).alias("correlation_id"),
        F.col("event_key").alias("order_id"),
        F.when(yes, F.col("amount")).alias("amount"),
        F.when(yes, F.transform("_items", lambda x: F.struct(x.product_id.alias("product_id"), x.quantity.alias("quantity")))).alias("items"),
        "reason",
    )
    failed = told.where(yes & (payment_status(F.col("amount")) == "FAILED") & present_id(F.col("event_key")))
    released = failed.select(
        F.concat(F.lit("release-"), key).alias("event_id"),
        F.lit("InventoryReleased").alias("event_type"),
        (F.col("arrival") + F.expr("INTERVAL 1 HOUR")).alias("occurred_at"),
        F.concat(F.lit("corr-"), key).alias("correlation_id"),
        F.col("event_key").alias("order_id"),
    )
    return bodies.published(answers.unionByName(released, allowMissingColumns=True))


def emit_payment_events(e: Entities) -> DataFrame:
    """What the payment worker sends: completed, or failed with the reason, each with its payment id."""
    rows = _ledger(e)
    failed = F.col("status") == "FAILED"
    return bodies.published(
        rows.select(
            F.concat(F.lit("payment-"), F.col("payment_id").cast("string")).alias("event_id"),
            F.when(failed, "PaymentFailed").otherwise("PaymentCompleted").alias("event_type"),
            "occurred_at", "correlation_id", "order_id", "payment_id", "amount",
            F.when(failed, "Payment declined").alias("reason"),
        )
    )


def round_trip_all(e: Entities) -> DataFrame:
    """Bodies of all six types, of an unknown type and broken ones, read back by the schema of their type."""
    rows = e.envelopes(False).withColumns(
        {"total_amount": F.col("amount"), "payment_id": F.col("seq"), "reason": F.lit("because"), "customer_id": F.col("order_id") % 100}
    )
    other = F.to_json(F.struct("event_id", "event_type", F.struct("order_id").alias("payload")))
    nulled = F.concat(F.lit('{"event_type":"InventoryReserved","event_id":"'), F.coalesce("event_id", F.lit("")), F.lit('","payload":{"amount":null}}'))
    sent = bodies.filled(rows).select(
        "seq",
        F.when(F.col("seq") % 101 == 0, "not json")
        .when(F.col("seq") % 103 == 0, '{"event_type":"PaymentFailed","payload":[]}')
        .when(F.col("seq") % 107 == 0, nulled)
        .otherwise(F.coalesce(bodies.body(), other))
        .alias("body"),
    )
    return bodies.parse(sent).select(
        "seq", "event_type", "order_id", "customer_id", "total_amount", "amount", "payment_id", "reason", "charge", "quarantine_reason"
    )


def scan_products(e: Entities) -> DataFrame:
    return e.products()


def parse_logs(e: Entities) -> DataFrame:
    lines = logs.render(e.log_records()).select("line")
    rows = logs.parse(lines).select(*logs.BASE_KEYS, *logs.ALL_CONTEXT)
    return _texts(rows, "order_id", "product_id")


def render_logs(e: Entities) -> DataFrame:
    names = ["method", "status_code"]
    values = [F.lit("GET").cast("variant"), (F.col("seq") % 5 + 200).cast("variant")]
    short = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*values))
    wide = F.map_from_arrays(
        F.array(*map(F.lit, [*names, "message"])), F.array(*values, F.lit("overlaid").cast("variant"))
    )
    records = e.log_records().withColumn("extra_data", F.when(F.col("seq") % 10 == 0, wide).otherwise(short))
    return logs.render(records, "extra_data").select("seq", "line")


def metrics_snapshot(e: Entities) -> DataFrame:
    log = e.request_log()
    return metrics.snapshot_lines(
        metrics.requests_total(log, ("method", "endpoint", "status")), metrics.latency_histogram(log)
    )


def service_snapshots(e: Entities) -> DataFrame:
    """The lines of each service under its own names: the gateway's families, and the order service's with its counters."""
    edge, own = (e.request_log().where(F.col("service") == s) for s in ("gateway", "order-service"))
    series = lambda log: (metrics.requests_total(log, ("method", "endpoint", "status")), metrics.latency_histogram(log))
    gateway = metrics.snapshot_lines(*series(edge), prefix="gateway_http")
    return gateway.unionByName(metrics.snapshot_lines(*series(own), business_counters(e)))


def seed_if_absent(e: Entities) -> DataFrame:
    return catalog.seed_if_absent(e.stock(gappy=True), e.seed())


# filters and projections


def lookup_keys(e: Entities) -> DataFrame:
    keys = e.actions().select("action_id", "actor_id")
    return access.lookup(keys, e.users().select("id", "email"), "actor_id", "id").select(
        "action_id", "actor_id", "found", "email"
    )


def customer_public(e: Entities) -> DataFrame:
    return e.users().select("id", "email", "role")


def validate_products(e: Entities) -> DataFrame:
    return validation.checked_products(e.draft_products()).select("id", "faults", "status_code")


def validate_requests(e: Entities) -> DataFrame:
    items = e.items().withColumn("quantity", F.col("quantity") - 1)
    return validation.checked_requests(e.requests(), items).select(
        "request_id", "n_items", "error_code", "status_code"
    )


def validate_emails(e: Entities) -> DataFrame:
    email = F.when(F.col("customer_id") % 13 == 0, F.replace("email", F.lit("@"), F.lit(""))).otherwise(
        F.col("email")
    )
    return validation.checked_emails(e.registrations().withColumn("email", email)).select("seq", "email", "valid")


def order_access(e: Entities) -> DataFrame:
    return _texts(access.order_access(e.access_reads(), e.orders()), "actor")


def role_access(e: Entities) -> DataFrame:
    return e.actions().select("action_id", "role", access.requires_role("admin").alias("status_code"))


def trace_defaults(e: Entities) -> DataFrame:
    def header(prefix: str, base: int):
        turn = F.col("event_id") % base
        return F.when(turn == 0, F.lit(None)).when(turn == 1, F.lit("")).otherwise(
            F.concat(F.lit(prefix), F.col("event_id").cast("string"))
        )

    rows = e.table("events").select(
        "event_id",
        header("req-", 5).alias("request_header"),
        header("corr-", 3).alias("correlation_header"),
    )
    return access.with_trace_ids(rows, "event_id").select(
        "event_id", "request_id", "correlation_id", "edge_correlation_id"
    )


def log_severity(e: Entities) -> DataFrame:
    return logs.at_least(e.log_records(), "WARNING").select("seq", "level", "severity")


def order_errors(e: Entities) -> DataFrame:
    rolled = intake.requested_quantities(e.items()).withColumn("asked", F.col("quantity"))
    return intake.order_errors(intake.first_failure(rolled.drop("quantity"), _tight(e)))


def _tight(e: Entities) -> DataFrame:
    """A catalog with gaps and little stock, so that lines fail without any contention."""
    return e.gappy_products().withColumn("quantity", F.col("quantity") / 20)


def dispatch_inventory(e: Entities) -> DataFrame:
    return routing.dispatch(routing.addressed(e.envelopes())).select(
        "seq", "attempt", "event_type", "routing_key", "handler"
    )


# joins


def price_lines(e: Entities) -> DataFrame:
    return intake.price_lines(e.items(), e.gappy_products())


def order_documents(e: Entities) -> DataFrame:
    docs = intake.order_documents(e.requests(), e.placed_items(), e.products())
    return docs.select("id", F.to_json(F.struct("*")).alias("document"))


def idempotent_replays(e: Entities) -> DataFrame:
    return intake.idempotent_replays(e.requests(), e.placed_items())


def dedupe_events(e: Entities) -> DataFrame:
    routed = routing.route(routing.addressed(e.envelopes()))
    consumer = choose(F.col("queue"), routing.CONSUMER_OF_QUEUE)
    return dedupe.once_per_event(
        routed.select("event_id", *ARRIVAL, consumer.alias("consumer")), ARRIVAL, ["consumer"]
    ).select("consumer", "event_id", "seq", "attempt")


def orphan_events(e: Entities) -> DataFrame:
    return saga.orphan_events(e.envelopes(), e.known_orders(), ARRIVAL).select(
        "seq", "event_type", "order_id", "matched"
    )


def release_reservations(e: Entities) -> DataFrame:
    failed = saga.status_events(e.envelopes(), ARRIVAL).where("event_type = 'PaymentFailed'")
    return inventory.release(e.inventory_levels(), e.reservations(), failed)


def route_events(e: Entities) -> DataFrame:
    return routing.route(routing.addressed(e.envelopes())).select(
        "queue", "routing_key", "seq", "attempt"
    )


def saga_outcomes(e: Entities) -> DataFrame:
    return saga.saga_outcomes(e.order_events(), e.event_items(), e.stock())


def apply_product_updates(e: Entities) -> DataFrame:
    return catalog.apply_updates(e.products(), e.product_updates())


def delete_products(e: Entities) -> DataFrame:
    return catalog.judge_deletes(e.deletes(), e.grown_catalog(), e.references())


def asof_with_ttl(e: Entities) -> DataFrame:
    return catalog.asof_with_ttl(e.reads(), e.versions(), 86_400)


def trace_summary(e: Entities) -> DataFrame:
    return logs.trace_summary(e.request_log())


def register_unique(e: Entities) -> DataFrame:
    return catalog.register_unique(e.registrations()).select("seq", "email", "status_code")


def known_actors(e: Entities) -> DataFrame:
    return access.known_actors(e.actions(), e.users()).select("action_id", "actor_id", "status_code")


# aggregations


def requested_quantities(e: Entities) -> DataFrame:
    return intake.requested_quantities(e.items())


def order_totals(e: Entities) -> DataFrame:
    return intake.order_totals(e.items(), e.products())


def reserved_by_product(e: Entities) -> DataFrame:
    return inventory.reserved_by_product(e.reservations())


def available_stock(e: Entities) -> DataFrame:
    return inventory.available_stock(e.inventory_levels(), e.reservations())


def http_requests_total(e: Entities) -> DataFrame:
    return metrics.requests_total(e.request_log())


def latency_histogram(e: Entities) -> DataFrame:
    return metrics.latency_histogram(e.request_log())


def histogram_quantiles(e: Entities) -> DataFrame:
    found = metrics.histogram_quantile(metrics.latency_histogram(e.request_log()), 0.95)
    return found.withColumn("quantile_value", F.round("quantile_value", 6))


def business_counters(e: Entities) -> DataFrame:
    outcomes = intake.order_outcomes(e.requests(), e.items(), e.gappy_products())
    return intake.business_counters(outcomes, validation.checked_products(e.draft_products()))


def red_grouping_sets(e: Entities) -> DataFrame:
    return _texts(metrics.red_grouping_sets(e.request_log()), "status")


def avg_latency(e: Entities) -> DataFrame:
    return metrics.avg_latency(e.request_log())


def latency_percentiles(e: Entities) -> DataFrame:
    return metrics.latency_percentiles(e.request_log())


def sliding_p95(e: Entities) -> DataFrame:
    return metrics.sliding_percentile(e.request_log()).select("method", "window_start", "window_end", "n", F.col("p95").alias("p95_s"))


def amount_defaults(e: Entities) -> DataFrame:
    """What the stock worker charges: total_amount, else amount, else 0, by the keys that a payload has."""
    turn = F.col("seq") % 4
    amount = F.col("amount").cast("string")
    fields = (
        F.when(turn == 0, F.concat(F.lit('"total_amount":'), amount, F.lit(',"amount":1.0,')))
        .when(turn == 1, F.concat(F.lit('"amount":'), amount, F.lit(",")))
        .when(turn == 2, F.lit(""))
        .otherwise(F.lit('"total_amount":null,"amount":1.0,'))
    )
    order = F.col("order_id").cast("string")
    body = F.concat(F.lit('{"event_type":"OrderCreated","payload":{'), fields, F.lit('"order_id":'), order, F.lit("}}"))
    sent = e.envelopes(False).where("event_type = 'OrderCreated'").select("seq", body.alias("body"))
    return bodies.parse(sent).select("seq", "order_id", "charge", "quarantine_reason")


def worker_throughput(e: Entities) -> DataFrame:
    return metrics.worker_throughput(dedupe.once_per_event(e.envelopes(), ARRIVAL))


# order-dependent


def idempotency_first_wins(e: Entities) -> DataFrame:
    return intake.idempotency_first_wins(e.requests())


def first_failure(e: Entities) -> DataFrame:
    lines = e.placed_items().withColumnRenamed("quantity", "asked")
    return intake.first_failure(lines, _tight(e), "pos")


def order_status(e: Entities) -> DataFrame:
    return saga.order_status(e.envelopes(), ARRIVAL)


def order_status_guarded(e: Entities) -> DataFrame:
    return saga.order_status(e.envelopes(), ARRIVAL, guarded=True)


def reserved_balance(e: Entities) -> DataFrame:
    order = ["changed_at", "order_id", "line", "supplier_id", "kind"]
    return inventory.reserved_balance(e.stock_changes(), order).select(
        "product_id", *order, "change", "reserved"
    )


def counter_rate(e: Entities) -> DataFrame:
    return metrics.counter_rate(e.counter_samples()).withColumnRenamed("tie", "event_id")


def latest_sample(e: Entities) -> DataFrame:
    gaps = e.counter_samples().withColumn("value", F.when(F.col("tie") % 3 != 0, F.col("value")))
    return metrics.latest_sample(gaps)


def admit_orders(e: Entities) -> DataFrame:
    lines = inventory.worker_lines(e.event_items(), e.stock(), aggregate_lines=True)
    return admission.admit(lines, "event_key", "product_id", ["arrival", "event_key"]).select(
        F.col("event_key").alias("order_id"), "accepted"
    )


def reserve_orders(e: Entities) -> DataFrame:
    return inventory.reserve(e.event_items(placed=True), e.stock(gappy=True)).withColumnRenamed(
        "event_key", "order_id"
    )


def intake_outcomes(e: Entities) -> DataFrame:
    return _texts(intake.take_orders(e.requests(), e.items(), e.gappy_products()), "order_id")


def status_transitions(e: Entities) -> DataFrame:
    return saga.status_transitions(e.envelopes(), ARRIVAL).select("order_id", "seq", "old_status", "new_status")


def first_payment(e: Entities) -> DataFrame:
    return payments.first_payment(_ledger(e)).select("order_id", "payment_id", "amount", "status")


# set operations and scalars


def workflow_events(e: Entities) -> DataFrame:
    rows = routing.addressed(e.envelopes())
    topics = [rows.where(F.col("exchange") == x) for x in ("inventory-events", "payment-events")]
    return routing.workflow_events(*topics).select("topic", "seq", "attempt", "event_type")


def payment_decisions(e: Entities) -> DataFrame:
    reserved = e.envelopes(redelivered=False).where("event_type = 'InventoryReserved'")
    return payments.decide(reserved).select("seq", "order_id", "amount", "status")


# time and streaming


def _ledger(e: Entities) -> DataFrame:
    return payments.ledger(e.envelopes().where("event_type = 'InventoryReserved'"), ARRIVAL)


def payment_ledger(e: Entities) -> DataFrame:
    return _ledger(e).select("payment_id", "event_id", "seq", "order_id", "amount", "status")


def payment_events(e: Entities) -> DataFrame:
    return payments.outcome_events(_ledger(e))


def duplicate_charges(e: Entities) -> DataFrame:
    return payments.duplicate_charges(payments.decide(_reserved_once(e)))


def _reserved_once(e: Entities) -> DataFrame:
    return dedupe.once_per_event(e.envelopes().where("event_type = 'InventoryReserved'"), ARRIVAL)


def compensations(e: Entities) -> DataFrame:
    failures = dedupe.once_per_event(e.envelopes().where("event_type = 'PaymentFailed'"), ARRIVAL)
    failures = failures.select("event_id", "order_id", *ARRIVAL)
    return inventory.compensations(failures, e.reservations(), ARRIVAL).select(
        "seq", "attempt", "order_id", "released_lines", "released_quantity", "emitted"
    )


def held_and_confirmed(e: Entities) -> DataFrame:
    return inventory.held_and_confirmed(e.reservations(), saga.order_status(e.envelopes(), ARRIVAL))


def orders_without_event(e: Entities) -> DataFrame:
    return intake.orders_without_event(e.named_orders(), e.envelopes(False)).select("order_id")


def request_rate(e: Entities) -> DataFrame:
    return metrics.request_rate(e.request_log())


def request_rate_by_endpoint(e: Entities) -> DataFrame:
    return metrics.request_rate(e.request_log(), labels=("method", "endpoint"))


def request_rate_by_status(e: Entities) -> DataFrame:
    return metrics.request_rate(e.request_log(), labels=("status",))


def sliding_red(e: Entities) -> DataFrame:
    """By service: what the gateway forwards is counted there and in the service behind it, not summed."""
    return metrics.sliding_red(e.request_log(), labels=("service",))


def family_histogram(e: Entities) -> DataFrame:
    return metrics.latency_histogram(e.request_log(), ("service", "method", "endpoint"))


def partial_updates(e: Entities) -> DataFrame:
    sparse = {c: F.when(F.col("id") % k != 0, F.col(c)) for c, k in (("price", 3), ("quantity", 4), ("name", 5))}
    return validation.checked_products(e.draft_products().withColumns(sparse), optional=True).select(
        "id", "faults", "status_code"
    )


def user_defaults(e: Entities) -> DataFrame:
    some = e.users().select("id", F.when(F.col("id") % 5 != 0, F.col("role")).alias("role"))
    return with_defaults(some, "users")


def request_durations(e: Entities) -> DataFrame:
    return e.request_log().select("request_id", duration_ms(F.col("duration_s")).alias("duration_ms"))


def append_products(e: Entities) -> DataFrame:
    """The catalog written in two appends, read back."""
    path, rows = run_dir(e.spark, "products"), e.products()
    tables.append(rows.where("quantity > 500"), path)
    tables.append(rows.where("NOT quantity > 500"), path)
    return tables.scan(e.spark, path, PRODUCTS)


def scraped_series(e: Entities) -> DataFrame:
    """Counter samples as a scrape leaves them, with the name of their series."""
    labels = F.map_from_arrays(F.array(F.lit("type"), F.lit("day")), F.array("series", F.to_date("ts").cast("string")))
    rows = e.counter_samples().select(
        "ts", F.lit("order-service").alias("job"), F.lit("events_total").alias("metric"), labels.alias("labels"),
        F.col("value").cast("double").alias("value"),
    )
    return samples.with_series(rows).select("ts", "series", "value")


def recent_window(e: Entities) -> DataFrame:
    return metrics.recent_window(e.request_log(), "INTERVAL 1 DAY").select("ts", "request_id", "endpoint", "status")


def error_rate_zero_filled(e: Entities) -> DataFrame:
    return metrics.error_rate_zero_filled(e.request_log())


BATCH: tuple[Query, ...] = (
    parse_envelopes, quarantine_counts, emit_order_created, round_trip_events, emit_inventory_events, emit_payment_events,
    round_trip_all, scan_products, parse_logs, render_logs,
    metrics_snapshot, seed_if_absent,
    lookup_keys, customer_public, validate_products, validate_requests, validate_emails, order_access,
    role_access, trace_defaults, log_severity, order_errors, dispatch_inventory,
    price_lines, order_documents, idempotent_replays, dedupe_events, orphan_events, release_reservations,
    route_events, saga_outcomes, apply_product_updates, delete_products, asof_with_ttl, trace_summary,
    register_unique, known_actors,
    requested_quantities, order_totals, reserved_by_product, available_stock, http_requests_total,
    latency_histogram, histogram_quantiles, business_counters, red_grouping_sets, avg_latency,
    latency_percentiles, worker_throughput, sliding_p95, amount_defaults, service_snapshots,
    idempotency_first_wins, first_failure, order_status, order_status_guarded, reserved_balance, counter_rate,
    latest_sample, admit_orders, reserve_orders, intake_outcomes, status_transitions, first_payment,
    workflow_events, payment_decisions,
    payment_ledger, payment_events, duplicate_charges, compensations, held_and_confirmed, orders_without_event,
    request_rate, request_rate_by_endpoint, request_rate_by_status, sliding_red, family_histogram, partial_updates,
    user_defaults, request_durations, append_products, scraped_series, recent_window, error_rate_zero_filled,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _plain(query(Entities(spark, sf_dir)))

    return {query.__name__: bind(query) for query in (*BATCH, *streams.STREAMS)}
