"""Small cases with known results, by area."""

import json
import re

import pytest
from pyspark.sql import functions as F

from ledgerbrook.functions import errors, scalars
from ledgerbrook.functions.defaults import with_defaults
from ledgerbrook.functions.scalars import topic_regex
from ledgerbrook.operators import access, catalog, dedupe, intake, inventory, logs, metrics, payments, routing, saga
from ledgerbrook.operators import validation
from ledgerbrook.plans.adapters import Entities
from ledgerbrook.sources import envelopes, lines, samples, tables

ORDER = ["at", "seq"]


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def events(spark, *rows):
    return frame(spark, "event_id string, event_type string, order_id bigint, amount double, at bigint, seq bigint", *rows)


# intake


@pytest.fixture
def shop(spark):
    return frame(
        spark,
        "id bigint, name string, price double, quantity bigint",
        (1, "Laptop", 1000.0, 10),
        (2, "Phone", 500.0, 10),
        (3, "Cable", 10.0, 3),
        (4, "Last", 7.0, 2),
    )


def _take(spark, shop, requests, items):
    return {
        r["request_id"]: r
        for r in intake.take_orders(
            frame(spark, "request_id bigint, customer_id bigint, idempotency_key string, arrival bigint", *requests),
            frame(spark, "request_id bigint, product_id bigint, quantity bigint", *items),
            shop,
        ).collect()
    }


def test_intake(spark, shop):
    requests = [(i, c, k, i) for i, c, k in [
        (1, 7, "a"), (2, 7, "b"), (3, 7, "c"), (4, 7, None), (5, 7, "d"), (6, 7, "a"), (7, 8, "a"), (8, 7, "b"),
        (9, 7, "e"), (10, 7, "f"), (11, 7, ""),
    ]]
    items = [
        (1, 1, 2), (2, 999999, 1), (3, 3, 2), (3, 3, 2), (4, 1, 1), (6, 2, 9), (7, 1, 1), (8, 2, 1),
        (9, 1, 0), (10, 999, 1), (10, 3, 50), (11, 4, 1),
    ]
    got = _take(spark, shop, requests, items)
    assert (got[1]["outcome"], got[1]["total_amount"], got[1]["status_code"]) == ("CREATED", 2000.0, 201)
    assert (got[2]["error_message"], got[2]["status_code"]) == ("Product 999999 was not found", 404)
    # repeated lines of a product are added up: 2 + 2 does not fit 3
    assert (got[3]["error_code"], got[3]["status_code"]) == ("INSUFFICIENT_INVENTORY", 409)
    assert (got[4]["outcome"], got[4]["error_code"]) == ("INVALID", "MISSING_KEY")
    assert got[5]["error_code"] == "NO_ITEMS"
    # the same key again: the first order, whatever the payload
    assert (got[6]["outcome"], got[6]["order_id"]) == ("REPLAYED", 1)
    # the same key of another customer is another order
    assert (got[7]["outcome"], got[7]["order_id"]) == ("CREATED", 7)
    # a failed request does not use its key up
    assert (got[8]["outcome"], got[8]["order_id"]) == ("CREATED", 8)
    assert got[9]["error_code"] == "BAD_QUANTITY"
    # two failing products: the lower id decides
    assert got[10]["error_message"] == "Insufficient inventory for product 3"
    # an empty key is a key
    assert got[11]["outcome"] == "CREATED"


def test_intake_takes_stock_once(spark, shop):
    got = _take(spark, shop, [(1, 7, "k", 1), (2, 7, "k", 2), (3, 7, "l", 3), (4, 7, "m", 4)],
                [(1, 4, 1), (2, 4, 1), (3, 4, 1), (4, 4, 1)])
    assert [got[i]["outcome"] for i in (1, 2, 3, 4)] == ["CREATED", "REPLAYED", "CREATED", "FAILED"]


def test_intake_empty(spark, shop):
    assert _take(spark, shop, [], []) == {}


def test_business_counters(spark):
    outcomes = frame(spark, "outcome string", ("CREATED",), ("REPLAYED",), ("FAILED",), ("INVALID",), ("CREATED",))
    made = frame(spark, "faults string", ("",), ("price",))
    assert values(intake.business_counters(outcomes, made), "metric", "value") == [
        ("orders_created_total", 2), ("orders_failed_total", 1), ("products_created_total", 1)
    ]


def test_orders_without_event(spark):
    orders = frame(spark, "order_id bigint", (1,), (2,))
    assert values(intake.orders_without_event(orders, events(spark, ("e", "OrderCreated", 1, None, 1, 1))), "order_id") == [(2,)]


# validation and access


def test_product_validation(spark):
    rows = frame(
        spark, "name string, description string, price double, quantity bigint",
        ("ok", "d", 1.0, 0), ("bad", "d", -100.0, 1), ("bad", "d", 0.0, -1), (None, None, 5.0, 1),
    )
    assert values(validation.checked_products(rows), "faults", "status_code") == [
        ("", 201), ("name,description", 422), ("price", 422), ("price,quantity", 422)
    ]
    partial = frame(spark, "name string, description string, price double, quantity bigint",
                    (None, None, 150.0, None), (None, None, -1.0, None))
    assert values(validation.checked_products(partial, optional=True), "faults", "status_code") == [("", 200), ("price", 422)]


def test_nested_requests(spark):
    rows = frame(
        spark, "n int, idempotency_key string, items array<struct<product_id bigint, quantity bigint>>",
        (1, "k", [(1, 2)]), (2, "k", []), (3, "k", [(1, 0)]), (4, None, [(1, 1)]), (5, "", [(1, 1)]), (6, "k", None),
    )
    got = rows.select("n", validation.request_ok().alias("ok"))
    assert values(got, "n", "ok") == [(1, True), (2, False), (3, False), (4, False), (5, True), (6, False)]


def test_access(spark):
    reads = frame(spark, "order_id bigint, actor bigint", (1, 7), (1, 8), (999999, 7))
    orders = frame(spark, "order_id bigint, customer_id bigint", (1, 7))
    assert values(access.order_access(reads, orders), "order_id", "actor", "status_code") == [
        (1, 7, 200), (1, 8, 403), (999999, 7, 404)
    ]
    roles = frame(spark, "role string", ("admin",), ("customer",), (None,))
    assert sorted(r[0] for r in roles.select(access.requires_role("admin")).collect()) == [200, 403, 403]


def test_trace_ids(spark):
    rows = frame(spark, "k string, request_header string, correlation_header string",
                 ("a", "req-123", "corr-456"), ("b", None, None), ("c", "", ""))
    got = {r["k"]: r for r in access.with_trace_ids(rows, "k").collect()}
    assert (got["a"]["request_id"], got["a"]["correlation_id"]) == ("req-123", "corr-456")
    assert got["b"]["correlation_id"] == got["b"]["request_id"] != got["b"]["edge_correlation_id"]
    assert len(got["c"]["request_id"]) == 36 and got["c"]["request_id"] != got["b"]["request_id"]


# catalog


def test_updates_and_deletes(spark, shop):
    updates = frame(spark, "product_id bigint, seq bigint, price double, quantity bigint",
                    (1, 1, 150.0, None), (1, 2, None, 5), (1, 3, 160.0, None), (77, 1, 1.0, 1))
    products = shop.withColumn("description", F.lit("d"))
    got = {r["id"]: r for r in catalog.apply_updates(products, updates).collect()}
    assert (got[1]["price"], got[1]["quantity"], got[1]["updated"]) == (160.0, 5, True)
    assert (got[2]["price"], got[2]["updated"]) == (500.0, False)
    assert values(catalog.missing_updates(products, updates), "product_id") == [(77,)]
    judged = catalog.judge_deletes(frame(spark, "product_id bigint", (1,), (2,), (99,)), products,
                                   frame(spark, "product_id bigint", (2,), (2,)))
    assert values(judged, "product_id", "outcome") == [(1, "DELETED"), (2, "BLOCKED"), (99, "MISSING")]
    assert values(catalog.delete_products(products, judged), "id") == [(2,), (3,), (4,)]


def test_repeated_products_judge_a_delete_once(spark):
    products = frame(spark, "id bigint", (1,), (1,), (2,))
    judged = catalog.judge_deletes(frame(spark, "product_id bigint", (1,), (2,), (9,)), products, frame(spark, "product_id bigint", (2,), (2,)))
    assert values(judged, "product_id", "outcome") == [(1, "DELETED"), (2, "BLOCKED"), (9, "MISSING")]


def test_unique_users(spark):
    rows = frame(spark, "seq bigint, email string", (1, "a@x.io"), (2, "a@x.io"), (3, "b@x.io"), (4, "old@x.io"))
    old = frame(spark, "email string", ("old@x.io",))
    assert values(catalog.register_unique(rows, old), "seq", "status_code") == [(1, 201), (2, 409), (3, 201), (4, 409)]


def test_seed(spark):
    stock = frame(spark, "product_id bigint, quantity bigint, reserved_quantity bigint", (1, 9, 4))
    seed = frame(spark, "product_id bigint, quantity bigint", (1, 100), (2, 50))
    assert values(catalog.seed_if_absent(stock, seed), "product_id", "quantity", "reserved_quantity") == [(1, 9, 4), (2, 50, 0)]


def test_lookup_ages(spark):
    reads = frame(spark, "id bigint, key bigint, s bigint", (1, 1, 10), (2, 1, 400), (3, 1, 401), (4, 1, 520), (5, 2, 10),
                  (6, 3, 700), (7, 3, 100000))
    versions = frame(spark, "id bigint, key bigint, s bigint, value double",
                     (1, 1, 100, 5.0), (2, 1, 500, 6.0), (3, 1, 510, None), (4, 3, 650, 8.0))
    to_ts = F.timestamp_seconds("s").alias("ts")
    got = catalog.asof_with_ttl(reads.select("id", "key", to_ts), versions.select("id", "key", to_ts, "value"), 300)
    assert [(r["id"], r["hit"], r["value"]) for r in got.orderBy("id").collect()] == [
        (1, False, None), (2, True, 5.0), (3, False, None), (4, False, None), (5, False, None),
        (6, True, 8.0), (7, False, None),
    ]


# events


def test_bodies(spark):
    good = {"event_id": "evt-1", "event_type": "PaymentCompleted", "occurred_at": "2024-01-01T00:00:00+00:00",
            "correlation_id": "c", "payload": {"order_id": 5, "amount": 2.5}}
    bodies = frame(spark, "body string", (json.dumps(good),), ("not json",), ('{"event_id":"x","payload":[]}',),
                   ('"text"',), ("{}",), (json.dumps({**good, "payload": {}, "order_id": 9}),))
    parsed = envelopes.parse(bodies)
    assert values(envelopes.good(parsed), "event_type", "order_id") == [("PaymentCompleted", 5), ("PaymentCompleted", 9)]
    assert values(envelopes.quarantine_counts(parsed), "quarantine_reason", "n") == [
        ("NO_TYPE", 1), ("UNDECODABLE", 1), ("WRONG_SHAPE", 2)
    ]


def test_publish_and_read_back(spark, tmp_path):
    rows = events(spark, ("evt-1", "OrderCreated", 1, 2.0, 1, 1), ("evt-2", "PaymentFailed", 2, 3.0, 2, 2)).withColumns(
        {"occurred_at": F.timestamp_seconds("at"), "correlation_id": F.lit("c")}
    )
    path = str(tmp_path / "topic")
    envelopes.write_published(envelopes.published(rows, F.struct("order_id", "amount")), path)
    back = envelopes.read_bodies(spark, path)
    assert values(back.select("exchange", "routing_key"), "exchange", "routing_key") == [
        ("order-events", "order.created"), ("payment-events", "payment.failed")
    ]
    assert values(envelopes.good(envelopes.parse(back)), "event_id", "order_id") == [("evt-1", 1), ("evt-2", 2)]
    stream = envelopes.stream_bodies(spark, path)
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, "id bigint, name string", (1, "a"))
    tables.append(rows, path)
    tables.append(rows, path)
    assert tables.scan(spark, path, "id bigint").count() == 2
    tables.replace(frame(spark, "id bigint, name string", (1, "a")), path)
    assert tables.scan(spark, path, "id bigint").count() == 1


def test_dedupe(spark):
    rows = events(spark, ("a", "X", 1, None, 2, 2), ("a", "X", 1, None, 1, 1), (None, "X", 1, None, 3, 3),
                  (None, "X", 1, None, 4, 4), ("", "X", 1, None, 5, 5), ("", "X", 1, None, 6, 6))
    once = dedupe.once_per_event(rows, ORDER)
    assert values(once, "seq") == [(1,), (3,), (4,), (5,), (6,)]
    marks = dedupe.markers(once, "order")
    left = dedupe.not_seen(rows.withColumn("consumer", F.lit("order")), marks)
    assert values(left, "seq") == [(3,), (4,)]


def test_routing(spark):
    table = [("one", "e", "a.*"), ("any", "e", "a.#"), ("tail", "e", "#.z"), ("all", "e", "#"), ("exact", "e", "a.b"),
             ("other", "f", "#"), ("mid", "e", "a.*.z")]
    rows = frame(spark, "exchange string, routing_key string", ("e", "a"), ("e", "a.b"), ("e", "a.b.z"), ("e", "axb"), ("e", "z"))
    assert values(routing.route(rows, table), "routing_key", "queue") == [
        ("a", "all"), ("a", "any"), ("a.b", "all"), ("a.b", "any"), ("a.b", "exact"), ("a.b", "one"),
        ("a.b.z", "all"), ("a.b.z", "any"), ("a.b.z", "mid"), ("a.b.z", "tail"), ("axb", "all"),
        ("z", "all"), ("z", "tail"),
    ]


@pytest.mark.parametrize(
    "pattern, yes, no",
    [("#.*", ["a", "a.b", "a.b.c"], []), ("#.#", ["a", "a.b"], []), ("*.*", ["a.b"], ["a", "a.b.c"]),
     ("a.#.b", ["a.b", "a.x.b", "a.x.y.b"], ["a", "ab", "a.bb"]), ("a.#", ["a", "a.b.c"], ["ab"]), ("#.b", ["b", "a.b"], ["ab"]),
     ("a+.(b|c)", ["a+.(b|c)"], ["aa.b"]), ("#", ["", "a", "a.b"], []), ("a.*.#.d", ["a.b.d", "a.b.c.d"], ["a.d"])],
)
def test_topic_patterns(pattern, yes, no):
    for keys, want in ((yes, True), (no, False)):
        assert [bool(re.search(topic_regex(pattern), k)) for k in keys] == [want] * len(keys)


def test_routing_needs_no_exchange(spark):
    rows = routing.addressed(Entities(spark, "/root/testdata/sf0.001").envelopes())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        plan = routing.route(rows)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" not in plan


def test_dispatch(spark):
    rows = frame(spark, "event_type string, routing_key string", ("PaymentFailed", None), ("X", "payment.failed"), (None, None))
    assert [r["handler"] for r in routing.dispatch(rows).collect()] == ["release", "release", "reserve"]


# saga


@pytest.mark.parametrize(
    "kind, status",
    [("InventoryReserved", "PAYMENT_PENDING"), ("PaymentCompleted", "CONFIRMED"), ("PaymentFailed", "CANCELLED"),
     ("InventoryRejected", "CANCELLED"), ("SomethingHappened", "PENDING"), ("InventoryReleased", "PENDING")],
)
def test_transitions(spark, kind, status):
    folded = saga.order_status(events(spark, ("e", kind, 1, None, 1, 1)), ORDER)
    assert values(saga.current_status(frame(spark, "order_id bigint", (1,)), folded), "status") == [(status,)]


def test_late_event_moves_status_back(spark):
    rows = events(spark, ("a", "PaymentCompleted", 1, None, 1, 1), ("b", "InventoryReserved", 1, None, 2, 2),
                  ("a", "PaymentCompleted", 1, None, 3, 3), ("c", "PaymentFailed", 0, None, 4, 4))
    assert values(saga.order_status(rows, ORDER), "order_id", "status") == [(1, "PAYMENT_PENDING")]
    assert values(saga.order_status(rows, ORDER, guarded=True), "order_id", "status") == [(1, "CONFIRMED")]
    assert values(saga.status_transitions(rows, ORDER), "old_status", "new_status") == [
        ("CONFIRMED", "PAYMENT_PENDING"), ("PENDING", "CONFIRMED")
    ]
    assert values(saga.orphan_events(rows, frame(spark, "order_id bigint", (2,)), ORDER), "matched") == [(False,), (False,)]


# payments and stock


def test_payments(spark):
    rows = events(spark, ("a", "InventoryReserved", 1, 250.0, 1, 1), ("b", "InventoryReserved", 102, 9999.0, 2, 2),
                  ("a", "InventoryReserved", 1, 250.0, 3, 3), ("c", "InventoryReserved", 1, 10.0, 4, 4),
                  ("d", "InventoryReserved", 5, None, 5, 5), ("e", "InventoryReserved", 0, 5.0, 6, 6))
    book = payments.ledger(rows, ORDER)
    assert values(book, "payment_id", "order_id", "amount", "status") == [
        (1, 1, 250.0, "COMPLETED"), (2, 102, 9999.0, "FAILED"), (3, 1, 10.0, "COMPLETED"), (4, 5, 0.0, "FAILED")
    ]
    assert values(payments.duplicate_charges(book), "order_id", "n_payments") == [(1, 2)]
    assert values(payments.first_payment(book).where("order_id = 1"), "payment_id") == [(1,)]
    told = payments.outcome_events(book.withColumn("correlation_id", F.lit("c")))
    assert values(told.where("order_id = 102"), "event_type", "reason") == [("PaymentFailed", "Payment declined")]
    lenient = payments.decide(rows, rule=F.lit("COMPLETED"))
    assert {r["status"] for r in lenient.collect()} == {"COMPLETED"}


def test_release(spark):
    stock = frame(spark, "product_id bigint, quantity bigint, reserved_quantity bigint", (1, 100, 3), (2, 50, 1))
    held = frame(spark, "order_id bigint, product_id bigint, quantity bigint, status string",
                 (101, 1, 3, "RESERVED"), (101, 2, 5, "RESERVED"), (101, 1, 9, "RELEASED"), (102, 1, 1, "RESERVED"))
    failed = frame(spark, "order_id bigint", (101,), (101,))
    assert values(inventory.release(stock, held, failed), "product_id", "reserved_quantity", "released") == [(1, 0, 3), (2, 0, 5)]
    after = inventory.released_reservations(held, failed)
    assert values(after.where("status = 'RESERVED'"), "order_id") == [(102,)]
    assert inventory.release(stock, after, failed).agg(F.sum("released")).first()[0] == 0
    rows = events(spark, ("a", "PaymentFailed", 101, None, 1, 1), ("b", "PaymentFailed", 101, None, 2, 2),
                  ("c", "PaymentFailed", 0, None, 3, 3), ("d", "PaymentFailed", 7, None, 4, 4))
    assert values(inventory.compensations(rows, held, ORDER), "seq", "released_quantity", "emitted") == [
        (1, 8, "InventoryReleased"), (2, 0, "InventoryReleased"), (3, 0, "InventoryReleased"), (4, 0, "InventoryReleased")
    ]


def test_reservations_and_defaults(spark):
    held = frame(spark, "order_id bigint, status string", (1, "RESERVED"), (1, "RELEASED"), (2, "RESERVED"))
    one = frame(spark, "order_id bigint", (1,))
    assert inventory.reservations_of(held, one).count() == 2
    assert inventory.reservations_of(held, one, "RESERVED").count() == 1
    rows = with_defaults(frame(spark, "id bigint, status string", (1, None), (2, "CONFIRMED")), "orders")
    assert values(rows, "id", "status", "total_amount") == [(1, "PENDING", 0.0), (2, "CONFIRMED", 0.0)]
    seed = frame(spark, "product_id bigint, quantity bigint", *catalog.FIRST_STOCK)
    assert values(catalog.stock_rows(seed), "product_id", "quantity", "reserved_quantity") == [(1, 100, 0), (2, 50, 0)]


# metrics and logs


def test_samples_and_lines(spark, tmp_path):
    rows = frame(spark, "s bigint, job string, metric string, labels map<string,string>, value double",
                 (0, "api", "up", {"b": "2", "a": "1"}, 1.0), (5, "api", "up", {"a": "1", "b": "2"}, 0.0))
    path = str(tmp_path / "samples")
    rows.select(F.timestamp_seconds("s").alias("ts"), "job", "metric", "labels", "value").write.parquet(path)
    named = samples.with_series(samples.read(spark, path))
    assert {r["series"] for r in named.collect()} == {'api:up{a="1",b="2"}'}
    assert metrics.latest_sample(named.withColumn("tie", F.lit(0))).first()["value"] == 0.0
    lines.write(frame(spark, "line string", ("x 1.0",)), str(tmp_path / "lines"))
    assert values(lines.read(spark, str(tmp_path / "lines")), "line") == [("x 1.0",)]



def test_histogram_and_quantile(spark):
    log = frame(spark, "method string, endpoint string, duration_s double", *[("GET", "/", x / 100) for x in range(1, 101)],
                ("GET", "/slow", 60.0))
    table = metrics.latency_histogram(log)
    got = {r["le"]: r["value"] for r in table.where("endpoint = '/'").collect()}
    assert (got["0.005"], got["0.05"], got["0.5"], got["1.0"], got["+Inf"], len(got)) == (0, 5, 50, 100, 100, 15)
    assert values(metrics.histogram_quantile(table, 0.5), "endpoint", "quantile_value") == [("/", 0.5), ("/slow", 10.0)]
    exact = metrics.latency_percentiles(log.where("endpoint = '/'"), rows_per_slice=10).first()
    assert (exact["p50"], exact["p95"]) == (0.505, 0.9505)
    approx = metrics.latency_percentiles_approx(log.where("endpoint = '/'")).first()
    assert approx["p50"] == pytest.approx(0.5, abs=0.02)


def test_counter_reset(spark):
    rows = frame(spark, "series string, s bigint, tie bigint, value bigint",
                 ("a", 0, 1, 10), ("a", 30, 2, 16), ("a", 59, 3, 4), ("a", 90, 4, 4), ("a", 3600, 5, 5), ("a", 3610, 6, 8))
    samples = rows.select("series", F.timestamp_seconds("s").alias("ts"), "tie", "value")
    for per_slice in (10**6, 2):
        got = metrics.counter_rate(samples, rows_per_slice=per_slice).orderBy("tie").collect()
        assert [r["increase"] for r in got] == [0, 6, 4, 0, 1, 3]
        assert [round(r["rate"] * 60) for r in got] == [0, 6, 10, 4, 1, 4]
    assert values(metrics.latest_sample(samples), "series", "value") == [("a", 8)]


def test_rates(spark):
    log = frame(spark, "s bigint, status bigint", (0, 200), (2, 500), (61, 200), (200, 503)).withColumn("ts", F.timestamp_seconds("s"))
    rates = {r["window_start"].second + 60 * r["window_start"].minute: r["n"]
             for r in metrics.request_rate(log).where("window_start >= '1970-01-01'").collect()}
    assert rates[0] == 2 and rates[5] == 1 and rates[200] == 1 and 65 not in rates
    filled = metrics.error_rate_zero_filled(log).orderBy("window_start").collect()
    assert [r["n"] for r in filled] == [1, 0, 0, 1]
    assert metrics.recent_window(log, "INTERVAL 2 MINUTES").count() == 1


def test_log_lines(spark):
    record = frame(
        spark,
        "timestamp string, level string, service string, logger string, message string, request_id string, "
        "correlation_id string, event string, order_id bigint, product_id bigint, event_id string",
        ("2024", "INFO", "order-service", "l", "Test message", "req-123", "corr-456", "test_event", None, None, "evt"),
        ("2024", "INFO", "payment-service", "l", "m", "req-123", "corr-456", None, 7, 3, "evt"),
    )
    first, second = [json.loads(r["line"]) for r in logs.render(record).collect()]
    assert first["request_id"] == "req-123" and "event_id" not in first and "order_id" not in first
    assert second == {"timestamp": "2024", "level": "INFO", "service": "payment-service", "logger": "l", "message": "m",
                      "correlation_id": "corr-456", "order_id": 7, "event_id": "evt"}
    wide = record.withColumn("extra", F.map_from_arrays(F.array(F.lit("message"), F.lit("duration_ms")),
                                                       F.array(F.lit("won").cast("variant"), F.lit(1.5).cast("variant"))))
    line = json.loads(logs.render(wide, "extra").first()["line"])
    assert (line["message"], line["duration_ms"], line["level"]) == ("won", 1.5, "INFO")
    assert [r["event_id"] for r in logs.parse(logs.render(record)).collect()] == [None, "evt"]
    levels = frame(spark, "level string", ("DEBUG",), ("ERROR",), ("odd",), ("warning",))
    assert values(logs.at_least(levels, "WARNING"), "level") == [("ERROR",), ("warning",)]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.payment_status(F.lit(-1.0)).alias("negative"),
        scalars.payment_status(F.lit(250.0)).alias("fine"),
        scalars.amount_or_default(F.lit(None).cast("double")).alias("amount"),
        scalars.route_template(F.lit("/products/12/x/7")).alias("route"),
        scalars.duration_ms(F.lit(0.0123456)).alias("ms"),
        errors.envelope(F.lit("ORDER_NOT_FOUND"), F.lit(9)).alias("error"),
    ).first()
    assert (row["negative"], row["fine"], row["amount"]) == ("FAILED", "COMPLETED", 0.0)
    assert (row["route"], row["ms"]) == ("/products/{id}/x/{id}", 12.35)
    assert row["error"]["message"] == "Order 9 was not found"
