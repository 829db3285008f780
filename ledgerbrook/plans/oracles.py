"""The same queries in SQL over the raw tables, for the equality check."""

from __future__ import annotations

import re

# adapters as common table expressions, each after the ones it uses
ADAPTERS = {
    "ev": "SELECT *, CAST(props->>'k' AS BIGINT) AS k FROM events",
    "products": """SELECT p_partkey AS id, p_name AS name, p_brand || ' ' || p_type AS description,
        p_retailprice AS price, CAST(p_size AS BIGINT) * 20 AS quantity FROM part""",
    "gappy": "SELECT * REPLACE (CASE WHEN id % 97 = 96 THEN id + 1000000000 ELSE id END AS id) FROM products",
    "tight": "SELECT id, quantity / 20 AS quantity FROM gappy",
    "levels": "SELECT id AS product_id, quantity, id % 200 AS reserved_quantity FROM products",
    "drafts": """SELECT id, CASE WHEN id % 31 <> 30 THEN name END AS name, description, price - 950 AS price,
        quantity - 100 AS quantity,
        concat_ws(',', CASE WHEN id % 31 = 30 THEN 'name' END, CASE WHEN price - 950 <= 0 THEN 'price' END,
            CASE WHEN quantity - 100 < 0 THEN 'quantity' END) AS faults FROM products""",
    "requests": """SELECT o_orderkey AS request_id, o_custkey AS customer_id,
        CASE WHEN o_orderkey % 50 <> 49
            THEN o_orderpriority || '-' || CAST(year(o_orderdate) AS VARCHAR) END AS idempotency_key,
        o_orderdate AS arrival FROM orders""",
    "items": """SELECT l_orderkey AS request_id,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
        l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    "rolled": """SELECT request_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity,
        max(quantity) AS largest, count(*) AS n_lines FROM items GROUP BY ALL""",
    "env": """SELECT CASE WHEN event_id % 211 <> 0 THEN 'evt-' || event_id END AS event_id, event_id AS seq,
        CASE WHEN k % 20 = 0 THEN 'InventoryReleased' WHEN k % 20 = 1 THEN 'SomethingHappened'
            WHEN event_type = 'signup' THEN 'OrderCreated' WHEN event_type = 'view' THEN 'InventoryReserved'
            WHEN event_type = 'click' THEN 'PaymentCompleted' WHEN event_type = 'error' THEN 'PaymentFailed'
            ELSE 'InventoryRejected' END AS event_type,
        ts + to_hours(attempt) AS occurred_at, 'corr-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS correlation_id,
        user_id * 10 + event_id % 10 AS order_id,
        CASE WHEN event_id % 37 = 0 THEN 9999.0 WHEN event_id % 41 = 0 THEN 0.0 ELSE value END AS amount,
        CAST(attempt AS BIGINT) AS attempt
        FROM ev, (VALUES (0), (1)) AS tries(attempt) WHERE attempt = 0 OR event_id % 7 = 0""",
    "once": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id
            ORDER BY occurred_at, seq, attempt) AS nth FROM env) WHERE event_id IS NULL OR nth = 1""",
    "changes": """SELECT *, CASE event_type WHEN 'InventoryReserved' THEN 'PAYMENT_PENDING'
            WHEN 'InventoryRejected' THEN 'CANCELLED' WHEN 'PaymentCompleted' THEN 'CONFIRMED'
            WHEN 'PaymentFailed' THEN 'CANCELLED' END AS new_status
        FROM once WHERE order_id <> 0
            AND event_type IN ('InventoryReserved', 'InventoryRejected', 'PaymentCompleted', 'PaymentFailed')""",
    "statuses": """SELECT order_id, arg_max(new_status, (occurred_at, seq, attempt)) AS status,
        count(*) AS n_changes FROM changes GROUP BY order_id""",
    "known": "SELECT DISTINCT order_id FROM env WHERE event_type = 'OrderCreated'",
    "addressed": """SELECT *, CASE WHEN event_type = 'OrderCreated' THEN 'order-events'
            WHEN event_type LIKE 'Inventory%' THEN 'inventory-events'
            WHEN event_type LIKE 'Payment%' THEN 'payment-events' END AS exchange,
        CASE event_type WHEN 'OrderCreated' THEN 'order.created' WHEN 'InventoryReserved' THEN 'inventory.reserved'
            WHEN 'InventoryRejected' THEN 'inventory.rejected' WHEN 'InventoryReleased' THEN 'inventory.released'
            WHEN 'PaymentCompleted' THEN 'payment.completed' WHEN 'PaymentFailed' THEN 'payment.failed'
            END AS routing_key FROM env""",
    "bindings": """SELECT * FROM (VALUES ('order-created', 'order-events', 'order\\.created', 'inventory'),
        ('inventory-payment-failed-queue', 'payment-events', 'payment\\.failed', 'inventory'),
        ('payment-inventory-queue', 'inventory-events', 'inventory\\.reserved', 'payment'),
        ('inventory-results', 'inventory-events', 'inventory\\.[^.]+', 'order'),
        ('inventory-results', 'payment-events', 'payment\\.[^.]+', 'order')) AS t(queue, exchange, rx, consumer)""",
    "routed": """SELECT a.*, b.queue, b.consumer FROM addressed a JOIN bindings b
        ON a.exchange = b.exchange AND regexp_full_match(a.routing_key, b.rx)""",
    "log": """SELECT ts, 'req-' || event_id AS request_id,
        'corr-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS correlation_id,
        CASE WHEN event_id % 2 = 0 THEN 'gateway' ELSE 'order-service' END AS service,
        CASE WHEN event_type IN ('click', 'view') THEN 'GET' WHEN event_type = 'error' THEN 'PUT'
            ELSE 'POST' END AS method,
        CASE WHEN event_type IN ('signup', 'purchase') THEN '/orders/' ELSE '/products/' || (k % 10) END AS endpoint,
        CAST(CASE WHEN event_type = 'error' THEN 500 + k % 4 WHEN event_type = 'signup' THEN 201
            WHEN event_type = 'purchase' AND k % 5 = 0 THEN 409 ELSE 200 END AS BIGINT) AS status,
        value / 100 AS duration_s FROM ev""",
    "records": """SELECT event_id AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
        CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' WHEN 'view' THEN 'DEBUG'
            ELSE 'INFO' END AS level,
        CASE event_id % 4 WHEN 0 THEN 'gateway' WHEN 1 THEN 'order-service' WHEN 2 THEN 'inventory-service'
            ELSE 'payment-service' END AS service,
        service || '.http' AS logger, 'handled ' || event_type AS message,
        CASE WHEN event_id % 4 < 2 THEN 'req-' || event_id END AS request_id,
        'corr-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS correlation_id,
        CASE WHEN k % 2 = 0 THEN 'http_request' END AS event,
        CASE WHEN event_id % 4 > 0 THEN event_id * 2 END AS order_id,
        CASE WHEN event_id % 4 = 1 AND k % 3 = 0 THEN k END AS product_id,
        CASE WHEN event_id % 4 > 1 THEN 'evt-' || event_id END AS event_id FROM ev""",
    "samples": """SELECT ts, event_type AS series, event_id AS tie, count(*) OVER (
        PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value
        FROM events""",
    "registrations": """SELECT seq, c_custkey AS customer_id,
        replace(lower(c_name), '#', '.') || '@example.com' AS email,
        CASE WHEN c_custkey % 100 = 0 THEN 'admin' ELSE 'customer' END AS role
        FROM (SELECT *, c_custkey AS seq FROM customer UNION ALL
            SELECT *, c_custkey + 1000000 FROM customer WHERE c_custkey % 10 = 0)""",
    "users": "SELECT customer_id AS id, email, role FROM registrations WHERE seq = customer_id",
    "actions": """SELECT event_id AS action_id, user_id * 20 AS actor_id,
        CASE WHEN user_id % 10 = 0 THEN 'admin' ELSE 'customer' END AS role FROM events""",
    "reservations": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
        CAST(l_quantity AS BIGINT) AS quantity,
        CASE WHEN l_orderkey % 10 = 0 THEN 'RELEASED' ELSE 'RESERVED' END AS status
        FROM lineitem""",
    "held": """SELECT product_id, CAST(sum(quantity) AS BIGINT) AS reserved, count(*) AS n_reservations
        FROM reservations WHERE status = 'RESERVED' GROUP BY product_id""",
    "priced": """SELECT i.*, p.price AS unit_price, p.id IS NOT NULL AS found,
        CAST(CAST(p.price AS DECIMAL(18,2)) * i.quantity AS DOUBLE) AS line_total
        FROM items i LEFT JOIN gappy p ON p.id = i.product_id""",
    "ledger": """SELECT row_number() OVER (ORDER BY occurred_at, seq, attempt) AS payment_id, event_id, seq,
        correlation_id, order_id, amount, attempt, occurred_at,
        CASE WHEN amount <= 0 OR amount = 9999.0 THEN 'FAILED' ELSE 'COMPLETED' END AS status
        FROM once WHERE event_type = 'InventoryReserved' AND order_id <> 0""",
    "documents_of": """SELECT r.request_id AS id, customer_id,
        CAST(sum(CAST(round(p.price * 100) AS BIGINT) * i.quantity) AS BIGINT) AS total_cents,
        '[' || string_agg('{"product_id":' || i.product_id || ',"quantity":' || i.quantity || '}',
            ',' ORDER BY pos) || ']' AS short_items,
        '[' || string_agg('{"product_id":' || i.product_id || ',"quantity":' || i.quantity || ',"unit_cents":'
            || CAST(round(p.price * 100) AS BIGINT) || '}', ',' ORDER BY pos) || ']' AS long_items
        FROM requests r JOIN items i USING (request_id) JOIN products p ON p.id = i.product_id GROUP BY ALL""",
    "buckets": """SELECT * FROM (VALUES ('0.005', 0.005), ('0.01', 0.01), ('0.025', 0.025), ('0.05', 0.05),
        ('0.075', 0.075), ('0.1', 0.1), ('0.25', 0.25), ('0.5', 0.5), ('0.75', 0.75), ('1.0', 1.0), ('2.5', 2.5),
        ('5.0', 5.0), ('7.5', 7.5), ('10.0', 10.0), ('+Inf', 1e300)) AS t(le, bound)""",
    "histogram": """SELECT method, endpoint, le, any_value(bound) AS bound,
        count(*) FILTER (duration_s <= CAST(bound AS DOUBLE)) AS value, count(*) AS count,
        CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS DOUBLE) AS sum
        FROM log, buckets GROUP BY method, endpoint, le""",
    "checked": """SELECT r.*, coalesce(n, 0) AS n_items,
        CASE WHEN idempotency_key IS NULL THEN 'MISSING_KEY' WHEN n IS NULL THEN 'NO_ITEMS'
            WHEN least_quantity <= 0 THEN 'BAD_QUANTITY' END AS error_code
        FROM requests r LEFT JOIN (SELECT request_id, count(*) AS n, min(quantity) AS least_quantity
            FROM items GROUP BY request_id) USING (request_id)""",
    "lines_intake": """SELECT request_id AS unit, 'p' || product_id AS res, arrival AS t,
            r.quantity AS test, r.quantity AS addq, p.quantity AS cap
        FROM rolled r JOIN checked c USING (request_id) LEFT JOIN gappy p ON p.id = r.product_id
        WHERE error_code IS NULL
        UNION ALL
        SELECT request_id, concat_ws(':', 'k', customer_id, idempotency_key), arrival, 1, 1, 1
        FROM checked WHERE error_code IS NULL""",
    "lines_admit": """SELECT request_id AS unit, product_id AS res, arrival AS t, r.quantity AS test,
            r.quantity AS addq, p.quantity AS cap
        FROM rolled r JOIN requests USING (request_id) LEFT JOIN products p ON p.id = r.product_id""",
    "lines_reserve": """SELECT request_id AS unit, product_id AS res, arrival AS t, r.largest AS test,
            r.quantity AS addq, p.quantity AS cap
        FROM rolled r JOIN requests USING (request_id) LEFT JOIN gappy p ON p.id = r.product_id""",
    "charges": """SELECT o_orderkey AS unit, o_orderdate AS t,
        CASE WHEN o_orderkey % 37 = 0 OR o_totalprice <= 0 OR o_totalprice = 9999.0
            THEN 'FAILED' ELSE 'COMPLETED' END AS pay FROM orders""",
    "lines_saga": """SELECT request_id AS unit, product_id AS res, arrival AS t, r.largest AS test,
            r.quantity AS addq, p.quantity AS cap
        FROM rolled r JOIN requests USING (request_id) LEFT JOIN products p ON p.id = r.product_id
        UNION ALL
        SELECT request_id, product_id, arrival + INTERVAL 1 HOUR, NULL, -r.quantity, p.quantity
        FROM rolled r JOIN requests USING (request_id) JOIN charges c ON c.unit = request_id
            LEFT JOIN products p ON p.id = r.product_id
        WHERE pay = 'FAILED'""",
    "slices": """SELECT min(epoch(o_orderdate))::BIGINT AS low,
        (max(epoch(o_orderdate))::BIGINT - min(epoch(o_orderdate))::BIGINT) // 2 + 1 AS width FROM orders""",
    "lines_chain": """SELECT request_id AS unit, product_id AS res, arrival AS t, r.largest AS test,
            r.quantity AS addq, p.quantity AS cap
        FROM rolled r JOIN requests USING (request_id) LEFT JOIN products p ON p.id = r.product_id
        UNION ALL
        SELECT request_id, product_id, make_timestamp((low + ((epoch(arrival)::BIGINT - low) // width + 1) * width)
            * 1000000 - 500000), NULL, -r.quantity, p.quantity
        FROM rolled r JOIN requests USING (request_id) JOIN charges c ON c.unit = request_id
            LEFT JOIN products p ON p.id = r.product_id, slices
        WHERE pay = 'FAILED'""",
    "intake": """SELECT c.*, v.accepted, h.request_id AS holder,
            (h.arrival, h.request_id) <= (c.arrival, c.request_id) AS answered,
            f.product_id AS bad_product, f.code AS bad_code, worth
        FROM checked c
        LEFT JOIN verdicts v ON v.unit = c.request_id
        LEFT JOIN (SELECT customer_id, idempotency_key, arrival, request_id FROM checked JOIN verdicts
            ON unit = request_id AND accepted) h
            ON h.customer_id = c.customer_id AND h.idempotency_key = c.idempotency_key AND v.unit IS NOT NULL
        LEFT JOIN (
            SELECT unit, arg_min(product_id, product_id) AS product_id, arg_min(code, product_id) AS code FROM (
                SELECT unit, accepted, CAST(substr(res, 2) AS BIGINT) AS product_id,
                    CASE WHEN cap IS NULL THEN 'PRODUCT_NOT_FOUND'
                        WHEN test > cap - coalesce(sum(CASE WHEN accepted THEN addq ELSE 0 END) OVER (
                            PARTITION BY res ORDER BY t, unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                        THEN 'INSUFFICIENT_INVENTORY' END AS code
                FROM lines_intake JOIN verdicts USING (unit) WHERE res LIKE 'p%')
            WHERE NOT accepted AND code IS NOT NULL GROUP BY unit) f ON f.unit = c.request_id
        LEFT JOIN (SELECT request_id, CAST(sum(CAST(price AS DECIMAL(18,2)) * r.quantity) AS DOUBLE) AS worth
            FROM rolled r JOIN gappy p ON p.id = r.product_id GROUP BY request_id) w ON w.request_id = c.request_id""",
    "outcomes": """SELECT request_id, CASE WHEN error_code IS NOT NULL THEN 'INVALID' WHEN accepted THEN 'CREATED'
            WHEN answered THEN 'REPLAYED' ELSE 'FAILED' END AS outcome, * EXCLUDE (request_id) FROM intake""",
}

# the bounds-tightening rounds of the admission, one recursion step per round
ROUNDS = """rounds AS (
    SELECT 0 AS r, unit, res, t, test, addq, cap, 0 AS st FROM {lines}
    UNION ALL
    SELECT r + 1, unit, res, t, test, addq, cap,
        CASE WHEN st <> 0 THEN st WHEN bool_or(fails) OVER (PARTITION BY unit) THEN -1
            WHEN bool_and(fits) OVER (PARTITION BY unit) THEN 1 ELSE 0 END
    FROM (SELECT *, bool_or(st = 0) OVER () AS more,
            test IS NULL OR coalesce(up + test <= cap, false) AS fits,
            test IS NOT NULL AND (cap IS NULL OR lo + test > cap) AS fails
        FROM (SELECT *,
                coalesce(sum(CASE WHEN st >= 0 THEN addq ELSE 0 END) OVER w, 0) AS up,
                coalesce(sum(CASE WHEN st = 1 THEN addq ELSE 0 END) OVER w, 0) AS lo
            FROM rounds
            WINDOW w AS (PARTITION BY res ORDER BY t, unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
    WHERE more),
verdicts AS (SELECT unit, bool_and(st = 1) AS accepted FROM rounds
    WHERE r = (SELECT max(r) FROM rounds) GROUP BY unit)"""

BODIES = {
    "parse_envelopes": """SELECT event_id, event_type, occurred_at, correlation_id, order_id, amount FROM env
        WHERE seq % 101 <> 0 AND seq % 103 <> 0""",
    "quarantine_counts": """SELECT CASE WHEN seq % 101 = 0 THEN 'UNDECODABLE' ELSE 'WRONG_SHAPE' END
        AS quarantine_reason, count(*) AS n FROM env WHERE seq % 101 = 0 OR seq % 103 = 0 GROUP BY 1""",
    "emit_order_created": """SELECT 'order-events' AS exchange, 'order.created' AS routing_key,
        '{"event_id":"order-' || id || '","event_type":"OrderCreated","occurred_at":"2024-01-01T00:00:00.000000+00:00",'
        || '"correlation_id":"corr-' || id || '","payload":{"order_id":' || id || ',"customer_id":' || customer_id
        || ',"total_amount":' || CAST(total_cents / 100 AS DECIMAL(18,2)) || ',"items":' || short_items || '}}' AS body
        FROM documents_of WHERE id IN (SELECT request_id FROM outcomes WHERE outcome = 'CREATED')""",
    "scan_products": "SELECT * FROM products",
    "parse_logs": """SELECT * EXCLUDE (seq) REPLACE (CAST(order_id AS VARCHAR) AS order_id,
        CAST(product_id AS VARCHAR) AS product_id) FROM records""",
    "render_logs": """SELECT seq, '{' || concat_ws(',',
        '"timestamp":"' || timestamp || '"', '"level":"' || level || '"', '"service":"' || service || '"',
        '"logger":"' || logger || '"', CASE WHEN seq % 10 <> 0 THEN '"message":"' || message || '"' END,
        '"request_id":"' || request_id || '"', '"correlation_id":"' || correlation_id || '"',
        '"event":"' || event || '"', '"order_id":' || order_id, '"product_id":' || product_id,
        '"event_id":"' || event_id || '"', '"method":"GET"', '"status_code":' || (seq % 5 + 200),
        CASE WHEN seq % 10 = 0 THEN '"message":"overlaid"' END) || '}' AS line FROM records""",
    "metrics_snapshot": """SELECT 'http_requests_total{endpoint="' || endpoint || '",method="' || method
            || '",status="' || status || '"} ' || count(*) || '.0' AS line FROM log GROUP BY method, endpoint, status
        UNION ALL SELECT 'http_request_duration_seconds_bucket{endpoint="' || endpoint || '",le="' || le
            || '",method="' || method || '"} ' || value || '.0' FROM histogram
        UNION ALL SELECT 'http_request_duration_seconds_count{endpoint="' || endpoint || '",method="' || method
            || '"} ' || count(*) || '.0' FROM log GROUP BY method, endpoint
        UNION ALL SELECT 'http_request_duration_seconds_sum{endpoint="' || endpoint || '",method="' || method
            || '"} ' || CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS VARCHAR) FROM log GROUP BY method, endpoint""",
    "seed_if_absent": """SELECT id AS product_id, quantity, CAST(0 AS BIGINT) AS reserved_quantity FROM gappy
        UNION ALL SELECT id, 100, 0 FROM products WHERE id NOT IN (SELECT id FROM gappy)""",
    "lookup_keys": """SELECT action_id, actor_id, id IS NOT NULL AS found, email
        FROM actions LEFT JOIN users ON id = actor_id""",
    "customer_public": "SELECT id, email, role FROM users",
    "validate_products": """SELECT id, faults, CAST(CASE WHEN faults = '' THEN 201 ELSE 422 END AS BIGINT)
        AS status_code FROM drafts""",
    "validate_requests": """SELECT request_id, n AS n_items, error_code,
        CAST(CASE WHEN error_code IS NULL THEN 201 ELSE 422 END AS BIGINT) AS status_code
        FROM (SELECT request_id, count(product_id) AS n,
                CASE WHEN any_value(idempotency_key) IS NULL THEN 'MISSING_KEY'
                    WHEN count(product_id) = 0 THEN 'NO_ITEMS'
                    WHEN min(quantity - 1) <= 0 THEN 'BAD_QUANTITY' END AS error_code
            FROM requests LEFT JOIN items USING (request_id) GROUP BY request_id)""",
    "validate_emails": """SELECT seq, email, regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') AS valid
        FROM (SELECT seq, CASE WHEN customer_id % 13 = 0 THEN replace(email, '@', '') ELSE email END AS email
            FROM registrations)""",
    "order_access": """SELECT read_id, order_id, CAST(actor AS VARCHAR) AS actor,
        CAST(CASE WHEN o_orderkey IS NULL THEN 404 WHEN actor = o_custkey THEN 200 ELSE 403 END AS BIGINT)
            AS status_code,
        CASE WHEN o_orderkey IS NULL THEN 'ORDER_NOT_FOUND' WHEN actor = o_custkey THEN NULL
            ELSE 'FORBIDDEN' END AS error_code
        FROM (SELECT event_id AS read_id, event_id * 2 AS order_id, o_orderkey, o_custkey,
                CASE WHEN event_id % 3 <> 0 THEN o_custkey ELSE user_id END AS actor
            FROM events LEFT JOIN orders ON o_orderkey = event_id * 2)""",
    "role_access": """SELECT action_id, role, CAST(CASE WHEN role = 'admin' THEN 200 ELSE 403 END AS BIGINT)
        AS status_code FROM actions""",
    "trace_defaults": """SELECT event_id, request_id,
        CASE WHEN event_id % 3 = 2 THEN 'corr-' || event_id ELSE request_id END AS correlation_id,
        CASE WHEN event_id % 3 = 2 THEN 'corr-' || event_id ELSE regexp_replace(md5('correlation|' || event_id),
            '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') END AS edge_correlation_id
        FROM (SELECT event_id, CASE WHEN event_id % 5 > 1 THEN 'req-' || event_id
            ELSE regexp_replace(md5('request|' || event_id),
                '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') END AS request_id FROM events)""",
    "log_severity": """SELECT seq, level, CAST(CASE level WHEN 'ERROR' THEN 40 ELSE 30 END AS BIGINT) AS severity
        FROM records WHERE level IN ('WARNING', 'ERROR')""",
    "order_errors": """SELECT request_id, code,
        CASE code WHEN 'PRODUCT_NOT_FOUND' THEN 'Product ' || product_id || ' was not found'
            ELSE 'Insufficient inventory for product ' || product_id END AS message,
        CAST(CASE code WHEN 'PRODUCT_NOT_FOUND' THEN 404 ELSE 409 END AS BIGINT) AS status_code
        FROM (SELECT DISTINCT ON (request_id) request_id, product_id,
                CASE WHEN t.id IS NULL THEN 'PRODUCT_NOT_FOUND' ELSE 'INSUFFICIENT_INVENTORY' END AS code
            FROM rolled r LEFT JOIN tight t ON t.id = product_id
            WHERE t.id IS NULL OR r.quantity > t.quantity ORDER BY request_id, product_id)""",
    "dispatch_inventory": """SELECT seq, attempt, event_type, routing_key,
        CASE WHEN event_type = 'PaymentFailed' THEN 'release' ELSE 'reserve' END AS handler FROM addressed""",
    "price_lines": "SELECT request_id, product_id, quantity, unit_price, found, line_total FROM priced",
    "order_documents": """SELECT id, '{"id":' || id || ',"customer_id":' || customer_id
        || ',"status":"PENDING","total_cents":' || total_cents || ',"items":' || long_items || '}' AS document
        FROM documents_of""",
    "idempotent_replays": """SELECT request_id, customer_id, idempotency_key, order_id,
        coalesce(payload <> first_payload, payload IS NOT NULL OR first_payload IS NOT NULL) AS payload_differs
        FROM (SELECT *, first_value(request_id) OVER w AS order_id, first_value(payload) OVER w AS first_payload
            FROM requests LEFT JOIN (SELECT request_id, string_agg(product_id || 'x' || quantity, ',' ORDER BY pos)
                AS payload FROM items GROUP BY request_id) USING (request_id)
            WHERE idempotency_key IS NOT NULL
            WINDOW w AS (PARTITION BY customer_id, idempotency_key ORDER BY arrival, request_id))
        WHERE request_id <> order_id""",
    "dedupe_events": """SELECT consumer, event_id, seq, attempt FROM (
            SELECT *, row_number() OVER (PARTITION BY consumer, event_id ORDER BY occurred_at, seq, attempt) AS nth
            FROM routed) WHERE event_id IS NULL OR nth = 1""",
    "orphan_events": """SELECT seq, event_type, order_id, order_id IN (SELECT order_id FROM known) AS matched
        FROM changes""",
    "release_reservations": """SELECT l.product_id, quantity, reserved_quantity AS reserved_before,
        CAST(coalesce(back, 0) AS BIGINT) AS released,
        CAST(greatest(0, reserved_quantity - coalesce(back, 0)) AS BIGINT) AS reserved_quantity
        FROM levels l LEFT JOIN (SELECT product_id, sum(quantity) AS back FROM reservations
            WHERE status = 'RESERVED' AND order_id IN (SELECT order_id FROM changes WHERE event_type = 'PaymentFailed')
            GROUP BY product_id) b ON b.product_id = l.product_id""",
    "route_events": "SELECT queue, routing_key, seq, attempt FROM routed",
    "saga_outcomes": """SELECT unit AS event_key,
        CASE WHEN ok THEN 'InventoryReserved' ELSE 'InventoryRejected' END AS stock_event,
        CASE WHEN NOT ok THEN NULL WHEN pay = 'FAILED' THEN 'PaymentFailed' ELSE 'PaymentCompleted' END
            AS payment_event,
        CASE WHEN ok AND pay <> 'FAILED' THEN 'CONFIRMED' ELSE 'CANCELLED' END AS status,
        ok AND pay = 'FAILED' AS released
        FROM (SELECT c.*, coalesce(accepted, true) AS ok FROM charges c LEFT JOIN verdicts v ON v.unit = c.unit)""",
    "apply_product_updates": """SELECT id, CASE WHEN id % 7 = 0 THEN 'new ' || name ELSE name END AS name, description,
        CASE WHEN id % 6 = 0 THEN round(price * 1.2, 2) WHEN id % 3 = 0 THEN round(price * 1.1, 2) ELSE price END
            AS price,
        CASE WHEN id % 5 = 0 THEN 0 ELSE quantity END AS quantity, true AS updated FROM products""",
    "delete_products": """SELECT product_id, CASE WHEN shift = 2 THEN 'MISSING'
            WHEN product_id IN (SELECT l_partkey FROM lineitem) THEN 'BLOCKED' ELSE 'DELETED' END AS outcome
        FROM (SELECT p_partkey + shift * 1000000 AS product_id, shift FROM part, range(3) AS t(shift))""",
    "asof_with_ttl": """SELECT id, key, ts, hit, CASE WHEN hit THEN value END AS value,
        CASE WHEN hit THEN filled END AS filled_at
        FROM (SELECT r.event_id AS id, r.user_id AS key, r.ts, v.value, v.ts AS filled,
                coalesce(v.event_type = 'signup' AND r.ts - v.ts <= INTERVAL 1 DAY, false) AS hit
            FROM (SELECT * FROM events WHERE event_type = 'view') r
            ASOF LEFT JOIN (SELECT * FROM events WHERE event_type IN ('signup', 'purchase')) v
            ON r.user_id = v.user_id AND r.ts >= v.ts)""",
    "trace_summary": """SELECT correlation_id, count(*) AS n_records, count(*) FILTER (service = 'gateway') AS n_edge,
        count(*) FILTER (status >= 500) AS n_errors, min(ts) AS first_ts, max(ts) AS last_ts,
        epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us FROM log GROUP BY correlation_id""",
    "register_unique": """SELECT seq, email, CAST(CASE WHEN row_number() OVER (PARTITION BY email ORDER BY seq) = 1
        THEN 201 ELSE 409 END AS BIGINT) AS status_code FROM registrations""",
    "known_actors": """SELECT action_id, actor_id, CAST(CASE WHEN actor_id IN (SELECT id FROM users) THEN 200
        ELSE 401 END AS BIGINT) AS status_code FROM actions""",
    "requested_quantities": "SELECT * FROM rolled",
    "order_totals": """SELECT request_id, CAST(sum(CAST(price AS DECIMAL(18,2)) * i.quantity) AS DOUBLE)
        AS total_amount, count(*) AS n_items FROM items i LEFT JOIN products p ON p.id = product_id
        GROUP BY request_id""",
    "reserved_by_product": "SELECT * FROM held",
    "available_stock": """SELECT l.product_id, quantity, reserved_quantity + coalesce(reserved, 0) AS reserved_quantity,
        quantity - reserved_quantity - coalesce(reserved, 0) AS available
        FROM levels l LEFT JOIN held h ON h.product_id = l.product_id""",
    "http_requests_total": "SELECT service, method, endpoint, status, count(*) AS value FROM log GROUP BY ALL",
    "latency_histogram": "SELECT method, endpoint, le, value, count, sum FROM histogram",
    "histogram_quantiles": """SELECT method, endpoint, round(CASE WHEN le = '+Inf' THEN low
            ELSE low + (bound - low) * (0.95 * count - low_n) / (value - low_n) END, 6) AS quantile_value
        FROM (SELECT *, coalesce(lag(CAST(bound AS DOUBLE)) OVER w, 0) AS low, coalesce(lag(value) OVER w, 0) AS low_n
            FROM histogram WINDOW w AS (PARTITION BY method, endpoint ORDER BY bound))
        WHERE value >= 0.95 * count AND low_n < 0.95 * count""",
    "business_counters": """SELECT 'orders_created_total' AS metric, count(*) FILTER (outcome = 'CREATED') AS value
            FROM outcomes
        UNION ALL SELECT 'orders_failed_total', count(*) FILTER (outcome = 'FAILED') FROM outcomes
        UNION ALL SELECT 'products_created_total', count(*) FILTER (faults = '') FROM drafts""",
    "red_grouping_sets": """SELECT method, endpoint, CAST(status AS VARCHAR) AS status,
        CAST(grouping(method, endpoint, status) AS BIGINT) AS grouping_id, count(*) AS requests
        FROM log GROUP BY GROUPING SETS ((method, endpoint), (status), ())""",
    "avg_latency": """SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) AS n,
        round(CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS DOUBLE) / count(*), 6) AS avg_s FROM log GROUP BY 1""",
    "latency_percentiles": """SELECT method, count(*) AS n, round(quantile_cont(duration_s, 0.5), 6) AS p50,
        round(quantile_cont(duration_s, 0.95), 6) AS p95, round(quantile_cont(duration_s, 0.99), 6) AS p99
        FROM log GROUP BY method""",
    "worker_throughput": """SELECT time_bucket(INTERVAL 1 HOUR, occurred_at) AS window_start,
        count(*) FILTER (event_type = 'InventoryReserved') AS reservations,
        count(*) FILTER (event_type <> 'InventoryReserved') AS payments
        FROM once WHERE event_type IN ('InventoryReserved', 'PaymentCompleted', 'PaymentFailed') GROUP BY 1""",
    "idempotency_first_wins": """SELECT customer_id, idempotency_key, arg_min(request_id, (arrival, request_id))
        AS order_id, count(*) AS n_requests FROM requests WHERE idempotency_key IS NOT NULL
        GROUP BY customer_id, idempotency_key""",
    "first_failure": """SELECT DISTINCT ON (request_id) request_id, product_id,
        CASE WHEN t.id IS NULL THEN 'PRODUCT_NOT_FOUND' ELSE 'INSUFFICIENT_INVENTORY' END AS code
        FROM items i LEFT JOIN tight t ON t.id = product_id
        WHERE t.id IS NULL OR i.quantity > t.quantity ORDER BY request_id, pos""",
    "order_status": "SELECT * FROM statuses",
    "order_status_guarded": """SELECT order_id, coalesce(
            arg_min(new_status, (occurred_at, seq, attempt)) FILTER (new_status IN ('CONFIRMED', 'CANCELLED')),
            arg_max(new_status, (occurred_at, seq, attempt))) AS status, count(*) AS n_changes
        FROM changes GROUP BY order_id""",
    "reserved_balance": """SELECT product_id, changed_at, order_id, line, supplier_id, kind, change,
        CAST(total - least(0, min(total) OVER w) AS BIGINT) AS reserved
        FROM (SELECT *, sum(change) OVER w AS total FROM (
            SELECT l_partkey AS product_id, l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line,
                l_suppkey AS supplier_id, o_orderdate AS changed_at, CAST(0 AS BIGINT) AS kind,
                CAST(l_quantity AS BIGINT) AS change FROM lineitem JOIN orders ON o_orderkey = l_orderkey
            UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_shipdate, 1,
                -2 * CAST(l_quantity AS BIGINT) FROM lineitem WHERE l_returnflag = 'R')
            WINDOW w AS (PARTITION BY product_id ORDER BY changed_at, order_id, line, supplier_id, kind
                ROWS UNBOUNDED PRECEDING))
        WINDOW w AS (PARTITION BY product_id ORDER BY changed_at, order_id, line, supplier_id, kind ROWS UNBOUNDED PRECEDING)""",
    "counter_rate": """SELECT series, ts, tie AS event_id, value, increase,
        round(sum(increase) OVER (PARTITION BY series ORDER BY epoch_us(ts)
            RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) / 60, 6) AS rate
        FROM (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS increase
            FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY ts, tie) AS prev FROM samples))""",
    "latest_sample": """SELECT series, arg_max(value, (ts, tie)) AS value, max(ts) AS ts
        FROM samples WHERE tie % 3 <> 0 GROUP BY series""",
    "admit_orders": "SELECT unit AS order_id, accepted FROM verdicts",
    "reserve_orders": """SELECT v.unit AS order_id, accepted,
        CASE WHEN accepted THEN 'InventoryReserved' ELSE 'InventoryRejected' END AS emitted, reason
        FROM verdicts v LEFT JOIN (
            SELECT unit, arg_min(reason, pos) AS reason FROM (
                SELECT unit, pos, CASE WHEN cap IS NULL THEN 'Inventory not found for product ' || res
                    WHEN i.quantity > cap - gone THEN 'Insufficient inventory for product ' || res END AS reason
                FROM (SELECT l.*, accepted, coalesce(sum(CASE WHEN accepted THEN addq ELSE 0 END) OVER (
                        PARTITION BY res ORDER BY t, unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
                    FROM lines_reserve l JOIN verdicts USING (unit))
                JOIN items i ON i.request_id = unit AND i.product_id = res
                WHERE NOT accepted)
            WHERE reason IS NOT NULL GROUP BY unit) f ON f.unit = v.unit""",
    "intake_outcomes": """SELECT request_id, outcome,
        CASE WHEN outcome IN ('CREATED', 'REPLAYED') THEN CAST(holder AS VARCHAR) END AS order_id,
        CASE WHEN outcome = 'CREATED' THEN worth END AS total_amount,
        CASE outcome WHEN 'INVALID' THEN error_code WHEN 'FAILED' THEN bad_code END AS error_code,
        CASE WHEN outcome <> 'FAILED' THEN NULL WHEN bad_code = 'PRODUCT_NOT_FOUND'
            THEN 'Product ' || bad_product || ' was not found'
            ELSE 'Insufficient inventory for product ' || bad_product END AS error_message,
        CAST(CASE WHEN outcome = 'INVALID' THEN 422 WHEN outcome <> 'FAILED' THEN 201
            WHEN bad_code = 'PRODUCT_NOT_FOUND' THEN 404 ELSE 409 END AS BIGINT) AS status_code FROM outcomes""",
    "status_transitions": """SELECT order_id, seq, coalesce(lag(new_status) OVER (PARTITION BY order_id
        ORDER BY occurred_at, seq, attempt), 'PENDING') AS old_status, new_status FROM changes""",
    "first_payment": """SELECT DISTINCT ON (order_id) order_id, payment_id, amount, status FROM ledger
        ORDER BY order_id, payment_id""",
    "workflow_events": """SELECT replace(exchange, '-events', '') AS topic, seq, attempt, event_type FROM addressed
        WHERE exchange IN ('inventory-events', 'payment-events')""",
    "payment_decisions": """SELECT seq, order_id, amount, CASE WHEN amount <= 0 OR amount = 9999.0 THEN 'FAILED'
        ELSE 'COMPLETED' END AS status FROM env
        WHERE event_type = 'InventoryReserved' AND attempt = 0 AND order_id <> 0""",
    "payment_ledger": "SELECT payment_id, event_id, seq, order_id, amount, status FROM ledger",
    "payment_events": """SELECT CASE status WHEN 'FAILED' THEN 'PaymentFailed' ELSE 'PaymentCompleted' END AS event_type,
        order_id, payment_id, amount, CASE status WHEN 'FAILED' THEN 'Payment declined' END AS reason, correlation_id
        FROM ledger""",
    "duplicate_charges": """SELECT order_id, count(*) AS n_payments,
        count(*) FILTER (status = 'COMPLETED') AS n_completed FROM ledger GROUP BY order_id HAVING count(*) > 1""",
    "compensations": """SELECT seq, attempt, order_id, CASE WHEN nth_of_order = 1 THEN coalesce(n, 0) ELSE 0 END
            AS released_lines,
        CAST(CASE WHEN nth_of_order = 1 THEN coalesce(q, 0) ELSE 0 END AS BIGINT) AS released_quantity,
        'InventoryReleased' AS emitted
        FROM (SELECT *, CASE WHEN order_id <> 0 THEN row_number() OVER (PARTITION BY order_id
                ORDER BY occurred_at, seq, attempt) END AS nth_of_order
            FROM once WHERE event_type = 'PaymentFailed')
        LEFT JOIN (SELECT order_id, count(*) AS n, sum(quantity) AS q FROM reservations WHERE status = 'RESERVED'
            GROUP BY order_id) USING (order_id)""",
    "held_and_confirmed": """SELECT coalesce(status, 'PENDING') AS order_status, CAST(sum(q) AS BIGINT) AS held,
        count(*) AS n_orders
        FROM (SELECT order_id, sum(quantity) AS q FROM reservations WHERE status = 'RESERVED' GROUP BY order_id)
        LEFT JOIN statuses USING (order_id) GROUP BY 1""",
    "orders_without_event": """SELECT DISTINCT order_id FROM env WHERE order_id NOT IN
        (SELECT order_id FROM known)""",
    "request_rate": """SELECT window_start, window_start + INTERVAL 60 SECONDS AS window_end, count(*) AS n,
        round(count(*) / 60, 6) AS rate
        FROM (SELECT make_timestamp(epoch_us(ts) // 5000000 * 5000000 - i * 5000000) AS window_start
            FROM log, range(12) AS t(i)) GROUP BY window_start""",
    "recent_window": """SELECT ts, request_id, endpoint, status FROM log
        WHERE ts > (SELECT max(ts) FROM log) - INTERVAL 1 DAY""",
    "error_rate_zero_filled": """SELECT make_timestamp(slot * 60000000) AS window_start, coalesce(n, 0) AS n,
        round(coalesce(n, 0) / 60, 6) AS rate
        FROM (SELECT unnest(range(min(epoch_us(ts)) // 60000000, max(epoch_us(ts)) // 60000000 + 1)) AS slot FROM log)
        LEFT JOIN (SELECT epoch_us(ts) // 60000000 AS slot, count(*) AS n FROM log
            WHERE regexp_full_match(CAST(status AS VARCHAR), '5..') GROUP BY 1) USING (slot)""",
    "stream_dedupe": "SELECT event_id, seq, attempt, event_type, order_id FROM once",
    "stream_order_status": "SELECT * FROM statuses",
    "stream_payments": "SELECT seq, attempt, order_id, amount, status FROM ledger",
    "stream_reservations": """SELECT unit AS order_id,
        CASE WHEN coalesce(accepted, true) THEN 'InventoryReserved' ELSE 'InventoryRejected' END AS emitted
        FROM charges LEFT JOIN verdicts USING (unit)
        UNION ALL SELECT unit, 'InventoryReleased' FROM charges WHERE pay = 'FAILED'""",
    "stream_stock": """SELECT p.id AS product_id, p.quantity, CAST(coalesce(held, 0) AS BIGINT) AS reserved_quantity
        FROM products p LEFT JOIN (SELECT res, sum(addq) AS held FROM lines_saga JOIN verdicts USING (unit)
            WHERE accepted AND (unit <> 0 OR addq > 0) GROUP BY res) ON res = p.id""",
}
BODIES["round_trip_events"] = """SELECT 'order-' || id AS event_id, 'OrderCreated' AS event_type, id AS order_id, customer_id,
        CAST(CAST(total_cents / 100 AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
        (SELECT count(*) FROM items i WHERE i.request_id = documents_of.id) AS n_items
        FROM documents_of WHERE id IN (SELECT request_id FROM outcomes WHERE outcome = 'CREATED')"""
SLIDES = "make_timestamp(epoch_us(ts) // 5000000 * 5000000 - i * 5000000) AS window_start"
for _name, _labels in (("endpoint", "method, endpoint"), ("status", "status")):
    BODIES[f"request_rate_by_{_name}"] = f"""SELECT {_labels}, window_start,
        window_start + INTERVAL 60 SECONDS AS window_end, count(*) AS n, round(count(*) / 60, 6) AS rate
        FROM (SELECT {_labels}, {SLIDES} FROM log, range(12) AS t(i)) GROUP BY ALL"""
BODIES |= {
    "sliding_red": f"""SELECT service, window_start, window_start + INTERVAL 60 SECONDS AS window_end,
        round(count(*) / 60, 6) AS rate, round(count(*) FILTER (status BETWEEN 500 AND 599) / 60, 6) AS error_rate,
        round(CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS DOUBLE) / count(*), 6) AS mean_duration_s
        FROM (SELECT service, status, duration_s, {SLIDES} FROM log, range(12) AS t(i)) GROUP BY service, window_start""",
    "family_histogram": """SELECT service, method, endpoint, le,
        count(*) FILTER (duration_s <= CAST(bound AS DOUBLE)) AS value, count(*) AS count,
        CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS DOUBLE) AS sum
        FROM log, buckets GROUP BY service, method, endpoint, le""",
    "partial_updates": """SELECT id, faults, CAST(CASE WHEN faults = '' THEN 200 ELSE 422 END AS BIGINT) AS status_code
        FROM (SELECT p_partkey AS id, concat_ws(',',
                CASE WHEN p_partkey % 3 <> 0 AND p_retailprice - 950 <= 0 THEN 'price' END,
                CASE WHEN p_partkey % 4 <> 0 AND CAST(p_size AS BIGINT) * 20 - 100 < 0 THEN 'quantity' END) AS faults FROM part)""",
    "user_defaults": "SELECT id, CASE WHEN id % 5 <> 0 THEN role ELSE 'customer' END AS role FROM users",
    "request_durations": "SELECT request_id, round(duration_s * 1000, 2) AS duration_ms FROM log",
    "append_products": "SELECT * FROM products",
    "scraped_series": """SELECT ts, 'order-service:events_total{day="' || strftime(ts, '%Y-%m-%d') || '",type="' || event_type
        || '"}' AS series, CAST(count(*) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM events""",
}
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00\"'"
_ID = """'{{"event_id":"' || {id} || '","event_type":"' || {kind} || '","occurred_at":"' || {at}
        || ',"correlation_id":"' || {corr} || '","payload":{{"order_id":' || {order} ||"""


def _head(kind: str, id: str, at: str, corr: str, order: str) -> str:
    """The text of a body up to the first payload field."""
    return _ID.format(kind=kind, id=id, at=ISO.format(at), corr=corr, order=order)


_OWN = {"corr": "'corr-' || unit", "order": "unit"}
BODIES["emit_inventory_events"] = f"""WITH told AS (FROM ({BODIES["reserve_orders"]}) r JOIN charges c ON c.unit = r.order_id
        JOIN orders ON o_orderkey = unit JOIN documents_of d ON d.id = unit)
    SELECT 'inventory-events' AS exchange, 'inventory.reserved' AS routing_key,
        {_head("'InventoryReserved'", "'stock-' || unit", "t", **_OWN)}
        ',"amount":' || CASE WHEN unit % 37 = 0 THEN 9999.0 ELSE o_totalprice END || ',"items":' || short_items || '}}}}' AS body
        FROM told WHERE accepted
    UNION ALL SELECT 'inventory-events', 'inventory.rejected',
        {_head("'InventoryRejected'", "'stock-' || unit", "t", **_OWN)} ',"reason":"' || reason || '"}}}}'
        FROM told WHERE NOT accepted
    UNION ALL SELECT 'inventory-events', 'inventory.released',
        {_head("'InventoryReleased'", "'release-' || unit", "t + INTERVAL 1 HOUR", **_OWN)} '}}}}'
        FROM told WHERE accepted AND pay = 'FAILED' AND unit <> 0"""
_PAID = _head(
    "CASE status WHEN 'FAILED' THEN 'PaymentFailed' ELSE 'PaymentCompleted' END", "'payment-' || payment_id",
    "occurred_at", "correlation_id", "order_id",
)
BODIES["emit_payment_events"] = f"""SELECT 'payment-events' AS exchange,
        CASE status WHEN 'FAILED' THEN 'payment.failed' ELSE 'payment.completed' END AS routing_key,
        {_PAID} ',"payment_id":' || payment_id || ',"amount":' || amount
        || CASE status WHEN 'FAILED' THEN ',"reason":"Payment declined"' ELSE '' END || '}}}}' AS body FROM ledger"""
BODIES["round_trip_all"] = """SELECT seq,
        CASE how WHEN 'text' THEN NULL WHEN 'list' THEN 'PaymentFailed' WHEN 'null' THEN 'InventoryReserved' ELSE event_type END AS event_type,
        CASE WHEN how = 'sent' THEN order_id END AS order_id,
        CASE WHEN how = 'sent' AND event_type = 'OrderCreated' THEN order_id % 100 END AS customer_id,
        CASE WHEN how = 'sent' AND event_type = 'OrderCreated' THEN amount END AS total_amount,
        CASE WHEN how = 'sent' AND event_type IN ('InventoryReserved', 'PaymentCompleted', 'PaymentFailed') THEN amount END AS amount,
        CASE WHEN how = 'sent' AND event_type IN ('PaymentCompleted', 'PaymentFailed') THEN seq END AS payment_id,
        CASE WHEN how = 'sent' AND event_type IN ('InventoryRejected', 'PaymentFailed') THEN 'because' END AS reason,
        CASE WHEN how = 'sent' AND event_type IN ('OrderCreated', 'InventoryReserved') THEN amount END AS charge,
        CASE how WHEN 'text' THEN 'UNDECODABLE' WHEN 'list' THEN 'WRONG_SHAPE' WHEN 'null' THEN 'NULL_AMOUNT'
            WHEN 'other' THEN 'UNKNOWN_TYPE' END AS quarantine_reason
        FROM (SELECT *, CASE WHEN seq % 101 = 0 THEN 'text' WHEN seq % 103 = 0 THEN 'list' WHEN seq % 107 = 0 THEN 'null'
            WHEN event_type = 'SomethingHappened' THEN 'other' ELSE 'sent' END AS how FROM env WHERE attempt = 0)"""
BODIES["stream_causes"] = """WITH asked AS (SELECT order_id, seq, occurred_at FROM env WHERE attempt = 0 AND event_type = 'OrderCreated'),
    told AS (SELECT order_id, seq, occurred_at FROM env WHERE attempt = 0
        AND event_type IN ('InventoryReserved', 'InventoryRejected')),
    met AS (SELECT c.order_id, c.seq AS cause, a.seq AS effect FROM asked c JOIN told a ON a.order_id = c.order_id
        AND a.occurred_at BETWEEN c.occurred_at AND c.occurred_at + INTERVAL 30 DAY)
    SELECT order_id, cause, effect, 'answered' AS outcome FROM met
    UNION ALL SELECT order_id, seq, NULL, 'timed_out' FROM asked WHERE seq NOT IN (SELECT cause FROM met)
    UNION ALL SELECT order_id, NULL, seq, 'unexplained' FROM told WHERE seq NOT IN (SELECT effect FROM met)"""
def _snapshot(service: str, prefix: str) -> str:
    rows = f"(SELECT * FROM log WHERE service = '{service}')"
    name = f"{prefix}_request_duration_seconds"
    return f"""SELECT '{prefix}_requests_total{{endpoint="' || endpoint || '",method="' || method
            || '",status="' || status || '"}} ' || count(*) || '.0' AS line FROM {rows} GROUP BY method, endpoint, status
        UNION ALL SELECT '{name}_bucket{{endpoint="' || endpoint || '",le="' || le || '",method="' || method || '"}} '
            || count(*) FILTER (duration_s <= CAST(bound AS DOUBLE)) || '.0' FROM {rows}, buckets GROUP BY method, endpoint, le
        UNION ALL SELECT '{name}_count{{endpoint="' || endpoint || '",method="' || method
            || '"}} ' || count(*) || '.0' FROM {rows} GROUP BY method, endpoint
        UNION ALL SELECT '{name}_sum{{endpoint="' || endpoint || '",method="' || method
            || '"}} ' || CAST(sum(CAST(duration_s AS DECIMAL(18,6))) AS VARCHAR) FROM {rows} GROUP BY method, endpoint"""


BODIES["service_snapshots"] = f"""{_snapshot("gateway", "gateway_http")}
    UNION ALL {_snapshot("order-service", "http")}
    UNION ALL SELECT metric || ' ' || value || '.0' FROM ({BODIES["business_counters"]})"""
BODIES["sliding_p95"] = f"""SELECT method, window_start, window_start + INTERVAL 60 SECONDS AS window_end, count(*) AS n,
        quantile_disc(duration_s, 0.95) AS p95_s
        FROM (SELECT method, duration_s, {SLIDES} FROM log, range(12) AS t(i)) GROUP BY method, window_start"""
BODIES["amount_defaults"] = """SELECT seq, order_id, CASE seq % 4 WHEN 0 THEN amount WHEN 1 THEN amount WHEN 2 THEN 0.0 END AS charge,
        CASE WHEN seq % 4 = 3 THEN 'NULL_AMOUNT' END AS quarantine_reason
        FROM env WHERE attempt = 0 AND event_type = 'OrderCreated'"""
BODIES["stream_saga"] = BODIES["saga_outcomes"]
BODIES["stream_late_events"] = BODIES["stream_dedupe"]
BODIES["stream_request_rate"] = BODIES["request_rate"]
BODIES["stream_ttl_lookup"] = BODIES["asof_with_ttl"]

# the admission behind a query, by the lines it runs on
ADMISSIONS = {
    "admit_orders": "lines_admit",
    "reserve_orders": "lines_reserve",
    "saga_outcomes": "lines_saga",
    "stream_reservations": "lines_saga",
    "stream_stock": "lines_saga",
    "stream_saga": "lines_chain",
    "intake_outcomes": "lines_intake",
    "business_counters": "lines_intake",
    "emit_order_created": "lines_intake",
    "emit_inventory_events": "lines_reserve",
    "service_snapshots": "lines_intake",
    "round_trip_events": "lines_intake",
}


def _used(text: str, found: dict[str, None]) -> dict[str, None]:
    for name, body in ADAPTERS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            found[name] = None
            _used(body, found)
    return found


def _sql(name: str, body: str) -> str:
    lines = ADMISSIONS.get(name)
    found = _used(body + (f" {lines}" if lines else ""), {})
    before, after = [], []
    for adapter, text in ADAPTERS.items():
        if adapter in found:
            (after if adapter in ("intake", "outcomes") else before).append(f"{adapter} AS ({text})")
    own = body.removeprefix("WITH ")
    joint = " " if own == body else ", "
    if lines:
        return f"WITH RECURSIVE {', '.join([*before, ROUNDS.format(lines=lines), *after])}{joint}{own}"
    return f"WITH {', '.join(before)}{joint}{own}" if before else body


def registered() -> dict[str, str]:
    return {name: _sql(name, body) for name, body in BODIES.items()}
