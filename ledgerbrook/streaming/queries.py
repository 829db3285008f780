"""The streams as queries: the adapted tables arrive in slices, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerbrook.operators import metrics
from ledgerbrook.plans.adapters import ARRIVAL, Entities
from ledgerbrook.streaming import operators as ops
from ledgerbrook.streaming.chain import Saga
from ledgerbrook.streaming.runtime import StreamRun, in_slices

SLICES = 4


def _zoned(df: DataFrame) -> DataFrame:
    """Watermarks need timestamps with a zone."""
    plain = [name for name, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in plain})


def _deliveries(e: Entities) -> list[DataFrame]:
    """First deliveries in order, then all redeliveries."""
    rows = _zoned(e.envelopes())
    return [*in_slices(rows.where("attempt = 0"), "seq", SLICES), rows.where("attempt = 1")]


def _late_deliveries(e: Entities) -> list[DataFrame]:
    """The same with the newest slice first: first deliveries weeks behind what has been seen."""
    *firsts, again = _deliveries(e)
    return [*reversed(firsts), again]


def stream_dedupe(e: Entities) -> DataFrame:
    return _dedupe(e, _deliveries(e))


def stream_late_events(e: Entities) -> DataFrame:
    return _dedupe(e, _late_deliveries(e))


def _dedupe(e: Entities, deliveries: list[DataFrame]) -> DataFrame:
    run = StreamRun(e.spark, "dedupe")
    worker = ops.Dedupe(run, "workflow", ARRIVAL, lambda fresh: fresh.select("event_id", "seq", "attempt", "event_type", "order_id"))
    run.replay(deliveries, lambda events: events.writeStream.foreachBatch(worker))
    return run.kept("event_id string, seq bigint, attempt bigint, event_type string, order_id bigint").drop("batch")


def stream_order_status(e: Entities) -> DataFrame:
    run = StreamRun(e.spark, "status")
    deliveries = _deliveries(e)
    worker = ops.StatusFold(run, ARRIVAL, deliveries[0])
    run.replay(deliveries, lambda events: events.writeStream.foreachBatch(worker))
    return worker.statuses.table(len(deliveries)).drop("at")


def stream_payments(e: Entities) -> DataFrame:
    run = StreamRun(e.spark, "payments")
    columns = ["seq", "attempt", "order_id", "amount", "status"]
    reserved = [rows.where("event_type = 'InventoryReserved'") for rows in _deliveries(e)]
    worker = ops.Dedupe(run, "payment", ARRIVAL, lambda fresh: ops.payment_outcomes(fresh).select(*columns))
    run.replay(reserved, lambda events: events.writeStream.foreachBatch(worker))
    return run.kept("seq bigint, attempt bigint, order_id bigint, amount double, status string").drop("batch")


def stream_request_rate(e: Entities) -> DataFrame:
    run = StreamRun(e.spark, "rate")
    log = _zoned(e.request_log()).withColumn("_at", F.unix_seconds("ts"))
    run.replay(
        in_slices(log.select("ts", "_at"), "_at", SLICES),
        lambda rows: ops.request_cells(rows, 5).writeStream.outputMode("update").foreachBatch(run.sink),
    )
    return metrics.spread_cells(run.latest("ts timestamp, n bigint", ["ts"]), 60, 5)


def stream_ttl_lookup(e: Entities) -> DataFrame:
    run = StreamRun(e.spark, "lookup")
    fills = e.versions().withColumn("kind", F.lit("version"))
    asks = e.reads().withColumn("value", F.lit(None).cast("double")).withColumn("kind", F.lit("read"))
    worker = ops.TtlLookup(run, 86_400)
    run.replay(
        in_slices(_zoned(fills.unionByName(asks)), "id", SLICES),
        lambda rows: rows.writeStream.foreachBatch(worker),
    )
    return run.kept(worker.SERVED, "served").drop("batch")


def _stock_run(e: Entities) -> tuple[StreamRun, ops.StockWorker, int]:
    """The stock worker over OrderCreated and PaymentFailed events, some delivered twice, and its batches."""
    run = StreamRun(e.spark, "stock")
    events = _zoned(e.stock_events()).withColumn("_at", F.unix_seconds("occurred_at"))
    again = events.where("order_id % 7 = 0").withColumn("occurred_at", F.col("occurred_at") + F.expr("INTERVAL 1 DAY"))
    worker = ops.OnceStockWorker(run, e.stock())
    slices = [*in_slices(events, "_at", 2), again]
    run.replay(slices, lambda rows: rows.writeStream.foreachBatch(worker))
    return run, worker, len(slices)


def stream_reservations(e: Entities) -> DataFrame:
    run, worker, _ = _stock_run(e)
    return run.kept(worker.EMITTED, "emitted").drop("batch")


def stream_stock(e: Entities) -> DataFrame:
    """The stock that the stream leaves, put together from its changes."""
    _, worker, batches = _stock_run(e)
    return worker.stock(batches)


def stream_saga(e: Entities) -> DataFrame:
    """Orders through four chained stages; what is released is free from the next slice on."""
    saga = Saga(e.spark, e.stock())
    orders = _zoned(e.arriving_orders()).withColumn("_at", F.unix_seconds("occurred_at"))
    saga.replay(rows.drop("_at") for rows in in_slices(orders, "_at", 2))
    return saga.outcomes().select((F.col("order_id") - 1).alias("event_key"), "stock_event", "payment_event", "status", "released")


def stream_causes(e: Entities) -> DataFrame:
    """Orders and the stock answers to them within 30 days, joined while both arrive.

    Two closing slices far ahead, a pair each that meets nothing, bring the watermark past the last row.
    """
    run = StreamRun(e.spark, "causes")
    events = _zoned(e.envelopes(False)).select("order_id", "seq", "occurred_at", "event_type")
    events = events.withColumn("_at", F.unix_seconds("occurred_at"))
    ends = [
        e.spark.createDataFrame([(-1, -1, n, "OrderCreated"), (-2, -2, n, "InventoryReserved")], "order_id bigint, seq bigint, n bigint, event_type string")
        .select("order_id", "seq", F.timestamp_seconds(F.lit(4_000_000_000) + F.col("n")).alias("occurred_at"), "event_type")
        for n in (0, 100_000_000)
    ]

    def start(rows: DataFrame) -> DataStreamWriter:
        asked = rows.where("event_type = 'OrderCreated'")
        told = rows.where("event_type IN ('InventoryReserved', 'InventoryRejected')")
        return ops.causes(asked, told, "INTERVAL 30 DAYS").writeStream.foreachBatch(run.sink)

    run.replay([*(rows.drop("_at") for rows in in_slices(events, "_at", SLICES)), *ends], start)
    return run.kept("order_id bigint, cause bigint, effect bigint, outcome string").where("order_id >= 0").drop("batch")


STREAMS = (
    stream_dedupe,
    stream_late_events,
    stream_order_status,
    stream_payments,
    stream_request_rate,
    stream_ttl_lookup,
    stream_reservations,
    stream_stock,
    stream_saga,
    stream_causes,
)
