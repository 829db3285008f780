"""Structured log lines: build, read, filter, trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions.scalars import LEVEL_RANKS, severity
from ledgerbrook.schemas import LOG_LINE

# fixed values: context keys each service's formatter keeps
CONTEXT_KEYS = {
    "order-service": ("request_id", "correlation_id", "event", "order_id", "product_id"),
    "gateway": ("request_id", "correlation_id", "event"),
    "inventory-service": ("correlation_id", "event", "order_id", "event_id"),
    "payment-service": ("correlation_id", "event", "order_id", "event_id"),
}
BASE_KEYS = ("timestamp", "level", "service", "logger", "message")
ALL_CONTEXT = ("request_id", "correlation_id", "event", "order_id", "product_id", "event_id")


def _kept(key: str) -> Column:
    services = [s for s, keys in CONTEXT_KEYS.items() if key in keys]
    return F.when(F.col("service").isin(*services), F.col(key))


def render(records: DataFrame, overlay: str | None = None) -> DataFrame:
    """Add ``line``: the JSON text of each record.

    Keys the formatter of the service does not keep, and absent keys, are left out.
    Keys of the ``overlay`` map (string -> variant) come last and win.
    """
    fields = [F.col(k) for k in BASE_KEYS] + [_kept(k).alias(k) for k in ALL_CONTEXT if k in records.columns]
    if overlay is None:
        return records.withColumn("line", F.to_json(F.struct(*fields)))
    keys = [*BASE_KEYS, *[k for k in ALL_CONTEXT if k in records.columns]]
    base = F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]), F.array(*[f.cast("variant") for f in fields])
    )
    extra = F.coalesce(F.col(overlay), F.expr("cast(map() as map<string,variant>)"))
    kept = F.map_filter(base, lambda k, v: v.isNotNull() & ~F.array_contains(F.map_keys(extra), k))
    return records.withColumn("line", F.to_json(F.map_concat(kept, extra)))


def parse(lines: DataFrame, column: str = "line") -> DataFrame:
    """Log lines of all services under one schema: keys a service does not write are null."""
    return lines.select(F.from_json(column, LOG_LINE).alias("_r")).select("_r.*")


def at_least(records: DataFrame, level: str) -> DataFrame:
    """Records at or above a level; unknown level names count as INFO."""
    floor = LEVEL_RANKS.get(level.upper(), LEVEL_RANKS["INFO"])
    return records.withColumn("severity", F.coalesce(severity(F.col("level")), F.lit(20)).cast("bigint")).where(
        F.col("severity") >= floor
    )


def trace_summary(log: DataFrame) -> DataFrame:
    """One row per correlation id over all services."""
    span = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    return log.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("service") == "gateway").alias("n_edge"),
        F.count_if(F.col("status") >= 500).alias("n_errors"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        span.alias("span_us"),
    )
