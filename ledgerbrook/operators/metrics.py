"""Request, error and duration metrics from request logs and counter samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.operators.running import ROWS_PER_SLICE, previous, running

# fixed values: histogram bounds of the public metrics client, in seconds
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

MICROS = 1_000_000
# windows of a spine that one row stands for until they are dealt out, and the size of a sketch
SPINE, SKETCH_K = 4096, 1024


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def requests_total(log: DataFrame, labels: Sequence[str] = ("service", "method", "endpoint", "status")) -> DataFrame:
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def latency_histogram(
    log: DataFrame, labels: Sequence[str] = ("method", "endpoint"), buckets: Sequence[float] = BUCKETS
) -> DataFrame:
    """Cumulative bucket counts, sum and count per label set.

    All buckets come out of one aggregate; rows are multiplied by the number of
    buckets only after it.
    """
    bounds = [(f"{b:g}" if b != int(b) else f"{b:.1f}", b) for b in buckets]
    grouped = log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.col("duration_s").cast("decimal(18,6)")).alias("_sum"),
        *[F.count_if(F.col("duration_s") <= b).alias(f"_b{i}") for i, (_, b) in enumerate(bounds)],
    )
    cells = [
        F.struct(F.lit(name).alias("le"), F.col(f"_b{i}").alias("value")) for i, (name, _) in enumerate(bounds)
    ] + [F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("value"))]
    return grouped.select(*labels, "count", "_sum", F.explode(F.array(*cells)).alias("_cell")).select(
        *labels,
        "_cell.le",
        "_cell.value",
        "count",
        F.col("_sum").cast("double").alias("sum"),
    )


def histogram_quantile(histogram: DataFrame, q: float, labels: Sequence[str] = ("method", "endpoint")) -> DataFrame:
    """Quantile by linear interpolation inside its bucket.

    A rank in the open last bucket answers with the highest finite bound.
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    cells = histogram.groupBy(*labels).agg(
        F.sort_array(F.collect_list(F.struct(bound.alias("le"), F.col("value").alias("value")))).alias("_h"),
        F.max("count").alias("_n"),
    )
    rank = F.col("_n") * q
    at = F.expr("aggregate(_h, 0, (i, c) -> i + int(c.value < _rank))")
    found = cells.withColumn("_rank", rank).withColumn("_i", at)
    upper = F.get("_h", F.col("_i"))
    lower = F.get("_h", F.col("_i") - 1)
    low_le, low_n = F.coalesce(lower.le, F.lit(0.0)), F.coalesce(lower.value, F.lit(0))
    # rank 0 in an empty first bucket: its lower bound
    share = F.try_divide(F.col("_rank") - low_n, upper.value - low_n)
    inside = low_le + (upper.le - low_le) * F.coalesce(share, F.lit(0.0))
    return found.select(
        *labels, F.when(upper.le == float("inf"), low_le).otherwise(inside).alias("quantile_value")
    )


def red_grouping_sets(log: DataFrame) -> DataFrame:
    """Requests by (method, endpoint), by status and in total, in one pass."""
    sets = [[F.col("method"), F.col("endpoint")], [F.col("status")], []]
    return log.groupingSets(sets, "method", "endpoint", "status").agg(
        F.grouping_id().cast("bigint").alias("grouping_id"), F.count(F.lit(1)).alias("requests")
    )


def avg_latency(log: DataFrame, width: str = "1 minute") -> DataFrame:
    total = F.sum(F.col("duration_s").cast("decimal(18,6)")).cast("double")
    return (
        log.groupBy(F.window("ts", width).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(total / F.count(F.lit(1)), 6).alias("avg_s"))
        .select(F.col("_w.start").alias("window_start"), "n", "avg_s")
    )


def latency_percentiles(
    log: DataFrame,
    labels: Sequence[str] = ("method",),
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Exact percentiles (linear between the two nearest ranks) per label set.

    Equal durations are counted first, the counts are summed along the value, and
    each percentile takes the two values its rank falls between. Nothing holds all
    values of a label set at once.
    """
    labels = list(labels)
    counted = log.groupBy(*labels, "duration_s").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counted.groupBy(*labels).agg(F.sum("_n").alias("n"))
    ranked = running(counted, labels, ["duration_s"], {"_upto": ("sum", "_n")}, rows_per_slice=rows_per_slice)
    with_size = ranked.join(sizes, labels)
    picks = []
    for i, q in enumerate(quantiles):
        rank = (F.col("n") - 1) * F.lit(float(q))
        for side, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            picks.append(F.min(F.when(F.col("_upto") > r, F.col("duration_s"))).alias(f"_{side}{i}"))
    picked = with_size.groupBy(*labels, "n").agg(*picks)
    outs = []
    for i, q in enumerate(quantiles):
        rank = (F.col("n") - 1) * F.lit(float(q))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.round(low + (high - low) * (rank - F.floor(rank)), 6).alias(f"p{q * 100:g}"))
    return picked.select(*labels, "n", *outs)


def latency_percentiles_approx(
    log: DataFrame, labels: Sequence[str] = ("method",), quantiles: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """One-pass sketch, for when the exact form is not worth its shuffle."""
    return log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx("duration_s", q, 10000).alias(f"p{q * 100:g}") for q in quantiles],
    )


def sliding_percentile(
    log: DataFrame,
    quantile: float = 0.95,
    width_seconds: int = 60,
    slide_seconds: int = 5,
    labels: Sequence[str] = ("method",),
    k: int = SKETCH_K,
) -> DataFrame:
    """A percentile of the durations per label set over sliding windows, from sketches that merge.

    One scan makes a sketch per (label set, slide); a window merges the sketches of its
    slides, and any coarser window could merge them again. The result is the value whose
    rank is the quantile, exact while a window holds no more than about ``k`` rows, else
    within a rank error of about 3.3 / k of its rows (at 99% confidence).
    """
    step, size = slide_seconds * MICROS, width_seconds * MICROS
    start = (F.floor(micros(F.col("ts")) / step) * step).cast("bigint")
    cells = log.groupBy(*labels, start.alias("_at")).agg(F.kll_sketch_agg_double("duration_s", k).alias("_sketch"))
    starts = F.transform(F.sequence(F.lit(0), F.lit(width_seconds // slide_seconds - 1)), lambda i: F.col("_at") - i * step)
    spread = cells.select(*labels, "_sketch", F.explode(starts).alias("_start"))
    merged = spread.groupBy(*labels, "_start").agg(F.kll_merge_agg_double("_sketch", k).alias("_sketch"))
    return merged.select(
        *labels,
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + size).alias("window_end"),
        F.kll_sketch_get_n_double("_sketch").alias("n"),
        F.kll_sketch_get_quantile_double("_sketch", F.lit(float(quantile))).alias(f"p{quantile * 100:g}"),
    )


def worker_throughput(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Reservations and payments handled per window."""
    kind = F.col("event_type")
    return (
        events.where(kind.isin("InventoryReserved", "PaymentCompleted", "PaymentFailed"))
        .groupBy(F.window("occurred_at", width).alias("_w"))
        .agg(
            F.count_if(kind == "InventoryReserved").alias("reservations"),
            F.count_if(kind != "InventoryReserved").alias("payments"),
        )
        .select(F.col("_w.start").alias("window_start"), "reservations", "payments")
    )


def counter_rate(
    samples: DataFrame,
    window_seconds: int = 60,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Per-second rate of a counter over the trailing window, at each sample.

    ``samples``: series, ts, tie, value. A drop is a reset: the new value is the
    increase. With the running sum of the increases, the trailing sum at t is the sum
    up to t less the sum up to t - window: a point per (series, t), and an as-of read of
    the points one window earlier. All three passes are running aggregates, which cut
    a series of any size into slices; nothing is windowed by series alone.
    """
    stepped = previous(samples, ["series"], ["ts", "tie"], {"_prev": "value"}, rows_per_slice=rows_per_slice)
    grown = F.when(F.col("_prev").isNull(), 0).when(
        F.col("value") < F.col("_prev"), F.col("value")
    ).otherwise(F.col("value") - F.col("_prev"))
    risen = stepped.withColumns({"increase": grown, "_us": micros(F.col("ts"))}).drop("_prev")
    summed = running(
        risen, ["series"], ["_us", "ts", "tie"], {"_upto": ("sum", "increase")}, rows_per_slice=rows_per_slice
    )
    # samples of one time see each other: the sum up to a time is that of its last sample
    points = summed.groupBy("series", "_us").agg(F.max("_upto").alias("_upto"))
    nothing = F.lit(None).cast(points.schema["_upto"].dataType).alias("_upto")
    reads = points.select("series", (F.col("_us") - window_seconds * MICROS).alias("_when"), F.lit(1).alias("_kind"), "_us", nothing)
    fills = points.select("series", F.col("_us").alias("_when"), F.lit(0).alias("_kind"), "_us", "_upto")
    read = running(
        fills.unionByName(reads), ["series"], ["_when", "_kind", "_us"], {"_before": ("last", "_upto")},
        rows_per_slice=rows_per_slice,
    ).where("_kind = 1").select("series", "_us", F.coalesce("_before", F.lit(0)).alias("_before"))
    # joined on the time too, so a busy series spreads
    trailing = points.join(read, ["series", "_us"]).select("series", "_us", (F.col("_upto") - F.col("_before")).alias("_sum"))
    return risen.join(trailing, ["series", "_us"]).select(
        "series", "ts", "tie", "value", "increase", F.round(F.col("_sum") / window_seconds, 6).alias("rate")
    )


def latest_sample(samples: DataFrame) -> DataFrame:
    """Last non-null value of each series."""
    at = F.when(F.col("value").isNotNull(), F.struct("ts", "tie"))
    return samples.groupBy("series").agg(F.max_by("value", at).alias("value"), F.max(at).alias("_at")).select(
        "series", "value", F.col("_at.ts").alias("ts")
    )


def request_rate(
    log: DataFrame, width_seconds: int = 60, slide_seconds: int = 5, labels: Sequence[str] = ()
) -> DataFrame:
    """Requests per second over sliding windows.

    Rows are counted per slide first; only those counts are spread over the
    ``width / slide`` windows they belong to.
    """
    step = slide_seconds * MICROS
    cell = F.timestamp_micros((F.floor(micros(F.col("ts")) / step) * step).cast("bigint")).alias("ts")
    cells = log.groupBy(*labels, cell).agg(F.count(F.lit(1)).alias("n"))
    return spread_cells(cells, width_seconds, slide_seconds, labels)


def spread_cells(
    cells: DataFrame, width_seconds: int, slide_seconds: int, labels: Sequence[str] = ()
) -> DataFrame:
    """Counts per slide (``ts``, ``n``) to rates per sliding window."""
    step, size = slide_seconds * MICROS, width_seconds * MICROS
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(width_seconds // slide_seconds - 1)), lambda i: micros(F.col("ts")) - i * step
    )
    return (
        cells.select(*labels, "n", F.explode(starts).alias("_start"))
        .groupBy(*labels, "_start")
        .agg(F.sum("n").alias("n"))
        .select(
            *labels,
            F.timestamp_micros("_start").alias("window_start"),
            F.timestamp_micros(F.col("_start") + size).alias("window_end"),
            "n",
            F.round(F.col("n") / width_seconds, 6).alias("rate"),
        )
    )


def sliding_red(
    log: DataFrame, width_seconds: int = 60, slide_seconds: int = 5, labels: Sequence[str] = ()
) -> DataFrame:
    """Request rate, rate of 5xx answers and mean duration over the same sliding windows, in one pass.

    As in ``request_rate`` rows are summed up per slide before they are spread.
    """
    step, size = slide_seconds * MICROS, width_seconds * MICROS
    start = (F.floor(micros(F.col("ts")) / step) * step).cast("bigint")
    cells = log.groupBy(*labels, start.alias("_at")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status").between(500, 599)).alias("n_errors"),
        F.sum(F.col("duration_s").cast("decimal(18,6)")).alias("_spent"),
    )
    starts = F.transform(F.sequence(F.lit(0), F.lit(width_seconds // slide_seconds - 1)), lambda i: F.col("_at") - i * step)
    spread = cells.select(*labels, "n", "n_errors", "_spent", F.explode(starts).alias("_start"))
    summed = spread.groupBy(*labels, "_start").agg(*[F.sum(c).alias(c) for c in ("n", "n_errors", "_spent")])
    return summed.select(
        *labels,
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + size).alias("window_end"),
        F.round(F.col("n") / width_seconds, 6).alias("rate"),
        F.round(F.col("n_errors") / width_seconds, 6).alias("error_rate"),
        F.round(F.col("_spent").cast("double") / F.col("n"), 6).alias("mean_duration_s"),
    )


def recent_window(log: DataFrame, span: str = "INTERVAL 15 MINUTES") -> DataFrame:
    """Rows younger than ``span`` before the newest row.

    The newest time is a scalar subquery, answered from the file statistics or a
    one-column scan; it is then an ordinary filter of the second scan.
    """
    newest = log.agg(F.max("ts").alias("_t")).scalar()
    return log.where(F.col("ts") > newest - F.expr(span))


def error_rate_zero_filled(log: DataFrame, status_pattern: str = "5..", width_seconds: int = 60) -> DataFrame:
    """Rate of matching statuses per window, zero where there is none.

    The pattern must match the whole status. The spine has one row per window of
    the time range, whatever the number of requests.
    """
    step = width_seconds * MICROS
    slot = F.floor(micros(F.col("ts")) / step)
    errors = (
        log.where(F.col("status").cast("string").rlike(f"^(?:{status_pattern})$"))
        .groupBy(slot.alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # blocks of windows first, dealt out before they are filled: no row holds the whole range
    ends = log.agg(F.min(slot).alias("_lo"), F.max(slot).alias("_hi"))
    blocks = ends.select("_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") / SPINE), F.floor(F.col("_hi") / SPINE))).alias("_b"))
    low, high = F.greatest("_lo", F.col("_b") * SPINE), F.least("_hi", F.col("_b") * SPINE + SPINE - 1)
    spine = blocks.repartition("_b").select(F.explode(F.sequence(low, high)).alias("_slot"))
    n = F.coalesce("_n", F.lit(0).cast("bigint"))
    return spine.join(errors, "_slot", "left").select(
        F.timestamp_micros(F.col("_slot") * step).alias("window_start"),
        n.alias("n"),
        F.round(n / width_seconds, 6).alias("rate"),
    )


def snapshot_lines(totals: DataFrame, histogram: DataFrame, counters: DataFrame | None = None, prefix: str = "http") -> DataFrame:
    """All series of one service as text lines, label names in order.

    ``prefix`` names the families of requests and durations; ``counters`` (metric, value) are added as they are.
    """

    def pair(name: str) -> Column:
        return F.concat(F.lit(f'{name}="'), F.col(name).cast("string"), F.lit('"'))

    def line(metric: str, labels: Sequence[str], value: Column) -> Column:
        return F.concat(
            F.lit(metric + "{"), F.concat_ws(",", *[pair(x) for x in labels]), F.lit("} "), value
        ).alias("line")

    count_value = F.concat(F.col("value").cast("string"), F.lit(".0"))
    requests = totals.select(line(f"{prefix}_requests_total", ("endpoint", "method", "status"), count_value))
    name = f"{prefix}_request_duration_seconds"
    buckets = histogram.select(line(f"{name}_bucket", ("endpoint", "le", "method"), count_value))
    per_series = histogram.where("le = '+Inf'")
    counts = per_series.select(
        line(f"{name}_count", ("endpoint", "method"), F.concat(F.col("count").cast("string"), F.lit(".0")))
    )
    sums = per_series.select(
        line(f"{name}_sum", ("endpoint", "method"), F.col("sum").cast("decimal(18,6)").cast("string"))
    )
    lines = requests.unionByName(buckets).unionByName(counts).unionByName(sums)
    if counters is not None:
        lines = lines.unionByName(counters.select(F.concat("metric", F.lit(" "), count_value).alias("line")))
    return lines
