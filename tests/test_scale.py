"""Operators on one hot key: results against plain folds, and rows spread over tasks."""

import random
from bisect import bisect_right

from pyspark.sql import functions as F

from ledgerbrook.operators import catalog, metrics, payments
from ledgerbrook.streaming.operators import causes
from ledgerbrook.streaming.runtime import StreamRun


def _samples(spark, n=600, series=1):
    rng = random.Random(3)
    rows, value, t = [], 0, 0
    for tie in range(n):
        t += rng.choice([0, 1, 7, 30, 61, 200])
        value = 0 if rng.random() < 0.05 else value + rng.randint(0, 9)
        rows.append((f"s{tie % series}", t, tie, value))
    return rows, spark.createDataFrame(rows, "series string, s bigint, tie bigint, value bigint").withColumn("ts", F.timestamp_seconds("s"))


def _rates(rows):
    out, grown = {}, {}
    last = {}
    for name, t, tie, value in rows:
        rise = 0 if name not in last else value if value < last[name] else value - last[name]
        last[name] = value
        grown.setdefault(name, []).append((t, rise))
        out[tie] = rise
    rates = {}
    for name, t, tie, _ in rows:
        rates[tie] = (out[tie], round(sum(r for at, r in grown[name] if t - 60 < at <= t) / 60, 6))
    return rates


def test_rate_of_one_hot_series(spark):
    """The plain window and the sliced passes agree with a fold."""
    rows, samples = _samples(spark)
    for per_slice in (10**6, 20):
        got = metrics.counter_rate(samples, rows_per_slice=per_slice).collect()
        assert {r["tie"]: (r["increase"], r["rate"]) for r in got} == _rates(rows)


def test_hot_series_spread_over_tasks(spark):
    """Where one series holds all rows, no task of the result holds more than a few slices."""
    _, samples = _samples(spark, 4000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = metrics.counter_rate(samples, rows_per_slice=100)
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_lookup_with_a_hot_bucket(spark):
    rng = random.Random(4)
    versions = [(i, 1, rng.randint(0, 500), rng.choice([None, float(i)])) for i in range(300)]
    reads = [(1000 + i, 1, rng.randint(0, 700)) for i in range(300)]
    of = lambda rows, more: spark.createDataFrame(rows, f"id bigint, key bigint, s bigint{more}").withColumn("ts", F.timestamp_seconds("s"))
    asked, held = of(reads, "").drop("s"), of(versions, ", value double").drop("s")
    ordered = sorted((s, i, v) for i, _, s, v in versions)
    expected = {}
    for i, _, s in reads:
        at = bisect_right([(a, b) for a, b, _ in ordered], (s, float("inf")))
        found = ordered[at - 1] if at else None
        expected[i] = found[2] if found and s - found[0] <= 100 else None
    for per_slice in (10**6, 20):
        got = catalog.asof_with_ttl(asked, held, 100, rows_per_slice=per_slice).collect()
        assert {r["id"]: r["value"] for r in got} == expected


def test_sketches_keep_their_rank_error(spark):
    """Windows far beyond the size of a sketch: the rank of the answer is off by the stated share at most."""
    k = 200
    log = spark.range(60_000).select(
        F.timestamp_seconds((F.col("id") % 120).cast("bigint")).alias("ts"),
        F.lit("GET").alias("method"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000.0).alias("duration_s"),
    )
    got = metrics.sliding_percentile(log, 0.95, 60, 30, k=k).collect()
    whole = sorted((r["ts"], r["duration_s"]) for r in log.collect())
    assert len(got) == 5
    for r in got:
        inside = sorted(d for t, d in whole if r["window_start"] <= t < r["window_end"])
        assert r["n"] == len(inside) > 10_000
        assert abs(bisect_right(inside, r["p95"]) / len(inside) - 0.95) <= 3.3 / k


def test_one_scan_and_no_large_row(spark):
    log = spark.createDataFrame([(5, "GET", 1.5, 500), (3_000_000, "GET", 2.5, 200)], "s bigint, method string, duration_s double, status bigint")
    log = log.withColumn("ts", F.timestamp_seconds("s"))
    rows = metrics.error_rate_zero_filled(log)
    assert rows.count() == 50_001 and rows.agg(F.sum("n")).first()[0] == 1
    assert metrics.error_rate_zero_filled(log.where("false")).count() == 0


def test_causes_meet_effects_as_they_arrive(spark):
    """Answers in later batches, several of one order, too late ones, and orders nobody answers."""
    rows = lambda *r: spark.createDataFrame(list(r), "kind string, order_id bigint, seq bigint, s bigint").withColumn("occurred_at", F.timestamp_seconds("s"))
    slices = [
        rows(("ask", 1, 1, 100), ("ask", 2, 2, 110), ("tell", 1, 3, 120)),
        rows(("tell", 1, 4, 150), ("ask", 3, 5, 150), ("tell", 9, 6, 155)),
        rows(("tell", 2, 7, 300), ("ask", 4, 8, 310)),
        rows(("ask", -1, -1, 10_000), ("tell", -2, -2, 10_000)),
        rows(("ask", -1, -3, 20_000), ("tell", -2, -4, 20_000)),
    ]
    run = StreamRun(spark, "test-causes")
    run.replay(
        slices,
        lambda r: causes(r.where("kind = 'ask'"), r.where("kind = 'tell'"), "INTERVAL 100 SECONDS").writeStream.foreachBatch(run.sink),
    )
    got = run.kept("order_id bigint, cause bigint, effect bigint, outcome string").where("order_id > 0").drop("batch").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            (1, 1, 3, "answered"), (1, 1, 4, "answered"), (2, 2, None, "timed_out"), (2, None, 7, "unexplained"),
            (3, 5, None, "timed_out"), (4, 8, None, "timed_out"), (9, None, 6, "unexplained"),
        ],
        key=str,
    )


def test_rules_are_columns(spark):
    """The payment rule is a parameter, not a function by row."""
    events = spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None)], "order_id bigint, amount double")
    ruled = payments.decide(events, rule=F.when(F.col("amount") > 10, "FAILED").otherwise("COMPLETED"))
    assert {r["order_id"]: (r["amount"], r["status"]) for r in ruled.collect()} == {
        1: (5.0, "COMPLETED"), 2: (50.0, "FAILED"), 3: (0.0, "COMPLETED"),
    }
    plan = ruled._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
