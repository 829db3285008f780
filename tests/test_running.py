"""Running aggregates: cut into slices or not, the result is the plain fold."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerbrook.operators import inventory
from ledgerbrook.operators.running import SLICE, numbered, previous, running, sliced


def _rows(seed):
    rng = random.Random(seed)
    # key 0 holds most rows
    return [
        (rng.choice([0, 0, 0, 1, 2, None]), rng.randint(0, 300), i, rng.choice([None, rng.randint(-9, 9)]))
        for i in range(400)
    ]


def _expected(rows):
    out = {}
    for key in {r[0] for r in rows}:
        total, low, last, before = 0, None, None, None
        seen = False
        for _, _, i, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            out[i] = {"prev": before}
            total += v or 0
            low = v if low is None else (low if v is None else min(low, v))
            last = v if v is not None else last
            seen = seen or v is not None
            out[i].update(total=total, low=low, last=last)
            before = v
    return out


@pytest.mark.parametrize("per_slice", [1_000_000, 20, 3])
def test_running(spark, per_slice):
    rows = _rows(per_slice)
    df = spark.createDataFrame(rows, "k bigint, t bigint, i bigint, v bigint")
    ran = running(
        df,
        ["k"],
        ["t", "i"],
        {"total": ("sum", "v"), "low": ("min", "v"), "last": ("last", "v")},
        rows_per_slice=per_slice,
    )
    got = {r["i"]: r for r in ran.collect()}
    prev = {r["i"]: r["prev"] for r in previous(df, ["k"], ["t", "i"], {"prev": "v"}, per_slice).collect()}
    expected = _expected(rows)
    assert len(got) == len(rows)
    for i, want in expected.items():
        assert (got[i]["total"] or 0, got[i]["low"], got[i]["last"]) == (want["total"], want["low"], want["last"])
        assert prev[i] == want["prev"]


def test_only_hot_keys_are_cut(spark):
    df = spark.createDataFrame(_rows(1), "k bigint, t bigint, i bigint, v bigint")
    cut = sliced(df, ["k"], ["t", "i"], 100).groupBy("k").agg(F.countDistinct(SLICE).alias("n")).collect()
    assert {r["k"]: r["n"] > 0 for r in cut} == {0: True, 1: False, 2: False, None: False}


SHAPES = {
    "nulls": lambda rng, i: None if rng.random() < 0.3 else rng.randint(0, 50),
    "ties": lambda rng, i: 7,
    "outlier": lambda rng, i: 10**15 if i == 3 else i % 40,
    "burst": lambda rng, i: 1_700_000_000_000_000 + i // 50,
    "tiny": lambda rng, i: rng.random() / 1000,
    "text": lambda rng, i: None if i % 9 == 0 else f"k{rng.randint(0, 60)}",
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_any_order_at_any_slice_size(spark, shape):
    """The sliced results equal a plain window, and a hot key splits whatever its order looks like."""
    rng = random.Random(len(shape))
    kind = {"tiny": "double", "text": "string"}.get(shape, "bigint")
    rows = [(rng.choice([0, 0, 0, 0, 1, None]), SHAPES[shape](rng, i), i, rng.choice([None, rng.randint(-9, 9)])) for i in range(600)]
    df = spark.createDataFrame(rows, f"k bigint, t {kind}, i bigint, v bigint")
    upto = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["i"]: (r["s"], r["m"], r["l"]) for r in df.select(
        "i", F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("s"), F.min("v").over(upto).alias("m"),
        F.last("v", True).over(upto).alias("l")).collect()}
    for per_slice in (1_000_000, 60, 10):
        ran = running(df, ["k"], ["t", "i"], {"s": ("sum", "v"), "m": ("min", "v"), "l": ("last", "v")}, rows_per_slice=per_slice)
        assert {r["i"]: (r["s"] or 0, r["m"], r["l"]) for r in ran.collect()} == want, per_slice
        cut = sliced(df, ["k"], ["t", "i"], per_slice).where(f"{SLICE} IS NOT NULL")
        most = cut.groupBy("k", SLICE).count().agg(F.max("count")).first()[0]
        assert most is None or most <= 2 * per_slice, (per_slice, most)


@pytest.mark.parametrize("per_slice", [1_000_000, 10])
def test_numbered(spark, per_slice):
    df = spark.range(0, 500).withColumn("t", F.expr("cast(pmod(id * 7919, 101) as timestamp)"))
    got = [r["n"] for r in numbered(df, ["t", "id"], "n", per_slice).orderBy("t", "id").collect()]
    assert got == list(range(1, 501))


@pytest.mark.parametrize("per_slice", [1_000_000, 5])
def test_balance_stops_at_zero(spark, per_slice):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2]), t, rng.randint(-6, 5), 2) for t in range(200)]
    df = spark.createDataFrame(rows, "product_id bigint, t bigint, change bigint, opening bigint")
    got = {
        r["t"]: r["reserved"]
        for r in inventory.reserved_balance(df, ["t"], rows_per_slice=per_slice).collect()
    }
    held = {1: 2, 2: 2}
    for product, t, change, _ in rows:
        held[product] = max(0, held[product] + change)
        assert got[t] == held[product]


@pytest.mark.parametrize("per_slice", [1_000_000, 60, 10])
def test_balance_with_null_keys_changes_and_openings(spark, per_slice):
    rng = random.Random(8)
    rows = [
        (rng.choice([1, 1, 1, 2, None]), t, rng.choice([None, rng.randint(-6, 5)]), None if t % 7 == 0 else 2) for t in range(300)
    ]
    df = spark.createDataFrame(rows, "product_id bigint, t bigint, change bigint, opening bigint")
    upto = Window.partitionBy("product_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("s", F.coalesce(F.sum("change").over(upto), F.lit(0)) + F.col("opening"))
    want = {r["t"]: r["b"] for r in summed.select("t", (F.col("s") - F.least(F.lit(0), F.min("s").over(upto))).alias("b")).collect()}
    got = inventory.reserved_balance(df, ["t"], rows_per_slice=per_slice).collect()
    assert {r["t"]: r["reserved"] for r in got} == want and len(got) == len(rows)


def test_balance_moves_its_rows_once(spark):
    df = spark.range(100).selectExpr("id % 7 AS product_id", "id AS t", "5 - id % 11 AS change", "0L AS opening")
    found = inventory.reserved_balance(df, ["t"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert found._jdf.queryExecution().explainString(mode).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(("per_slice", "passes"), [(1_000_000, 1), (10, 2)])
def test_keys_are_counted_in_few_passes(spark, per_slice, passes):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(40).selectExpr("id % 2 AS k", "id AS t").mapInArrow(count, "k bigint, t bigint")
    sliced(df, ["k"], ["t"], per_slice)
    # cutting the slices reads the rows twice more: once for the bounds
    assert seen.value == 40 * (passes + (2 if passes > 1 else 0))
