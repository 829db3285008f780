"""Mixing: targets by hand, the dual, copies near the targets."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerbrook.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, size int"


def targets_by_hand(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        share = {s: (left - sum(fixed.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > cap * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in above}


def check(spark, rows):
    out = mixing.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    source = defaultdict(list)
    for d, text, s, *_ in rows:
        sizes[s] += len((text or "").split())
        source[d].append(s)
    want = targets_by_hand(sizes) if sizes else {}
    taken, smallest = defaultdict(int), {}
    for r in out:
        s = source[r["doc_id"]][0]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        if r["size"]:
            smallest[s] = min(smallest.get(s, r["size"]), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= smallest.get(s, 0) / 2 + 1e-6, (s, t, want[s])
    return out


def test_targets_and_copies(spark):
    rows = [(i, "w " * (1 + i * 7919 % 400), ["a", "b", None, "c", "B"][i % 5], "t", 1) for i in range(400)]
    rows += [(1000 + i, "w " * 50, "a", "t", 1) for i in range(900)]
    rows += [(5000, None, "empty", "t", 1), (5001, "", "a", "t", 1), (5002, "x " * 20000, "c", "t", 1), (None, "q r", "null", "t", 1)]
    first = check(spark, rows)
    again = mixing.report(spark.createDataFrame(rows[::-1], SCHEMA)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_caps_cascade(spark):
    rows = [(0, "w " * 1000, "a", "t", 1), (1, "w " * 10, "b", "t", 1), (2, "w", "c", "t", 1), (3, "w w w", "d", "t", 1)]
    out = mixing.report(spark.createDataFrame(rows, SCHEMA))
    want = targets_by_hand({"a": 1000, "b": 10, "c": 1, "d": 3})
    assert {r["doc_id"]: r["target"] for r in out.collect()} == {i: pytest.approx(want[s]) for i, s in enumerate("abcd")}


def test_tilts_solve_the_dual(spark):
    """The rates meet each target, and all stay exponential in the size."""
    sizes = [(s, n, c) for s in ("=a", "=b") for n, c in ((10, 30), (50, 20), (400, 3))]
    classes = spark.createDataFrame(sizes, "sid string, size long, n long")
    total = sum(n * c for s, n, c in sizes if s == "=a")
    goals = [("=a", total / 93 * 53 / 53, 0.4 * total, total), ("=b", total / 53, 2.2 * total, total)]
    goals = spark.createDataFrame(goals, "sid string, mean double, target double, source_size long")
    tilt = mixing.tilts(classes, goals)
    rate = F.least(F.lit(3.0), F.exp(F.col("t") * F.col("size") / F.col("mean")))
    met = classes.join(tilt, "sid").join(goals, "sid").groupBy("sid").agg(F.sum(F.col("n") * F.col("size") * rate).alias("g"), F.first("target").alias("target"))
    for r in met.collect():
        assert r["g"] == pytest.approx(r["target"], rel=1e-8)


def test_resampled(spark):
    rows = [(i, "w " * (5 + i % 9), "ab"[i % 2], "t", 1) for i in range(60)] + [(3, "w w w w w w w w", "b", "t", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.resampled(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["source"]] += len(r["text"].split())
    sizes = {"a": sum(len(r[1].split()) for r in rows if r[2] == "a"), "b": sum(len(r[1].split()) for r in rows if r[2] == "b")}
    for s, t in targets_by_hand(sizes).items():
        assert abs(words[s] - t) <= 7


def test_empty(spark):
    assert mixing.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.report(spark.createDataFrame([(1, None, "a", "t", 1)], SCHEMA)).first()["taken"] == 0
