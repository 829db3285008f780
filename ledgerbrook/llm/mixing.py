"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: the number of copies it goes into the mix with. Among
all rates that give each source its target of words, the balanced ones stay closest
in entropy to taking every document once. Their form is ``min(cap, exp(t * x))``,
x the size of the document over the mean size of its source, and the tilt t of each
source solves the convex dual; documents at the cap are a kink of it, nothing more.
Newton steps on all sources at once are one aggregate over the histogram of sizes,
with bisection where a step would leave the bracket.

Rates become whole copies per (source, size) class, from the largest size down,
each class taking over the rounding error of those before it; so a source misses
its target by less than about one of its small documents. Within a class the extra
copies go to the first documents in the order of a hash of doc_id.

Targets share all words by weight over the sources in code point order, null last;
weights repeat. A target stops at ``cap`` times the words of its source, what it
leaves is shared by the others again, until none is above.

The histogram has at most as many rows a source as the sizes it holds, whatever the
number of documents.

Defined cases: a null or empty text has size 0 and is taken once, which adds no
words. A source without words has target 0. Repeated rows are documents of their
own. A null doc_id is kept. Extra columns are ignored, an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, ranked, whole_row, words

WEIGHTS = (1, 2, 3)
CAP = 3
STEPS = 60
TOLERANCE = 1e-9


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Rows (source, source_size, ...) with ``target``; the driver holds sums only."""
    order = [F.col("source").isNull(), F.col("source")]
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    rows = keep(ranked(keep(sources, "sources"), order).withColumn("weight", weight.cast("double")).drop("_rank"), "sources")
    full = F.col("source_size") * float(cap)
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, held = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > full
        found = rows.agg(
            F.sum(F.when(above, full)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if found["n"] == held or not found["open"]:
            break
        held, level = found["n"], (total - (found["capped"] or 0.0)) / found["open"]
    target = F.least(full, F.col("weight") * F.lit(float(level or 0.0)))
    return rows.select(*sources.columns, target.alias("target"))


def tilts(classes: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """The tilt of each source (key ``sid``), from classes (sid, size, n) and sources (sid, mean, source_size, target).

    A source whose target is all it may give, or nothing, has an infinite tilt.
    """
    state = sources.select(
        "sid",
        "mean",
        "target",
        F.lit(0.0).alias("t"),
        F.lit(-1024.0).alias("low"),
        F.lit(1024.0).alias("high"),
        ((F.col("target") <= 0) | (F.col("target") >= cap * F.col("source_size"))).alias("done"),
    )
    state = keep(state, "tilts")
    x = F.col("size") / F.col("mean")
    rate = F.least(F.lit(float(cap)), F.exp(F.col("t") * x))
    open_ = F.exp(F.col("t") * x) < cap
    for _ in range(STEPS):
        left = state.where("NOT done").select("sid", "mean", "t")
        if left.isEmpty():
            break
        words_ = F.col("n") * F.col("size")
        sums = (
            classes.where("size > 0")
            .join(left, "sid")
            .groupBy("sid")
            .agg(F.sum(words_ * rate).alias("g"), F.sum(F.when(open_, words_ * rate * x)).alias("slope"))
        )
        off = F.col("g") - F.col("target")
        low, high = F.when(off < 0, F.col("t")).otherwise(F.col("low")), F.when(off > 0, F.col("t")).otherwise(F.col("high"))
        newton = F.col("t") - F.try_divide(off, F.col("slope"))
        inside = (newton > low) & (newton < high)
        ready = F.abs(off) <= TOLERANCE * F.col("target")
        state = state.join(sums, "sid", "left").select(
            "sid",
            "mean",
            "target",
            F.when(F.col("done") | ready, F.col("t")).when(inside, newton).otherwise((low + high) / 2).alias("t"),
            low.alias("low"),
            high.alias("high"),
            (F.col("done") | ready | (high - low < 1e-12)).alias("done"),
        )
        state = keep(state, "tilts")
    return state.select("sid", "t")


def rounded(classes: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each class (sid, size, n, rate) of one source, errors carried to the next smaller size."""
    classes = classes.sort_values("size", ascending=False)
    size, n, rate = (classes[c].to_numpy() for c in ("size", "n", "rate"))
    cap = int(classes["cap"].iloc[0])
    copies, carry = np.empty(len(classes), np.int64), 0.0
    for i in range(len(classes)):
        wanted = n[i] * rate[i] + (carry / size[i] if size[i] else 0.0)
        copies[i] = min(cap * int(n[i]), max(0, int(np.floor(wanted + 0.5))))
        carry += (n[i] * rate[i] - copies[i]) * size[i]
    return pd.DataFrame({"sid": classes["sid"], "size": classes["size"], "copies": copies})


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``rows`` (doc_id, source, _size, _mark, anything else) with _source_size, _target and _copies."""
    sid = F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source"))
    # the order inside a class depends on the number and the text alone, so reruns agree
    keyed = rows.withColumns({"_sid": sid, "_order": F.xxhash64("doc_id")})
    placed = ranked(keyed, [F.col(c) for c in ("_sid", "_size", "_order", "doc_id", "_mark")])
    classes = placed.groupBy("_sid", "_size").agg(
        F.first("source").alias("source"), F.count("*").alias("n"), F.min("_rank").alias("first")
    )
    classes = keep(classes.withColumnsRenamed({"_sid": "sid", "_size": "size"}), "size-classes")
    per_source = classes.groupBy("sid").agg(
        F.first("source").alias("source"),
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("filled"),
    )
    goals = targets(per_source, weights, cap).withColumn("mean", F.col("source_size") / F.col("filled"))
    goals = keep(goals, "targets")
    solved = goals.join(tilts(classes, goals, cap), "sid")
    full = float(cap)
    rate = (
        F.when(F.col("size") == 0, 1.0)
        .when(F.col("target") <= 0, 0.0)
        .when(F.col("target") >= full * F.col("source_size"), full)
        .otherwise(F.least(F.lit(full), F.exp(F.col("t") * F.col("size") / F.col("mean"))))
    )
    rated = classes.join(solved.drop("source"), "sid").withColumn("rate", rate).withColumn("cap", F.lit(cap))
    # one group is the distinct sizes of one source: bounded by the longest text, not by the rows
    whole = rated.select("sid", "size", "n", "rate", "cap").groupBy("sid").applyInPandas(
        rounded, "sid string, size long, copies long"
    )
    whole = rated.join(whole, ["sid", "size"]).select(
        F.col("sid").alias("_sid"),
        F.col("size").alias("_size"),
        "n",
        "first",
        "copies",
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
    )
    out = placed.join(keep(whole, "copies"), ["_sid", "_size"])
    extra = (F.col("_rank") - F.col("first")) < F.col("copies") % F.col("n")
    copies = F.floor(F.col("copies") / F.col("n")) + extra.cast("long")
    return out.withColumn("_copies", copies.cast("long")).select(
        *rows.columns, "_source_size", "_target", "_copies"
    )


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_size``, the number of words of the text, and ``_mark``, which tells texts of one doc_id apart."""
    size = F.size(words(F.col("text"))).cast("long")
    return docs.withColumns({"_size": size, "_mark": F.xxhash64(F.coalesce("text", F.lit("")))})


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    rows = keep(sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    return mix(rows).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def resampled(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    rows = sized(docs.select(whole_row(docs), "doc_id", "source", "text")).drop("text")
    mixed = mix(rows).where("_copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("row.*")
