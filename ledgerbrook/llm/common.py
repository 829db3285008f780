"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerbrook.session import run_dir

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return (a fixed value).
SEPARATORS = r"[\x20\x09-\x0D]+"


#: Tables kept in each of the scopes that are open.
_OPEN: list[list[str]] = []


def keep(df: DataFrame, label: str = "kept") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage is cut, columns stay prunable."""
    return _kept(df, label, _OPEN[-1] if _OPEN else None)


def _kept(df: DataFrame, label: str, scope: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = run_dir(spark, f"llm-{label}")
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Remove the tables that are kept inside when the block ends; what it yields keeps a table beyond the block.

    Nothing but the table handed on may be read afterwards. The shuffle files behind removed tables go with them.
    """
    own: list[str] = []
    _OPEN.append(own)
    outer = _OPEN[-2] if len(_OPEN) > 1 else None
    try:
        yield lambda df, label: _kept(df, label, outer)
    finally:
        _OPEN.remove(own)
        conf = spark._jsc.hadoopConfiguration()
        for path in own:
            found = spark._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(conf).delete(found, True)
        give_up_shuffles(spark)


def give_up_shuffles(spark: SparkSession) -> None:
    """Ask Spark to drop the shuffle files behind what has been written: it does when the driver has collected the plans."""
    # once is not enough for the plan of the last write; Python hands its references back a moment later
    for _ in range(2):
        gc.collect()
        time.sleep(0.2)
        spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _reachable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed but lies in the same place (local runs)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file, installed alike on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one value: beside it, no helper column can meet a column of the caller."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias("row")


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def first_by(df: DataFrame, key: Column, n: int) -> DataFrame:
    """One row for each of the ``n`` smallest values of ``key``; only keys meet in one place."""
    keyed = df.withColumn("_key", key)
    edge = keyed.select("_key").distinct().orderBy("_key").limit(n).agg(F.max("_key")).first()[0]
    return keyed.where(F.col("_key") <= F.lit(edge)).dropDuplicates(["_key"]).drop("_key")


def ranked(df: DataFrame, keys: list[Column], name: str = "_rank") -> DataFrame:
    """``df`` with the global position of each row in the order of ``keys``, from 0.

    Range partitions are cut over the whole key tuple, so a hot leading key still
    spreads. The sorted rows are written once; the positions come from the row
    numbers in that table and one offset per partition, so no task sees all rows.
    The range sort looks at its input twice, so hand in what is cheap to read.
    """
    sorted_rows = keep(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("_at", 33)
    sizes = sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition of the sort: as many as tasks, whatever the rows
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        sorted_rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + inside)
        .drop("_part", "_before", "_at")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node reachable.

    Alternating large-star and small-star steps: every step is an aggregate with
    map-side combine and a join, and the number of rounds grows with the logarithm
    of the longest path. Nodes without edges do not appear.
    """
    with scratch(edges.sparkSession) as hand_on:
        current = hand_on(_stars(edges), "edges")
    root = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        root.select("node", F.col("node").alias("root"))
    )


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) from every node to the root of its component."""

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        met = both.join(smallest(both), "u").where("v > u")
        return met.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        met = down.join(smallest(down), "u")
        linked = met.select(F.col("v").alias("a"), F.col("m").alias("b"))
        return linked.union(met.select("u", "m")).where("a != b").distinct()

    def stars_only(e: DataFrame) -> bool:
        """Every node points once, and to a node that points nowhere."""
        twice = e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        inner = e.select(F.col("b").alias("a")).join(e.select("a"), "a", "left_semi")
        return twice.union(inner).isEmpty()

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = keep(down.where("a != b").distinct(), "edges")
    while not stars_only(current):
        current = keep(small_star(large_star(current)), "edges")
    return current
