"""Running aggregates that hold when one key owns a large part of the rows.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. The functions
here first count rows per key. The rows of keys above ``rows_per_slice`` are cut
into slices by a range partitioning over key and whole order, so ties, bursts,
outliers and nulls in the first order column split like everything else, and any
type that can be ordered serves. Slices are windowed apart, each is summarised with
an ordinary aggregate, and what the earlier slices add up to is joined back. All
other keys take the plain window. The slices are written before they are used:
range bounds come from a sample, and must not move between two reads.

Size bound of the two broadcast tables: a key is cut only when it holds more than
``max(rows_per_slice, total / MAX_HOT_KEYS)`` rows, so there are fewer than
``MAX_HOT_KEYS`` such keys. Their rows go to ``SPLIT`` slices for each such number,
so all slices together are fewer than ``(SPLIT + 2) * MAX_HOT_KEYS``, whatever the
size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.session import cut_lineage

ROWS_PER_SLICE = 1_000_000
MAX_HOT_KEYS = 50_000
SPLIT = 4
SLICE = "_slice"


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``_slice``: null for a key that fits one task, else a number growing along ``order``."""
    return _sliced(df, keys, order, rows_per_slice)[0]


def _sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int
) -> tuple[DataFrame, bool]:
    """``sliced``, and whether any key was cut."""
    keys, order = list(keys), list(order)
    spans = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one pass over the input tells whether any key is hot
    total, largest = spans.agg(F.sum("_n"), F.max("_n")).first()
    most = max(rows_per_slice, (total or 0) / MAX_HOT_KEYS)
    none = df.withColumn(SLICE, F.lit(None).cast("bigint"))
    if (largest or 0) <= most:
        return none, False
    # fewer than MAX_HOT_KEYS rows, read twice: written, so that the input is not counted again for each
    hot = cut_lineage(spans.where(F.col("_n") > most))
    rows = hot.agg(F.sum("_n")).first()[0]
    if keys:
        match = F.lit(True)
        for i, k in enumerate(keys):
            match = match & F.col(k).eqNullSafe(F.col(f"_h{i}"))
        named = F.broadcast(hot.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]))
        # one pass over the rows: the cold ones go on as they are
        marked = df.join(named.withColumn("_hot", F.lit(True)), match, "left").select(*df.columns, "_hot")
        cold = marked.where("_hot IS NULL").drop("_hot").withColumn(SLICE, F.lit(None).cast("bigint"))
        warm = marked.where("_hot").drop("_hot")
    else:
        cold, warm = None, df
    cut = warm.repartitionByRange(math.ceil(rows / most) * SPLIT, *keys, *order)
    cut = cut_lineage(cut.withColumn(SLICE, F.spark_partition_id().cast("bigint")))
    return cold.unionByName(cut) if cold is not None else cut, True


def _inner(kind: str, column: str) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True)
    return getattr(F, kind)(column)


def _summary(kind: str, column: str, order: Sequence[str]) -> Column:
    if kind == "last":
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))
    return getattr(F, kind)(column)


def _combine(kind: str, carry: Column, inner: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry + inner, inner, carry, F.lit(0))
    if kind == "min":
        return F.least(carry, inner)
    if kind == "max":
        return F.greatest(carry, inner)
    return F.coalesce(inner, carry)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, str]],
    inclusive: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add running aggregates per ``keys`` in ``order``.

    ``outputs`` maps a new column to ``(kind, column)`` with kind one of ``sum``,
    ``min``, ``max``, ``last`` (last non-null). ``order`` must be total within a
    key. With ``inclusive=False`` the current row is left out.
    """
    keys, order = list(keys), list(order)
    rows, hot = _sliced(df, keys, order, rows_per_slice)
    return over_slices(rows, keys, order, outputs, inclusive, hot).select(*df.columns, *outputs)


def _dealt(rows: DataFrame, keys: list[str], hot: bool) -> DataFrame:
    """Rows by key and slice, asked for outright where a key is cut.

    Rows that lie hash-partitioned by the keys alone would satisfy the window too, and leave a hot key
    in one task. Where no key is cut the slice is a constant that Spark drops from the window, which
    would then move the rows once more.
    """
    return rows.repartition(*keys, SLICE) if hot else rows


def over_slices(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, tuple[str, str]],
    inclusive: bool,
    hot: bool = True,
) -> DataFrame:
    """``running`` on rows that carry their ``_slice`` already; ``hot`` tells whether any key may be cut."""
    upto = 0 if inclusive else -1
    rows = _dealt(rows, keys, hot)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    local = rows.select("*", *[_inner(k, c).over(inside).alias(f"_i_{n}") for n, (k, c) in outputs.items()])

    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.where(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(*[_summary(k, c, order).alias(f"_s_{n}") for n, (k, c) in outputs.items()])
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col(SLICE).alias("_at"),
            *[_inner(k, f"_s_{n}").over(before).alias(f"_c_{n}") for n, (k, _) in outputs.items()],
        )
    )
    match = F.col(SLICE) == F.col("_at")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(F.broadcast(carried), match, "left").select(
        *rows.columns,
        *[_combine(k, F.col(f"_c_{n}"), F.col(f"_i_{n}")).alias(n) for n, (k, _) in outputs.items()],
    )


def lowest_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    change: str,
    opening: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``_sum``, the running sum of ``change`` upon ``opening``, and ``_low``, the lowest such sum so far.

    Both come from one shuffle and one sort: the lowest sum of a slice is
    taken of its own sums, and what the earlier slices add up to shifts it as a whole.
    """
    rows, hot = _sliced(df, keys, order, rows_per_slice)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = _dealt(rows, list(keys), hot).withColumn("_own", F.coalesce(F.sum(change).over(inside), F.lit(0)) + F.col(opening))
    local = local.withColumn("_dip", F.min("_own").over(inside))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slices = local.where(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE)
    slices = slices.agg(F.sum(change).alias("_added"), F.min("_own").alias("_least"))
    slices = slices.withColumn("_ahead", F.coalesce(F.sum("_added").over(before), F.lit(0)))
    slices = slices.withColumn("_lower", F.min(F.col("_least") + F.col("_ahead")).over(before))
    carried = slices.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(SLICE).alias("_at"), "_ahead", "_lower"
    )
    match = F.col(SLICE) == F.col("_at")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ahead = F.coalesce("_ahead", F.lit(0))
    return local.join(F.broadcast(carried), match, "left").select(
        *df.columns,
        (F.col("_own") + ahead).alias("_sum"),
        F.least(F.col("_dip") + ahead, F.col("_lower")).alias("_low"),
    )


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add the value of the row just before, per ``keys`` in ``order`` (null on the first row).

    Values travel in a struct, so a null on the previous row stays null and is not skipped.
    """
    boxed = df.select("*", *[F.struct(F.col(c).alias("v")).alias(f"_b_{n}") for n, c in outputs.items()])
    ran = running(
        boxed,
        keys,
        order,
        {f"_p_{n}": ("last", f"_b_{n}") for n in outputs},
        inclusive=False,
        rows_per_slice=rows_per_slice,
    )
    return ran.select(*df.columns, *[F.col(f"_p_{n}.v").alias(n) for n in outputs])


def numbered(
    df: DataFrame, order: Sequence[str], name: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Dense 1-based numbers over the whole table, in ``order``, without a single-task sort."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    ran = running(ones, [], order, {name: ("sum", "_one")}, rows_per_slice=rows_per_slice)
    return ran.select(*df.columns, name)
