"""Shards cut from a Hilbert curve through the metadata of documents.

Language, source and size are quantised to ``2**bits`` steps each: sizes by approximate
quantiles of the table itself, texts by the rows that stand before their whole value in
the order of all values. The steps are the coordinates of a cell, and the Hilbert index of the cell
orders the documents, equal texts of a cell together. Runs of equal length are cut
from that order: the law is ``rows``, counts of any two shards differ by one at
most. A shard then covers a compact box of the metadata, so the minimum and maximum
of each column in its file prune it for filters on any of them.

Only DataFrame functions: the curve is a fold over bit levels, positions come from
a range sort over the whole key tuple, so a hot cell or text spreads over tasks.

Defined cases: a null text has size 8, and the CRC of no bytes. Null lang or source
comes first among its dimension. Repeated rows take positions beside each other. A
null doc_id sorts first. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, let, ranked
from ledgerbrook.operators.running import running

SHARDS = 24
BITS = 6
PER_ROW = 8


def hilbert_index(steps: list[Column], bits: int) -> Column:
    """Index along the Hilbert curve of a cell given by its coordinates, 0 to 2**bits - 1 each."""
    n = len(steps)
    if n * bits > 62:
        raise ValueError("the index must fit a long")
    dims = range(n)
    levels = [1 << k for k in range(bits - 1, 0, -1)]
    # undo the rotations and reflections, from the coarsest level to the finest
    rounds = F.array(*(F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in levels for i in dims))

    def turn(x: Column, at: Column) -> Column:
        q, low = at["q"], at["q"] - 1
        own = F.get(x, at["i"])
        set_ = own.bitwiseAND(q) != 0
        swap = x[0].bitwiseXOR(own).bitwiseAND(low)
        change = F.when(set_, low).otherwise(swap)

        def moved(v: Column, k: Column) -> Column:
            other = F.when(~set_ & (k == at["i"]) & (k != 0), v.bitwiseXOR(swap)).otherwise(v)
            return F.when(k == 0, v.bitwiseXOR(F.when(~set_ & (at["i"] == 0), F.lit(0)).otherwise(change))).otherwise(other)

        return F.transform(x, moved)

    turned = F.aggregate(rounds, F.array(*(s.cast("int") for s in steps)), turn) if levels else F.array(*steps)

    def coded(x: Column) -> Column:
        gray = [x[0]]
        for k in dims[1:]:
            gray.append(gray[-1].bitwiseXOR(x[k]))
        flip = F.lit(0)
        for q in levels:
            flip = flip.bitwiseXOR(F.when(gray[-1].bitwiseAND(F.lit(q)) != 0, q - 1).otherwise(0))
        return F.array(*(g.bitwiseXOR(flip) for g in gray))

    def woven(x: Column) -> Column:
        out = F.lit(0).cast("long")
        for level in range(bits - 1, -1, -1):
            for k in dims:
                bit = F.shiftright(x[k], level).bitwiseAND(F.lit(1)).cast("long")
                out = out + F.shiftleft(bit, level * n + n - 1 - k)
        return out

    return let(let(turned, coded), woven)


def _text_cuts(rows: DataFrame, name: str, total: int, steps: int) -> list[str]:
    """The first value of each step: values in order, cut by the rows before them; at most ``steps``."""
    values = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    placed = running(values, [], [name], {"upto": ("sum", "n")})
    at = F.floor((F.col("upto") - F.col("n")) * steps / max(total, 1))
    return sorted(r[0] for r in placed.groupBy(at).agg(F.min(name).alias("v")).select("v").collect())


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang, source): doc_id, size, text_crc32, law, shard, slot, grown_shard, curve."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + PER_ROW).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"),
        F.col("lang").cast("string").alias("_lang"),
        F.col("source").cast("string").alias("_source"),
    )
    rows = keep(rows, "shard-keys")
    side = 1 << bits
    shares = [k / side for k in range(1, side)]
    known = rows.agg(F.count("*").alias("n"), F.percentile_approx("size", shares, 10_000).alias("sizes")).first()
    total = known["n"]

    def step(found: list, reached: Callable[[Column], Column]) -> Column:
        if not found:
            return F.lit(0)
        below = F.size(F.filter(F.array(*map(F.lit, found)), reached))
        # few distinct values still spread over the whole side of the grid
        return F.floor(below * side / (len(found) + 1)).cast("int")

    def text_step(name: str) -> Column:
        # a null reaches no first value and stands before all
        found = step(_text_cuts(rows, name, total, side), lambda c: c <= F.col(name))
        return F.when(F.col(name).isNull(), 0).otherwise(found)

    sizes = step(sorted(set(known["sizes"] or [])), lambda c: c < F.col("size"))
    curve = hilbert_index([text_step("_lang"), text_step("_source"), sizes], bits)
    placed = rows.select("doc_id", "size", "text_crc32", "_text", curve.alias("curve"))
    order = [F.col(c) for c in ("curve", "_text", "doc_id", "size", "text_crc32")]
    at = ranked(placed, order)
    out = at.withColumn("shard", F.expr(f"cast(_rank * {shards} div {max(total, 1)} as int)"))
    # the first position of a shard: the least rank with rank * shards >= shard * total
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
