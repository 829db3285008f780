"""Order MinHash fingerprints, likeness under edits.

A text is its sequence of words; its k-mers are runs of ``k`` words, each numbered
by its occurrence, so a run met again is a new element. The elements are dealt to
``slots`` by hash, and each slot selects its ``width`` minimal elements, puts them
back in text order and hashes the tuple. Two texts agree in a slot if the same
elements come in the same order, so the share of agreeing slots falls with moved
passages too, as edit distance does, where sets would not.

Everything is array functions over one row: two sorts of longs that carry the
position in their low bits, and scans. Documents meet their neighbour in descending
doc_id by a window per range of numbers (ranges of like counts, from quantiles);
the first document of each range serves as neighbour of the range before.

Defined cases: a null text is empty. A text without words has no filled slot; its
likeness to another such text is 1, to any other 0. A text with fewer words than
``k`` is one k-mer. Positions are kept to 24 bits: beyond 16 million words order
within a slot is that of the low bits. A single document is its own neighbour.
Rows of one doc_id are ordered by text; a null doc_id comes last. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, let, words

K = 2
SLOTS = 64
WIDTH = 2
RANGE_BYTES = 8 << 20
MOST_RANGES = 50_000

_POSITION = (1 << 24) - 1
_NONE = "." * 8


def signature(text: Column, k: int = K, slots: int = SLOTS, width: int = WIDTH) -> Column:
    """The tuple hash of every slot as ints, null where a slot is empty."""
    if slots & (slots - 1):
        raise ValueError("slots must be a power of two")
    bits = slots.bit_length() - 1
    low = F.lit(_POSITION).cast("long")

    def placed(h: Column, i: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(h, 24), 24).bitwiseOR(i.cast("long").bitwiseAND(low))

    def kmers(w: Column) -> Column:
        whole = F.array(placed(F.xxhash64(F.array_join(w, " ")), F.lit(0)))
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - k),
            lambda i: placed(F.xxhash64(*(F.get(w, i + j) for j in range(k))), i),
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= k, runs).when(F.size(w) > 0, whole).otherwise(none)

    def starts(values: Column, shift: int) -> Column:
        """Where in a sorted array the bits above ``shift`` change."""
        top = lambda v: F.shiftright(v, shift)
        flags = F.transform(values, lambda v, i: F.when((i == 0) | (top(v) != top(F.get(values, i - 1))), i))
        return F.array_compact(flags)

    def numbered(values: Column) -> Column:
        """Elements dealt to slots: slot and hash of (k-mer, occurrence) in the high bits, position in the low ones."""

        def from_runs(at: Column) -> Column:
            last = F.size(values)
            count = F.flatten(
                F.transform(at, lambda s, j: F.sequence(F.lit(0), F.coalesce(F.get(at, j + 1), last) - 1 - s))
            )
            return let(
                count,
                lambda n: F.transform(
                    values, lambda v, i: placed(F.xxhash64(F.shiftrightunsigned(v, 24), F.get(n, i)), v.bitwiseAND(low))
                ),
            )

        return let(starts(values, 24), from_runs)

    def chosen(values: Column) -> Column:
        def tuples(at: Column) -> Column:
            def one(s: Column) -> Column:
                slot = lambda v: F.shiftrightunsigned(v, 64 - bits)
                first = F.get(values, s)
                own = F.filter(F.slice(values, s + 1, width), lambda v: slot(v) == slot(first))
                ordered = F.array_sort(F.transform(own, lambda v: F.struct(v.bitwiseAND(low), F.shiftrightunsigned(v, 24))))
                names = F.transform(ordered, lambda p: p["col2"])
                return F.struct(slot(first).cast("int").alias("slot"), _low_half(F.xxhash64(names)).alias("h"))

            return F.transform(at, one)

        return let(starts(values, 64 - bits), tuples)

    def spread(found: Column) -> Column:
        return let(F.map_from_entries(found), lambda m: F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda s: F.element_at(m, s)))

    sorted_kmers = let(words(text), lambda w: F.array_sort(kmers(w)))
    dealt = let(sorted_kmers, lambda v: F.sort_array(numbered(v)))
    return let(let(dealt, chosen), spread)


def _low_half(value: Column) -> Column:
    """The low 32 bits of a long as an int."""
    low = value.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots filled on either side that agree; 1 if none is filled."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(x.eqNullSafe(y).cast("int")))

    def share(p: Column) -> Column:
        filled = F.size(F.array_compact(p))
        agree = F.size(F.filter(p, lambda x: x == 1))
        return F.when(filled == 0, 1.0).otherwise(agree / filled)

    return let(pairs, share)


def as_text(values: Column) -> Column:
    """Eight hex digits a slot, dots for an empty one."""
    return F.array_join(
        F.transform(values, lambda v: F.when(v.isNull(), _NONE).otherwise(F.lpad(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), ""
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by as many, or all, first ones of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _cuts_below(cuts: list[int], value: Column) -> Column:
    """How many of the sorted ``cuts`` are less than ``value``, in two steps of about their square root each."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[at : at + width] for at in range(0, len(cuts), width)]
    heads = F.array(*(F.lit(g[0]) for g in groups))
    inner = F.array(*(F.array(*map(F.lit, g)) for g in groups))
    at = F.size(F.filter(heads, lambda c: c < value))
    fine = let(at, lambda n: F.size(F.filter(F.get(inner, n - 1), lambda c: c < value)) + (n - 1) * width)
    return F.when(at == 0, 0).otherwise(fine)


def with_following(
    docs: DataFrame, derived: dict[str, Callable[[Column], Column]], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Rows (doc_id, text) with columns derived from the text, and the same of the next row as ``next_*``.

    Next is by descending doc_id, the first after the last.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(2, min(MOST_RANGES, int(size // range_bytes) + 1))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []))
    below = _cuts_below(cuts, F.col("doc_id"))
    # range 0 holds the largest numbers, null has its own range at the end
    place = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.lit(len(cuts)) - below)
    rows = docs.select("doc_id", "text", place.alias("_range"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    inside = Window.partitionBy("_range").orderBy(*order)
    names = ["text", *derived]
    full = rows.withColumns({name: f(F.col("text")) for name, f in derived.items()})
    met = full.withColumn("_next", F.lead(F.struct(*names)).over(inside))
    # the first row of each range, taken from the plain texts
    number = F.coalesce(F.col("doc_id"), F.lit(0))
    largest = rows.groupBy("_range").agg(F.max(number).alias("_number"))
    heads = rows.join(F.broadcast(largest), "_range").where(number == F.col("_number"))
    heads = keep(heads.groupBy("_range").agg(F.min("text").alias("text")), "range-heads")
    along = Window.orderBy("_range")
    first = F.first("text").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    served = heads.select("_range", F.coalesce(F.lead("text").over(along), first).alias("text"))
    served = served.withColumns({name: f(F.col("text")) for name, f in derived.items()})
    served = served.select("_range", F.struct(*names).alias("_head"))
    out = met.join(F.broadcast(served) if ranges <= 1000 else served, "_range")
    following = F.coalesce("_next", "_head")
    return out.select("doc_id", *names, *(following[c].alias(f"next_{c}") for c in names))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the digest columns of the fingerprint of the text and of its edited form."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    met = with_following(rows, {"own": signature})
    met = met.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    met = met.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "own",
        "next_own",
        signature(F.col("edited")).alias("changed"),
    )
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
