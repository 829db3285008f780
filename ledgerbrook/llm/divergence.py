"""How sources of one language differ in their words: a divergence for every pair, and the terms that stand out.

Terms are counted per (lang, source); each language keeps the terms of at least
``LEAST_DF`` of its documents. Shares are smoothed and scaled to whole numbers, and the
price of a term between shares p and q is (p-q)^2 / (p+q), floored: all sums are exact.

The counts of a source over the kept terms of its language, ordered by falling total,
are the leaves of a segment tree. Trees are hash-consed: a node is its pair of children,
so equal subtrees, of one source or of several, are one node. Two trees are traversed at
once from the top, level by level; a pair of nodes met again is not followed a second
time, and on the way back its price is added wherever it stood. Most terms are rare, so
most of a tree is a few shared nodes.

The leaves are dealt out in blocks of ``BLOCK`` terms, which are the lower subtrees, and
the sources of a language in stripes of ``STRIPE``: a task holds the counts of at most
two stripes in one block, and the sums of blocks are added up. Counting sends per task
one row per (lang, source, term), so frequent terms and large sources are small groups.

Defined cases: null text, lang and source count as ''. Sources without terms, and
languages that keep none, take part (a price of 0 where nothing is kept). Repeated rows
count each. Texts of any length are read in lots. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, ranked
from ledgerbrook.llm.ngram_hash import byte_table, word_lots

LEAST_DF = 10
TERM_RANKS = 10
SCALE = 1_000_000_000
BLOCK = 4096
STRIPE = 64
_HELD = 300_000
_ROWS = 256


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term) of this task, handed on whenever many are held."""
    table = byte_table(keep_digits=False)
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in seen.items():
            n = len(times)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(lang, n),
                    pa.repeat(source, n),
                    pa.array(times.keys(), pa.binary()).cast(pa.string()),
                    pa.array(times.values(), pa.int64()),
                    pa.array([docs[t] for t in times], pa.int64()),
                ],
                names=["lang", "source", "term", "times", "docs"],
            )

    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            lang, source, text = (c.to_pylist() for c in batch.slice(at, _ROWS).columns)
            for key in zip(lang, source, text, strict=True):
                times, docs = seen.setdefault(key[:2], (Counter(), Counter()))
                before, own = len(times), set()
                for words in word_lots(key[2], table):
                    times.update(words)
                    own.update(words)
                docs.update(own)
                held += len(times) - before
            if held > _HELD:
                yield from out()
                seen.clear()
                held = 0
    yield from out()


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, times) for the terms that their language keeps."""
    named = docs.select(_named("lang"), _named("source"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = named.mapInArrow(_tally, "lang string, source string, term string, times long, docs long")
    # one exchange serves the counts by source and the document frequency by language
    dealt = found.repartition("lang", "term").groupBy("lang", "term", "source")
    whole = dealt.agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    df = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return whole.withColumn("df", df).where(F.col("df") >= LEAST_DF).select("lang", "source", "term", "times")


def _named(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def _share(times: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (times + 2) / (n + 2 v)), in decimals: the product passes 64 bits on large corpora."""
    above = (times.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, n.cast("decimal(20,0)") + v.cast("decimal(20,0)") * 2).cast("long") + 1


def _price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def consed(leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Roots of the trees over the rows of ``leaves`` (a power of two wide) and, from the leaves up, the children of
    each level's nodes; equal children are one node."""
    nodes, levels = leaves, []
    while nodes.shape[1] > 1:
        size = int(nodes.max(initial=0)) + 1
        known, nodes_ = np.unique(nodes[:, 0::2] * size + nodes[:, 1::2], return_inverse=True)
        levels.append((known // size, known % size))
        nodes = nodes_.reshape(len(leaves), -1)
    return nodes[:, 0], levels


def traverse(a: int, b: int, levels: list[tuple[np.ndarray, np.ndarray]], price) -> int:
    """The sum of ``price(leaf of a, leaf of b)`` over all places; every pair of nodes is followed once."""
    left, right, back = np.array([a]), np.array([b]), []
    for low, high in reversed(levels):
        size = int(max(low.max(), high.max())) + 1
        pairs = np.concatenate([low[left] * size + low[right], high[left] * size + high[right]])
        met, at = np.unique(pairs, return_inverse=True)
        back.append(at.reshape(2, -1))
        left, right = met // size, met % size
    value = price(left, right)
    for at in reversed(back):
        value = value[at[0]] + value[at[1]]
    return int(value[0])


def _prices(table: pa.Table) -> pa.Table:
    """Prices of all pairs of sources of two stripes in one block."""
    rows = {r["at"]: r for r in table.to_pylist()}
    v = table.column("v")[0].as_py()
    width = table.column("width")[0].as_py()
    sources = sorted(rows)
    times = np.zeros((len(sources), BLOCK), np.int64)
    times[:, width:] = -1
    for own, s in zip(times, sources, strict=True):
        own[np.array(rows[s]["ids"], np.int64)] = rows[s]["times"]
    known, leaves = np.unique(times, return_inverse=True)
    roots, levels = consed(leaves.reshape(times.shape))
    # the share of each count within each source; whole numbers of any size until they fit
    shares = np.array(
        [[0 if c < 0 else 1 + SCALE * (c + 2) // (rows[s]["n"] + 2 * v) for c in known.tolist()] for s in sources], np.int64
    )
    lower, upper, values = [], [], []
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    for i, a in enumerate(sources):
        for j in range(i + 1, len(sources)):
            b = sources[j]
            if first != second and a // STRIPE == b // STRIPE:
                continue
            p, q = shares[i], shares[j]

            def price(x: np.ndarray, y: np.ndarray, p=p, q=q) -> np.ndarray:
                gap, total = p[x] - q[y], p[x] + q[y]
                return gap * gap // np.maximum(total, 1)

            lower.append(a)
            upper.append(b)
            values.append(traverse(int(roots[i]), int(roots[j]), levels, price))
    lang = pa.repeat(table.column("lang")[0], len(lower))
    return pa.table({"lang": lang, "a": pa.array(lower, pa.int64()), "b": pa.array(upper, pa.int64()), "value": pa.array(values, pa.int64())})


def _numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Places from 0 within each language, whose rows are one run of the whole order."""
    placed = ranked(df, [F.col("lang"), *order], "_place")
    begins = placed.groupBy("lang").agg(F.min("_place").alias("_begin"))
    return placed.join(begins, "lang").withColumn(name, F.col("_place") - F.col("_begin")).drop("_place", "_begin")


def _best(df: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = df.withColumn("rank", F.row_number().over(order))
    out = out if limit is None else out.where(F.col("rank") <= limit)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` for every other source of the language, ``term`` for the
    terms in which a source stands out from its language most."""
    kept = keep(counts(docs), "terms")
    sources = docs.select(_named("lang"), _named("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("times").alias("n"))
    terms = kept.groupBy("lang", "term").agg(F.sum("times").alias("total"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    zero = F.lit(0).cast("long")
    groups = sources.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "lang_n")])
    groups = keep(_numbered(keep(groups, "sources"), [F.col("source")], "at"), "sources")
    ids = _numbered(keep(terms, "totals"), [F.desc("total"), F.col("term")], "id")
    return _pairs(kept, groups, ids).unionByName(_terms(kept, groups, terms))


def _pairs(kept: DataFrame, groups: DataFrame, ids: DataFrame) -> DataFrame:
    blocks = F.greatest(F.ceil(F.col("v") / BLOCK), F.lit(1)).cast("long")
    cells = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    cells = cells.withColumn("width", F.least(F.col("v") - F.col("block") * BLOCK, F.lit(BLOCK)))
    leaves = kept.join(ids.select("lang", "term", "id"), ["lang", "term"])
    leaves = leaves.withColumn("block", F.floor(F.col("id") / BLOCK))
    # at most BLOCK entries a row
    leaf = F.struct((F.col("id") % BLOCK).alias("id"), "times")
    leaves = leaves.groupBy("lang", "source", "block").agg(F.collect_list(leaf).alias("leaves"))
    empty = F.array().cast("array<bigint>")
    held = cells.join(leaves, ["lang", "source", "block"], "left").select(
        "lang", "block", "at", "n", "v", "width",
        F.coalesce("leaves.id", empty).alias("ids"), F.coalesce("leaves.times", empty).alias("times"),
    )
    last = groups.groupBy("lang").agg(F.floor(F.max("at") / STRIPE).alias("last"))
    own = F.floor(F.col("at") / STRIPE)
    met = held.join(last, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    met = met.withColumn("first", F.least(own, "other")).withColumn("second", F.greatest(own, "other")).drop("last", "other")
    priced = met.groupBy("lang", "block", "first", "second").applyInArrow(_prices, "lang string, a long, b long, value long")
    whole = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ends = F.array(F.struct(F.col("a").alias("at"), F.col("b").alias("to")), F.struct(F.col("b").alias("at"), F.col("a").alias("to")))
    both = whole.select("lang", "value", F.inline(ends))
    name = groups.select("lang", "at", "source")
    both = both.join(name, ["lang", "at"]).join(name.select("lang", F.col("at").alias("to"), F.col("source").alias("item")), ["lang", "to"])
    return _best(both, "pair")


def _terms(kept: DataFrame, groups: DataFrame, terms: DataFrame) -> DataFrame:
    rows = kept.join(terms, ["lang", "term"]).join(groups, ["lang", "source"])
    rows = rows.withColumn("p", _share(F.col("times"), F.col("n"), F.col("v")))
    rows = rows.withColumn("q", _share(F.col("total"), F.col("lang_n"), F.col("v"))).where("p > q")
    value = _price(F.col("p"), F.col("q")).alias("value")
    return _best(rows.select("lang", "source", F.col("term").alias("item"), value), "term", TERM_RANKS)
