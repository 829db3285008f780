"""Near-duplicate groups by a chosen-path set similarity join.

Each document is the set of its distinct word shingles. Documents with the same
set form one class. Classes carry minwise tokens (the minimum of the set under
fixed hash functions) and a sketch of one bit per function. Independent trees
branch the classes: a node holds the classes that agree on all tokens chosen on
the path to it, and each tree has tokens of its own on the first three levels. A pair of
similarity s survives each choice with probability s, so with two choices a node
a pair at 0.75 is lost by one tree with probability 1/9 at most, and by all six with
about 2e-6. Deeper levels, which only nodes reach that stay large so long, take tokens
that other trees used above: there the trees are no longer independent. A node with one class, or whose classes are linked
already, ends; a small one is compared exhaustively, by sketch up to ``PAIRS``
classes, on full sets in one task up to ``SMALL`` classes; one whose classes are nearly all of one
component is compared in blocks against the few others; any other branches on. What is
still large is compared exhaustively in blocks at the greatest depth, or once the blocks
have no more than ``ROOM`` rows for each class. Every candidate pair is confirmed on full sets.

Dense groups are folded first: in each node every class is tried against two pivots,
the class of the smallest doc_id and one by hash, so a large group of copies
is one component, or few, before any exhaustive comparison, and pairs inside a
component are never listed.

Shingles and words are told apart by 64-bit hashes, classes by 128 bits. The
sketch lets a linked pair pass unless 36 or more of 128 bits differ (16 expected
at 0.75, standard deviation 3.7).

Defined cases: a null or empty text, or one of separators only, has n_shingles 0
and is linked with nothing. A text with fewer words than a shingle is one shingle
of all its words. Repeated rows are rows of one group. A null doc_id is a document
without number: it never names a group unless all its members have none. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.llm.common import components, give_up_shuffles, keep, scratch, whole_row

TREES = 6
BRANCHES = 2
LEVELS = 3
TOKENS = TREES * BRANCHES * LEVELS
SKETCH_BITS = 128
SKETCH_DIFFERS = 35
DEPTH = 8
PAIRS = 64
SMALL = 1024
BLOCK_SHINGLES = 1 << 21
ROOM = 1

SIGNATURE = "doc_id long, text_key long, n_shingles long, cls binary, tokens array<long>, s0 long, s1 long"
SETS = "cls binary, shingles binary"

_CHUNK = 1 << 17
_SLICE_ROWS, _SLICE_BYTES = 256, 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_BYTES = _stream(1 << 20, 256)
_BASE = 0x2545F4914F6CDD1D
_PLACES = _stream(2 << 20, 64) | np.uint64(1)
_FUNCTIONS = _stream(3 << 20, TOKENS + SKETCH_BITS) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of UTF-8 texts laid end to end, and where each text's words begin among them."""
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inner = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    last = inner.copy()
    last[:-1] &= ~inner[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inner[edges]
    last[edges - 1] = inner[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, "right")))
        low, high = starts[at], ends[to - 1]
        up, down = _powers(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = _mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, worked out for few texts at a time."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        fits = int(np.searchsorted(sizes, before + _SLICE_BYTES, "right"))
        to = min(max(fits, at + 1), at + _SLICE_ROWS)
        yield from _sets_of(texts.slice(at, to - at), size)
        at = to


def _sets_of(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    hashes, bounds = word_hashes(data, offsets)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        own = hashes[low:high]
        if not len(own):
            yield own
            continue
        width = min(size, len(own))
        n = len(own) - width + 1
        total = np.full(n, width, np.uint64)
        for k in range(width):
            total += own[k : k + n] * _PLACES[k]
        yield np.unique(_mix(total))


def _class_of(shingles: np.ndarray) -> bytes:
    twice = _mix(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    return np.array([shingles.sum() + np.uint64(len(shingles)), twice.sum()], np.uint64).tobytes()


def _minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(len(_FUNCTIONS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(out, (shingles[at : at + 2048, None] * _FUNCTIONS[None, :]).min(axis=0), out=out)
    return out


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, tokens, bits = [], [], [], []
            for shingles in shingle_sets(batch.column(2), size):
                n.append(len(shingles))
                if not len(shingles):
                    cls.append(None), tokens.append(None), bits.append((None, None))
                    continue
                minima = _minima(shingles)
                cls.append(_class_of(shingles))
                tokens.append(minima[:TOKENS].view(np.int64))
                ones = ((_mix(minima[TOKENS:]) >> np.uint64(20)) & np.uint64(1)).astype(np.uint8)
                bits.append(tuple(np.packbits(ones).view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(cls, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())),
                    pa.array([b[0] for b in bits], pa.int64()),
                    pa.array([b[1] for b in bits], pa.int64()),
                ],
                names=["doc_id", "text_key", "n_shingles", "cls", "tokens", "s0", "s1"],
            )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (s for s in shingle_sets(batch.column(0), size) if len(s))
            while sets := list(islice(found, _SLICE_ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["cls", "shingles"],
                )

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(k) for k in range(4))
            mask = []
            for x, y in zip(left, right, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                mask.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return run


def _compare(percent: int):
    """Links between members of one cell that are in different components, by exact intersections of full sets."""

    def run(cell: pa.Table) -> pa.Table:
        names, roots, tops = (cell[c].to_pylist() for c in ("cls", "root", "top"))
        sets = [np.frombuffer(x, np.uint64) for x in cell["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets], np.int64)
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(ids, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(ids))])
        posted, at = owner[order], np.concatenate([[0], np.cumsum(sizes)])
        number = {r: i for i, r in enumerate(set(roots))}
        root = np.array([number[r] for r in roots])
        a, b = [], []
        for i in range(len(sets)):
            if roots[i] == tops[i]:
                # the others look for links into the largest component, not it for them
                continue
            own = ids[at[i] : at[i + 1]]
            both = np.bincount(np.concatenate([posted[starts[k] : starts[k + 1]] for k in own]), minlength=len(sets))
            linked = np.flatnonzero((100 * both >= percent * (sizes[i] + sizes - both)) & (root != root[i]))
            # one link to each component joins it
            for j in linked[np.unique(root[linked], return_index=True)[1]]:
                a.append(names[i])
                b.append(names[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _near(sketch_a: list[str], sketch_b: list[str]) -> Column:
    differing = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(sketch_a, sketch_b)), F.lit(0))
    return differing <= SKETCH_DIFFERS


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


class _Join:
    """One run of the join: classes with tokens, and the linked pairs found so far."""

    def __init__(self, docs: DataFrame, size: int, percent: int) -> None:
        self.docs, self.size, self.percent = docs, size, percent
        # tokens and sketches are read by class only: rows keep the name of their class
        with scratch(docs.sparkSession) as hand_on:
            signed = keep(docs.select("doc_id", _text_key(), "text").mapInArrow(_sign(size), SIGNATURE), "signatures")
            self.classes = hand_on(
                signed.where("n_shingles > 0")
                .groupBy("cls")
                .agg(
                    F.min("doc_id").alias("doc_id"),
                    *(F.first(c).alias(c) for c in ("n_shingles", "tokens", "s0", "s1")),
                ),
                "classes",
            )
            self.signed = hand_on(signed.select("doc_id", "text_key", "n_shingles", "cls"), "signatures")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those candidate pairs (a, b) of classes that are linked, by their full sets."""
        # full sets and the shuffles of texts behind them are given up here, not at the end of the join
        with scratch(self.docs.sparkSession) as hand_on:
            return hand_on(self._confirmed(pairs), "links")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs.distinct(), "candidates")
        sets = self.full_sets(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct())
        left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("right"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return joined.mapInArrow(_confirm(self.percent), "a binary, b binary")

    def compared(self, rows: DataFrame) -> DataFrame:
        """Links found in the cells (node, low, high) of large nodes; no pair leaves its task unless it is one."""
        with scratch(self.docs.sparkSession) as hand_on:
            return hand_on(self._compared(rows), "links")

    def _compared(self, rows: DataFrame) -> DataFrame:
        sets = self.full_sets(rows.select("cls").distinct())
        full = rows.join(sets, "cls").select("node", "low", "high", "cls", "root", "top", "shingles")
        found = full.groupBy("node", "low", "high").applyInArrow(_compare(self.percent), "a binary, b binary")
        return found.distinct()

    def full_sets(self, ends: DataFrame) -> DataFrame:
        """The full sets (cls, shingles) of the classes named in ``cls``."""
        # the shuffles of texts are given up before the sets are joined
        with scratch(self.docs.sparkSession) as hand_on:
            return hand_on(self._full_sets(ends), "sets")

    def _full_sets(self, ends: DataFrame) -> DataFrame:
        # written first: Spark sees its size, and moves the texts only where the numbers are too many to send around
        ends = keep(ends, "wanted")
        wanted = keep(ends.join(self.classes.select("cls", "doc_id"), "cls").select("doc_id").distinct(), "wanted")
        # what told which ones are wanted goes before texts move
        give_up_shuffles(self.docs.sparkSession)
        texts = self.docs.select("doc_id", "text")
        named = texts.join(wanted.where("doc_id IS NOT NULL"), "doc_id", "left_semi")
        # classes of documents without number are told by their sets alone
        unnamed = texts.where("doc_id IS NULL")
        sets = named.union(unnamed).select("text").mapInArrow(_full_sets(self.size), SETS)
        return sets.join(ends, "cls", "left_semi").dropDuplicates(["cls"])

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of class ids whose sizes and sketches allow a link."""
        short = self.classes.select("cls", "n_shingles", "s0", "s1")
        a = short.toDF("a", "na", "a0", "a1")
        b = short.toDF("b", "nb", "b0", "b1")
        fits = 100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")
        return pairs.join(a, "a").join(b, "b").where(fits & _near(["a0", "a1"], ["b0", "b1"])).select("a", "b")

    def roots(self) -> DataFrame:
        """The nodes below the root of every tree, as (tree, node, cls, width)."""
        chosen = [(t, t * BRANCHES + k) for t in range(TREES) for k in range(BRANCHES)]
        node = lambda t, p: F.xxhash64(F.lit(t), F.lit(p), F.col("tokens")[p]).alias("node")
        nodes = F.array(*(F.struct(F.lit(t).alias("tree"), node(t, p)) for t, p in chosen))
        return self.classes.select(F.inline(nodes), "cls", F.col("n_shingles").alias("width"))

    def crowds(self) -> DataFrame:
        """Those nodes below the roots that hold more than one class: one with a single class leads nowhere."""
        with scratch(self.docs.sparkSession) as hand_on:
            found = keep(self.roots(), "nodes")
            crowd = found.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
            return hand_on(found.join(crowd, "node").select("tree", "node", "cls", "width"), "nodes")

    def stars(self, rows: DataFrame, pivots: list[Column]) -> DataFrame:
        """Pairs (a, b): each class of a node with each of its pivots, the least ones by ``pivots``."""
        named = rows.join(self.classes.select("cls", "doc_id"), "cls")
        least = [F.min(F.struct(p.alias("by"), "cls"))["cls"] for p in pivots]
        centre = named.groupBy("node").agg(F.array_distinct(F.array(*least)).alias("centres"))
        met = rows.join(centre, "node").select(F.explode("centres").alias("a"), F.col("cls").alias("b"))
        return met.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def children(self, rows: DataFrame, depth: int) -> DataFrame:
        """The nodes that rows (tree, node, cls, width) go to next: two tokens, of the tree's own on the first levels.

        Deeper down they are those that another tree has used above, so no path meets a token twice.
        """
        turn = F.pmod(F.col("tree") + depth // LEVELS, F.lit(TREES))
        first = turn * BRANCHES + TREES * BRANCHES * (depth % LEVELS)
        below = F.array(*(F.xxhash64("node", first + k, F.element_at("tokens", first + k + 1)) for k in range(BRANCHES)))
        return rows.join(self.classes.select("cls", "tokens"), "cls").select("tree", F.explode(below).alias("node"), "cls", "width")

    def exhaustive(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components in each small node, by sketch."""
        short = self.classes.select("cls", "n_shingles", "s0", "s1")
        keys = ["node"]
        full = keep(rows.join(short, "cls").select(*keys, "cls", "root", "n_shingles", "s0", "s1"), "small-nodes")
        a = full.toDF(*keys, "a", "root_a", "na", "a0", "a1")
        b = full.toDF(*keys, "b", "root_b", "nb", "b0", "b1")
        fits = 100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")
        other = (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
        return a.join(b, keys).where(other & fits & _near(["a0", "a1"], ["b0", "b1"])).select("a", "b").distinct()


def _cells(rows: DataFrame) -> DataFrame:
    """Rows (node, n, top, root_count, cls, root) of nodes of any size, repeated into cells of bounded size.

    A node that fits is one cell. Members of the largest component of a node need no comparison among themselves:
    their blocks meet those of the others (low at 0 or above), and the blocks of the
    others meet each other (low below 0).
    """
    major = F.col("root") == F.col("top")
    rows_of_cell, blocks, others = _block_counts()
    own = F.pmod(F.xxhash64("cls"), F.when(major, blocks).otherwise(others)).cast("int")
    cell = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    met = F.when(major, F.transform(upto(others), lambda o: cell(F.col("_own"), o))).otherwise(
        F.concat(
            F.transform(upto(blocks), lambda k: cell(k, F.col("_own"))),
            F.transform(upto(others), lambda o: cell(-1 - F.least("_own", o), F.greatest("_own", o))),
        )
    )
    whole = F.array(cell(F.lit(0), F.lit(0)))
    met = F.when(F.col("n") <= rows_of_cell, whole).otherwise(met)
    spread = rows.withColumn("_own", own).select("node", "cls", "root", "top", F.explode(met).alias("c"))
    return spread.select("node", "c.low", "c.high", "cls", "root", "top")


def _block_counts() -> tuple[Column, Column, Column]:
    """The rows of a block, and how many blocks the largest component of a node and the rest of it make."""
    rows = F.greatest(F.lit(1), F.least(F.lit(SMALL), F.floor(F.lit(BLOCK_SHINGLES) / F.col("widest"))))
    size = lambda n: F.greatest(F.ceil(n / rows), F.lit(1)).cast("int")
    return rows, size(F.col("root_count")), size(F.col("n") - F.col("root_count"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, group_key, text_key.

    Documents whose shingle sets have ``100 * |intersection| >= percent * |union|``
    are linked. ``group_key`` names the group also where numbers are missing; it is
    null for documents without words.
    """
    with scratch(docs.sparkSession) as hand_on:
        return hand_on(_groups(docs, size, percent), "groups")


def _groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    join = _Join(docs, size, percent)
    found = join.crowds()
    pivots = [F.struct("doc_id", "cls"), F.struct(F.xxhash64("node", "cls"), "cls")]
    links = join.confirmed(join.sketched(join.stars(found, pivots)))
    grouped = components(links)
    small, cells = [], []
    # what may be compared in blocks at once: as many rows as there are classes
    room = ROOM * join.classes.count()
    for depth in range(1, DEPTH + 1):
        labelled = _labelled(found, grouped)
        roots = labelled.groupBy("node", "root").agg(F.count("*").alias("c"), F.max("width").alias("width"))
        stats = roots.groupBy("node").agg(
            F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("k"), F.max("width").alias("widest")
        )
        stats = stats.where("k > 1").select(
            "node", "n", "widest", F.col("m.c").alias("root_count"), F.col("m.root").alias("top")
        )
        labelled = keep(labelled.join(stats, "node"), "nodes")
        crowded = F.col("n") > PAIRS
        # blocks of the largest component against one block of all others: rows in proportion to the node
        _, blocks, others = _block_counts()
        onward = crowded & (others > 1)
        copies = F.when(F.col("root") == F.col("top"), others).otherwise(blocks + others)
        cost = labelled.agg(F.sum(F.when(onward, copies))).first()[0] or 0
        small.append(labelled.where(~crowded))
        if cost <= room or depth == DEPTH:
            cells.append(_cells(labelled.where(crowded)))
            break
        cells.append(_cells(labelled.where(crowded & ~onward)))
        found = keep(join.children(labelled.where(onward).select("tree", "node", "cls", "width"), depth), "nodes")
    links = links.union(join.confirmed(join.exhaustive(reduce(DataFrame.union, small))))
    links = links.union(join.compared(reduce(DataFrame.union, cells)))
    groups = _labelled(join.classes.select("cls", "doc_id"), components(links))
    named = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = groups.select("cls", "root").join(named, "root")
    out = join.signed.select("doc_id", "text_key", "n_shingles", "cls").join(by_class, "cls", "left")
    linked = F.col("n_shingles") > 0
    component = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.col("root").alias("group_key"),
        "text_key",
    )


def representatives(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, the smallest doc_id; all without words."""
    found = near_duplicates(docs, size, percent)
    # more than one kept row in a group only where rows repeat
    first = F.row_number().over(Window.partitionBy("group_key").orderBy("text_key"))
    ones = found.where("kept AND group_key IS NOT NULL").withColumn("_n", first).where("_n = 1")
    bare = found.where("group_key IS NULL").distinct()
    wanted = ones.select("doc_id", "text_key", F.lit(True).alias("one")).unionByName(
        bare.select("doc_id", "text_key", F.lit(False).alias("one"))
    )
    wanted = keep(wanted, "wanted")
    keyed = docs.select(whole_row(docs), F.col("doc_id").alias("id"), _text_key().alias("key"))
    met = keyed.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("key").eqNullSafe(F.col("text_key")))
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy("row.text"))
    # repeated rows meet one wanted row each: keep the first, unless they have no words
    return met.withColumn("place", place).where("place = 1 OR NOT one").select("row.*")


def _labelled(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows with a class, and the root of its group (itself where it has no link)."""
    labels = grouped.select(F.col("node").alias("cls"), "root")
    return rows.join(labels, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
