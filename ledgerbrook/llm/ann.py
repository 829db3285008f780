"""Nearest neighbours by inner product: probed lists with an adaptive scan of dimensions.

Vectors get one more component that makes all lengths equal, so the largest inner
product is the smallest Euclidean distance, and are turned by a fixed random
rotation, after which any leading dimensions are a fair sample of all. They are
dealt to lists by the nearest of the centroids, and kept in column blocks. A query
scans its nearest lists: after each block of columns a hypothesis test on the
partial distance drops candidates that are, but for a small error, farther than
the k-th best so far; what survives all blocks is scored in double precision on the
original vectors. The two nearest lists of a query come first and give the bound
with which the others begin.

Equal vectors are one class: it is searched for and found once, and stands for its
smallest vec_ids. Lists and queries are cut into chunks of bounded size, and a task
scans one chunk of queries against one chunk of a list.

The centroids are fitted on a bounded sample of classes (the first ``SAMPLE`` by
hash); every vector is in a list. How many lists are probed is measured: at most
``MEASURED`` queries (the first by hash) are compared with every vector, and as many
of the nearest lists are taken as hold ``RECALL`` of their true neighbours, all lists
if need be. Queries that meet fewer candidates than asked for are run against all
lists.

Defined cases: null, empty or zero vectors, or such with null or non-finite
components, take no part, nor do vectors of another length than most have (the
longest of those at a tie). Fewer candidates than k give as many rows. Ties go to
the smaller vec_id. Rows with a null vec_id take no part. Repeated rows of one
vec_id and vector are one. Extra columns are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.llm.common import first_by, keep

NEAREST = 20
SAMPLE = 20_000
LISTS = 1024
ROUNDS = 8
FIRST_LISTS = 2
LEAST_PROBED = 8
MEASURED = 128
RECALL = 0.95
COLUMNS = 16
ERROR = 2.1
CHUNK = 4096
QUERY_CHUNK = 512


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct rows (vec_id, embedding as array<double>) that take part in the search."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    common = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("embedding") == (common["n"] if common else 0))


def rotation(n: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(20).standard_normal((n, n)))[0]


def centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres by Lloyd's rounds from a fixed start."""
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest_lists(sample, centres, 1)[:, 0]
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        count = np.bincount(near, minlength=lists)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest_lists(rows: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest centres of each row, nearest first."""
    out = np.empty((len(rows), k), np.int64)
    for at in range(0, len(rows), 1024):
        far = (centres**2).sum(axis=1) - 2 * rows[at : at + 1024] @ centres.T
        out[at : at + 1024] = np.argsort(far, axis=1, kind="stable")[:, :k]
    return out


def scan(query: np.ndarray, columns: np.ndarray, bound: float) -> np.ndarray:
    """Which candidates may be nearer than ``bound`` (squared), by partial distances over blocks of columns."""
    n = len(columns)
    left, partial = np.arange(columns.shape[1]), np.zeros(columns.shape[1])
    for at in range(0, n, COLUMNS):
        part = columns[at : at + COLUMNS]
        part = part if len(left) == columns.shape[1] else part[:, left]
        partial = partial + ((part - query[at : at + COLUMNS, None]) ** 2).sum(axis=0)
        seen = min(at + COLUMNS, n)
        # for all columns the partial distance is the distance itself
        slack = 1 + ERROR / math.sqrt(seen) if seen < n else math.sqrt(1 + 1e-6)
        going = partial * n <= bound * slack**2 * seen + 1e-9
        left, partial = left[going], partial[going]
        if not len(left):
            break
    return left


class _Space:
    """The augmented and rotated space, with its centroids."""

    def __init__(self, sample: np.ndarray, longest: float, lists: int) -> None:
        self.longest = longest
        self.turn = rotation(sample.shape[1] + 1)
        self.centres = centroids(self.stored(sample), min(lists, len(sample)))

    def stored(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (rows**2).sum(axis=1), 0))
        return np.concatenate([rows, rest[:, None]], axis=1) @ self.turn

    def asked(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows, np.zeros((len(rows), 1))], axis=1) @ self.turn


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(shared: Callable[[], _Space], probed: int):
    """Rows (cls, list, place) of each class; as a query where ``probed`` is positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1))
            placed = space.asked(rows) if probed else space.stored(rows)
            found = nearest_lists(placed, space.centres, max(1, probed))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(placed), pa.list_(pa.float64())), pa.array(list(found), pa.list_(pa.int64()))],
                names=["cls", "embedding", "placed", "lists"],
            )

    return run


def _scan_group(k: int, tested: bool):
    def run(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(stored):
            columns = np.ascontiguousarray(np.stack(stored["placed"]).T)
            original = np.stack(stored["embedding"])
            names = stored["cls"].to_numpy()
            least = stored["least"].to_numpy()
            for cls, vector, placed, bound, longest in zip(
                queries["cls"], queries["embedding"], queries["placed"], queries["bound"], queries["longest"], strict=True
            ):
                base = float(vector @ vector) + longest
                far = np.inf if np.isnan(bound) else base - 2 * bound
                best: list[np.ndarray] = []
                # piece by piece, so that the bound of one piece prunes the next
                for at in range(0, len(names), 1024):
                    part = columns[:, at : at + 1024]
                    left = at + (scan(placed, part, far) if tested else np.arange(part.shape[1]))
                    if len(left):
                        best.append(left)
                        pool = np.concatenate(best)
                        score = original[pool] @ vector
                        order = np.lexsort((least[pool], -score))[:k]
                        best = [pool[order]]
                        if len(order) == k:
                            far = min(far, base - 2 * score[order[-1]])
                if best:
                    score = original[best[0]] @ vector
                    out += [(cls, names[i], s) for i, s in zip(best[0], score, strict=True)]
        return pd.DataFrame(out, columns=["query", "cls", "score"])

    return run


class _Search:
    def __init__(self, vectors: DataFrame, is_query: Column, k: int, lists: int | None, share: float | None) -> None:
        self.k = k
        rows = usable(vectors).withColumn("cls", F.xxhash64("embedding", F.lit(0)).cast("string"))
        rows = rows.withColumn("cls", F.concat_ws(".", "cls", F.xxhash64(F.lit(1), "embedding")))
        self.rows = keep(rows.dropDuplicates(["vec_id", "cls"]).withColumn("asks", F.coalesce(is_query, F.lit(False))), "vectors")
        grouped = self.rows.groupBy("cls").agg(
            F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("least"),
            F.max("asks").alias("asks"),
            F.count("*").alias("members"),
        )
        self.classes = keep(grouped, "vector-classes")
        norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
        size = self.classes.agg(F.count("*"), F.max(norm)).first()
        self.count, self.longest = size[0], float(size[1] or 0.0)
        if not self.count:
            return
        # bounded by SAMPLE
        sample = first_by(self.classes.select("cls", "embedding"), F.xxhash64("cls"), SAMPLE).orderBy("cls")
        sample = sample.select("embedding").toArrow()
        wanted = lists or max(1, min(LISTS, int(math.sqrt(self.count))))
        space = _Space(_matrix(sample.column(0)), self.longest, wanted)
        self.lists = len(space.centres)
        held = vectors.sparkSession.sparkContext.broadcast(space)
        self.shared = lambda: held.value
        kind = "cls string, embedding array<double>, placed array<double>, lists array<long>"
        chunks = self._placed(self.classes, kind, 0).select("cls", "embedding", "placed", F.col("lists")[0].alias("list"))
        stored = keep(chunks.join(self.classes.select("cls", "least"), "cls"), "lists")
        # one row per list
        sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
        self.stored = stored.join(F.broadcast(sizes), "list").withColumn("chunk", F.pmod(F.xxhash64("cls"), "chunks").cast("int"))
        self.sizes = sizes
        needed = self._needed() if share is None else math.ceil(share * self.lists)
        self.probed = min(self.lists, max(LEAST_PROBED, needed))

    def _needed(self) -> int:
        """How many nearest lists hold ``RECALL`` of the true neighbours of the measured queries."""
        kind = "cls string, embedding array<double>, placed array<double>, lists array<long>"
        # bounded by MEASURED
        chosen = first_by(self.classes.where("asks").select("cls", "embedding"), F.xxhash64("cls"), MEASURED)
        asked = keep(self._placed(chosen, kind, self.lists), "measured")
        every = asked.withColumn("list", F.explode("lists")).withColumn("bound", F.lit(float("nan")))
        found = self.best(self.scanned(every, tested=False))
        found = found.join(self.classes.select("cls", "members"), "cls")
        found = self.stored.select("cls", "list").join(F.broadcast(found), "cls")
        found = found.join(F.broadcast(asked.select(F.col("cls").alias("query"), "lists")), "query")
        place = F.array_position("lists", F.col("list")).alias("place")
        at = found.select("query", "score", "least", "members", place).orderBy("query", F.desc("score"), "least").toPandas()
        if not len(at):
            return 0
        # a class counts by those of its rows that are among the k + 1 best
        before = at.groupby("query")["members"].cumsum() - at["members"]
        weight = np.clip(self.k + 1 - before, 0, at["members"]).to_numpy(float)
        held = np.cumsum(np.bincount(at["place"].to_numpy(np.int64), weight, self.lists + 1))
        return int(np.argmax(held >= RECALL * held[-1]))

    def _placed(self, classes: DataFrame, kind: str, probed: int) -> DataFrame:
        return classes.select("cls", "embedding").mapInArrow(_assign(self.shared, probed), kind)

    def scanned(self, asked: DataFrame, tested: bool = True) -> DataFrame:
        """(query, cls, score) of queries (cls, embedding, placed, list, bound) in their lists; all distances unless ``tested``."""
        met = asked.join(F.broadcast(self.sizes), "list").withColumn("longest", F.lit(self.longest))
        parts = asked.groupBy("list").agg(F.ceil(F.count("*") / QUERY_CHUNK).cast("int").alias("parts"))
        met = met.join(F.broadcast(parts), "list")
        met = met.withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int"))
        met = met.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        held = self.stored.join(F.broadcast(parts), "list").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        keys = ["list", "chunk", "part"]
        left = met.select(*keys, "cls", "embedding", "placed", "bound", "longest").groupBy(*keys)
        right = held.select(*keys, "cls", "embedding", "placed", "least").groupBy(*keys)
        return left.cogroup(right).applyInPandas(_scan_group(self.k + 1, tested), "query string, cls string, score double")

    def best(self, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "least")
        ranked = found.join(self.classes.select("cls", "least"), "cls").withColumn("_n", F.row_number().over(order))
        return ranked.where(F.col("_n") <= self.k + 1).drop("_n")

    def run(self) -> DataFrame:
        """The best classes (query, cls, score, least) of every class that asks."""
        kind = "cls string, embedding array<double>, placed array<double>, lists array<long>"
        asked = keep(self._placed(self.classes.where("asks"), kind, self.probed), "queries")
        first = asked.withColumn("list", F.explode(F.slice("lists", 1, FIRST_LISTS))).withColumn("bound", F.lit(float("nan")))
        near = keep(self.best(self.scanned(first)), "near")
        bound = near.groupBy(F.col("query").alias("cls")).agg(F.count("*").alias("n"), F.min("score").alias("least_score"))
        bound = bound.select("cls", F.when(F.col("n") > self.k, F.col("least_score")).alias("bound"))
        later = asked.join(bound, "cls", "left").withColumn("bound", F.coalesce("bound", F.lit(float("nan"))))
        rest = later.withColumn("list", F.explode(F.slice("lists", FIRST_LISTS + 1, max(1, self.lists))))
        found = keep(self.best(near.drop("least").unionByName(self.scanned(rest))), "found")
        enough = found.groupBy(F.col("query").alias("cls")).agg(F.count("*").alias("n"))
        wanted = min(self.k + 1, self.count)
        short = asked.join(enough.where(F.col("n") >= wanted), "cls", "left_anti")
        if short.isEmpty():
            return found
        every = F.explode(F.sequence(F.lit(0), F.lit(self.lists - 1)))
        again = short.withColumn("list", every.cast("long")).withColumn("bound", F.lit(float("nan")))
        whole = self.best(self.scanned(again))
        return found.join(short.select(F.col("cls").alias("query")), "query", "left_anti").unionByName(whole)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, lists: int | None = None, share: float | None = None
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest other rows of each row for which ``is_query`` holds.

    ``share``: of the lists to probe, measured where it is not given.
    """
    search = _Search(vectors, is_query, k, lists, share)
    if not search.count:
        return search.rows.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    found = search.run()
    # of one class no more than k + 1 of the smallest numbers can be wanted
    inside = Window.partitionBy("cls").orderBy("vec_id")
    members = search.rows.select("cls", "vec_id").withColumn("_n", F.row_number().over(inside)).where(F.col("_n") <= k + 1)
    listed = found.join(members.drop("_n"), "cls")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n", "least", "cls")
    asking = search.rows.where("asks").select(F.col("cls").alias("query"), F.col("vec_id").alias("query_id"))
    pairs = keep(listed, "answers").join(asking, "query").where("query_id != vec_id")
    mine = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
