"""Toxicity scores from the nearest labelled examples.

Texts are TF-IDF vectors over terms: words without the marks around them, and the
first four and five letters of longer words, which carry what inflected forms
share. The vocabulary holds the terms that speak most for the label by chi-squared
among the labelled examples (those with at least a tenth of the best value), their document frequencies are counted over all
documents. Cosine is exact in that space.

The examples (at most ``EXAMPLES``, the first by a hash of doc_id) are an inverted
index in blocks: for each term of a block the weights of its documents, and their
maximum. For a text the maxima bound its cosine with any document of a block, so
its blocks are taken by falling bound until the bound is below the k-th best: the
k nearest are exact. They vote by nearness, and votes become probabilities by an
isotonic fit over the examples themselves, each scored without itself. The nearest
examples come along as evidence.

Only the examples, the vocabulary and the fit are bounded by parameters and sent to
the tasks; every document is scored in full.

Defined cases: a text with no term of the vocabulary (also null and empty) takes
the share of the label among such examples. Without any labelled example every
score is 0. Repeated labels of a document count as 1 if any is 1; null labels are
left out. Repeated rows are scored alike. A null doc_id has no example and is held
out never. Extra columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep

EXAMPLES = 8000
TERMS = 512
LEAST_DF = 3
LEAST_SHARE = 0.1
NEAREST = 25
BLOCK = 64
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
EVIDENCE = 5

_MARKS = ".,;:!?\"'`()[]{}<>|*#$%&-_/\\"
_MEMO = 300_000


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def terms_of(word: str) -> list[str]:
    """The terms of one word: itself without marks, and its first letters."""
    core = word.strip(_MARKS).lower()
    if not core:
        return []
    return [core, *(f"{core[:n]}^{n}" for n in (4, 5) if len(core) > n)]


def _counted(text: str, memo: dict[str, tuple[int, ...]], vocabulary: dict[str, int]) -> Counter:
    found: Counter = Counter()
    for word in text.split():
        ids = memo.get(word)
        if ids is None:
            if len(memo) > _MEMO:
                memo.clear()
            ids = memo[word] = tuple(vocabulary[t] for t in terms_of(word) if t in vocabulary)
        if ids:
            found.update(ids)
    return found


@dataclass
class Model:
    """Vocabulary, blocked index, labels and the fit from votes to probabilities."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    blocks: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)
    maxima: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    nearest: int = NEAREST
    empty_rate: float = 0.0
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def vectors(self, counts: list[Counter]) -> np.ndarray:
        """Unit TF-IDF vectors, zero where no term is known."""
        out = np.zeros((len(counts), len(self.vocabulary)))
        for row, found in zip(out, counts, strict=True):
            if found:
                at = np.fromiter(found, np.int64, len(found))
                row[at] = (1 + np.log(np.fromiter(found.values(), float, len(found)))) * self.idf[at]
        length = np.sqrt((out**2).sum(axis=1, keepdims=True))
        return np.divide(out, length, out=out, where=length > 0)

    def index(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Lay the examples out in blocks of like documents, with the maximum of each term in each block."""
        order = np.lexsort((ids, vectors.max(axis=1, initial=0), vectors.argmax(axis=1) if vectors.shape[1] else ids))
        self.ids, self.labels, vectors = ids[order], labels[order], vectors[order]
        maxima = []
        for at in range(0, len(ids), BLOCK):
            part = vectors[at : at + BLOCK]
            top = part.max(axis=0)
            used = np.flatnonzero(top)
            self.blocks.append((at, used, np.ascontiguousarray(part[:, used].T)))
            maxima.append(top)
        self.maxima = np.array(maxima).reshape(len(self.blocks), vectors.shape[1]).T

    def search(self, queries: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and rows of the nearest examples, best first; -1 where there are fewer. ``skip``: a row per query."""
        n, k = len(queries), self.nearest
        best, rows = np.zeros((n, k)), np.full((n, k), -1)
        bounds = queries @ self.maxima
        order = np.argsort(-bounds, axis=1, kind="stable")
        active = np.arange(n)
        for turn in range(len(self.blocks)):
            block = order[active, turn]
            reach = bounds[active, block]
            # equal bounds are still looked at: ties go to the smaller id
            going = (reach > 0) & (reach >= best[active, -1] - 1e-9)
            active, block = active[going], block[going]
            if not len(active):
                break
            for b in np.unique(block):
                own = active[block == b]
                at, used, weights = self.blocks[b]
                score = np.round(queries[np.ix_(own, used)] @ weights, 12)
                held = np.broadcast_to(np.arange(at, at + weights.shape[1]), score.shape)
                if skip is not None:
                    score = np.where(held == skip[own, None], 0.0, score)
                score = np.concatenate([best[own], score], axis=1)
                held = np.where(score > 0, np.concatenate([rows[own], held], axis=1), -1)
                names = np.where(held >= 0, self.ids[held], np.iinfo(np.int64).max)
                top = np.lexsort((names, -score), axis=1)[:, :k]
                best[own], rows[own] = np.take_along_axis(score, top, 1), np.take_along_axis(held, top, 1)
        return best, rows

    def vote(self, best: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The share of nearness that votes for the label; NaN where there is no example near."""
        if not len(self.labels):
            return np.full(len(best), np.nan)
        weight = np.where(rows >= 0, 1 / (1.05 - np.minimum(best, 1.0)), 0.0)
        for_it = (weight * np.where(rows >= 0, self.labels[rows], 0.0)).sum(axis=1)
        total = weight.sum(axis=1)
        return np.divide(for_it, total, out=np.full(len(best), np.nan), where=total > 0)

    def calibrate(self, vectors: np.ndarray) -> None:
        """Isotonic rates over the examples' own votes; ``vectors`` in the order of the index."""
        if not len(vectors):
            return
        pooled = [self.search(vectors[at : at + 512], np.arange(at, min(at + 512, len(vectors)))) for at in range(0, len(vectors), 512)]
        votes = np.concatenate([self.vote(*found) for found in pooled])
        known = ~np.isnan(votes)
        bare = self.labels[~known]
        self.empty_rate = float((bare.sum() + self.labels.mean()) / (len(bare) + 1))
        self.votes, self.rates = isotonic(votes[known], self.labels[known])

    def scores(self, votes: np.ndarray) -> np.ndarray:
        known = ~np.isnan(votes)
        out = np.full(len(votes), self.empty_rate)
        if len(self.votes):
            out[known] = np.interp(votes[known], self.votes, self.rates)
        return np.clip(out, 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and rates of the rising step function closest to ``y``, by pooling adjacent violators."""
    if not len(x):
        return np.zeros(0), np.zeros(0)
    places, at = np.unique(x, return_inverse=True)
    total, count = np.bincount(at, y), np.bincount(at).astype(float)
    pools: list[list[float]] = []
    for place, t, c in zip(places, total, count, strict=True):
        pools.append([t, c, place, place])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t2, c2, _, high = pools.pop()
            pools[-1] = [pools[-1][0] + t2, pools[-1][1] + c2, pools[-1][2], high]
    rates = np.array([t / c for t, c, _, _ in pools])
    edges = [(low, r) for (_, _, low, _), r in zip(pools, rates, strict=True)]
    edges += [(high, r) for (_, _, _, high), r in zip(pools, rates, strict=True)]
    edges.sort()
    return np.array([e[0] for e in edges]), np.array([e[1] for e in edges])


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [sorted({t for w in set(text.split()) for t in terms_of(w)}) for text in batch.column(2).fill_null("").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "toxic", "terms"]
        )


def _frequencies(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, memo, rows = np.zeros(len(vocabulary), np.int64), {}, 0
        for batch in batches:
            for text in batch.column(0).fill_null("").to_pylist():
                rows += 1
                found = _counted(text, memo, vocabulary)
                if found:
                    seen[list(found)] += 1
        at = np.arange(-1, len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([[rows], seen]))], names=["term", "df"])

    return run


def _example_counts(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            found = [_counted(t, memo, vocabulary) for t in batch.column(2).fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([list(c) for c in found], pa.list_(pa.int64())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS) -> Model:
    """Model from the labelled rows (doc_id, toxic) outside the held-out fold and their texts in ``docs``."""
    rows = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id")) != HELD_OUT)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    chosen = keep(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "example-labels")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    # bounded by ``examples``
    sample = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # copies of a text would make all its words seem to speak for its label
    sample = sample.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    sample = sample.select("doc_id", "toxic", "text")
    sample = keep(sample, "examples")
    size = sample.agg(F.count("*"), F.sum("toxic")).first()
    n, n1 = size[0], size[1] or 0.0
    listed = sample.mapInArrow(_example_terms, "doc_id long, toxic double, terms array<string>")
    a, both = F.sum("toxic"), F.count("*")
    counted = listed.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(a.alias("a"), both.alias("df"))
    lift = F.col("a") * n - F.col("df") * F.lit(n1)
    chi = lift * lift / (F.col("df") * (n - F.col("df")) + 1e-9)
    # bounded by ``terms``
    best = counted.where((F.col("df") >= LEAST_DF) & (lift > 0)).select("term", chi.alias("chi"))
    best = best.orderBy(F.desc("chi"), "term").limit(terms).collect()
    best = [row["term"] for row in best if row["chi"] >= LEAST_SHARE * best[0]["chi"]]
    vocabulary = {term: i for i, term in enumerate(sorted(best))}
    df = np.zeros(len(vocabulary) + 1)
    spread = texts.select("text").mapInArrow(_frequencies(vocabulary), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in spread.collect():
        df[row["term"] + 1] = row["df"]
    model = Model(vocabulary, np.log((1 + df[0]) / (1 + df[1:])) + 1)
    found = sample.mapInArrow(
        _example_counts(vocabulary), "doc_id long, toxic double, terms array<long>, counts array<long>"
    ).orderBy("doc_id").collect()
    vectors = model.vectors([Counter(dict(zip(r["terms"], r["counts"], strict=True))) for r in found])
    ids = np.array([r["doc_id"] for r in found], np.int64)
    order_of = {i: k for k, i in enumerate(ids.tolist())}
    model.index(ids, np.array([r["toxic"] for r in found], float), vectors)
    model.calibrate(vectors[[order_of[i] for i in model.ids.tolist()]] if len(ids) else vectors)
    return model


def _score(shared: Callable[[], Model]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = shared(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = [_counted(t, memo, model.vocabulary) for t in part.column(1).fill_null("").to_pylist()]
                best, rows = model.search(model.vectors(counts))
                score = model.scores(model.vote(best, rows))
                near = [[int(model.ids[r]) for r in own[:EVIDENCE] if r >= 0] for own in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array(near, pa.list_(pa.int64()))],
                    names=["key", "score", "evidence"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score, evidence (doc_ids of the nearest examples)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    scored = rows.mapInArrow(_score(lambda: held.value), "key long, score double, evidence array<long>")
    return scored.withColumnRenamed("key", "doc_id")


def predicted(score_: Column, threshold: float = THRESHOLD) -> Column:
    return (score_ >= threshold).cast("int")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, fit(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to carry the label."""
    model = fit(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memo = held.value, {}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                counts = [_counted(t, memo, own.vocabulary) for t in part.column(at).fill_null("").to_pylist()]
                scores = own.scores(own.vote(*own.search(own.vectors(counts))))
                yield part.filter(pa.array(scores < THRESHOLD))

    return docs.select(*names).mapInArrow(run, docs.schema)
