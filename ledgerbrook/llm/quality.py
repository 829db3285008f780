"""Quality scores from random-indexing word vectors and a small neural network.

Texts are streams of tokens: runs of letters, digits and bytes beyond ASCII, with A-Z
lower-cased, a mark before runs with capitals (one for those all in capitals, one for
others), and runs of one repeated other character. A token has a row (a hash of its
bytes into ``ROWS``) and a fixed sparse index vector with entries of +1 and -1.
Its context vector is the sum of the index vectors of its neighbours, up to ``WINDOW``
places away, over every text of the table; tasks add up whole-number matrices of ROWS x
``DIMENSIONS``, which Spark sums by row. Vectors are scaled to length one.

A document pools the vectors of its tokens: their mean, their spread, and the mean
product of neighbours, which is large where words repeat; with them its length, the
length of the mean, and the share of tokens that repeat the one or two places before.
A two-layer network (numpy, Adam) learns the label from these by the labelled
sample outside the held-out fold; one number, the temperature, is then fitted on rows
that the network has not seen, so that scores are probabilities.

Only the labelled sample (at most ``EXAMPLES`` rows, the first by a hash of doc_id), the
matrix and the network are bounded by parameters and sent around; word vectors are
counted over all texts, and every text is scored in full.

Defined cases: null and empty texts pool to zeros and are scored like any other. Without
any label in the learning folds every score is 0; with one kind of label, its share,
smoothed. Repeated labels of a document count as 1 if any is 1; null labels and null
doc_ids are not learned from. A repeated doc_id with other texts learns from each text. Repeated rows are scored alike. A null doc_id is held out
never. Texts of any length are read in lots. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep

EXAMPLES = 8000
ROWS = 1 << 14
DIMENSIONS = 48
ENTRIES = 2
WINDOW = 2
HIDDEN = 32
EPOCHS = 60
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5

_SPACE = re.compile(rb"[\x00-\x20]")
_LOT = 1 << 18
_FEATURES = 3 * DIMENSIONS + 4


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def _kinds() -> np.ndarray:
    """The kind of each byte: 0 separates, 1 is part of a word, any other stands for itself."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = np.arange(0x21, 0x7F)
    for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        kind[low:high] = 1
    return kind


_KIND = _kinds()
_IS_CAPITAL = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_LOW = (np.arange(256) + 32 * _IS_CAPITAL + 1).astype(np.uint32)
#: Odd numbers that weigh the bytes of a token by their place in it.
_WEIGHT = np.random.default_rng(2).integers(0, 1 << 31, 64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_LEADING, _CAPITALS = 0, 1


def tokens(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the tokens of ``data`` and the place where each begins."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[raw]
    start = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    length = np.diff(np.append(start, len(raw)))
    inside = np.arange(len(raw)) - np.repeat(start, length)
    value = np.add.reduceat(_LOW[raw] * _WEIGHT[inside & 63], start, dtype=np.uint32)
    row = ((value * np.uint32(2654435761)) >> np.uint32(32 - ROWS.bit_length() + 1)).astype(np.int64)
    capitals = np.add.reduceat(_IS_CAPITAL[raw], start, dtype=np.int64)
    real = kind[start] > 0
    row, start, length, capitals = row[real], start[real], length[real], capitals[real]
    marked = np.flatnonzero(capitals)
    mark = np.where((capitals == length) & (length > 1), _CAPITALS, _LEADING)[marked]
    return np.insert(row, marked, mark), np.insert(start, marked, start[marked])


def lots(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token rows, piece of each token, text of each piece) for lots of about ``_LOT`` bytes, in order.

    A text is one piece, or several that are cut at white space at places that depend on the text alone.
    """
    held: list[bytes] = []
    number: list[int] = []
    size = 0

    def out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, start = tokens(b" ".join(held))
        begin = np.cumsum([0] + [len(h) + 1 for h in held[:-1]])
        return rows, np.searchsorted(begin, start, "right") - 1, np.array(number)

    for at, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            cut = _SPACE.search(text, begin + _LOT)
            end = cut.start() if cut else len(text)
            held.append(text[begin:end])
            number.append(at)
            size, begin = size + end - begin, end
            if size >= _LOT:
                yield out()
                held, number, size = [], [], 0
    if held:
        yield out()


class Line:
    """Token rows of lot after lot, with the last tokens of the lot before in front."""

    def __init__(self) -> None:
        self.rows = self.text = np.zeros(0, np.int64)
        self.new = 0

    def take(self, rows: np.ndarray, text: np.ndarray) -> None:
        self.new = min(WINDOW, len(self.rows))
        self.rows = np.concatenate([self.rows[len(self.rows) - self.new :], rows])
        self.text = np.concatenate([self.text[len(self.text) - self.new :], text])

    def pairs(self, gap: int) -> np.ndarray:
        """Places of the right tokens of pairs ``gap`` apart in one text; each pair is met in one lot only."""
        right = np.arange(max(gap, self.new), len(self.rows))
        return right[self.text[right] == self.text[right - gap]]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each row's index vector; the same on every machine."""
    rng = np.random.default_rng(0)
    return rng.integers(0, DIMENSIONS, (ROWS, ENTRIES)), rng.choice(np.array([-1.0, 1.0]), (ROWS, ENTRIES))


def add_contexts(total: np.ndarray, line: Line, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to the flat matrix ``total`` the index vectors of neighbours in the same text."""
    for gap in range(1, WINDOW + 1):
        at = line.pairs(gap)
        left, right = line.rows[at - gap], line.rows[at]
        for own, other in ((left, right), (right, left)):
            for e in range(ENTRIES):
                total += np.bincount(own * DIMENSIONS + places[other, e], signs[other, e], ROWS * DIMENSIONS)


def contexts(texts: Iterable[bytes]) -> np.ndarray:
    """The context vectors of all rows over ``texts``, in whole numbers."""
    total, line, (places, signs) = np.zeros(ROWS * DIMENSIONS), Line(), index_vectors()
    for rows, piece, text in lots(texts):
        line.take(rows, text[piece])
        add_contexts(total, line, places, signs)
    return total.reshape(ROWS, DIMENSIONS).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    matrix = contexts(scalar.as_py() or b"" for batch in batches for scalar in batch.column(0))
    at = np.flatnonzero(np.abs(matrix).sum(axis=1))
    columns = [pa.array(at), *(pa.array(np.ascontiguousarray(matrix[at, d])) for d in range(DIMENSIONS))]
    yield pa.RecordBatch.from_arrays(columns, names=["row", *_NAMES])


_NAMES = [f"d{d}" for d in range(DIMENSIONS)]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all rows, counted over every text; ROWS x DIMENSIONS numbers come to the driver."""
    schema = ", ".join(["row long", *(f"{n} long" for n in _NAMES)])
    found = docs.select(F.col("text").cast("binary")).mapInArrow(_contexts, schema)
    whole = found.groupBy("row").agg(*[F.sum(n).cast("double").alias(n) for n in _NAMES]).toArrow()
    out = np.zeros((ROWS, DIMENSIONS))
    if whole.num_rows:
        out[whole.column("row").to_numpy()] = np.stack([whole.column(n).to_numpy() for n in _NAMES], axis=1)
    length = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return np.divide(out, length, out=out, where=length > 0).astype(np.float32)


def pool(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """What the network sees of each text: a row per text, the same whatever stands beside it."""
    n, first = np.zeros(len(texts)), np.zeros((len(texts), DIMENSIONS))
    square, product, again = first.copy(), first.copy(), np.zeros((len(texts), 2))
    line = Line()
    for rows, piece, text in lots(texts):
        line.take(rows, text[piece])
        own = vectors[line.rows].astype(np.float64)
        new = own[line.new :]
        n += np.bincount(text[piece], minlength=len(texts))
        pieces = np.flatnonzero(np.diff(piece, prepend=-1))
        if len(pieces):
            # the pieces of one text are added one by one, in order
            np.add.at(first, text[piece[pieces]], np.add.reduceat(new, pieces, axis=0))
            np.add.at(square, text[piece[pieces]], np.add.reduceat(new * new, pieces, axis=0))
        for gap in (1, 2):
            at = line.pairs(gap)
            again[:, gap - 1] += np.bincount(line.text[at[line.rows[at] == line.rows[at - gap]]], minlength=len(texts))
            if gap == 1 and len(at):
                of = piece[at - line.new]
                pieces = np.flatnonzero(np.diff(of, prepend=-1))
                met = np.add.reduceat(own[at - 1] * own[at], pieces, axis=0)
                np.add.at(product, text[of[pieces]], met)
    some = np.maximum(n, 1)[:, None]
    mean = first / some
    spread = np.sqrt(np.maximum(square / some - mean**2, 0))
    length = np.sqrt((mean**2).sum(axis=1, keepdims=True))
    return np.concatenate([mean, spread, product / some, np.log1p(n)[:, None], length, again / some], axis=1)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) in lots bounded by rows and, but for single texts, by bytes."""
    at, own, size = 0, [], 0
    for scalar in texts:
        own.append(scalar.as_py() or b"")
        size += len(own[-1])
        if len(own) == 512 or size >= _LOT:
            yield at, own
            at, own, size = at + len(own), [], 0
    if own:
        yield at, own


@dataclass
class Network:
    """Two layers over standardised features, and the temperature of their output."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float = 0.0
    temperature: float = 1.0
    flat: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        # one row at a time the sums are the same wherever a row stands in its batch
        hidden = np.maximum(np.einsum("ij,jk->ik", z, self.w1) + self.b1, 0)
        return np.einsum("ij,j->i", hidden, self.w2) + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(x), self.flat)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Network:
    """The network on four fifths of the rows and the temperature on the rest; rows come in a fixed order."""
    n = len(x)
    blank = Network(np.zeros(_FEATURES), np.ones(_FEATURES), np.zeros((_FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN))
    if not n or y.min() == y.max():
        blank.flat = float((y.sum() + 0.5) / (n + 1)) if n else 0.0
        return blank
    rng = np.random.default_rng(1)
    aside = np.arange(n) % 5 == 4
    if y[~aside].min() == y[~aside].max() or not aside.any():
        aside[:] = False
    own, label = x[~aside], y[~aside]
    net = Network(
        own.mean(axis=0), own.std(axis=0) + 1e-3,
        rng.normal(0, np.sqrt(2 / _FEATURES), (_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
    )
    z = np.clip((own - net.centre) / net.scale, -8, 8)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 64):
            rows = order[at : at + 64]
            inner = z[rows] @ params[0] + params[1]
            hidden = np.maximum(inner, 0)
            error = (1 / (1 + np.exp(-(hidden @ params[2] + params[3]))) - label[rows]) / len(rows)
            back = np.outer(error, params[2]) * (inner > 0)
            slopes = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * params[2], np.array([error.sum()])]
            step += 1
            for p, (m, v), g in zip(params, moments, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if aside.any():
        net.temperature = temperature(net.logits(x[aside]), y[aside])
    return net


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, by golden section over its logarithm."""

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    low, high, ratio = np.log(0.1), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _pooled(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _slices(batch.column(2)):
                part, x = batch.slice(at, len(texts)), pa.array(pool(texts, vectors.value).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), x], names=["doc_id", "label", "x"])

    return run


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", examples: int = EXAMPLES) -> Model:
    """Word vectors of all ``docs`` (doc_id, text) and the network learned from ``labels`` (doc_id, label)."""
    value = F.col(label)
    rows = labels.where(value.isNotNull() & F.col("doc_id").isNotNull()).where(fold(F.col("doc_id")) != HELD_OUT)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(value).cast("double").alias("label"))
    chosen = keep(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "example-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # bounded by ``examples``
    sample = texts.join(F.broadcast(chosen), "doc_id")
    # a text and its copies teach once; which of them is named does not depend on the run
    sample = sample.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
    vectors = word_vectors(docs)
    held = docs.sparkSession.sparkContext.broadcast(vectors)
    found = sample.select("doc_id", "label", F.col("text").cast("binary")).mapInArrow(_pooled(held), "doc_id long, label double, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist()).reshape(-1, _FEATURES)
    order = np.lexsort([*x.T[:4], found.column("doc_id").to_numpy(), (found.column("doc_id").to_numpy() * 2654435761) % (1 << 32)])
    return Model(vectors, train(x[order], found.column("label").to_numpy()[order]))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                found = pa.array(model.network.scores(pool(texts, model.vectors)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), found], names=["key", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_score(shared), "key long, score double").withColumnRenamed("key", "doc_id")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return score(docs, fit(docs, labels)).select("doc_id", held_out, "score", predicted)
