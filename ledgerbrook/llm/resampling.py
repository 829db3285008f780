"""Importance resampling towards a target collection by hashed word runs.

Features are all runs of 1 to ``orders`` words; a feature's bucket is the CRC-32 of its
bytes, modulo ``buckets``, derived from running checksums (``ngram_hash``). Counts per
bucket over all documents and over all target texts give each bucket a gain, the floored
log ratio of the smoothed shares in thousandths. A document weighs the sum of the gains
of its features. Weight plus Gumbel noise, fixed by the seed and doc_id, ranks the
documents: the highest scores are a sample without replacement by importance.

Tasks add up counts in one array of ``buckets`` numbers and hand on that; the gains,
one per bucket, are all that is sent to the tasks. The ranking is a range sort of
(score, doc_id) rows.

Defined cases: a null or empty text has no features, weight 0 and is not drawn, like any
with fewer than ``least`` words. A null doc_id has the noise of ``<seed>:`` and comes
last among ties; repeated rows are counted and ranked each. An empty target gives gains
of the smoothing alone; an empty table gives an empty result. Extra columns are ignored
by ``resample`` and untouched by ``drawn``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, ranked, whole_row
from ledgerbrook.llm.ngram_hash import Scan, byte_table

ORDERS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
_SLICE_ROWS, _SLICE_BYTES = 256, 1 << 22


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) in lots bounded by rows and, but for single texts, by bytes."""
    at, lot, size = 0, [], 0
    for scalar in texts:
        data = scalar.as_py() or b""
        if lot and (len(lot) == _SLICE_ROWS or size + len(data) > _SLICE_BYTES):
            yield at, lot
            at, lot, size = at + len(lot), [], 0
        lot.append(data)
        size += len(data)
    if lot:
        yield at, lot


def _counts(orders: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = byte_table(keep_digits=True), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                scan = Scan(texts, table)
                for n in range(1, orders + 1):
                    total += np.bincount(scan.runs(n)[1] % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> list[int]:
    """Features per bucket over all rows of ``texts`` (text); as many numbers as buckets come to the driver."""
    found = texts.select(F.col("text").cast("binary")).mapInArrow(_counts(orders, buckets), "bucket long, n long")
    out = [0] * buckets
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(docs: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, per bucket."""
    all_docs, all_target, n = sum(docs), sum(target), len(docs)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_docs + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(docs, target, strict=True)
        ],
        np.int64,
    )


def _weigh(gain: np.ndarray, orders: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(keep_digits=True)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                scan = Scan(texts, table)
                weight, features = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for n in range(1, orders + 1):
                    text, crc = scan.runs(n)
                    np.add.at(weight, text, gain[crc % np.uint32(len(gain))])
                    features += np.bincount(text, minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *map(pa.array, (scan.counts, features, weight))],
                    names=["carried", "n_words", "n_features", "weight"],
                )

    return run


def weigh(docs: DataFrame, carried: Column, gain: np.ndarray, orders: int = ORDERS) -> DataFrame:
    """Per row of ``docs``: ``carried`` as it is, n_words, n_features, weight."""
    rows = docs.select(carried.alias("carried"), F.col("text").cast("binary").alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(_weigh(gain, orders), f"carried {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Floored Gumbel noise in thousandths, the same in every run."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def _scored(docs: DataFrame, target: DataFrame, carried: Column, doc_id: str, orders: int, buckets: int, seed: int) -> DataFrame:
    gain = gains(bucket_counts(docs, orders, buckets), bucket_counts(target, orders, buckets))
    return weigh(docs, carried, gain, orders).withColumn("score", F.col("weight") + noise(F.col(doc_id), seed))


def resample(
    docs: DataFrame,
    target: DataFrame,
    orders: int = ORDERS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (null if not drawn)."""
    out = _scored(docs, target, F.col("doc_id").cast("long"), "carried", orders, buckets, seed)
    out = keep(out.withColumnRenamed("carried", "doc_id"), "weighed")
    eligible = F.col("n_words") >= least
    room = out.where(eligible).count() * percent // 100
    order = [(~eligible).cast("int"), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("weight")]
    place = ranked(out, order, "place")
    rank = F.when(eligible & (F.col("place") < room), F.col("place") + 1)
    return place.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def drawn(
    docs: DataFrame,
    target: DataFrame,
    orders: int = ORDERS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; rows equal to the last one drawn in score and
    doc_id are drawn too."""
    out = _scored(docs, target, whole_row(docs), "carried.doc_id", orders, buckets, seed)
    out = keep(out.where(F.col("n_words") >= least).drop("n_words", "n_features", "weight"), "weighed")
    room = out.count() * percent // 100
    keys = out.select("score", F.col("carried.doc_id").alias("doc_id"))
    last = ranked(keys, [F.desc("score"), F.asc_nulls_last("doc_id")], "place").where(F.col("place") == room - 1).first()
    if last is None:
        return out.where("false").select("carried.*")
    above = F.col("score") > last["score"]
    doc_id = F.col("carried.doc_id")
    tied = F.lit(True) if last["doc_id"] is None else doc_id <= last["doc_id"]
    return out.where(above | ((F.col("score") == last["score"]) & F.coalesce(tied, F.lit(False)))).select("carried.*")
