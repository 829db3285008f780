"""Nearest neighbours against brute force, and the pruning test."""

import numpy as np
from pyspark.sql import functions as F

from ledgerbrook.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def by_hand(ids, vectors, k):
    vectors = vectors.astype(float)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 9))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA)
    out = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def recall(found, want):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_and_scores_over_lists(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    vectors = (centres[rng.integers(0, 12, 1500)] + 0.6 * rng.standard_normal((1500, 24))).astype(np.float32)
    vectors[700:1000] = vectors[5]
    ids = rng.permutation(4000)[:1500]
    found = result(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)])
    want = by_hand(ids, vectors, 20)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.9
    of = dict(zip(ids.tolist(), vectors.astype(float), strict=True))
    for q, rows in found.items():
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        assert all(abs(s - of[q] @ of[i]) < 1e-12 for i, s in rows)


def test_recall_without_clusters(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"])
    found = result(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)])
    got = recall(found, by_hand(ids, vectors, 20))
    print("recall", got)
    assert got >= 0.9


def test_all_lists_give_all(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 50)
    monkeypatch.setattr(ann, "QUERY_CHUNK", 7)
    monkeypatch.setattr(ann, "ERROR", 50.0)
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (400, 6)).astype(np.float32)
    vectors[vectors.any(axis=1) == 0, 0] = 1
    ids = np.arange(400)
    found = result(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], share=1.0)
    want = by_hand(ids, vectors, 20)
    assert {q: [i for i, _ in r] for q, r in found.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [1.0, float("nan")])]
    rows += [(7, [float("inf"), 1.0]), (8, [1.0, None]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, []), (60, None)]
    found = result(spark, rows)
    assert found == {0: [(20, 1.0), (3, 0.5)], 20: [(0, 1.0), (3, 0.5)]}
    assert result(spark, []) == {} and result(spark, [(20, [1.0])]) == {}


def test_the_scan_keeps_what_is_near():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((3000, 64)) @ ann.rotation(64)
    lost = 0
    for q in range(50):
        far = ((vectors - vectors[q]) ** 2).sum(axis=1)
        bound = np.sort(far)[20]
        kept = set(ann.scan(vectors[q], vectors.T, bound).tolist())
        lost += len(set(np.argsort(far)[:21].tolist()) - kept)
        assert len(kept) < 400
    assert lost <= 0.02 * 50 * 21
