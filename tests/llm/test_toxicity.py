"""Exact search against all cosines, the fit, held-out accuracy."""

import zlib
from collections import Counter

import numpy as np

from ledgerbrook.llm import toxicity

SF = "/root/testdata/sf0.01"


def model(n, terms, seed):
    rng = np.random.default_rng(seed)
    own = toxicity.Model({f"t{i}": i for i in range(terms)}, rng.uniform(1, 5, terms))
    counts = [Counter({int(t): int(rng.integers(1, 4)) for t in rng.integers(0, terms, rng.integers(0, 6))}) for _ in range(n)]
    ids = rng.permutation(n * 3)[:n]
    own.index(ids, rng.integers(0, 2, n).astype(float), own.vectors(counts))
    return own, ids, own.vectors(counts)


def test_search_is_exact():
    for seed in range(4):
        own, ids, vectors = model(700, 40, seed)
        best, rows = own.search(vectors[:80])
        for q in range(80):
            cosines = np.round(vectors @ vectors[q], 12)
            order = sorted((-c, i) for c, i in zip(cosines, ids, strict=True) if c > 0)[: own.nearest]
            found = [(-round(b, 12), own.ids[r]) for b, r in zip(best[q], rows[q], strict=True) if r >= 0]
            assert np.allclose([a for a, _ in order], [a for a, _ in found])
            if len(order) < own.nearest:
                assert {i for _, i in order} == {i for _, i in found}


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0, 0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1, 1.0]))
    assert np.interp([0, 0.1, 0.15, 0.2, 0.3, 0.4], x, y).tolist() == [0, 0.5, 0.5, 0.5, 1, 1]


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = {r["doc_id"]: r for r in toxicity.report(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    truth = [(r["toxic"], out[r["doc_id"]]["predicted"]) for r in labels.collect() if out[r["doc_id"]]["held_out"]]
    right = sum(t == p for t, p in truth) / len(truth)
    assert right >= 0.93
    # labels of the held-out fold change nothing
    other = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    again = {r["doc_id"]: r["score"] for r in toxicity.report(docs, other).collect()}
    assert again == {i: r["score"] for i, r in out.items()}


def test_odd_rows(spark):
    rows = [(i, f"you total idiot scum {i}" if i % 3 == 0 else f"a calm and useful note {i}", "x", 0.5) for i in range(60)]
    rows += [(100, None, "x", 0.1), (101, "", "x", 0.1), (102, "idiot " * 20000, "x", 0.1), (0, "you total idiot scum 0", "x", 0.1), (None, "IDIOT!", "x", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, evidence string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(0, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.report(docs, labels).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[102]["predicted"] == by_id[None]["predicted"] == 1 and by_id[100]["predicted"] == by_id[101]["predicted"] == 0
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(60) if i % 3} | {100, 101}
    none = toxicity.report(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.report(docs.where("false"), labels).count() == 0
