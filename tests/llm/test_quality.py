"""Tokens, contexts and pools against plain loops, the network, held-out accuracy, odd rows."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerbrook.llm import quality

SF = "/root/testdata/sf0.01"
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|([!-/:-@\[-`{-~])\1*")


def plain_tokens(data):
    out = []
    for met in TOKEN.finditer(data):
        run = met[0]
        capitals = len(re.findall(rb"[A-Z]", run))
        if capitals:
            out.append(1 if capitals == len(run) > 1 else 0)
        out.append(run.lower())
    return out


def row_of(token):
    return token if isinstance(token, int) else int(quality.tokens(token)[0][0])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abZÉé19 \n.$!_\x00\x7f", max_size=60))
def test_tokens(text):
    data = text.encode()
    assert quality.tokens(data)[0].tolist() == [row_of(t) for t in plain_tokens(data)]


def plain_contexts(texts):
    places, signs = quality.index_vectors()
    total = np.zeros((quality.ROWS, quality.DIMENSIONS), np.int64)
    for text in texts:
        rows = [row_of(t) for t in plain_tokens(text)]
        for i, own in enumerate(rows):
            for j in range(max(0, i - quality.WINDOW), min(len(rows), i + quality.WINDOW + 1)):
                if i != j:
                    for place, sign in zip(places[rows[j]], signs[rows[j]], strict=True):
                        total[own, place] += int(sign)
    return total


def plain_pool(text, vectors):
    rows = [row_of(t) for t in plain_tokens(text)]
    if not rows:
        return np.zeros(3 * quality.DIMENSIONS + 4)
    own = vectors[rows].astype(float)
    n, mean = len(rows), own.mean(axis=0)
    spread = np.sqrt(np.maximum((own**2).mean(axis=0) - mean**2, 0))
    product = (own[:-1] * own[1:]).sum(axis=0) / n
    again = [sum(a == b for a, b in zip(rows, rows[g:])) / n for g in (1, 2)]
    return np.concatenate([mean, spread, product, [np.log1p(n), np.sqrt((mean**2).sum())], again])


TEXTS = [b"", b"One word", b"   \n ", b"a a a a b", ("é " * 40 + "Tail ### $$$").encode(), b"x", b"LOUD!! loud!! Loud" * 30]


@pytest.mark.parametrize("lot", [1, 7, 50, 1 << 18])
def test_contexts_and_pools_do_not_depend_on_lots(monkeypatch, lot):
    monkeypatch.setattr(quality, "_LOT", lot)
    assert np.array_equal(quality.contexts(TEXTS), plain_contexts(TEXTS))
    vectors = np.random.default_rng(3).normal(size=(quality.ROWS, quality.DIMENSIONS)).astype(np.float32)
    found = quality.pool(TEXTS, vectors)
    assert np.allclose(found, [plain_pool(t, vectors) for t in TEXTS], atol=1e-5)
    assert np.array_equal(found[2:5], quality.pool(TEXTS[2:5], vectors))


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(5)
    x = np.zeros((4000, 3 * quality.DIMENSIONS + 4))
    x[:, :4] = rng.normal(size=(4000, 4))
    # no straight line tells these apart
    rate = 1 / (1 + np.exp(-3 * (np.abs(x[:, 0]) - 0.7)))
    y = (rng.uniform(size=4000) < rate).astype(float)
    net = quality.train(x[:3000], y[:3000], epochs=20)
    scores = net.scores(x[3000:])
    loss = -np.mean(y[3000:] * np.log(scores + 1e-12) + (1 - y[3000:]) * np.log(1 - scores + 1e-12))
    assert np.mean((scores >= 0.5) == y[3000:]) > 0.66 and loss < 0.6
    again = quality.train(x[:3000], y[:3000], epochs=20)
    assert np.array_equal(again.scores(x[3000:]), scores)


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(6)
    z = rng.normal(size=20_000)
    y = (rng.uniform(size=20_000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality.temperature(4 * z, y) - 4) < 0.3


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = {r["doc_id"]: r for r in quality.report(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    truth = [(r["quality"], out[r["doc_id"]]["predicted"]) for r in labels.collect() if out[r["doc_id"]]["held_out"]]
    assert sum(t == p for t, p in truth) / len(truth) >= 0.95
    assert np.mean([p == 0 for t, p in truth if t == 0]) >= 0.85
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    # neither the other fold's labels nor other columns matter, nor the order of the rows
    plain = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source").repartition(7)
    again = {r["doc_id"]: r["score"] for r in quality.report(plain, other).collect()}
    assert again == {i: r["score"] for i, r in out.items()}


def test_odd_rows(spark):
    rows = [(i, f"word {i} " * 30 if i % 2 else f"Some sentence about thing {i}, and more of it.", "x", 0.5) for i in range(80)]
    rows += [(100, None, "x", 0.1), (101, "", "x", 0.1), (102, "word 7 " * 60_000, "x", 0.1), (0, rows[0][1], "x", 0.1), (1, "another", "x", 0.1), (None, "word 5 " * 30, "x", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, score double")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)] + [(0, 1), (3, None), (None, 1), (999, 1)], "doc_id long, quality int")
    out = quality.report(docs, labels).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[102]["predicted"] == by_id[None]["predicted"] == 0 and by_id[0]["predicted"] == 1
    assert by_id[100]["score"] == by_id[101]["score"]
    assert {r["score"] for r in quality.report(docs, labels.where("false")).collect()} == {0.0}
    assert {r["predicted"] for r in quality.report(docs, labels.where("quality = 1")).collect()} == {1}
    assert quality.report(docs.where("false"), labels).count() == 0
