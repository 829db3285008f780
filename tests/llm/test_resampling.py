"""Checksums of word runs against direct ones, counts and draws by hand, odd rows."""

import hashlib
import math
import re
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerbrook.llm import ngram_hash, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs_of(text, orders):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, orders + 1) for i in range(len(w) - n + 1)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZ9é本 \n.,\x00~", max_size=60), max_size=5), st.integers(1, 4))
def test_runs_have_the_checksum_of_their_bytes(texts, n):
    scan = ngram_hash.Scan([t.encode() for t in texts], ngram_hash.byte_table(keep_digits=True))
    text, crc = scan.runs(n)
    direct = []
    for i, t in enumerate(texts):
        w = words_of(t)
        direct += [(i, crc32(" ".join(w[j : j + n]).encode())) for j in range(len(w) - n + 1)]
    assert list(zip(text.tolist(), crc.tolist(), strict=True)) == direct


@given(st.text(alphabet="ab c.", max_size=80), st.integers(1, 12))
def test_lots_lose_no_word(text, lot):
    table = ngram_hash.byte_table(keep_digits=True)
    assert [w for part in ngram_hash.word_lots(text.encode(), table, lot) for w in part] == text.encode().translate(table).split()


def test_long_words_and_long_texts():
    table = ngram_hash.byte_table(keep_digits=True)
    text = "x" * 300_000 + " " + "ab " * 700_000
    scan = ngram_hash.Scan([text.encode()], table)
    _, crc = scan.runs(2)
    assert len(crc) == 700_000
    assert crc[0] == crc32(b"x" * 300_000 + b" ab") and crc[-1] == crc32(b"ab ab")


def brute(docs, target, orders, percent, least, seed, buckets):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for run in runs_of(t, orders):
                out[crc32(run.encode()) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        found = runs_of(text, orders)
        weight = sum(gain[crc32(r.encode()) % buckets] for r in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


DOCS = (
    [(i, f"Alpha beta {'gamma ' * (i % 7)} number{i} and some more words to be long enough, one two three four five six seven eight nine ten") for i in range(60)]
    + [(100, None), (101, ""), (102, "   \n"), (103, "tiny"), (None, "alpha " * 30), (5, "alpha " * 30), (5, "alpha " * 30), (104, "é" * 5000 + " beta" * 50_000)]
)
TARGET = ["gamma gamma alpha", None, "", "beta number7 é"]


@pytest.mark.parametrize("orders,percent", [(1, 10), (3, 50)])
def test_against_a_plain_version(spark, orders, percent):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in DOCS], "doc_id long, text string, weight int, rank int")
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    out = resampling.resample(docs, target, orders=orders, percent=percent)
    found = sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert found == brute(DOCS, TARGET, orders, percent, 20, 2024, 10_000)


def test_drawn_rows_are_the_ranked_ones(spark):
    docs = spark.createDataFrame(
        [(i, t, "a", "b", "c", 0.5) for i, t in DOCS if i != 5],
        "doc_id long, text string, carried string, place string, score string, n_words double",
    )
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    ranked = resampling.resample(docs, target, percent=40).where("rank IS NOT NULL")
    kept = resampling.drawn(docs, target, percent=40)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in ranked.collect())
    assert {(r["carried"], r["place"], r["score"], r["n_words"]) for r in kept.collect()} == {("a", "b", "c", 0.5)}


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS[:25], "doc_id long, text string")
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert resampling.resample(docs.where("false"), target).count() == 0
    assert resampling.drawn(docs.where("false"), target).count() == 0
    ranks = [r["rank"] for r in resampling.resample(docs, target.where("false")).collect()]
    assert sorted(r for r in ranks if r is not None) == [1, 2]
