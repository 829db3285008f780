"""The audit against plain sums in whole numbers, trees against their leaves, odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerbrook.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, least=10):
    times, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        times[lang, source].update(words)
        df[lang].update(set(words))
    out = set()
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        own = sorted(s for g, s in groups if g == lang)
        total = Counter()
        for s in own:
            total.update({t: times[lang, s][t] for t in kept})

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(times[lang, s]) for s in own}, shares(total)
        for s in own:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if times[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
                rows = rows if part == "pair" else rows[:10]
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(rows)}
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()}


def corpus(sources=5, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "abcdefgé" for b in "klmnopqr"]
    docs = []
    for i in range(300):
        lang, source = ["en", "de"][i % 7 == 0], f"s{int(rng.integers(sources)) if i % 3 else 0}"
        docs.append((" ".join(rng.choice(words[: 20 + i % 44], int(rng.integers(0, 60)))) + " Once,only'THE the", lang, source))
    return docs + [
        (None, "en", "silent"), ("", None, None), ("word", "xx", "lonely"), ("x y", None, "a"), ("x y", None, None),
        ("THE " * 200_000, "en", "s0"), ("the the", "en", "s0"), ("the the", "en", "s0"),
    ]


@pytest.mark.parametrize("block,stripe", [(4096, 64), (8, 2), (16, 1)])
def test_against_plain_sums(spark, monkeypatch, block, stripe):
    docs = corpus()
    frame = spark.createDataFrame([(*d, 0.5, "x") for d in docs], "text string, lang string, source string, value double, at string")
    if block == 4096:
        assert rows_of(divergence.audit(frame)) == plain(docs)
        return
    # small blocks and stripes: the workers see the module's own numbers, so price the blocks here
    monkeypatch.setattr(divergence, "BLOCK", block)
    rng = np.random.default_rng(1)
    import pyarrow as pa

    n, v = 4, block - 3
    times = rng.integers(0, 3, (n, v))
    table = pa.table(
        {
            "lang": ["l"] * n, "block": [0] * n, "at": list(range(n)), "n": [int(t.sum()) for t in times], "v": [v] * n,
            "width": [v] * n, "ids": [np.flatnonzero(t).tolist() for t in times], "times": [t[t > 0].tolist() for t in times],
            "first": [0] * n, "second": [0] * n,
        }
    )
    found = {(r["a"], r["b"]): r["value"] for r in divergence._prices(table).to_pylist()}
    p = [[1 + 10**9 * (int(c) + 2) // (int(t.sum()) + 2 * v) for c in t] for t in times]
    assert found == {(a, b): sum((x - y) ** 2 // (x + y) for x, y in zip(p[a], p[b], strict=True)) for a in range(n) for b in range(a + 1, n)}


def test_many_sources_meet_across_stripes(spark):
    docs = [(f"common w{i % 9} w{i % 4} w{i % 4}", "en", f"source{i % 150}") for i in range(600)]
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    assert rows_of(divergence.audit(frame)) == plain(docs)


def test_equal_subtrees_are_one_node_and_priced_once():
    leaves = np.zeros((3, 64), np.int64)
    leaves[1, 5] = leaves[2, 5] = leaves[2, 37] = 1
    roots, levels = divergence.consed(leaves)
    assert len(set(roots.tolist())) == 3
    # per level at most: nothing, the one leaf, and at the top what the two halves make of them
    assert [len(a) for a, _ in levels] == [2, 2, 2, 2, 2, 3]
    seen = []

    def price(x, y):
        seen.append(len(x))
        return np.abs(x - y)

    assert divergence.traverse(int(roots[0]), int(roots[2]), levels, price) == 2
    assert seen == [2]


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 2**60
    row = spark.range(1).select(divergence._share(F.lit(big), F.lit(3 * big), F.lit(10**7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 2) // (3 * big + 2 * 10**7)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(none).count() == 0
    rare = spark.createDataFrame([("one", "en", "a"), ("two", "en", "b")], "text string, lang string, source string")
    assert rows_of(divergence.audit(rare)) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
