"""Order MinHash: neighbours, edited texts, likeness, against plain folds."""

import hashlib

from pyspark.sql import functions as F

from ledgerbrook.llm.fingerprints import K, SLOTS, fingerprints, likeness, signature, with_following

SCHEMA = "doc_id long, text string, own string, edited string"
ROWS = [(5, "a b c d e f g h"), (9, "x y z"), (7, ""), (3, None), (1, "one"), (2, "é😀é w w w w w w"), (4, "a b c d e f g h")]


def following(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return [(r, order[(i + 1) % len(order)]) for i, r in enumerate(order)]


def test_edited_texts(spark):
    rows = [*ROWS, (None, "no number"), (2, "é😀é w w w w w w")]
    df = spark.createDataFrame([(d, t, "o", "e") for d, t in rows], SCHEMA)
    out = fingerprints(df).collect()
    want = []
    for (doc, text), (_, other) in following(rows):
        text, other = text or "", other or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out), key=str) == sorted(want, key=str)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[5]["fingerprint"] == by_id[4]["fingerprint"] != by_id[9]["fingerprint"]
    assert by_id[7]["fingerprint"] == by_id[3]["fingerprint"] == "." * 8 * SLOTS
    assert by_id[5]["near_next"] == 1.0 and by_id[9]["near_next"] == 0.0


def test_following_over_many_ranges(spark):
    rows = [(i * 3, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["next_text"] for r in with_following(df, {}, range_bytes=20).collect()}
    assert out == {a[0]: b[1] for a, b in following(rows)}
    one = spark.createDataFrame([(1, "alone")], "doc_id long, text string")
    assert with_following(one, {}).first()["next_text"] == "alone"


def test_order_and_occurrence_count(spark):
    base = " ".join(f"w{i}" for i in range(400))
    moved = " ".join([f"w{i}" for i in range(200, 400)] + [f"w{i}" for i in range(200)])
    edited = " ".join(f"w{i}" if i % 40 else f"n{i}" for i in range(400))
    again = " ".join(["x y"] * 300)
    more = " ".join(["x y"] * 100)
    df = spark.createDataFrame([(base, moved, edited, again, more)], "a string, b string, c string, d string, e string")
    s = {c: signature(F.col(c)) for c in "abcde"}
    near = lambda x, y: likeness(s[x], s[y]).alias(x + y)
    r = df.select(near("a", "a"), near("a", "b"), near("a", "c"), near("d", "e")).first()
    # moved halves share nearly all runs of words, but only half of the pairs keep their order
    assert r["aa"] == 1.0 and 0.2 < r["ab"] < 0.8 and 0.7 < r["ac"] < 1.0
    assert r["de"] < 0.5


def test_signature_by_hand(spark):
    """The same slots from a plain loop over the elements."""
    texts = ["a b c a b c a b", "one", "", " ".join(f"w{i % 37}" for i in range(500))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    hashes = lambda *parts: spark.range(1).select(F.xxhash64(*parts)).first()[0]
    for row in df.select("text", signature(F.col("text")).alias("s")).collect()[:2]:
        words = row["text"].split()
        runs = [words[i : i + K] for i in range(len(words) - K + 1)] if len(words) >= K else [[" ".join(words)]]
        seen, slots = {}, {}
        for at, run in enumerate(runs):
            h = (hashes(*map(F.lit, run)) & (1 << 64) - 1) >> 24
            seen[h] = seen.get(h, -1) + 1
            e = (hashes(F.lit(h).cast("long"), F.lit(seen[h]).cast("int")) & (1 << 64) - 1) >> 24
            slots.setdefault(e >> 40 - 6, []).append((e, at))
        for slot in range(SLOTS):
            own = sorted(slots.get(slot, []))
            # signed order within a slot is unsigned order: its top bits are the same
            chosen = [e for e, _ in sorted(own[:2], key=lambda p: p[1])]
            want = hashes(F.array(*(F.lit(e).cast("long") for e in chosen))) if chosen else None
            if want is not None:
                want = (want + (1 << 31)) % (1 << 32) - (1 << 31)
            assert row["s"][slot] == want


def test_empty_and_long(spark):
    assert fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "word " * 60000), (2, "x" * 200000)], "doc_id long, text string")
    assert fingerprints(df).count() == 2
