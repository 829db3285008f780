"""Near-duplicate groups against all pairs."""

import random
import re
import time

import pytest

from pyspark.sql import functions as F

from ledgerbrook.llm import common, near_dedup
from ledgerbrook.llm.near_dedup import near_duplicates, representatives

SCHEMA = "doc_id long, text string, cls string, node string"


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(least[r], doc)
    return sorted(
        ((doc, len(s), least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str
    )


def result(spark, rows):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    out = near_duplicates(df).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_random_groups_and_odd_texts(spark):
    rng = random.Random(3)
    rows, doc = [], 0
    for _ in range(30):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([3, 6, 40, 120, 400]))]
        for _ in range(rng.randint(1, 5)):
            rows.append((doc, edited(base, rng, rng.randint(0, max(1, len(base) // 30)))))
            doc += 1
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "a b c d"), (906, "é É"), (907, "É É")]
    rows += [(908, "x " * 30000), (909, "x " * 50), (910, "same words in here once"), (910, "same words in here once")]
    rng.shuffle(rows)
    assert result(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("room", [0, 100])
def test_large_groups_reach_every_depth(spark, monkeypatch, room):
    """Nodes far above the exhaustive size, with strangers at 0.6 among near copies."""
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    monkeypatch.setattr(near_dedup, "PAIRS", 4)
    monkeypatch.setattr(near_dedup, "ROOM", room)
    monkeypatch.setattr(near_dedup, "DEPTH", 3)
    rng = random.Random(8)
    base = [f"v{i}" for i in range(200)]
    rows = [(i, edited(base, rng, rng.choice([0, 1, 2, 8, 9, 10]))) for i in range(60)]
    rows += [(100 + i, " ".join(base[:150] + [f"u{i}_{k}" for k in range(60)])) for i in range(20)]
    assert result(spark, rows) == by_hand(rows)


def test_empty_and_nulls(spark):
    assert result(spark, []) == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, None), (None, "z y x")]
    assert result(spark, rows) == by_hand(rows)


def test_representatives(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "q r s t u"), (2, "q r s t u"), (3, ""), (4, None), (4, None), (None, "n o")]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    out = representatives(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(
        [(1, "a b c d e"), (2, "q r s t u"), (3, ""), (4, None), (4, None), (None, "n o")], key=str
    )


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    import numpy as np

    data = np.frombuffer(("longword " * 50 + "x" * 300).encode(), np.uint8)
    offsets = np.array([0, 100, 100, len(data)])
    whole = near_dedup.word_hashes(data, offsets)
    monkeypatch.setattr(near_dedup, "_CHUNK", 16)
    for a, b in zip(whole, near_dedup.word_hashes(data, offsets), strict=True):
        assert (a == b).all()


def test_steps_leave_no_tables_behind(spark):
    from pathlib import Path

    from ledgerbrook.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.glob("llm-*")}
    df = spark.createDataFrame([(i, f"a b c d e f{i % 2}") for i in range(6)], "doc_id long, text string")
    out = near_duplicates(df)
    left = {p.name for p in folder.glob("llm-*")} - before
    assert len(left) == 1 and next(iter(left)).startswith("llm-groups")
    assert sorted(r["component_id"] for r in out.collect()) == [0, 0, 0, 1, 1, 1]


def test_full_sets_go_before_the_join_ends(spark, monkeypatch):
    made = []
    written = common.run_dir
    monkeypatch.setattr(common, "run_dir", lambda session, label: made.append(written(session, label)) or made[-1])

    def there():
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
        return {re.search(r"llm-([a-z-]+)-", m)[1] for m in made if fs.exists(path(m))}

    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text + " thirteen"), (3, "other words that stand alone here")], "doc_id long, text string")
    with common.scratch(spark):
        join = near_dedup._Join(docs, 5, 75)
        join.crowds()
        a = join.classes.where("doc_id = 1").select(F.col("cls").alias("a"))
        b = join.classes.where("doc_id > 1").select(F.col("cls").alias("b"))
        links = join.confirmed(a.crossJoin(b))
        assert links.count() == 1
        assert common.components(links).count() == 2
        assert there() == {"signatures", "classes", "nodes", "links", "edges"}
        assert sum(f"llm-{n}-" in m for m in made for n in ("candidates", "wanted", "sets")) == 4
    assert there() == set()


def test_tokens_and_texts_go_before_the_sets_are_joined(spark, monkeypatch):
    made = []
    written = common.run_dir
    monkeypatch.setattr(common, "run_dir", lambda session, label: made.append(written(session, label)) or made[-1])

    def there():
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
        return [m for m in made if fs.exists(path(m))]

    docs = spark.createDataFrame([(i, f"one two three four five six number{i % 3}") for i in range(9)], "doc_id long, text string")
    with common.scratch(spark):
        join = near_dedup._Join(docs, 5, 75)
        kept = [spark.read.parquet(m).columns for m in there() if "llm-signatures-" in m]
        assert kept == [["doc_id", "text_key", "n_shingles", "cls"]]
        with common.scratch(spark):
            sets = join.full_sets(join.classes.select("cls"))
            assert not [m for m in there() if "llm-wanted-" in m]
            assert sets.count() == 3


def test_shuffles_of_a_scope_go_when_it_ends(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while files.hasNext():
            found.add(files.next().getName())
        return {f for f in found if f.startswith("shuffle_")}

    before = shuffles()
    with common.scratch(spark):
        common.keep(spark.range(0, 20000, 1, 2).repartition(3, "id"), "rows")
        own = shuffles() - before
        assert own
    deadline = time.time() + 5
    while own & shuffles() and time.time() < deadline:
        time.sleep(0.1)
    assert not own & shuffles()
