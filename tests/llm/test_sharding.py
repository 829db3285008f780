"""Hilbert order: the curve itself, the law, runs."""

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerbrook.llm.sharding import hilbert_index, shard

SCHEMA = "doc_id long, text string, lang string, source string, shard string, size int"


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (2, 1), (3, 3)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(dims)))
    names = [F.col(f"c{i}") for i in range(dims)]
    path = [tuple(r[:dims]) for r in df.select(*names, hilbert_index(names, bits).alias("h")).orderBy("h").collect()]
    index = sorted(r[0] for r in df.select(hilbert_index(names, bits)).collect())
    assert index == list(range(len(cells)))
    for a, b in itertools.pairwise(path):
        assert sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1


def check(rows, out):
    n = len(rows)
    assert len(out) == n
    counts = [0] * 24
    slots = {}
    for r in out:
        counts[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want


def test_law(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"t{i} é" * (i % 40), ["en", "de", None][i % 3], f"src{i % 7}", "a", 1) for i in range(500)]
    rows += [(1000, None, None, None, "a", 1), (1000, None, None, None, "a", 1), (None, "", "", "", "a", 1)]
    out = shard(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, out)
    # a run of the curve: the order over all shards is that of the index
    order = [r["curve"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_small_and_empty(spark):
    rows = [(i, "x", "en", "s", "a", 1) for i in range(5)]
    check(rows, shard(spark.createDataFrame(rows, SCHEMA)).collect())
    assert shard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_reruns_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    key = lambda out: sorted((r["doc_id"], r["shard"], r["slot"]) for r in out.collect())
    assert key(shard(df)) == key(shard(df.repartition(7)))


def test_files_prune(spark):
    """A shard spans less of each dimension than the table does."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = shard(df).select("doc_id", "shard", "size").join(df.select("doc_id", "lang", "source"), "doc_id")
    langs = out.groupBy("shard").agg(F.countDistinct("lang").alias("n")).agg(F.avg("n")).first()[0]
    assert langs < 3


def test_values_with_a_long_common_prefix_are_told_apart(spark):
    """Each shard holds few of the sources, also where they begin alike."""
    rows = [(i, "same", "en", f"https://www.example.com/source_{i % 24:02d}") for i in range(960)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = shard(df).join(df.select("doc_id", "source"), "doc_id").groupBy("shard").agg({"source": "approx_count_distinct"})
    assert max(r[1] for r in out.collect()) <= 2
    odd = df.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN lang END AS lang", "CAST(NULL AS string) AS source")
    assert shard(odd).count() == 960
