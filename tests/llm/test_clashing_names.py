"""Stages of the pipeline on tables whose extra columns are named like the helpers inside."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerbrook.llm import mixing, near_dedup, resampling, secrets, toxicity

SOURCES = Path(near_dedup.__file__).parent
#: Every name in quotes in the modules of the stages and their helpers is a possible clash.
NAMES = sorted(
    {
        name
        for module in ("common", "near_dedup", "secrets", "mixing", "toxicity")
        for name in re.findall(r"[\"'](_?[a-z][a-z0-9_]*)[\"']", (SOURCES / f"{module}.py").read_text())
    }
    - {"doc_id", "text", "source", "lang", "n_chars"}
)


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["a b c d e f g", "a b c d e f g", "password = hunter2hunter2 x", "you total idiot scum", None, "", "one more plain text"]
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({name: F.concat(F.lit(f"{name}="), F.col("doc_id").cast("string")) for name in NAMES})


@pytest.mark.parametrize("stage", ["near_dedup", "secrets", "mixing", "toxicity", "resampling"])
def test_extra_columns_go_through_unchanged(spark, docs, stage):
    labels = spark.createDataFrame([(i, int(i == 3)) for i in range(7)], "doc_id long, toxic int")
    target = spark.createDataFrame([("plain text",)], "text string")
    out = {
        "near_dedup": lambda: near_dedup.representatives(docs),
        "secrets": lambda: secrets.redact(docs),
        "mixing": lambda: mixing.resampled(docs),
        "toxicity": lambda: toxicity.accepted(docs, labels),
        "resampling": lambda: resampling.drawn(docs, target, percent=100, least=1),
    }[stage]()
    assert out.columns == docs.columns and len(NAMES) > 100
    rows = out.collect()
    assert rows
    for r in rows:
        assert [r[name] for name in NAMES] == [f"{name}={r['doc_id']}" for name in NAMES]
