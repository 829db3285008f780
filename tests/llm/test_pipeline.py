"""The corpus pipeline: what each stage lets through."""

import corpus_pipeline as pipeline
from ledgerbrook.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        after = {r["doc_id"] for r in docs.collect()}
        assert after and after <= before
        if name == "near_dedup":
            assert docs.count() == len(after) < len(before)
        if name == "secret_scans":
            assert after == before
        before = after
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "secret_scans", "source_mixing", "packing"]


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("offset != 0 OR length > 2048").count() == 0
    assert out.count() == out.select("sequence_id").distinct().count()
