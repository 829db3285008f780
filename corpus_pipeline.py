"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows of the one before;
``run`` writes every stage as Parquet to the shared folder and reads it again, so a
lost executor costs one stage at most.

Defined cases, for all stages: nulls in any column are kept as they are. Null and empty
texts are not toxic unless the rate of such examples says so, have no near duplicates
and no secrets, count no words in the mix (they are taken once) and pack to the closing
id alone. Repeated rows of a text with words are one group and leave one row; those
without words all stay. A null doc_id is a document without number: it never names a
group unless all its members have none. Texts are worked on whole, whatever their
length. Extra columns go through every stage but the last unchanged, whatever their
names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerbrook.llm import mixing, near_dedup, packing, secrets, toxicity
from ledgerbrook.llm.common import keep, table, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; those without words all stay."""
    return near_dedup.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times."""
    return mixing.resampled(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences that cross no documents."""
    # workers are shared with the stages before: a smaller table of words than the operator's own
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), words=250_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_tokens),
]

#: SQL can express neither the scores nor the mix.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
