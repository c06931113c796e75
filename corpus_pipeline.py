"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet and read back as the next stage's ``docs``, so a lost executor costs
one stage at most. All but the last keep the columns of ``documents``.

1. ``quality_rules``: documents that the base rule or the learned list rejects go.
2. ``simhash_dedup``: one document of each near-duplicate component stays.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``pii``: personal data is replaced by ``<kind>``, and ``n_chars`` follows.
5. ``packing``: texts become pieces of packed sequences, with their ids.

Nulls, empty texts, repeated rows and empty tables are treated as each operator
states; an empty table passes through every stage as an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailfeat.llm import decontamination, packing, pii, quality_rules, simhash
from trailfeat.llm.common import table
from trailfeat.llm.queries import tokenizer_path
from trailfeat.session import checkpoint_dir


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, id_bytes=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The stages train models, hash with XXH64 and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
