"""A corpus from raw documents: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes every stage as Parquet and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from queuelake.llm.frames import table, written
from queuelake.llm.near_dedup import keep_one_row_of_each
from queuelake.llm.packing import pack_documents
from queuelake.llm.quality import keep_good
from queuelake.llm.toxicity import keep_clean


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's thresholds."""
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labels of ``docs``, finds clean."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, of the least doc_id."""
    return keep_one_row_of_each(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: The trained model and the tokens have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
