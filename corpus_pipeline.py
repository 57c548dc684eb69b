"""The corpus pipeline: each stage takes the documents its predecessor kept.

Toxic documents go, then those of low quality, then all but one of each group of near
duplicates, then copies of benchmark items; what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import decontaminate, near_dups, packing, quality_fm, toxicity
from caseloom.llm.common import matching
from caseloom.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text is not toxic; see ``without_toxic``. Without labels of both kinds all stay or none."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model, 0.3)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text is good; see ``with_quality``. Without labels of both kinds all stay or none."""
    model = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.with_quality(docs, model, 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the least id of each group of near duplicates.

    All rows of an id stay or go together; rows without id, without words or without a partner stay.
    """
    rows = near_dups.near_duplicates(docs, percent=80)
    gone = cut_lineage(rows.filter("NOT kept").select("doc_id"), "duplicates")
    return matching(docs, gone, "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text copies no benchmark item, with id or without; see ``decontaminated``."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences; see ``pack``. Null and empty texts are an end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The classifiers, alignment and tokenizer cannot be stated in SQL; see tests/llm/test_llm_queries.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's result written and read again; an empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
