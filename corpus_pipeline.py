"""A corpus pipeline: quality rules, near duplicates, secrets, source mix, pieces.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``.
Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.minhash_dedup import drop_near_duplicates
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.piece_sampling import sample_pieces
from tidemark.llm.quality_crf import keep_quality, train_field
from tidemark.llm.secret_scan import redact_secrets
from tidemark.operators.materialize import materialize
from tidemark.session import ship_package
from tidemark.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose lines are mostly boilerplate."""
    ship_package(spark)
    return keep_quality(docs, train_field(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near duplicates (similarity 0.80 or more)."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kind; no document goes."""
    ship_package(spark)
    return redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their target weights."""
    ship_package(spark)
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: doc_id, n_pieces, piece_ids, lossless."""
    ship_package(spark)
    return sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
    ("pieces", pieces),
]

#: no stage but the counts of the second can be expressed in SQL (field, draws, sampling)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
