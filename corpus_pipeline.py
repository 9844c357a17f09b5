"""A corpus from raw documents to packed sequences, stage by stage.

Each stage reads what the one before wrote; all but the last give the columns of
``documents``.  Rejected documents go in the first two stages, secrets are
replaced in the third, the fourth takes documents (or blocks of them) once, more
often or not at all, and the last packs what it took into sequences.

Nulls: a null or empty text fails the quality rules, so no later stage of ``run``
sees one, though each stage takes them; nulls in other columns are carried, and a null
source is a host and a source of its own.  A very long text is measured, compared,
scanned, cut and packed whole.  Of equal or similar documents the smallest doc_id
stays, of rows with the same doc_id the one with the first text, and rows with a null
doc_id all stay.  Repeated rows are one document.  An empty table gives no sequences.
Columns beside those of ``documents`` are carried up to the last stage, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import documents, settle
from millrace.llm.host_rules import kept_documents
from millrace.llm.mixing import mixed_documents
from millrace.llm.packing import pack
from millrace.llm.secret_scan import without_secrets
from millrace.llm.signature_tree import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]

#: Tokens, trees and blocks are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of a data folder's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
