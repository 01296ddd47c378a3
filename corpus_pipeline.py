"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. Stages 1 to 4 return the columns of documents without the rows
that they drop; the last returns the pieces of the packed sequences. Null texts count as empty, repeated rows and null ids as the stage's
operator says (`drop_bad`, `drop_copies`, `drop_near_copies`, `drop_contaminated`, `pack_documents`); further columns pass through whatever their
names are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortline.llm.common import staged, table
from cohortline.llm.decontaminate import drop_contaminated
from cohortline.llm.exact_dedup import drop_copies
from cohortline.llm.near_stage import drop_near_copies
from cohortline.llm.packing import pack_documents
from cohortline.llm.quality import drop_bad, train_quality
from cohortline.llm.queries import held_out
from cohortline.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from the labels, held-out rows left out."""
    labels = table(spark, sf_dir, "labels")
    return drop_bad(docs, train_quality(docs, labels.filter(~held_out("doc_id"))))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space aside)."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like an item of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminate), ("packing", pack),
]

#: The classifier and the packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
