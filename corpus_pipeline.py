"""From raw documents to packed training sequences.

Five stages; each takes what its predecessor kept, written as Parquet and read
again. The first four return the columns of documents, the last one row for each
packed piece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.common import staged, table
from marlstone.llm.decontamination import drop_contaminated
from marlstone.llm.jaccard_join import jaccard_dedup
from marlstone.llm.line_dedup import drop_repeated_lines
from marlstone.llm.packing import pack_documents
from marlstone.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger takes for toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of similar lines stays; a document without
    anything left goes."""
    return drop_repeated_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return jaccard_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4,096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The tagger and the similarity stages have no SQL form; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
