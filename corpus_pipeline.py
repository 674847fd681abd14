"""From raw documents to token ids: quality rules, near-duplicate join, decontamination, personal data, BPE.

All stages but the last return the columns of documents, whatever these are: further columns are carried along, also if they are named like a result.
An empty table goes through every stage. What each stage does with null and empty texts, repeated rows and ties is said at the stage;
texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payloom.llm import bpe, decontamination, jaccard_join, pii, quality_rules
from payloom.llm.common import materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go. Null and empty texts have too few words, so they go; of repeated rows all stay or none."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents stays: sets of five-word shingles, linked from a Jaccard similarity of 0.8 on.

    The one with the smallest doc_id stays, and of several rows with that doc_id the one with the least text. Empty texts are linked with nothing and stay,
    and so do rows without doc_id."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go. Null and empty texts contain none and stay; repeated rows have one fate; null or empty items are in nothing."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text. Null stays null; of overlapping spans the first, then the longest, names the gap."""
    return pii.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text that they decode to, with digests of both. Null and empty texts have no tokens."""
    return bpe.encode_documents(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", personal_data),
    ("bpe", encode),
]

#: SQL can't express the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it. payloom.llm.common.release(spark) deletes what was written once the result is stored."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
