"""A corpus pipeline: five stages over ``documents``, each working on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, packing, quality_rules, secrets
from millrace.llm._common import stash
from millrace.llm.queries import table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base checks or the learned rules reject go."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, rules)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z and a-z alike), the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 on five-word shingles, the smallest doc_id stays."""
    from millrace.llm import minhash

    return minhash.drop_near(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; no document goes."""
    return secrets.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("secret scan", clean), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table between two stages is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
