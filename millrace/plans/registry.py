"""Registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import corpus, entity, evaluation, exchange, ingestion, shapes, synthesis  # noqa: F401  they register their queries
from ._base import ORACLE_SQL, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_report(spark, sf_dir)


__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
