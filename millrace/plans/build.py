"""The corpus build: entities, scaffolds, records, the gate, pairs, deduplication, split, exports and statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import grading, near_dedup, relational, scaffold
from ..sources import jsonio
from . import reports


@dataclass(frozen=True)
class Settings:
    limit: int | None = None
    category: str | None = None
    augment: bool = True
    near: bool = True
    train: float = 0.85
    val: float = 0.10
    seed: int = 42


@dataclass
class Built:
    records: DataFrame
    pairs: DataFrame
    statistics: dict


def build(units: DataFrame, kinds: DataFrame, constants: DataFrame, personas: DataFrame, out: str | None = None, cache: DataFrame | None = None, settings: Settings = Settings()) -> Built:
    """All stages. Records that fail the gate go to the pairs if they may be repaired; ``out`` gets the exports and a manifest."""
    s = scaffold.generate(units, kinds, constants, settings.limit, settings.category)
    records = scaffold.augmented(s, personas, cache) if settings.augment else scaffold.canonical(s)
    checked = grading.validated(records, "user_query", "ground_truth_answer")
    reports_of = checked.select(F.col("id").alias("record_id"), "passed", "is_dpo_eligible", "rejection_reasons")
    pairs = grading.preference_pairs(records, reports_of)
    good = checked.where("passed").select(*records.columns)
    unique = relational.exact_dedup(good, F.col("user_query"), "id")
    if settings.near:
        unique = near_dedup.greedy(unique, F.col("user_query"), "id")
    none = F.lit(None).cast("string")
    split = relational.hash_split(unique, "id", settings.train, settings.val, settings.seed).withColumn("category", text.category_of(none, F.col("entity_uri")))
    if out:
        spark = units.sparkSession
        split.write.mode("overwrite").parquet(f"{out}/records")
        split = spark.read.parquet(f"{out}/records")
        jsonio.write_jsonl(split.select("id", "archetype", "entity_uri", jsonio.openai(F.struct("user_query", "ground_truth_answer"), "You answer questions about measurement.").alias("messages"), "persona", "split"), f"{out}/openai", ["split"])
        jsonio.write_jsonl(split.select("id", jsonio.sharegpt(F.struct("user_query", "ground_truth_answer"), "You answer questions about measurement.").alias("conversations"), "split"), f"{out}/sharegpt", ["split"])
        jsonio.write_partitions(split, f"{out}/partitions")
        jsonio.write_jsonl(pairs, f"{out}/pairs")
    return Built(split, pairs, reports.statistics(split))
