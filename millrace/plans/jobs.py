"""Whole jobs: settings of a file, the benchmark on disk, evaluation with resume, regrading, scorecards and what ran them."""

from __future__ import annotations

import hashlib
import json
import os
import platform
from collections.abc import Sequence
from dataclasses import replace

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grading, inference, records, relational, synthesis
from ..sources import fetch
from .build import Settings
from .reports import markdown

AXES = ("task", "format", "difficulty")
#: Where a settings file says what: field, section, key.
KEYS = (("limit", "project", "max_entities_per_archetype"), ("augment", "augmenter", "enabled"), ("train", "exporter", "train_ratio"), ("val", "exporter", "val_ratio"), ("seed", "project", "seed"))


def settings(path: str) -> tuple[Settings, str]:
    """Settings and output folder of a YAML file; what it does not say, or all if there is no file, is the default."""
    if not os.path.exists(path):
        return Settings(), "./dataset"
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("PyYAML is needed to read settings from a file") from e
    with open(path, encoding="utf-8") as f:
        said = yaml.safe_load(f) or {}
    found = {field: said[section][key] for field, section, key in KEYS if (said.get(section) or {}).get(key) is not None}
    return replace(Settings(), **found), (said.get("project") or {}).get("output_dir", "./dataset")


def environment(spark: SparkSession) -> dict:
    """What a run ran on, without names of hosts or users."""
    return {"os": platform.system(), "machine": platform.machine(), "python": platform.python_version(), "spark": pyspark.__version__, "cores": spark.sparkContext.defaultParallelism, "cluster": not spark.sparkContext.master.startswith("local")}


def build_benchmark(spark: SparkSession, units: DataFrame, constants: DataFrame, out: str, count: int = 50, seed: int = 42) -> DataFrame:
    """All tasks as JSON lines, in a folder per track; the items as read back."""
    items = synthesis.generate_all(spark, units, constants, count, seed)
    items.write.mode("overwrite").parquet(f"{out}/items")
    items = spark.read.parquet(f"{out}/items")
    records.write_tracks(items, f"{out}/tracks")
    return items


def fingerprint(items: DataFrame, model: str) -> str:
    """A run's name: of the model, and of the items whatever their order."""
    r = items.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id", "question", "ground_truth_answer")).alias("x"), F.sum(F.pmod(F.xxhash64("id"), F.lit(1_000_003))).alias("s")).first()
    return hashlib.sha256(f"{model}|{r['n']}|{r['x']}|{r['s']}".encode()).hexdigest()[:16]


def evaluate(items: DataFrame, model: str, provider: inference.Provider, out: str, steps: int = 8) -> dict:
    """Asks, grades and writes ``results`` and ``scorecard.json`` under ``out``.

    Items are dealt over ``steps`` by a hash; each step is written whole or not at all, so a run that was stopped goes on with the steps
    that lack. A run of other items or another model starts anew. The steps go when the results are written.
    """
    spark = items.sparkSession
    held = f"{out}/_run={fingerprint(items, model)}"
    paths = [f"{held}/step={k}" for k in range(steps)]
    done = records.present(spark, [f"{p}/_SUCCESS" for p in paths])
    rows = items.withColumns({"model": F.lit(model), "prompt": records.prompt(F.col("question"), F.col("options")), "step": F.pmod(F.xxhash64("id"), F.lit(steps))})
    for k, path in enumerate(paths):
        if not done[f"{path}/_SUCCESS"]:
            grading.graded(inference.ask(rows.where(F.col("step") == k).drop("step"), "prompt", provider)).write.mode("overwrite").parquet(path)
    spark.read.parquet(*paths).withColumn("passed", F.col("grade.passed")).write.mode("overwrite").parquet(f"{out}/results")
    card = finished(spark, out, model)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(held)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return card


def regrade(spark: SparkSession, out: str, to: str) -> dict:
    """Grades the responses of an evaluation again, without asking; the new results and scorecard go to ``to``."""
    old = spark.read.parquet(f"{out}/results")
    grading.graded(old.drop("grade", "passed")).withColumn("passed", F.col("grade.passed")).write.mode("overwrite").parquet(f"{to}/results")
    return finished(spark, to, old.select("model").first()["model"] if old.head(1) else "")


def scorecards(results: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """Per model: total, passed, overall_accuracy_pct, and a map by each axis of value to struct(total, passed, accuracy_pct).

    Counted once by all axes together; what is collected per model is one entry for each value of an axis.
    """
    cells = results.groupBy("model", *axes).agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("p"))
    score = lambda p, n: F.round(100.0 * p / n, 2)
    axis = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a).cast("string"), F.lit("")).alias("value")) for a in axes])).alias("at")
    by = cells.select("model", "n", "p", axis).groupBy("model", "at.axis", "at.value").agg(F.sum("n").alias("total"), F.sum("p").alias("passed"))
    entry = F.struct("value", F.struct("total", "passed", score(F.col("passed"), F.col("total")).alias("accuracy_pct")).alias("score"))
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("axis") == a, entry)))).alias(f"by_{a}") for a in axes]
    first = F.col("axis") == axes[0]
    out = by.groupBy("model").agg(F.sum(F.when(first, F.col("total"))).alias("total"), F.sum(F.when(first, F.col("passed"))).alias("passed"), *maps)
    return out.select(F.col("model").alias("model_name"), "total", "passed", score(F.col("passed"), F.col("total")).alias("overall_accuracy_pct"), *[f"by_{a}" for a in axes])


def finished(spark: SparkSession, out: str, model: str) -> dict:
    """Writes the scorecard of ``out``'s results as one JSON document, with telemetry and environment."""
    results = spark.read.parquet(f"{out}/results")
    row = scorecards(results).first()
    card = row.asDict(recursive=True) if row else {"model_name": model, "total": 0, "passed": 0, "overall_accuracy_pct": 0.0} | {f"by_{a}": {} for a in AXES}
    speed = grading.telemetry(results).drop("model").first()
    tokens = results.agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.round(F.try_divide(F.sum("completion_tokens"), F.sum("latency")), 2).alias("tokens_per_second")).first()
    card |= {"telemetry": (speed.asDict() if speed else {}) | tokens.asDict(), "environment": environment(spark)}
    fetch.put(spark, f"{out}/scorecard.json", json.dumps(card, indent=2).encode())
    return card


def refreshed(cards: DataFrame, path: str) -> DataFrame:
    """Scorecards with those that have since landed in a folder; a model's newer card replaces its older."""
    from ..sources import jsonio

    landed = jsonio.read_scorecards(cards.sparkSession, path, cards.schema).drop("file")
    return relational.upsert(cards, landed, ["model_name"])


def shown(card: dict) -> str:
    """A scorecard as tables for a terminal."""
    head = f"{card['model_name']}: {card['passed']} of {card['total']} ({card['overall_accuracy_pct']} %)"
    tables = [markdown([{a: k, **v} for k, v in card[f"by_{a}"].items()], [a, "total", "passed", "accuracy_pct"]) for a in AXES]
    return "\n\n".join([head, *tables])
