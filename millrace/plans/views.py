"""The queries behind the viewers: zero-filled slices, analytics, browsers and triage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zero_filled(results: DataFrame, tasks: DataFrame, slice_: Column | None = None) -> DataFrame:
    """Per model and task of a slice of results (model, task, passed): totals and accuracy, zero where there are none. ``tasks`` has each task once."""
    models = results.select("model").distinct().crossJoin(tasks.select("task"))
    sums = (results if slice_ is None else results.where(slice_)).groupBy("model", "task").agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"))
    out = models.join(sums, ["model", "task"], "left").fillna(0, ["total", "passed"])
    return out.withColumn("accuracy_pct", F.when(F.col("total") == 0, 0.0).otherwise(F.round(100.0 * F.col("passed") / F.col("total"), 2)))


def analytics(rows: DataFrame, key: str) -> DataFrame:
    """Per value of ``key``: records, share of all, mean tokens, distinct entities."""
    out = rows.groupBy(key).agg(F.count(F.lit(1)).alias("records"), F.round(F.avg("tokens"), 1).alias("avg_tokens"), F.count_distinct("entity").alias("entities"))
    return out.withColumn("share", F.round(100.0 * F.col("records") / F.sum("records").over(Window.partitionBy()), 1))


def browsed(samples: DataFrame, grades: DataFrame | None = None, reviews: DataFrame | None = None) -> DataFrame:
    """Samples with the status of their grade and review; grades of unknown samples give rows of their own."""
    out = samples if grades is None else samples.join(grades.select("id", F.col("passed").alias("_passed")), "id", "full_outer" if "question" in samples.columns else "left")
    passed = F.lit(None).cast("boolean") if grades is None else F.col("_passed")
    out = out.withColumn("status", F.when(passed, "passed").when(~passed, "failed").otherwise("unevaluated")).drop("_passed")
    if reviews is not None:
        out = out.join(reviews.select("id", F.col("status").alias("_review"), "notes"), "id", "left").withColumn("review", F.coalesce("_review", F.lit("pending"))).drop("_review")
    return out


def triage(rows: DataFrame) -> DataFrame:
    """Reviewed rows that are flagged or have notes."""
    return rows.where((F.col("review") == "flagged") | (F.coalesce(F.trim("notes"), F.lit("")) != ""))


def ordinal(column: Column, order: Sequence[str]) -> Column:
    """A sort key: the place in ``order``; other values come last."""
    out = F.lit(len(order))
    for k, v in reversed(list(enumerate(order))):
        out = F.when(column == v, k).otherwise(out)
    return out


def leaderboard_view(cards: DataFrame, target: str = "all", search: str = "") -> DataFrame:
    """Scorecards (model, exec_type, provider, gpu, os) of a class: ``all`` and ``local``, ``cloud`` leave baselines out, ``baseline`` has them alone.

    ``search`` is looked for in the four texts, whatever its case.
    """
    baseline = F.coalesce(F.lower("model").contains("baseline"), F.lit(False)) | F.coalesce(F.col("exec_type") == "baseline", F.lit(False))
    local = F.coalesce(F.col("exec_type") == "local", F.lit(False))
    wanted = {"all": ~baseline, "local": local & ~baseline, "cloud": ~local & ~baseline, "baseline": baseline}[target]
    hit = F.lit(search == "")
    for c in ("model", "provider", "gpu", "os"):
        hit = hit | F.coalesce(F.lower(c).contains(search.lower()), F.lit(False))
    return cards.where(wanted & hit)


#: What a missing figure sorts as.
MISSING = {"speed": 0.0, "latency": 9999.0}


def sorted_leaders(cards: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """By a name or a figure, either way; missing scores as -1, speeds as 0, latencies as 9999; ties by model."""
    key = F.col(column) if column == "model" else F.coalesce(column, F.lit(MISSING.get(column, -1.0)))
    return cards.orderBy(key.desc() if descending else key.asc(), "model")


def drilled(rows: DataFrame, status: str, task: str = "all") -> DataFrame:
    """The items that a model missed ("failed") or passed, of one task or of all."""
    return rows.where((F.col("status") == status) & (F.lit(task == "all") | (F.col("task") == task)))


def difficulty_counts(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Items by difficulty in a fixed order, zero where there are none, with the share of all items in percent."""
    dim = rows.sparkSession.createDataFrame([(k, d) for k, d in enumerate(order)], "place int, difficulty string")
    counts = rows.groupBy("difficulty").agg(F.count(F.lit(1)).alias("items")).join(dim, "difficulty", "full_outer").fillna(0, ["items"])
    out = counts.withColumn("total", F.sum("items").over(Window.partitionBy())).where("place is not null")  # a row per difficulty
    return out.select("place", "difficulty", "items", F.when(F.col("total") > 0, F.floor(100.0 * F.col("items") / F.col("total") + 0.5)).otherwise(0).cast("long").alias("share"))


def leaders_markdown(stats: DataFrame) -> str:
    """The leaderboard as a Markdown table."""
    from .reports import markdown

    return markdown([r.asDict() for r in stats.orderBy("rank").collect()], ["rank", "model", "total", "passed", "accuracy", "latency"])
