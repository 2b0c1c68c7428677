"""Grading of responses, and the scores, telemetry and comparisons made of the grades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import answers, text, units

ERROR_MARK = "ERROR_CALLING_MODEL:"


def graded(rows: DataFrame) -> DataFrame:
    """Adds ``grade`` to rows with format, correct_option_key, ground_truth_answer and response.

    Order of cases: call error, choice, free form (equal text first, then the same quantity). Unit expressions are
    compared only where nothing cheaper decides.
    """
    response = F.coalesce(F.col("response"), F.lit(""))
    failed = response.startswith(ERROR_MARK)
    choice = (F.col("format") == "mcq") | F.col("correct_option_key").isNotNull()
    rows = rows.withColumn("_mcq", F.when(~failed & choice, answers.mcq(response))).withColumn("_free", F.when(~failed & ~choice, answers.freeform(response)))
    said = F.coalesce(F.nullif("_free.answer", F.lit("")), response)
    want = F.coalesce("ground_truth_answer", F.lit(""))
    rows = rows.withColumn("_want", units.plain_units(want)).withColumn("_said", units.plain_units(said))
    exact = (F.lower("_want") == F.lower("_said")) | (F.lower(text.strip(want)) == F.lower(text.strip(said)))
    rows = rows.withColumn("_exact", F.when(F.col("_free").isNotNull(), exact))
    ask = F.col("_free").isNotNull() & ~F.col("_exact") & (F.col("_said") != "")
    rows = rows.withColumn("_units", units.equivalent(F.when(ask, F.col("_want")), F.when(ask, F.col("_said"))))
    why, equal = F.when(ask, F.col("_units.error")), F.coalesce(ask & F.col("_units.equal"), F.lit(False))
    key_right = F.coalesce(F.col("_mcq.key") == F.col("correct_option_key"), F.lit(False))
    passed = F.when(failed, F.lit(False)).when(choice, key_right).otherwise(F.col("_exact") | equal)
    kind = (
        F.when(failed, "provider_error")
        .when(passed, F.lit(None).cast("string"))
        .when(choice & F.col("_mcq.key").isNull(), "unparseable_response")
        .when(choice, "mcq_choice_mismatch")
        .when(why.startswith("Unit evaluation error"), "processing_error")
        .when(why.startswith("Dimensional incompatibility"), "dimensional_mismatch")
        .when(why.startswith("Magnitude mismatch"), "magnitude_mismatch")
        .when(text.strip(response) == "", "empty_response")
        .otherwise("value_mismatch")
    )
    status = F.when(passed, "passed").when(kind.isin("provider_error", "unparseable_response", "processing_error", "empty_response"), "error").otherwise("incorrect")
    grade = F.struct(
        passed.alias("passed"), status.alias("eval_status"), kind.alias("error_type"), F.col("_mcq.key").alias("predicted_key"), F.when(~choice & ~failed, said).alias("extracted_answer"),
        F.col("_exact").alias("exact_match"), F.when(F.col("_free").isNotNull(), equal).alias("symbolic_match"), F.coalesce(F.when(failed, response), why).alias("error"), F.coalesce("_mcq.explanation", "_free.explanation").alias("predicted_explanation"),
    )
    return rows.withColumn("grade", grade).drop("_mcq", "_free", "_want", "_said", "_exact", "_units")


def gold(rows: DataFrame) -> DataFrame:
    """The baseline that answers right: key or ground truth, with constant metrics (fixed values)."""
    return rows.withColumns({"response": F.coalesce("correct_option_key", "ground_truth_answer"), "latency": F.lit(0.001), "tokens_per_second": F.lit(2000.0)})


def accuracy(passed: Column) -> Column:
    """Aggregate: percent passed, two digits."""
    return F.round(100.0 * F.count_if(passed) / F.count(F.lit(1)), 2)


def breakdown(rows: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Totals over everything and by each axis alone, in one pass."""
    p = F.col("passed")
    return rows.groupingSets([[], *[[a] for a in axes]], *axes).agg(F.count(F.lit(1)).alias("total"), F.count_if(p).alias("passed"), accuracy(p).alias("accuracy_pct"))


def telemetry(rows: DataFrame, model: str = "model") -> DataFrame:
    """Per model, of positive latencies: n, avg, p50 (interpolated), p95 (index floor(0.95 n), the maximum under 20), and their sum."""
    from .selection import at_ranks, written

    rows = written(rows.where(F.col("latency") > 0).select(model, "latency"))
    n = F.col("n")
    middle = (n - 1) * F.lit(0.5)
    p95 = F.when(n >= 20, F.floor(n * F.lit(0.95))).otherwise(n - 1)
    picked = at_ranks(rows, [model], "latency", [("_low", F.floor(middle)), ("_high", F.ceil(middle)), ("_p95", p95)], True)
    sums = rows.groupBy(model).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("latency"), 3).alias("avg_latency"), F.round(F.sum("latency"), 2).alias("duration"))
    both = sums.alias("s").join(picked.alias("p"), F.col(f"s.{model}").eqNullSafe(F.col(f"p.{model}")))
    p50 = F.round(F.col("_low") * F.lit(0.5) + F.col("_high") * F.lit(0.5), 3)
    return both.select(f"s.{model}", "n", "avg_latency", p50.alias("p50"), F.round("_p95", 3).alias("p95"), "duration")


def model_stats(rows: DataFrame) -> DataFrame:
    """Per model: total, passed, accuracy and mean latency."""
    out = rows.groupBy("model").agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.avg("latency").alias("latency"))
    return out.select("model", "total", "passed", F.round(100.0 * F.col("passed") / F.col("total"), 2).alias("accuracy"), F.round("latency", 3).alias("latency"))


def ranked(stats: DataFrame) -> DataFrame:
    """Adds a rank without ties; a missing score sorts as -1 and a missing latency as 9999. One row per model."""
    w = Window.orderBy(F.coalesce("accuracy", F.lit(-1.0)).desc(), F.coalesce("latency", F.lit(9999.0)), "model")
    return stats.withColumn("rank", F.row_number().over(w))


def arena(a: DataFrame, b: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Two models' results (id, passed) side by side; an id that a model lacks counts as failed. ``questions`` (id, question) are looked up."""
    both = a.select("id", F.col("passed").alias("pass_a")).join(b.select("id", F.col("passed").alias("pass_b")), "id", "full_outer")
    x, y = F.coalesce("pass_a", F.lit(False)), F.coalesce("pass_b", F.lit(False))
    both = both.withColumn("outcome", F.when(x & ~y, "a_wins").when(y & ~x, "b_wins").when(x, "both_passed").otherwise("both_failed"))
    return both if questions is None else both.join(questions.select("id", "question"), "id", "left")


def validated(rows: DataFrame, query_col: str, answer_col: str) -> DataFrame:
    """Adds ``passed``, ``is_dpo_eligible`` and ``rejection_reasons`` by the syntax gate: balanced math in query and answer."""
    q, a = text.math_problems(F.col(query_col)), text.math_problems(F.col(answer_col))
    ok = (F.size(q) == 0) & (F.size(a) == 0)
    reason = F.when(ok, F.array().cast("array<string>")).otherwise(F.array(F.lit("Tier 1 LaTeX syntax or delimiter unbalance failure.")))
    return rows.withColumns({"passed": ok, "is_dpo_eligible": ~ok & (F.size(q) == 0), "rejection_reasons": reason, "tier1_errors": F.concat(q, a)})


def preference_pairs(records: DataFrame, reports: DataFrame, order: str | None = None) -> DataFrame:
    """Pairs of a good answer and a flawed one, from records whose latest report failed but may be repaired."""
    from .relational import latest

    last = latest(reports.select("record_id", "passed", "is_dpo_eligible", "rejection_reasons", *([order] if order else [])), ["record_id"], F.col(order) if order else F.lit(0))
    chosen = last.where("not passed and is_dpo_eligible").select(F.col("record_id").alias("id"), F.array_join("rejection_reasons", "; ").alias("reason"))
    out = records.join(chosen, "id")
    return out.select(F.concat(F.lit("dpo_"), "id").alias("id"), "archetype", "entity_uri", F.col("user_query").alias("prompt"), F.col("ground_truth_answer").alias("chosen"), F.concat(F.lit("[Flawed response: "), "reason", F.lit("]")).alias("rejected"), F.col("reason").alias("rejection_reason"))
