"""Cache, inference and viewer queries."""

from millrace.operators import inference
from millrace.plans import views
from millrace.sources import cache
from pyspark.sql import functions as F


def test_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert cache.read(spark, path).count() == 0
    row = lambda k, v, at: (k, "p", v, "m", at)
    frame = lambda rows: spark.createDataFrame(rows, "cache_key string, prompt string, response string, model string, at string").withColumn("created_at", F.to_timestamp("at"))
    cache.put(frame([row("a", "1", "2026-01-01"), row("b", "2", "2026-01-01")]), path)
    cache.put(frame([row("a", "3", "2026-01-02")]), path)
    assert sorted((r.cache_key, r.response) for r in cache.read(spark, path).collect()) == [("a", "3"), ("b", "2")]
    assert cache.clear(spark, path) and not cache.clear(spark, path)


def test_providers(spark):
    rows = spark.createDataFrame([(i, f"x\nWhat is item {i}?", "student", "Student", f"item {i}?") for i in range(5)], "scaffold_id int, prompt string, persona string, title string, canonical_query string")
    out = inference.paraphrased(rows, inference.echo).orderBy("scaffold_id").collect()
    assert [r.user_query for r in out] == [f"What is item {i}?" for i in range(5)] and {r.llm_generator for r in out} == {"live"}

    def broken(prompts):
        raise RuntimeError("HTTP 401")

    out = inference.paraphrased(rows, broken).collect()
    assert {r.llm_generator for r in out} == {"fallback"} and out[0].user_query.startswith("[Student] item")
    assert inference.run_statistics(inference.paraphrased(rows, inference.echo)).count() == 3


def test_reviews(spark):
    samples = spark.createDataFrame([("1", "q"), ("2", "q")], "id string, question string")
    grades = spark.createDataFrame([("1", True), ("9", False)], "id string, passed boolean")
    reviews = spark.createDataFrame([("1", "flagged", None), ("2", "approved", " see ")], "id string, status string, notes string")
    rows = views.browsed(samples, grades, reviews)
    assert sorted((r.id, r.status, r.review) for r in rows.collect()) == [("1", "passed", "flagged"), ("2", "unevaluated", "approved"), ("9", "failed", "pending")]
    assert {r.id for r in views.triage(rows).collect()} == {"1", "2"}


def test_slices_have_all_tasks(spark, tmp_path):
    """More than 100 event types: none is lost."""
    from millrace.plans.evaluation import model_task_slice

    spark.createDataFrame([(7 * (k % 2), f"t{k:03}", 30.0) for k in range(130)], "user_id int, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    out = model_task_slice(spark, str(tmp_path)).collect()
    assert len(out) == 260 and sum(r.total for r in out) == 130 and {r.total for r in out if r.model == 0 and r.task == "t129"} == {0}


def test_no_persona_or_model_is_cut(spark):
    from millrace.operators import scaffold

    one = spark.createDataFrame([("s", "a", "q?", "g", "u")], "id string, archetype string, canonical_query string, ground_truth_answer string, entity_uri string")
    personas = spark.range(1200).select(F.concat(F.lit("p"), "id").alias("persona"), F.lit("T").alias("title"))
    assert scaffold.augmented(one, personas).select("persona").distinct().count() == 1200
    stats = spark.range(1200).select(F.col("id").alias("rank"), F.concat(F.lit("m"), "id").alias("model"), F.lit(1).alias("total"), F.lit(1).alias("passed"), F.lit(1.0).alias("accuracy"), F.lit(1.0).alias("latency"))
    assert "m1199" in views.leaders_markdown(stats)
