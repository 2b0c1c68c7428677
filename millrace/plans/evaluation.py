"""Queries over evaluation results: events as telemetry (event_type as task, user_id as model, value as latency), labels as grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import numeric as N
from ..functions import text as T
from ..operators import grading, ordered, relational
from . import views
from ._base import query, table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.name'), json_extract_string(props, '$.label'), json_extract_string(props, '$.k'), event_type) AS name FROM events WHERE coalesce(CAST(json_extract_string(props, '$.year') AS INT), 2022) = 2022")
def alias_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("props", "name string, label string, k string, year int")
    rows = events(spark, sf_dir).select("event_id", "event_type", p.alias("p")).where(F.coalesce("p.year", F.lit(2022)) == 2022)
    return rows.select("event_id", F.coalesce("p.name", "p.label", "p.k", "event_type").alias("name"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, len(json_keys(props)) AS members FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = A.mapping(F.col("props"))
    return events(spark, sf_dir).select("event_id", F.element_at(m, "k").cast("long").alias("k"), F.size(m).cast("long").alias("members"))


@query("SELECT task, fmt, difficulty, count(*) AS total, count(*) FILTER (passed) AS passed, round(100.0 * count(*) FILTER (passed) / count(*), 2) AS accuracy_pct FROM (SELECT d.lang AS task, CASE WHEN d.n_chars < 1000 THEN 'mcq' ELSE 'free_form' END AS fmt, CASE WHEN l.toxic = 1 THEN 'advanced' ELSE 'basic' END AS difficulty, l.quality = 1 AS passed FROM documents d JOIN labels l USING (doc_id)) GROUP BY GROUPING SETS ((), (task), (fmt), (difficulty))")
def scorecard_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("task"), F.when(F.col("n_chars") < 1000, "mcq").otherwise("free_form").alias("fmt"))
    rows = d.join(table(spark, sf_dir, "labels"), "doc_id").select("task", "fmt", F.when(F.col("toxic") == 1, "advanced").otherwise("basic").alias("difficulty"), (F.col("quality") == 1).alias("passed"))
    return grading.breakdown(rows, ["task", "fmt", "difficulty"])


@query("""WITH e AS (SELECT user_id AS model, value AS v FROM events WHERE value > 0), r AS (SELECT model, v, row_number() OVER (PARTITION BY model ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY model) AS n FROM e)
SELECT model, n, round(avg(v), 3) AS avg_latency, round(quantile_cont(v, 0.5), 3) AS p50, round(max(CASE WHEN i = CASE WHEN n >= 20 THEN CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) ELSE n - 1 END THEN v END), 3) AS p95, round(sum(v), 2) AS duration FROM r GROUP BY model, n""")
def latency_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grading.telemetry(events(spark, sf_dir).select(F.col("user_id").alias("model"), F.col("value").alias("latency")), "model")


LEADERS = """WITH s AS (SELECT user_id AS model, count(*) AS total, count(*) FILTER (value > 20) AS passed, avg(value) AS latency FROM events GROUP BY user_id),
a AS (SELECT model, total, passed, round(100.0 * passed / total, 2) AS accuracy, round(latency, 3) AS latency FROM s)"""


@query(LEADERS + " SELECT *, row_number() OVER (ORDER BY coalesce(accuracy, -1) DESC, coalesce(latency, 9999), model) AS rank FROM a")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grading.ranked(grading.model_stats(events(spark, sf_dir).select(F.col("user_id").alias("model"), (F.col("value") > 20).alias("passed"), F.col("value").alias("latency"))))


@query(LEADERS + " SELECT count(*) AS models, round(avg(accuracy), 2) AS mean_accuracy, max(accuracy) AS best, count(*) FILTER (model % 2 = 0) AS local_models, min(CASE WHEN accuracy = (SELECT max(accuracy) FROM a) THEN model END) AS top_model FROM a")
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = grading.model_stats(events(spark, sf_dir).select(F.col("user_id").alias("model"), (F.col("value") > 20).alias("passed"), F.col("value").alias("latency")))
    return a.agg(F.count(F.lit(1)).alias("models"), F.round(F.avg("accuracy"), 2).alias("mean_accuracy"), F.max("accuracy").alias("best"), F.count_if(F.col("model") % 2 == 0).alias("local_models"), F.max(F.struct("accuracy", -F.col("model"))).alias("top")).select("models", "mean_accuracy", "best", "local_models", (-F.col("top.col2")).alias("top_model"))


@query("""WITH a AS (SELECT user_id AS id, max(value) > 20 AS passed FROM events WHERE event_type = 'click' GROUP BY 1), b AS (SELECT user_id AS id, max(value) > 20 AS passed FROM events WHERE event_type = 'purchase' GROUP BY 1),
q AS (SELECT c_custkey AS id, c_name AS question FROM customer)
SELECT coalesce(a.id, b.id) AS id, a.passed AS pass_a, b.passed AS pass_b, CASE WHEN coalesce(a.passed, false) AND NOT coalesce(b.passed, false) THEN 'a_wins' WHEN coalesce(b.passed, false) AND NOT coalesce(a.passed, false) THEN 'b_wins' WHEN coalesce(a.passed, false) THEN 'both_passed' ELSE 'both_failed' END AS outcome, question
FROM a FULL JOIN b ON a.id = b.id LEFT JOIN q ON q.id = coalesce(a.id, b.id)""")
def arena_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two event types as models, users as questions, with what is known of each question."""
    side = lambda k: events(spark, sf_dir).where(F.col("event_type") == k).groupBy(F.col("user_id").alias("id")).agg((F.max("value") > 20).alias("passed"))
    questions = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("question"))
    return grading.arena(side("click"), side("purchase"), questions)


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE l.quality END AS grade, l.doc_id IS NOT NULL AS regraded FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)")
def regrade_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.lit(True).alias("found"))
    both = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(new, "doc_id", "left")
    return both.select("doc_id", F.when(F.col("found"), F.col("quality")).otherwise(F.col("n_chars")).cast("long").alias("grade"), F.coalesce("found", F.lit(False)).alias("regraded"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "value", "ts")
    return relational.latest(rows, ["user_id", "event_type"], F.struct("ts", "event_id")).select("user_id", "event_type", "event_id", "value")


@query("""WITH e AS (SELECT user_id, event_id, ts, value > 20 AS ok, sum(CASE WHEN value > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
s AS (SELECT user_id, sum(CAST(ok AS INT)) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak, ok FROM e) SELECT user_id, CAST(max(streak) AS BIGINT) AS best_streak, round(100.0 * avg(CAST(ok AS INT)), 2) AS accuracy FROM s GROUP BY user_id""")
def quiz_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordered.best_streaks(events(spark, sf_dir), "user_id", ["ts", "event_id"], F.col("value") > 20)
    return found.select("user_id", "best_streak", F.round(100.0 * F.col("rights") / F.col("answers"), 2).alias("accuracy"))


@query("""WITH s AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS axis, least(greatest(avg(value), 0), 100) AS score FROM events GROUP BY event_type)
SELECT event_type, axis, round(score * cos(axis * (2 * pi() / 5) - pi() / 2), 4) AS x, round(score * sin(axis * (2 * pi() / 5) - pi() / 2), 4) AS y FROM s""")
def radar_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = events(spark, sf_dir).groupBy("event_type").agg(F.avg("value").alias("score"))
    s = s.withColumn("axis", F.row_number().over(Window.orderBy("event_type")).cast("long") - 1)  # one row per event type
    return s.select("event_type", "axis", N.radar_point(F.col("score"), F.col("axis"), 5).alias("p")).select("event_type", "axis", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


@query("""WITH m AS (SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE 'ERROR_CALLING_MODEL: ' END || 'HTTP ' || (400 + user_id) || ' ' || props AS m FROM events)
SELECT event_id, CASE WHEN NOT starts_with(m, 'ERROR_CALLING_MODEL:') THEN NULL WHEN contains(m, '401') THEN 'authentication' WHEN contains(m, '403') THEN 'forbidden' WHEN contains(m, '404') THEN 'not_found' END AS reason FROM m""")
def error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a status by user and the event's properties behind."""
    mark = F.when(F.col("event_type") == "error", "").otherwise("ERROR_CALLING_MODEL: ")
    rows = events(spark, sf_dir).select("event_id", F.concat(mark, F.lit("HTTP "), (F.col("user_id") + 400).cast("string"), F.lit(" "), "props").alias("m"))
    return rows.select("event_id", T.error_class(F.col("m")).alias("reason"))


@query("SELECT page_id, 'cloud' AS exec_type, 'Remote Cloud Endpoint (' || lower(regexp_extract(url, '://([^/?#:]*)', 1)) || ')' AS provider, regexp_replace(url, '[?#].*$', '') AS url, false AS is_local FROM pages")
def endpoint_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' addresses as endpoints."""
    rows = table(spark, sf_dir, "pages").select("page_id", T.endpoint_class(F.col("url"), F.lit("m")).alias("e"))
    return rows.select("page_id", "e.*")


@query("""SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN NULL ELSE substr('ABCD', CAST(length(text) % 4 AS INT) + 1, 1) END AS key, CASE turn % 4 WHEN 1 THEN trim(text, ' 	
') END AS explanation FROM conversations""")
def parse_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts behind a letter in prose, as a JSON member, behind a thought, or as an object without an answer."""
    c = table(spark, sf_dir, "conversations")
    letter = F.substring(F.lit("ABCD"), (F.length("text") % 4 + 1).cast("int"), F.lit(1))
    kind = F.col("turn") % 4
    said = (
        F.when(kind == 0, F.concat(F.lit("The correct answer is **"), letter, F.lit("**. "), "text"))
        .when(kind == 1, F.concat(F.lit("```json\n"), F.to_json(F.struct(F.lower(letter).alias("choice"), F.col("text").alias("rationale"))), F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("<think>Answer: "), "text", F.lit("</think>Answer: ("), letter, F.lit(")")))
        .otherwise(F.to_json(F.struct(F.sha2("text", 256).alias("note"))))
    )
    return c.select("conv_id", "turn", A.mcq(said).alias("a")).select("conv_id", "turn", "a.*")


@query()
def parse_freeform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", A.freeform(F.col("text")).alias("a")).select("conv_id", "turn", "a.*")


@query("""SELECT item_id, item_id % 5 < 2 AS passed, CASE WHEN item_id % 5 < 2 THEN 'passed' WHEN item_id % 5 = 4 THEN 'incorrect' ELSE 'error' END AS eval_status, CASE item_id % 5 WHEN 2 THEN 'provider_error' WHEN 3 THEN 'empty_response' WHEN 4 THEN 'dimensional_mismatch' END AS error_type FROM benchmark""")
def grade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("item_id") % 5, (F.col("item_id") + 1).cast("string")
    said = F.when(k == 0, F.concat(n, F.lit(" N"))).when(k == 1, F.concat(F.lit('{"answer": "'), n, F.lit(' kg m s-2"}'))).when(k == 2, "ERROR_CALLING_MODEL: HTTP 500").when(k == 3, "").otherwise(F.concat(n, F.lit(" J")))
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.concat(n, F.lit(" N")).alias("ground_truth_answer"), said.alias("response"), F.lit("free_form").alias("format"), F.lit(None).cast("string").alias("correct_option_key"))
    return grading.graded(rows).select("item_id", "grade.passed", "grade.eval_status", "grade.error_type")


@query("""WITH a AS (SELECT user_id, event_type, count(*) AS total, count(*) FILTER (value > 20) AS passed FROM events WHERE event_type <> 'click' GROUP BY ALL), m AS (SELECT DISTINCT user_id FROM events), t AS (SELECT DISTINCT event_type FROM events)
SELECT m.user_id AS model, t.event_type AS task, coalesce(total, 0) AS total, coalesce(passed, 0) AS passed, CASE WHEN total IS NULL THEN 0 ELSE round(100.0 * passed / total, 2) END AS accuracy_pct FROM m CROSS JOIN t LEFT JOIN a USING (user_id, event_type)""")
def model_task_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models' scores under a slice, with zeros for tasks without results."""
    e = events(spark, sf_dir).select(F.col("user_id").alias("model"), F.col("event_type").alias("task"), (F.col("value") > 20).alias("passed"))
    tasks = events(spark, sf_dir).select(F.col("event_type").alias("task")).distinct()
    return views.zero_filled(e, tasks, F.col("task") != "click")


@query("SELECT task, records, share, avg_tokens, entities FROM (SELECT lang AS task, count(*) AS records, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS share, round(avg(n_chars), 1) AS avg_tokens, count(DISTINCT source) AS entities FROM documents GROUP BY lang)")
def viewer_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("task"), F.col("source").alias("entity"), F.col("n_chars").alias("tokens"))
    return views.analytics(d, "task")


@query("""WITH s AS (SELECT d.doc_id AS id, d.lang AS task, d.n_chars < 1000 AS short, l.quality AS grade FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT id, task, CASE grade WHEN 1 THEN 'passed' WHEN 0 THEN 'failed' ELSE 'unevaluated' END AS status FROM s WHERE short AND (grade = 0 OR grade IS NULL) AND contains('src', 'src') ORDER BY CASE task WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END, id LIMIT 40""")
def benchmark_browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("n_chars < 1000").select(F.col("doc_id").alias("id"), F.col("lang").alias("task"))
    grades = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("passed"))
    rows = views.browsed(d, grades).where(F.col("status").isin("failed", "unevaluated"))
    return relational.page(rows.select("id", "task", "status"), [views.ordinal(F.col("task"), ["en", "de"]), F.col("id")], 0, 40)
