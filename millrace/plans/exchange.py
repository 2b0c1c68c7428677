"""Queries over records as they are exchanged and viewed: chat records, prompts, tracks, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..operators import inference, records, relational
from . import jobs, reports, views
from ._base import query, table

SYSTEM = "You answer from the tables."
CARDS = """WITH c AS (SELECT 'model_' || user_id || CASE WHEN min(event_type) = 'error' THEN '_baseline' ELSE '' END AS model, CASE max(event_type) WHEN 'view' THEN 'local' WHEN 'signup' THEN 'baseline' ELSE 'cloud' END AS exec_type, min(event_type) AS provider, max(event_type) AS gpu, 'os' || user_id AS os, round(avg(value), 3) AS latency, round(max(value), 2) AS accuracy FROM events GROUP BY user_id)"""
TURNS = "SELECT conv_id, arg_max(text, turn) FILTER (role = 'user') AS u, arg_max(text, turn) FILTER (role = 'assistant') AS a, arg_max(text, turn) FILTER (role = 'system') AS s FROM conversations GROUP BY conv_id"


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as models, their events as scorecards."""
    low, high = F.min("event_type"), F.max("event_type")
    name = F.concat(F.lit("model_"), F.col("user_id").cast("string"), F.when(low == "error", "_baseline").otherwise(""))
    kind = F.when(high == "view", "local").when(high == "signup", "baseline").otherwise("cloud")
    e = table(spark, sf_dir, "events").groupBy("user_id")
    return e.agg(name.alias("model"), kind.alias("exec_type"), low.alias("provider"), high.alias("gpu"), F.concat(F.lit("os"), F.col("user_id").cast("string")).alias("os"), F.round(F.avg("value"), 3).alias("latency"), F.round(F.max("value"), 2).alias("accuracy")).drop("user_id")


@query(f"""WITH t AS ({TURNS}), r AS (SELECT conv_id AS id, 'train' AS split, coalesce(s, '{SYSTEM}') AS system_prompt, coalesce(u, '') AS user_query, coalesce(a, '') AS ground_truth_answer, '' AS rejected, '' AS rejection_reason, false AS is_dpo FROM t
UNION ALL SELECT -1 - doc_id, 'dpo', '{SYSTEM}', lang, coalesce(text, ''), source, 'source', true FROM documents WHERE coalesce(text, '') <> ''
UNION ALL SELECT 1000000000 + item_id, 'test', '{SYSTEM}', text, 'item', '', '', false FROM benchmark)
SELECT *, greatest(1, CAST(floor((length(system_prompt) + length(user_query) + length(ground_truth_answer) + length(rejected)) / CAST(3.8 AS DOUBLE)) AS BIGINT)) AS approx_tokens FROM r""")
def viewer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in either chat format (even and odd ids), documents as preference pairs and benchmark items as flat records."""
    turn = F.col("conv_id") % 2 == 0
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")))).alias("m"))
    openai = F.when(turn, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    other = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    share = F.when(~turn, F.transform("m", lambda x: F.struct(other(x["role"]).alias("from"), x["content"].alias("value"))))
    chats = c.select(F.col("conv_id").cast("long").alias("id"), openai.alias("messages"), share.alias("conversations"))
    pairs = table(spark, sf_dir, "documents").where("coalesce(text, '') <> ''").select((-1 - F.col("doc_id")).alias("id"), F.col("lang").alias("prompt"), F.col("text").alias("chosen"), F.col("source").alias("rejected"), F.lit("source").alias("rejection_reason"))
    flat = table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1_000_000_000).alias("id"), F.lit("test").alias("split"), F.col("text").alias("canonical_query"), F.lit("item").alias("answer"))
    return records.viewer_rows(chats.unionByName(pairs, True).unionByName(flat, True), SYSTEM)


@query(r"""SELECT p_partkey AS id, sha256('Question: Which brand has ' || trim(p_name) || '?' || chr(10) || chr(10) || 'Options:' || chr(10) || 'A. ' || trim(p_brand) || chr(10) || 'B. ' || trim(p_type) || chr(10) || chr(10)
|| 'Instructions: Analyze the options carefully and select the single correct letter (A, B, C, or D).' || chr(10) || 'Respond in valid JSON format with keys "answer" (the single uppercase letter) and "explanation" (brief justification).' || chr(10) || chr(10) || 'Example response format:' || chr(10) || '```json' || chr(10) || '{' || chr(10) || '  "answer": "A",' || chr(10) || '  "explanation": "Brief explanation of the metrological rationale."' || chr(10) || '}' || chr(10) || '```') AS prompt FROM part
UNION ALL SELECT -1 - item_id, sha256('Question: ' || regexp_replace(text, '^\s+|\s+$', '', 'g') || chr(10) || chr(10) || 'Instructions: Provide the exact numerical value and unit for the answer.' || chr(10) || 'Respond in valid JSON format with keys "answer" (the exact value and unit) and "explanation" (brief justification).' || chr(10) || chr(10) || 'Example response format:' || chr(10) || '```json' || chr(10) || '{' || chr(10) || '  "answer": "1.054571817e-34 J s",' || chr(10) || '  "explanation": "Exact by the 2019 SI definition."' || chr(10) || '}' || chr(10) || '```') FROM benchmark""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prompts by their hash: parts as choices, benchmark items as free forms."""
    option = lambda k, c: F.struct(F.lit(k).alias("key"), F.col(c).alias("text"))
    choices = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"), F.concat(F.lit("Which brand has "), F.trim("p_name"), F.lit("?")).alias("q"), F.array(option("A", "p_brand"), option("B", "p_type")).alias("o"))
    free = table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).cast("long").alias("id"), F.col("text").alias("q"), F.array().cast("array<struct<key:string,text:string>>").alias("o"))
    return choices.union(free).select("id", F.sha2(records.prompt(F.col("q"), F.col("o")), 256).alias("prompt"))


@query("""SELECT track, count(*) AS items, CAST(sum(n_chars) AS BIGINT) AS chars, min(doc_id) AS first FROM (SELECT *, 'all' AS track FROM documents UNION ALL SELECT *, CASE WHEN lang = 'en' THEN 'mcq' ELSE 'open' END FROM documents) GROUP BY track""")
def track_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.when(F.col("lang") == "en", "mcq").otherwise("free_form").alias("format"))
    return records.tracks(items).groupBy("track").agg(F.count(F.lit(1)).alias("items"), F.sum("n_chars").alias("chars"), F.min("doc_id").alias("first"))


@query(CARDS + " SELECT model, exec_type, provider, latency, accuracy FROM c WHERE NOT contains(model, 'baseline') AND exec_type = 'cloud' AND (contains(model, '1') OR contains(provider, '1') OR contains(gpu, '1') OR contains(os, '1'))")
def leaderboard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.leaderboard_view(cards(spark, sf_dir), "cloud", "1").select("model", "exec_type", "provider", "latency", "accuracy")


@query(CARDS + " SELECT exec_type, count(*) AS models, count(*) FILTER (contains(model, 'baseline')) AS named FROM c WHERE contains(model, 'baseline') OR exec_type = 'baseline' GROUP BY exec_type")
def baseline_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.leaderboard_view(cards(spark, sf_dir), "baseline")
    return rows.groupBy("exec_type").agg(F.count(F.lit(1)).alias("models"), F.count_if(F.col("model").contains("baseline")).alias("named"))


@query(CARDS + " SELECT model, CASE WHEN accuracy > 60 THEN accuracy END AS accuracy, latency FROM c ORDER BY coalesce(CASE WHEN accuracy > 60 THEN accuracy END, -1) DESC, model LIMIT 25")
def leaderboard_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards(spark, sf_dir).select("model", F.when(F.col("accuracy") > 60, F.col("accuracy")).alias("accuracy"), "latency")
    return views.sorted_leaders(rows, "accuracy").limit(25)


@query("SELECT d.doc_id AS id, d.lang AS task, 'failed' AS status FROM documents d JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id) WHERE l.quality = 0 AND d.lang = 'en'")
def missed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("task"))
    grades = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") == 1).alias("passed"))
    return views.drilled(views.browsed(d, grades), "failed", "en").select("id", "task", "status")


@query("""WITH d AS (SELECT CASE lang WHEN 'en' THEN 'introductory' WHEN 'de' THEN 'advanced' ELSE 'other' END AS difficulty FROM documents), v(place, difficulty) AS (VALUES (0, 'introductory'), (1, 'intermediate'), (2, 'advanced'))
SELECT place, difficulty, (SELECT count(*) FROM d WHERE d.difficulty = v.difficulty) AS items, CAST(floor(100.0 * (SELECT count(*) FROM d WHERE d.difficulty = v.difficulty) / (SELECT count(*) FROM d) + 0.5) AS BIGINT) AS share FROM v""")
def difficulty_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.when(F.col("lang") == "en", "introductory").when(F.col("lang") == "de", "advanced").otherwise("other").alias("difficulty"))
    return views.difficulty_counts(d, ["introductory", "intermediate", "advanced"])


@query("SELECT lang AS task, avg(CAST(quality AS DOUBLE)) AS acc, avg(CAST(quality AS DOUBLE)) AS acc_norm, count(*) AS items FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def harness_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("task")).join(table(spark, sf_dir, "labels"), "doc_id")
    mean = F.avg(F.col("quality").cast("double"))
    return rows.groupBy("task").agg(mean.alias("acc"), mean.alias("acc_norm"), F.count(F.lit(1)).alias("items"))


@query("SELECT page_id, 'Master Split' AS tab FROM pages UNION ALL SELECT -1 - page_id, 'Benchmark' FROM pages UNION ALL SELECT -1000000001 - page_id, 'Archetype' FROM pages")
def tab_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' addresses as paths, bare and in two folders."""
    p = table(spark, sf_dir, "pages")
    path = F.regexp_replace("url", "^[^:]*://", "")
    rows = p.select("page_id", path.alias("path")).union(p.select(-1 - F.col("page_id"), F.concat(F.lit("benchmark/"), path))).union(p.select(-1000000001 - F.col("page_id"), F.concat(F.lit("by_archetype/"), path)))
    return rows.select("page_id", records.tab_category(F.col("path")).alias("tab"))


@query("""SELECT n_nationkey, CASE WHEN length(trim(n_comment)) >= 10 AND n_nationkey % 3 = 0 THEN n_comment ELSE '[Key ' || n_nationkey || '] ' || n_name END AS question FROM (SELECT n_nationkey, n_name, 'about ' || n_name || ' in ' || r_name AS n_comment FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def persona_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as personas; every third has a question in the mapping, others a short one or none."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    persona = F.concat(F.lit("key_"), F.col("n_nationkey").cast("string"))
    third = F.col("n_nationkey") % 3
    found = F.when(third == 0, F.concat(F.lit("about "), "n_name", F.lit(" in "), "r_name")).when(third == 1, F.lit("short"))
    return n.select("n_nationkey", records.question_for(F.create_map(F.replace(persona, F.lit("_"), F.lit(" ")), found), persona, F.col("n_name")).alias("question"))


@query("""SELECT DISTINCT provider || '/' || model AS asked, CASE provider WHEN 'ollama' THEN 'ollama/' || model WHEN 'vllm' THEN 'openai/' || model ELSE model END AS name, CASE provider WHEN 'ollama' THEN 'http://h' WHEN 'lm_studio' THEN 'http://localhost:1234/v1' END AS base
FROM (SELECT event_type || user_id AS model, unnest(['ollama', 'vllm', 'lm_studio', 'x']) AS provider FROM events)""")
def model_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").select(F.concat("event_type", F.col("user_id").cast("string")).alias("model")).distinct()
    rows = names.withColumn("provider", F.explode(F.array(*map(F.lit, ("ollama", "vllm", "lm_studio", "x")))))
    base = F.when(F.col("provider") == "ollama", "http://h/v1/")
    return rows.select(F.concat_ws("/", "provider", "model").alias("asked"), records.model_name(F.col("provider"), F.col("model")).alias("name"), records.api_base(F.col("provider"), base).alias("base"))


@query("SELECT conv_id, sha256(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text)) AS chat FROM conversations GROUP BY conv_id")
def chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return c.select("conv_id", F.sha2(records.chat_text(F.col("m")), 256).alias("chat"))


@query("SELECT doc_id, lang FROM documents ORDER BY sha256('42_' || doc_id), doc_id LIMIT 1")
def random_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.random_pick(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")


@query("SELECT lang AS persona, source AS generator, count(*) AS records, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY lang), 2) AS share FROM documents GROUP BY lang, source")
def persona_generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a persona's records each generator made."""
    from pyspark.sql import Window

    n = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("persona"), F.col("source").alias("generator")).agg(F.count(F.lit(1)).alias("records"))
    return n.withColumn("share", F.round(100.0 * F.col("records") / F.sum("records").over(Window.partitionBy("persona")), 2))


@query("""SELECT p_partkey AS id, list_contains(['MEDIUM', 'SMALL', 'PROMO'], split_part(p_type, ' ', 1)) AS linked FROM part""")
def kind_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a part's kind is among those that are known."""
    known = F.array(*map(F.lit, ("MEDIUM", "SMALL", "PROMO")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), N.linked(known, F.substring_index("p_type", " ", 1)).alias("linked"))


@query(r"""SELECT doc_id, sha256(replace(replace(replace(replace(replace(replace(regexp_replace(t, '\\text\{([^}]+)\}', '\1', 'g'), '\cdot', '·'), '\Theta', 'Θ'), '\Delta', 'Δ'), '\nu', 'ν'), '\pm', '±'), '\circ', '°')) AS plain
FROM (SELECT doc_id, coalesce(text, '') || '\text{m}\cdot\Delta x \pm 3\circ' AS t FROM documents)""")
def plain_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(T.plain_math(F.concat(F.coalesce("text", F.lit("")), F.lit(r"\text{m}\cdot\Delta x \pm 3\circ"))), 256).alias("plain"))


@query("""WITH r AS (SELECT user_id, event_type, value > 50 AS ok FROM events), m AS (SELECT user_id, count(*) AS total, count(*) FILTER (ok) AS passed FROM r GROUP BY user_id)
SELECT 'model_' || user_id AS model_name, m.total, m.passed, round(100.0 * m.passed / m.total, 2) AS overall_accuracy_pct, event_type AS task, count(*) AS task_total, count(*) FILTER (ok) AS task_passed, round(100.0 * count(*) FILTER (ok) / count(*), 2) AS task_pct
FROM r JOIN m USING (user_id) GROUP BY user_id, m.total, m.passed, event_type""")
def model_scorecards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as models, their events as results; a row for each task of a scorecard."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model"), F.col("event_type").alias("task"), (F.col("value") > 50).alias("passed"))
    cards_ = jobs.scorecards(e.withColumns({"format": F.lit("mcq"), "difficulty": F.lit("advanced")}))
    rows = cards_.select("model_name", "total", "passed", "overall_accuracy_pct", F.explode("by_task").alias("task", "s"))
    return rows.select("model_name", "total", "passed", "overall_accuracy_pct", "task", F.col("s.total").alias("task_total"), F.col("s.passed").alias("task_passed"), F.col("s.accuracy_pct").alias("task_pct"))


@query("""SELECT page_id, provider, CASE WHEN contains(u, 'openrouter') OR provider = 'openrouter' THEN 'OPENROUTER_API_KEY,OPENROUTER_KEY,' WHEN contains(u, 'anthropic') THEN 'ANTHROPIC_API_KEY,' WHEN contains(u, 'groq') THEN 'GROQ_API_KEY,' WHEN contains(u, 'together') THEN 'TOGETHER_API_KEY,' ELSE '' END || 'OPENAI_API_KEY' AS names
FROM (SELECT page_id, provider, lower(coalesce(url, '') || CASE WHEN provider = 'openrouter' THEN '' ELSE '?' || provider END) AS u FROM pages, (SELECT unnest(['openrouter', 'groq', 'together', 'x']) AS provider))""")
def provider_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' addresses as endpoints, each with four providers; one is told by the model's name, the others by the address."""
    p = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("provider", F.explode(F.array(*map(F.lit, ("openrouter", "groq", "together", "x")))))
    named = F.col("provider") == "openrouter"
    endpoint = F.when(named, F.col("url")).otherwise(F.concat(F.coalesce("url", F.lit("")), F.lit("?"), "provider"))
    names = inference.key_names(endpoint, F.when(named, F.concat("provider", F.lit("/some-model"))))
    return p.select("page_id", "provider", F.array_join(names, ",").alias("names"))


def answered(prompts: list[str]) -> list[tuple[str, int, int]]:
    """A provider that rephrases for the students alone."""
    return [('Here: {"student": "Please tell me: ' + p.rsplit("Question: ", 1)[1] + '", "judge": "no"}', 1, 1) for p in prompts]


@query("SELECT s_suppkey AS id, persona, CASE persona WHEN 'student' THEN 'Please tell me: ' || s_name WHEN 'judge' THEN '[Judge] ' || s_name ELSE s_name END AS user_query FROM supplier, (SELECT unnest(['student', 'judge', 'general_user']) AS persona)")
def batched_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("canonical_query"))
    return inference.batched(s, ["student", "judge", "general_user"], answered).select("id", "persona", "user_query")


@query("""WITH d AS (SELECT lang, coalesce(source, '') AS source, length(coalesce(text, '')) > 500 AS live FROM documents), p AS (SELECT lang, count(*) AS records, count(*) FILTER (live) AS live FROM d GROUP BY lang)
SELECT p.lang AS persona, CASE p.lang WHEN 'en' THEN 'English' ELSE upper(p.lang[1]) || p.lang[2:] END AS title, p.records, round(100.0 * p.records / sum(count(*)) OVER (), 2) AS share_pct, p.live, source AS archetype, count(*) AS n
FROM d JOIN p ON d.lang IS NOT DISTINCT FROM p.lang GROUP BY p.lang, p.records, p.live, source""")
def persona_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by persona, a row for each archetype; one persona has a title of its own."""
    generator = F.when(F.length(F.coalesce("text", F.lit(""))) > 500, "live").otherwise("cache")
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("persona"), F.col("source").alias("archetype"), generator.alias("llm_generator"))
    r = reports.group_report(d, "persona", "archetype", spark.createDataFrame([("en", "English")], "persona string, title string"))
    live = F.coalesce(F.try_element_at("generators", F.lit("live")), F.lit(0)).alias("live")
    return r.select("persona", "title", "records", "share_pct", live, F.explode("by_archetype").alias("archetype", "n"))
