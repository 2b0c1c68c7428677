"""Queries over the corpus: documents as records (lang as persona, source as archetype), labels as reviews, pages as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import grading, near_dedup, relational, selection
from ..sources import archive, jsonio
from . import views
from ._base import query, table

TOKENS = "CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE greatest(1, CAST(floor(CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) AS DOUBLE) * CAST(1.1 AS DOUBLE)) AS BIGINT)) END"
WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"
KEY = "sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')))"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'fr' AND n_chars >= 500")
def filter_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).where((F.col("lang") == "fr") & (F.col("n_chars") >= 500)).select("doc_id", "lang", "source", "n_chars")


@query("SELECT doc_id, lang, source FROM documents WHERE lang <> 'de' AND (contains(lower(text), 'ther') OR contains(lower(source), 'ther') OR contains(lower(lang), 'ther'))")
def multi_column_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relational.search(docs(spark, sf_dir).where("lang <> 'de'"), "Ther", ["text", "source", "lang"])
    return found.select("doc_id", "lang", "source")


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 50")
def page_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.page(docs(spark, sf_dir).select("doc_id", "source", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 1)


@query("SELECT d.doc_id, l.quality, t.toxic, coalesce(t.toxic, l.quality, -1) AS first_label FROM documents d LEFT JOIN (SELECT doc_id, quality FROM labels WHERE quality = 1) l USING (doc_id) LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE toxic = 1) t USING (doc_id)")
def optional_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    one, two = labels.where("quality = 1").select("doc_id", "quality"), labels.where("toxic = 1").select("doc_id", "toxic")
    out = relational.lookup(relational.lookup(docs(spark, sf_dir).select("doc_id"), one, ["doc_id"]), two, ["doc_id"])
    return out.select("doc_id", "quality", "toxic", F.coalesce("toxic", "quality", F.lit(-1)).alias("first_label"))


@query("SELECT doc_id, (length(text) - length(replace(text, '$', '')) - (length(text) - length(replace(text, '\\$', ''))) // 2) AS dollars, (length(text) - length(replace(text, '$', '')) - (length(text) - length(replace(text, '\\$', ''))) // 2) % 2 = 0 AS passed FROM documents")
def validate_latex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", T.unescaped(F.col("text"), r"\$").cast("long").alias("dollars"), T.well_formed(F.col("text")).alias("passed"))


@query("""SELECT 'dpo_' || d.doc_id AS id, d.source AS archetype, d.lang AS entity_uri, CAST(length(d.text) AS BIGINT) AS chosen_chars, '[Flawed response: quality]' AS rejected, 'quality' AS rejection_reason
FROM documents d JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) WHERE l.quality = 0 AND l.toxic = 0""")
def dpo_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records and labels as reports: of low quality and not toxic may be repaired."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    reports = labels.select(F.col("doc_id").alias("record_id"), (F.col("quality") != 0).alias("passed"), (F.col("toxic") == 0).alias("is_dpo_eligible"), F.array(F.lit("quality")).alias("rejection_reasons"))
    records = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("source").alias("archetype"), F.col("lang").alias("entity_uri"), F.lit("").alias("user_query"), F.col("text").alias("ground_truth_answer"))
    out = grading.preference_pairs(records, reports)
    return out.select(F.col("id"), "archetype", "entity_uri", F.length("chosen").cast("long").alias("chosen_chars"), "rejected", "rejection_reason")


WORD_LIST = "w AS (SELECT DISTINCT regexp_extract(text, '[\\p{L}]+') AS word FROM documents WHERE regexp_matches(text, '[\\p{L}]'))"


def first_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words of documents, each once."""
    return docs(spark, sf_dir).select(F.regexp_extract("text", r"([\p{L}]+)", 1).alias("word")).where("word != ''").distinct()


@query("WITH " + WORD_LIST + " SELECT word FROM w ORDER BY word COLLATE en_us DESC, word LIMIT 50 OFFSET 50")
def collated_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of words, from z to a as browsers compare them."""
    return relational.page(first_words(spark, sf_dir), [relational.collated(F.col("word")).desc(), F.col("word")], 1)


@query("WITH " + WORD_LIST + " SELECT word FROM w WHERE contains(lower(strip_accents(word)), 'ere')")
def accent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words found whatever their case and accents."""
    return relational.search(first_words(spark, sf_dir), "ÉRE", ["word"], "UNICODE_CI_AI")


@query(f"SELECT min(doc_id) AS doc_id, {KEY} AS text_key FROM documents GROUP BY 2")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = relational.exact_dedup(docs(spark, sf_dir).select("doc_id", "text"), F.col("text"), "doc_id")
    return kept.select("doc_id", T.text_key(F.col("text")).alias("text_key"))


@query()
def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = relational.exact_dedup(docs(spark, sf_dir).select("doc_id", "text", "lang"), F.col("text"), "doc_id")
    return near_dedup.greedy(exact, F.col("text"), "doc_id").select("doc_id", "lang")


SPLIT = "WITH r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY sha256('42_' || doc_id), doc_id) - 1 AS i, count(*) OVER () AS n FROM documents), s AS (SELECT doc_id, lang, CASE WHEN i < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'train' WHEN i < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) + CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r) "


@query(SPLIT + "SELECT doc_id, split FROM s")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.hash_split(docs(spark, sf_dir).select("doc_id"), "doc_id")


@query(SPLIT + "SELECT split, lang, count(*) AS records FROM s GROUP BY split, lang")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.hash_split(docs(spark, sf_dir).select("doc_id", "lang"), "doc_id").groupBy("split", "lang").agg(F.count(F.lit(1)).alias("records"))


@query("SELECT lang, source, CASE WHEN grouping(lang) = 0 THEN 'persona' WHEN grouping(source) = 0 THEN 'archetype' ELSE 'total' END AS axis, count(*) AS records FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = docs(spark, sf_dir).groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.grouping("lang").alias("gl"), F.grouping("source").alias("gs"), F.count(F.lit(1)).alias("records"))
    return out.select("lang", "source", F.when(F.col("gl") == 0, "persona").when(F.col("gs") == 0, "archetype").otherwise("total").alias("axis"), "records")


@query("SELECT source || '.jsonl' AS name, count(*) AS record_count, CAST(sum(octet_length(encode(text))) AS BIGINT) AS byte_size, sha256(string_agg(sha256(text), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY source")
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("source", "doc_id", F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("digest"))
    out = rows.groupBy("source").agg(F.count(F.lit(1)).alias("record_count"), F.sum("bytes").alias("byte_size"), F.array_sort(F.collect_list(F.struct("doc_id", "digest"))).alias("all"))
    return out.select(F.concat("source", F.lit(".jsonl")).alias("name"), "record_count", "byte_size", F.sha2(F.array_join("all.digest", ""), 256).alias("sha256"))


@query(f"SELECT doc_id, {TOKENS} AS tokens, CAST(greatest(1, CAST(floor(length(text) / CAST(3.8 AS DOUBLE)) AS BIGINT)) AS BIGINT) AS char_tokens FROM documents")
def approx_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", T.approx_tokens(F.col("text")).alias("tokens"), T.char_tokens(F.col("text")).alias("char_tokens"))


STATS = """
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM t),
s AS (SELECT g, n, min(v) AS min, round_even(avg(v), 1) AS mean, max(CASE WHEN i = least(n - 1, CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT)) THEN v END) AS median,
 max(CASE WHEN i = least(n - 1, CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT)) THEN v END) AS p95, max(CASE WHEN i = least(n - 1, CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT)) THEN v END) AS p99,
 max(v) AS max, round_even(stddev_pop(v), 1) AS std FROM r GROUP BY g, n)
"""


@query(f"WITH t AS (SELECT lang AS g, {TOKENS} AS v FROM documents), {STATS} SELECT g AS lang, n, min, mean, median, p95, p99, max, std FROM s")
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.distribution(docs(spark, sf_dir).select("lang", T.approx_tokens(F.col("text")).alias("tokens")), "tokens", ["lang"])


@query(f"WITH t AS (SELECT lang AS g, {TOKENS} AS v FROM documents), {STATS} SELECT g AS lang, CASE WHEN p99 <= 512 THEN 512 WHEN p99 <= 1024 THEN 1024 ELSE 2048 END AS context, CASE WHEN n < 1000 THEN 'n<1K' WHEN n < 10000 THEN '1K<n<10K' WHEN n < 100000 THEN '10K<n<100K' WHEN n < 1000000 THEN '100K<n<1M' ELSE '1M<n<10M' END AS size_bucket FROM s")
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_stats(spark, sf_dir).select("lang", T.context_length(F.col("p99")).alias("context"), T.size_bucket(F.col("n")).alias("size_bucket"))


MARKS = {"dollar": "$", "percent": "%", "star": "*", "amp": "&", "hash": "#", "backslash": "\\"}


@query("SELECT mark, count(*) AS records FROM (SELECT unnest(list_filter(['$', '%', '*', '&', '#', '\\', '\\text', '\\cdot'], lambda x: contains(text, x))) AS mark FROM documents) GROUP BY mark ORDER BY records DESC, mark LIMIT 10")
def math_macro_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = ["$", "%", "*", "&", "#", "\\", "\\text", "\\cdot"]
    counts = docs(spark, sf_dir).agg(*[F.count_if(F.contains("text", F.lit(m))).alias(str(k)) for k, m in enumerate(marks)])
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(m).alias("mark"), F.col(str(k)).alias("records")) for k, m in enumerate(marks)])).alias("r"))
    return long.select("r.*").where("records > 0").orderBy(F.desc("records"), "mark").limit(10)


@query(f"""WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents), e AS (SELECT unnest(w) AS word FROM t), b AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM t WHERE len(w) > 1)
SELECT (SELECT count(*) FROM e) AS total_words, (SELECT count(DISTINCT word) FROM e) AS vocabulary, (SELECT count(DISTINCT pair) FROM b) AS pairs,
 round((SELECT count(DISTINCT word) FROM e) / CAST((SELECT count(*) FROM e) AS DOUBLE), 3) AS distinct_1, round((SELECT count(DISTINCT pair) FROM b) / CAST((SELECT count(*) FROM e) AS DOUBLE), 3) AS distinct_2""")
def lexical_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = relational.diversity(docs(spark, sf_dir).select(T.words(F.col("text")).alias("w")))
    return out.select("*", F.round(F.col("vocabulary") / F.col("total_words"), 3).alias("distinct_1"), F.round(F.col("pairs") / F.col("total_words"), 3).alias("distinct_2"))


@query("WITH c AS (SELECT lang, source, count(*) AS k FROM documents GROUP BY 1, 2) SELECT lang AS persona, CAST(sum(k) AS BIGINT) AS records, round(100.0 * sum(k) / sum(sum(k)) OVER (), 2) AS share, count(*) AS archetypes, max(k) AS largest, row_number() OVER (ORDER BY sum(k) DESC, lang) AS rank FROM c GROUP BY lang")
def persona_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = docs(spark, sf_dir).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("k"))
    out = c.groupBy(F.col("lang").alias("persona")).agg(F.sum("k").alias("records"), F.count(F.lit(1)).alias("archetypes"), F.max("k").alias("largest"))
    total = F.sum("records").over(Window.partitionBy())  # one row per persona
    return out.select("persona", "records", F.round(100.0 * F.col("records") / total, 2).alias("share"), "archetypes", "largest", F.row_number().over(Window.orderBy(F.desc("records"), "persona")).alias("rank"))


@query(f"""WITH d AS (SELECT source, lang, {TOKENS} AS v, contains(text, '$') AS math FROM documents), t AS (SELECT source AS g, v FROM d), {STATS}
SELECT g AS archetype, n AS records, round(100.0 * n / sum(n) OVER (), 2) AS share, personas, mean, median, p95, max, math_share FROM s JOIN (SELECT source AS g, count(DISTINCT lang) AS personas, round(100.0 * avg(CAST(math AS INT)), 1) AS math_share FROM d GROUP BY source) USING (g)""")
def archetype_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).select("source", "lang", T.approx_tokens(F.col("text")).alias("tokens"), F.contains("text", F.lit("$")).alias("math"))
    shape = relational.distribution(d, "tokens", ["source"])
    more = d.groupBy("source").agg(F.count_distinct("lang").alias("personas"), F.round(100.0 * F.avg(F.col("math").cast("int")), 1).alias("math_share"))
    return shape.join(more, "source").select(F.col("source").alias("archetype"), F.col("n").alias("records"), F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("share"), "personas", "mean", "median", "p95", "max", "math_share")


@query("SELECT source, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr FROM documents GROUP BY source")
def persona_archetype_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1))).fillna(0)


@query("SELECT source, doc_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS preview FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 2")
def group_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = relational.first_n(docs(spark, sf_dir).select("source", "doc_id", T.preview(F.col("text"), 120).alias("preview")), ["source"], ["doc_id"], 2)
    return first.select("source", "doc_id", "preview")


@query("""WITH r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('42_' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang, source) AS n, count(*) OVER () AS total FROM documents)
SELECT doc_id, lang, source FROM r WHERE k <= greatest(1, round_even(n * (100 / CAST(total AS DOUBLE)), 0)) ORDER BY sha256('43_' || doc_id), doc_id LIMIT 100""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.stratified(docs(spark, sf_dir).select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 100)


@query("SELECT d.lang, l.quality, grouping(d.lang) AS all_langs, grouping(l.quality) AS all_labels, count(*) AS records, CAST(sum(d.n_chars) AS BIGINT) AS chars FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY GROUPING SETS ((d.lang), (l.quality), (d.lang, l.quality), ())")
def global_stats_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = docs(spark, sf_dir).select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    sets = [["lang"], ["quality"], ["lang", "quality"], []]
    return both.groupingSets(sets, "lang", "quality").agg(F.grouping("lang").cast("long").alias("all_langs"), F.grouping("quality").cast("long").alias("all_labels"), F.count(F.lit(1)).alias("records"), F.sum("n_chars").alias("chars"))


@query("SELECT text, min(item_id) AS item_id, 'benchmark' AS origin FROM benchmark GROUP BY text UNION ALL SELECT d.text, min(d.doc_id), 'documents' FROM documents d WHERE d.text NOT IN (SELECT text FROM benchmark) GROUP BY d.text")
def distinct_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark").select("text", "item_id", F.lit("benchmark").alias("origin"), F.lit(0).alias("tier"))
    both = bench.unionByName(docs(spark, sf_dir).select("text", F.col("doc_id").alias("item_id"), F.lit("documents").alias("origin"), F.lit(1).alias("tier")))
    return both.groupBy("text").agg(F.min(F.struct("tier", "item_id", "origin")).alias("r")).select("text", "r.item_id", "r.origin")


@query("SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'approved' WHEN 0 THEN 'flagged' END, 'pending') AS review, coalesce(l.toxic, 0) = 1 AS has_notes FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality = 0 OR l.toxic = 1 OR d.source = 'src1'")
def review_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    status = F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "flagged")
    reviews = labels.select(F.col("doc_id").alias("id"), status.alias("status"), F.when(F.col("toxic") == 1, "toxic").otherwise("").alias("notes"))
    d = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "source")
    both = views.browsed(d, reviews=reviews)
    shown = views.triage(both).unionByName(both.where("source = 'src1'").join(views.triage(both).select("id"), "id", "left_anti"))
    return shown.select(F.col("id").alias("doc_id"), "review", (F.coalesce("notes", F.lit("")) != "").alias("has_notes"))


@query("SELECT page_id, reverse(split_part(reverse(url), '/', 1)) AS tail, CASE WHEN contains(url, '/constant/') OR contains(url, 'constants') THEN 'constants' WHEN contains(url, '/quantitykind/') OR contains(url, 'quantity_kind') THEN 'quantity_kinds' ELSE 'units' END AS category FROM pages")
def category_from_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.uri_tail(F.col("url")).alias("tail"), T.category_of(F.lit(None).cast("string"), F.col("url")).alias("category"))


@query("SELECT doc_id, CASE WHEN contains(id, '_en_') OR ends_with(id, '_en') OR starts_with(id, 'en_') THEN 'en' WHEN contains(id, '_fr_') OR ends_with(id, '_fr') OR starts_with(id, 'fr_') THEN 'fr' ELSE 'general_user' END AS persona, coalesce(string_split(id, '_')[3], 'general_user') AS third FROM (SELECT doc_id, source || '_arch1_' || lang || '_' || doc_id AS id FROM documents)")
def persona_from_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = docs(spark, sf_dir).select("doc_id", F.concat("source", F.lit("_arch1_"), "lang", F.lit("_"), F.col("doc_id").cast("string")).alias("id"))
    return rows.select("doc_id", T.persona_of(none, none, F.col("id"), ["en", "fr"]).alias("persona"), T.persona_third(F.col("id")).alias("third"))


@query("SELECT conv_id, to_json(list({role: role, content: text} ORDER BY turn, role, text)) AS messages, count(*) AS turns FROM conversations GROUP BY conv_id")
def chat_openai(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"), F.count(F.lit(1)).alias("turns"))
    return rows.select("conv_id", F.to_json(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))).alias("messages"), "turns")


@query("""SELECT conv_id, to_json(list({"from": CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END, "value": text} ORDER BY turn, role, text)) AS conversations FROM conversations GROUP BY conv_id""")
def chat_sharegpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    return rows.select("conv_id", F.to_json(F.transform("m", lambda x: F.struct(name(x["role"]).alias("from"), x["text"].alias("value")))).alias("conversations"))


@query("""SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS first_user, arg_max(text, turn) FILTER (role = 'user') AS last_user, arg_max(text, turn) FILTER (role = 'assistant') AS answer, arg_max(text, turn) FILTER (role = 'system') AS system_prompt FROM conversations GROUP BY conv_id""")
def normalize_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda role: F.when(F.col("role") == role, F.col("turn"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", of("user")).alias("first_user"), F.max_by("text", of("user")).alias("last_user"), F.max_by("text", of("assistant")).alias("answer"), F.max_by("text", of("system")).alias("system_prompt"))


@query()
def zip_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as members of an archive: true sizes before and after packing."""
    site = table(spark, sf_dir, "pages").select(F.format_string("pages/%d.html", "page_id").alias("relative_path"), F.col("html").cast("binary").alias("content"))
    return archive.totals(archive.placed(site)[1])


@query("SELECT 'pages/' || page_id || '.html' AS relative_path, octet_length(encode(html)) AS byte_size FROM pages")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive as written to the shared folder: its members' sizes."""
    site = table(spark, sf_dir, "pages").select(F.format_string("pages/%d.html", "page_id").alias("relative_path"), F.col("html").cast("binary").alias("content"))
    return archive.package(site, f"{selection.shared_path(spark)}/site.zip").select("relative_path", "byte_size")


@query(SPLIT.rstrip() + """, x AS (SELECT doc_id, s.lang, source, split FROM s JOIN documents USING (doc_id))
SELECT 'by_persona' AS export, lang AS key, count(*) AS records, min(doc_id) AS first_id, CAST(sum(doc_id) AS BIGINT) AS ids FROM x GROUP BY lang UNION ALL SELECT 'by_persona_train', lang, count(*), min(doc_id), CAST(sum(doc_id) AS BIGINT) FROM x WHERE split = 'train' GROUP BY lang
UNION ALL SELECT 'by_archetype', source, count(*), min(doc_id), CAST(sum(doc_id) AS BIGINT) FROM x GROUP BY source UNION ALL SELECT 'by_category', CASE WHEN doc_id % 2 = 0 THEN 'units' ELSE 'constants' END, count(*), min(doc_id), CAST(sum(doc_id) AS BIGINT) FROM x GROUP BY ALL""")
def partitioned_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, written by destination in one pass and counted as read back; the pass's own counters agree."""
    split = relational.hash_split(docs(spark, sf_dir).select("doc_id", "lang", "source"), "doc_id")
    records = split.select(F.col("doc_id").alias("id"), F.col("lang").alias("persona"), F.col("source").alias("archetype"), F.when(F.col("doc_id") % 2 == 0, "units").otherwise("constants").alias("category"), "split")
    path = f"{selection.shared_path(spark)}/exports"
    counters = jsonio.write_partitions(records, path)
    back = jsonio.read_partitions(spark, path, "id long").groupBy("export", "key").agg(F.count(F.lit(1)).alias("records"), F.min("id").alias("first_id"), F.sum("id").alias("ids"))
    wrote = F.create_map(*[F.lit(x) for name, n in counters.items() for x in (name, n)])
    sums = back.withColumn("_all", F.sum("records").over(Window.partitionBy("export")))  # a row per destination
    return sums.where(F.assert_true(F.col("_all") == wrote[F.col("export")], "counters differ from what was written").isNull()).drop("_all")


@query("""SELECT page_id, path, CASE WHEN path = 'index.html' THEN 'Web Portal Landing' WHEN starts_with(path, 'benchmark/') AND ends_with(path, '_scorecard.json') THEN 'Model Evaluation Scorecard' WHEN starts_with(path, 'benchmark/') AND ends_with(path, '.jsonl') THEN 'Benchmark Gold Testbed' WHEN starts_with(path, 'benchmark/') THEN 'Benchmark Report & Metadata' WHEN contains(lower(path), 'report') THEN 'Scientific Report & Card' WHEN ends_with(path, '.jsonl') THEN 'Dataset Split / Samples' WHEN starts_with(path, 'by_persona/') THEN 'Persona Partition' WHEN starts_with(path, 'formats/') THEN 'Export Format Partition' ELSE 'Website Asset' END AS label
FROM (SELECT page_id, ['index.html', 'benchmark/m_scorecard.json', 'benchmark/x.jsonl', 'benchmark/readme.md', 'persona_Report.md', 'train.jsonl', 'by_persona/a.txt', 'formats/b.bin', 'logo.png'][page_id % 9 + 1] AS path FROM pages)""")
def file_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["index.html", "benchmark/m_scorecard.json", "benchmark/x.jsonl", "benchmark/readme.md", "persona_Report.md", "train.jsonl", "by_persona/a.txt", "formats/b.bin", "logo.png"]
    rows = table(spark, sf_dir, "pages").select("page_id", F.get(F.array(*map(F.lit, names)), (F.col("page_id") % 9).cast("int")).alias("path"))
    return rows.select("page_id", "path", T.file_label(F.col("path")).alias("label"))


@query(f"""WITH d AS (SELECT d.doc_id, d.lang, d.text, l.quality, {TOKENS} AS v, (length(text) - length(replace(text, '$', ''))) % 2 = 0 AS ok, {KEY} AS k FROM documents d LEFT JOIN labels l USING (doc_id)),
u AS (SELECT * FROM d WHERE doc_id IN (SELECT min(doc_id) FROM d GROUP BY k)),
p AS (SELECT *, row_number() OVER (ORDER BY sha256('42_' || doc_id), doc_id) - 1 AS i, count(*) OVER () AS n FROM u),
s AS (SELECT *, CASE WHEN i < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'train' WHEN i < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) + CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM p)
SELECT split, lang, count(*) AS records, CAST(sum(v) AS BIGINT) AS tokens, max(v) AS most_tokens, count(*) FILTER (ok) AS well_formed, count(*) FILTER (quality = 1) AS approved FROM s GROUP BY GROUPING SETS ((split, lang), (split), ())""")
def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with labels, tokens and the math gate, without copies, split and reported by split and language.

    Texts are reduced to narrow rows in the scan; the rest of the plan never sees them.
    """
    slim = docs(spark, sf_dir).select("doc_id", "lang", T.approx_tokens(F.col("text")).alias("v"), T.well_formed(F.col("text")).alias("ok"), T.text_key(F.col("text")).alias("key"))
    unique = relational.earliest(slim, ["key"], F.col("doc_id")).drop("key")
    both = unique.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    split = relational.hash_split(both, "doc_id")
    return split.groupingSets([["split", "lang"], ["split"], []], "split", "lang").agg(F.count(F.lit(1)).alias("records"), F.sum("v").alias("tokens"), F.max("v").alias("most_tokens"), F.count_if("ok").alias("well_formed"), F.count_if(F.col("quality") == 1).alias("approved"))
