"""Queries that apply the operators to whole driver tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact_dedup, filter_audit, lm_scoring, minhash, packing, pii, posting_lists, quality_rules, secrets, substring_dedup, transducer, url_filter

HOST_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file on this machine (the same on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.train(docs, table(spark, sf_dir, "labels")))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *[counted(F.col("spans"), k) for k in ("assign", "access", "hex")], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_filter.mine(url_filter.labelled(pages, table(spark, sf_dir, "labels"), HOST_RULES))
    return url_filter.judge(pages, rules, HOST_RULES)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select("doc_id", *[counted(F.col("spans"), k) for k in pii.KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"), keep="max")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_secrets": op2_secrets,
    "op3_minhash": op3_minhash,
    "op4_url_filter": op4_url_filter,
    "op5_personal_data": op5_personal_data,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_posting_lists": op11_posting_lists,
    "op12_filter_audit": op12_filter_audit,
    "op13_divergence": op13_divergence,
}

WORDS_SQL = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_minhash": f"""
        WITH RECURSIVE t AS (SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh FROM t),
        e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM e a JOIN e b USING (x)
              WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
        l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
        g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a),
        m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m USING (doc_id)
    """,
    "op6_substring_dedup": f"""
        WITH t AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
        i AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: sha256(array_to_string(w[i:i + 34], ' ')))) AS h FROM t WHERE len(w) >= 35),
        v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM i),
        gone AS (SELECT DISTINCT doc_id, i + j AS k FROM v, (SELECT unnest(range(35)) AS j) WHERE n > 1),
        e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM t),
        s AS (SELECT e.doc_id, count(*) FILTER (gone.k IS NOT NULL) AS n_removed, string_agg(e.word, ' ' ORDER BY e.k) FILTER (gone.k IS NULL) AS kept FROM e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.k = e.k GROUP BY e.doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN s USING (doc_id)
    """,
    "op7_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM t
    """,
    "op12_filter_audit": f"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
        l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)] AS bad FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
        h AS (SELECT part, bad, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
        d AS (SELECT unnest(range(1, 6)) AS i),
        o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM d a, d b, d c, d, d e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        s AS (SELECT o, i AS step, o[i] AS own, o[1:i - 1] AS before FROM o, d),
        r AS (SELECT part, o, step, own, sum(n) FILTER (NOT bad[own] AND NOT e) AS kept, sum(n) FILTER (bad[own] AND NOT e) AS removed, sum(n) FILTER (bad[own] AND e) AS redundant,
              sum(n) FILTER (bad[own] AND len(list_filter(bad, lambda x: x)) = 1) AS unique_fails, sum(g) FILTER (bad[own] AND NOT e) AS good_lost, sum(x) FILTER (bad[own] AND NOT e) AS toxic_lost
              FROM (SELECT *, len(list_filter(before, lambda i: bad[i])) > 0 AS e FROM h, s) GROUP BY ALL)
        SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley FROM r
    """,
    "op13_divergence": f"""
        WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({LOWER_SQL}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        e AS (SELECT r, lang, source, unnest(terms) AS term FROM t),
        k AS (SELECT lang, term, count(*) AS n FROM e GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN k USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM t),
        s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
        p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 * (coalesce(c.n, 0) + 2) AS BIGINT) // CAST(s.n + 2 * l.v AS BIGINT) AS p, 1 + CAST(1000000000 * (k.n + 2) AS BIGINT) // CAST(l.n + 2 * l.v AS BIGINT) AS q
              FROM s JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
              UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM l)
              UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM f)
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
    """,
}
