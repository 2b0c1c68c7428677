"""Queries over entities: the star schema as units, quantity kinds and constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..operators import ordered, relational, scaffold
from ._base import query, table


@query("""WITH t AS (SELECT 'e' || c_custkey AS uri, c_name AS name, c_nationkey AS nation, c_acctbal AS value, 0 AS tier FROM customer UNION ALL SELECT 'e' || s_suppkey, s_name, s_nationkey, s_acctbal, 1 FROM supplier),
r AS (SELECT *, row_number() OVER (PARTITION BY uri ORDER BY tier DESC, name DESC) AS k FROM t) SELECT uri, name, nation, value, tier FROM r WHERE k = 1""")
def precedence_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("e"), F.col("c_custkey").cast("string")).alias("uri"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("value"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("e"), F.col("s_suppkey").cast("string")).alias("uri"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("value"))
    return relational.precedence_union([c, s], ["uri"], "name").select("uri", "name", "nation", "value", "tier")


@query("SELECT r_name AS unit, array_to_string(list(n_name ORDER BY n_nationkey) FILTER (n_name <> 'unknown'), ', ') AS kinds, count(n_name) AS many FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def kind_labels_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    out = r.join(n, r.r_regionkey == n.n_regionkey, "left").groupBy(F.col("r_name").alias("unit")).agg(F.array_sort(F.collect_list(F.when(F.col("n_name") != "unknown", F.struct("n_nationkey", "n_name")))).alias("k"), F.count("n_name").alias("many"))
    return out.select("unit", F.array_join("k.n_name", ", ").alias("kinds"), "many")


@query("SELECT r_name AS scaffold, c_mktsegment AS persona, sha256(r_name || '_' || c_mktsegment) AS cache_key FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer)")
def persona_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    personas = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("persona")).distinct()
    return scaffold.with_personas(table(spark, sf_dir, "region").select(F.col("r_name").alias("scaffold")), personas).withColumn("cache_key", T.cache_key(F.col("scaffold"), F.col("persona")))


@query("""WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS k FROM part),
f AS (SELECT * FROM p WHERE k <= 3)
SELECT p_partkey || '_arch' || a AS id, p_type AS category, a AS archetype, CASE a WHEN 1 THEN 'What is ' || p_name || '?' WHEN 2 THEN 'What is the size of ' || p_name || '?' ELSE 'Convert ' || p_size || ' of ' || p_name || ' to SI.' END AS query
FROM f, (VALUES (1), (2), (3)) v(a) WHERE a < 3 OR p_size > 10""")
def scaffold_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three entities of each category are taken before they fan out."""
    p = relational.first_n(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size"), ["p_type"], ["p_partkey"], 3)
    row = lambda a, q, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(a).alias("archetype"), q.alias("query")))
    rows = F.array_compact(F.array(row(1, F.concat(F.lit("What is "), "p_name", F.lit("?"))), row(2, F.concat(F.lit("What is the size of "), "p_name", F.lit("?"))), row(3, F.concat(F.lit("Convert "), F.col("p_size").cast("string"), F.lit(" of "), "p_name", F.lit(" to SI.")), F.col("p_size") > 10)))
    out = p.select("p_partkey", F.col("p_type").alias("category"), F.explode(rows).alias("r"))
    return out.select(F.concat(F.col("p_partkey").cast("string"), F.lit("_arch"), F.col("r.archetype").cast("string")).alias("id"), "category", "r.archetype", "r.query")


@query("SELECT s_suppkey, coalesce(n_name, 'Nation ' || s_nationkey) AS label FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = s_nationkey")
def metadata_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    out = relational.lookup(table(spark, sf_dir, "supplier"), n, F.col("s_nationkey") == F.col("n_nationkey"))
    return out.select("s_suppkey", F.coalesce("n_name", T.title(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")))).alias("label"))


#: Kinds that share dimensions, and the unit that each must not have.
COMPAT_RULES = [("brass", 10, "brass is not sized 10"), ("BRASS", 11, "brass is not sized 11"), ("steel", 10, "steel is not sized 10"), ("standard", 12, "standard is not sized 12")]


@query("""WITH rules(ord, kind, unit, reason) AS (VALUES (0, 'brass', 10, 'brass is not sized 10'), (1, 'BRASS', 11, 'brass is not sized 11'), (2, 'steel', 10, 'steel is not sized 10'), (3, 'standard', 12, 'standard is not sized 12')),
h AS (SELECT p_partkey, min(ord) AS ord FROM part JOIN rules ON p_size = unit AND contains(lower(p_type), lower(kind)) GROUP BY p_partkey)
SELECT p.p_partkey, h.ord IS NULL AS valid, r.reason FROM part p LEFT JOIN h USING (p_partkey) LEFT JOIN rules r USING (ord)""")
def compat_rule_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed rule list becomes one ordered conditional: no nested-loop join."""
    reason = F.lit(None).cast("string")
    for kind, unit, why in reversed(COMPAT_RULES):
        reason = F.when((F.col("p_size") == unit) & F.contains(F.lower("p_type"), F.lit(kind.lower())), why).otherwise(reason)
    return table(spark, sf_dir, "part").select("p_partkey", reason.isNull().alias("valid"), reason.alias("reason"))


@query("SELECT o_orderkey, c_name AS response, c_custkey IS NOT NULL AS hit FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def cache_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    out = relational.lookup(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), cache, F.col("o_custkey") == F.col("c_custkey"))
    return out.select("o_orderkey", F.col("c_name").alias("response"), F.col("c_custkey").isNotNull().alias("hit"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def cache_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    return relational.lookup(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), cache, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)")
def resume_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.remaining(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), done, ["o_orderkey"])


@query("SELECT o_orderkey, o_orderpriority, 'old' AS origin FROM orders WHERE NOT contains(o_orderpriority, 'URGENT') UNION ALL SELECT o_orderkey, 'REPLACED', 'new' FROM orders WHERE contains(o_orderpriority, 'URGENT')")
def replace_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    gone = F.contains("o_orderpriority", F.lit("URGENT"))
    return o.where(~gone).withColumn("origin", F.lit("old")).unionByName(o.where(gone).select("o_orderkey", F.lit("REPLACED").alias("o_orderpriority"), F.lit("new").alias("origin")))


@query("""WITH p AS (SELECT p_brand, p_partkey, p_size, sha256('42_' || p_partkey) AS lot FROM part), l AS (SELECT *, lead(p_partkey) OVER w AS next_key, lead(p_size) OVER w AS next_size FROM p WINDOW w AS (PARTITION BY p_brand ORDER BY lot, p_partkey))
SELECT p_brand, p_partkey, next_key FROM l WHERE next_size <> p_size""")
def adjacent_mismatch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size", relational.lot(F.col("p_partkey")).alias("lot"))
    out = ordered.with_next(rows, ["lot", "p_partkey"], ["p_partkey", "p_size"], ["p_brand"])
    return out.where("next.p_size <> p_size").select("p_brand", "p_partkey", F.col("next.p_partkey").alias("next_key"))


@query("""WITH l AS (SELECT p_partkey, p_size, lead(p_partkey) OVER w AS next_key, lead(p_size) OVER w AS next_size FROM part WINDOW w AS (ORDER BY sha256('42_' || p_partkey), p_partkey))
SELECT p_partkey, next_key FROM l WHERE next_size <> p_size""")
def neighbour_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All neighbours of one order of the whole table."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size", relational.lot(F.col("p_partkey")).alias("lot"))
    return ordered.with_next(rows, ["lot", "p_partkey"], ["p_partkey", "p_size"]).where("next.p_size <> p_size").select("p_partkey", F.col("next.p_partkey").alias("next_key"))


OPTIONS = """WITH c AS (SELECT p_partkey AS id, [p_brand, 'Brand#99', p_type, p_name || ' x'] AS texts FROM part),
o AS (SELECT id, texts[1] AS correct, unnest(texts) AS text FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sha256('42_' || id || '_' || text), text) AS n FROM o)"""


@query(OPTIONS + " SELECT id, string_agg(substr('ABCD', CAST(n AS INT), 1) || '. ' || text, chr(10) ORDER BY n) AS options, max(CASE WHEN text = correct THEN substr('ABCD', CAST(n AS INT), 1) END) AS correct_key FROM k GROUP BY id")
def mcq_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), N.options(F.col("p_brand"), F.array(F.lit("Brand#99"), "p_type", F.concat("p_name", F.lit(" x"))), F.col("p_partkey")).alias("q"))
    return p.select("id", F.array_join(F.transform("q.options", lambda o: F.concat(o["key"], F.lit(". "), o["text"])), "\n").alias("options"), "q.correct_key")


@query(OPTIONS + " SELECT id, 'Which brand is part ' || id || '?' || chr(10) || string_agg(substr('ABCD', CAST(n AS INT), 1) || '. ' || trim(text), chr(10) ORDER BY n) || chr(10) || 'Answer:' AS prompt FROM k GROUP BY id")
def format_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = mcq_options(spark, sf_dir)
    return q.select("id", F.concat(F.lit("Which brand is part "), F.col("id").cast("string"), F.lit("?\n"), "options", F.lit("\nAnswer:")).alias("prompt"))


@query("""WITH v(name, l, m, t) AS (VALUES ('force', 1, 1, -2), ('speed', 1, 0, -1), ('energy', 2, 1, -2), ('one', 0, 0, 0))
SELECT n_nationkey, name, l + 1 AS product_l, m AS product_m, t - 1 AS product_t, l - 1 AS quotient_l, 2 * l AS square_l, 2 * t AS square_t, (l = 0 AND m = 0 AND t = 0) AS dimensionless,
CASE WHEN l = 0 AND m = 0 AND t = 0 THEN '1' ELSE array_to_string(list_filter([CASE WHEN l = 1 THEN '\\text{L}' WHEN l <> 0 THEN '\\text{L}^{' || l || '}' END, CASE WHEN m = 1 THEN '\\text{M}' WHEN m <> 0 THEN '\\text{M}^{' || m || '}' END, CASE WHEN t = 1 THEN '\\text{T}' WHEN t <> 0 THEN '\\text{T}^{' || t || '}' END], lambda x: x IS NOT NULL), ' \\cdot ') END AS latex FROM nation, v""")
def dimension_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(k).alias("name"), N.dimension(F.lit(d)).alias("d")) for k, d in (("force", "L1 M1 T-2"), ("speed", "A0E0L1I0M0H0T-1D0"), ("energy", "L2M1T-2"), ("one", ""))])
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(kinds).alias("k")).select("n_nationkey", "k.name", "k.d")
    speed, d = N.dimension(F.lit("L1T-1")), F.col("d")
    p, q, s = N.times(d, speed), N.over(d, speed), N.to_power(d, 2)
    return rows.select("n_nationkey", "name", p["L"].alias("product_l"), p["M"].alias("product_m"), p["T"].alias("product_t"), q["L"].alias("quotient_l"), s["L"].alias("square_l"), s["T"].alias("square_t"), N.is_dimensionless(d).alias("dimensionless"), N.dimension_latex(d).alias("latex"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)) + CAST(255.3722 AS DOUBLE), 6) AS kelvin, round(l_quantity * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)), 6) AS interval_kelvin, printf('%.2f', l_quantity) AS label FROM lineitem")
def affine_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, m, b = F.col("l_quantity"), F.lit(5.0) / F.lit(9.0), F.lit(255.3722)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(N.converted(q, m, b), 6).alias("kelvin"), F.round(N.converted(q, m, b, True), 6).alias("interval_kelvin"), F.format_string("%.2f", q).alias("label"))


@query("SELECT l_orderkey, l_linenumber, round(sqrt(l_discount * l_discount + l_tax * l_tax), 6) AS u, round(2 * sqrt(l_discount * l_discount + l_tax * l_tax), 6) AS expanded, round(sqrt(power(2 * l_discount, 2) + power(l_tax, 2)), 6) AS relative, round(l_discount / sqrt(CAST(3 AS DOUBLE)), 6) AS rectangular, round(l_tax / sqrt(CAST(6 AS DOUBLE)), 6) AS triangular FROM lineitem")
def gum_quadrature(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("l_discount"), F.col("l_tax")
    u = N.quadrature(a, b)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(u, 6).alias("u"), F.round(N.expanded(u), 6).alias("expanded"), F.round(N.relative_quadrature((a, 2), (b, 1)), 6).alias("relative"), F.round(N.rectangular(a), 6).alias("rectangular"), F.round(N.triangular(b), 6).alias("triangular"))


@query("SELECT l_suppkey, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity) / sqrt(count(*)), 6) AS u FROM lineitem GROUP BY l_suppkey")
def type_a_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.round(N.type_a(F.col("l_quantity")), 6).alias("u"))


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) = CAST(printf('%.3f', o_totalprice) AS DECIMAL(18, 3)) AS same, CAST(o_totalprice AS DECIMAL(18, 2)) = CAST(printf('%.1f', o_totalprice) AS DECIMAL(18, 1)) AS rounded_same FROM orders")
def exact_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lambda f: F.format_string(f, "o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.same_decimal(s("%.2f"), F.concat(s("%.3f"), F.lit("e0"))).alias("same"), N.same_decimal(s("%.2f"), s("%.1f")).alias("rounded_same"))
