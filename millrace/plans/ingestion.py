"""Queries over sources: tables written as Turtle and read back, graph patterns, unit texts and expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..functions import units as U
from ..operators import patterns
from ..operators.patterns import Pattern
from ..sources import entities, turtle
from ._base import query, spread, table

PREFIXES = "@prefix r: <http://www.w3.org/2000/01/rdf-schema#> . @prefix v: <http://example.org/v/> . @prefix u: <http://example.org/e/> .\n"


def parts_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as units: a Turtle text per part, with a label in two languages, a multiplier, a dimension and one or two kinds."""
    row = F.format_string(
        PREFIXES + 'u:%d a v:%s ; r:label "%s"@en , "%s"@de ; v:symbol "p%d" ; v:conversionMultiplier %d.5 ; v:hasDimensionVector v:L%dT-2 ; v:hasQuantityKind v:%s%s .',
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, "Unit").otherwise("DerivedUnit"), "p_name", "p_brand", "p_partkey", "p_size", F.col("p_size") % 4, "p_type", F.when(F.col("p_size") > 25, ", v:Large").otherwise(""),
    )
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return turtle.triples_of(parts.select(row.alias("value"), F.concat(F.col("p_brand"), F.lit(".ttl")).alias("src")))


@query("SELECT o_kind, src, CAST(sum(n) AS BIGINT) AS n FROM (SELECT 'iri' AS o_kind, p_brand || '.ttl' AS src, CASE WHEN p_size > 25 THEN 4 ELSE 3 END AS n FROM part UNION ALL SELECT 'literal', p_brand || '.ttl', 4 FROM part) GROUP BY 1, 2")
def turtle_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_graph(spark, sf_dir).groupBy("o_kind", "src").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS unit, p_name AS label, 'p' || p_partkey AS symbol, p_size + CAST(0.5 AS DOUBLE) AS multiplier, CAST(p_size % 4 AS INT) AS length_power, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS kinds FROM part")
def sparql_bgp(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = parts_graph(spark, sf_dir)
    u = entities.units(g.where(F.col("lang").isNull() | (F.col("lang") == "en")))
    return u.select(entities.local(F.col("uri")).alias("unit"), "label", "symbol", F.col("conversion.multiplier").alias("multiplier"), F.col("dimension_vector.L").alias("length_power"), F.size("has_quantity_kinds").alias("kinds"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS constant, s_suppkey % 5 <> 0 AS measured, printf('%.2f', s_acctbal) || CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'e-' || (s_suppkey % 30 + 1) END AS numeric_value,
CASE WHEN s_suppkey % 5 <> 0 THEN '0.' || (s_suppkey % 90 + 10) || 'e-' || (s_suppkey % 30 + 1) END AS standard_uncertainty, CAST(2000 + s_nationkey AS INT) AS defining_year FROM supplier""")
def graph_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as constants: balances as values, four of five in concise notation with an uncertainty."""
    power, u = F.concat(F.lit("e-"), (F.col("s_suppkey") % 30 + 1).cast("string")), (F.col("s_suppkey") % 90 + 10).cast("string")
    exact = F.col("s_suppkey") % 5 == 0
    value = F.concat(F.format_string("%.2f", "s_acctbal"), F.when(exact, "").otherwise(F.concat(F.lit("("), u, F.lit(")"), power)))
    stated = F.when(exact, "(exact)").otherwise(F.concat(F.lit("0."), u, power))
    row = F.format_string(PREFIXES + 'u:%d a v:PhysicalConstant ; r:label "%s" ; v:numericValue "%s" ; v:standardUncertainty "%s" ; v:unitSymbol "m s-1" ; v:evaluationYear %d .', "s_suppkey", "s_name", value, stated, F.col("s_nationkey") + 2000)
    suppliers = spread(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey"))
    c = entities.constants(turtle.triples_of(suppliers.select(row.alias("value"), F.lit("c.ttl").alias("src"))))
    return c.select(entities.local(F.col("uri")).alias("constant"), (F.col("category") == "recommended").alias("measured"), "numeric_value", "standard_uncertainty", "defining_year")


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, suppliers, customers and documents as triples (s, p, o, lang)."""

    def of(what: str, s: Column, /, **properties: Column) -> DataFrame:
        lang = properties.pop("lang", F.lit(None).cast("string"))
        pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), o.cast("string").alias("o")) for p, o in properties.items()])).alias("x")
        return table(spark, sf_dir, what).select(s.alias("s"), pairs, lang.alias("lang")).select("s", "x.p", "x.o", "lang")

    name = lambda kind, key: F.concat(F.lit(kind + "/"), F.col(key).cast("string"))
    out = of("nation", name("nation", "n_nationkey"), type=F.lit("Nation"), name=F.col("n_name"), region=name("region", "n_regionkey"))
    out = out.unionByName(of("region", name("region", "r_regionkey"), type=F.lit("Region"), name=F.col("r_name")))
    out = out.unionByName(of("supplier", name("supplier", "s_suppkey"), type=F.lit("Supplier"), name=F.col("s_name"), nation=name("nation", "s_nationkey"), balance=F.col("s_acctbal")))
    out = out.unionByName(of("customer", name("customer", "c_custkey"), nation=name("nation", "c_nationkey"), segment=F.col("c_mktsegment")))
    return out.unionByName(of("documents", name("source", "source"), title=F.concat(F.lit("d"), F.col("doc_id").cast("string")), lang=F.col("lang")))


@query("""SELECT s_name AS supplier, n_name AS nation, r_name AS region, s_acctbal AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 5000""")
def graph_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of required patterns with a condition on one of them."""
    found = patterns.match(
        triples(spark, sf_dir),
        [Pattern("?s", "type", "Supplier"), Pattern("?s", "name", "?supplier"), Pattern("?s", "balance", "?b", where="cast(b as double) > 5000"), Pattern("?s", "nation", "?n"), Pattern("?n", "name", "?nation"), Pattern("?n", "region", "?r"), Pattern("?r", "type", "Region"), Pattern("?r", "name", "?region")],
        select=["supplier", "nation", "region", "b"],
    )
    return found.select("supplier", "nation", "region", F.col("b").cast("double").alias("balance"))


@query("""WITH s AS (SELECT s_nationkey AS k, s_name FROM supplier WHERE s_acctbal > 9000), c AS (SELECT DISTINCT c_nationkey AS k, c_mktsegment FROM customer)
SELECT n_name AS nation, s_name AS supplier, c_mktsegment AS segment FROM nation LEFT JOIN s ON s.k = n_nationkey LEFT JOIN c ON c.k = n_nationkey""")
def graph_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two OPTIONAL groups that multiply, distinct rows: rich suppliers and customers' segments of each nation."""
    return patterns.match(
        triples(spark, sf_dir),
        [Pattern("?n", "type", "Nation"), Pattern("?n", "name", "?nation")],
        [[Pattern("?s", "nation", "?n"), Pattern("?s", "type", "Supplier"), Pattern("?s", "name", "?supplier"), Pattern("?s", "balance", "?b", where="cast(b as double) > 9000")], [Pattern("?c", "nation", "?n"), Pattern("?c", "segment", "?segment")]],
        ["nation", "supplier", "segment"], distinct=True,
    )


@query("""WITH t AS (SELECT DISTINCT 'source/' || source AS s FROM documents WHERE lang IN ('en', 'de')), a AS (SELECT 'source/' || source AS s, 'd' || doc_id AS title FROM documents WHERE lang = 'fr' AND n_chars > 2000), b AS (SELECT 'source/' || source AS s, 'd' || doc_id AS title FROM documents WHERE lang = 'es'),
x AS (SELECT t.s, a.title FROM t LEFT JOIN a USING (s))
SELECT DISTINCT x.s AS source, coalesce(x.title, b.title) AS title FROM x LEFT JOIN b ON b.s = x.s AND (x.title IS NULL OR x.title = b.title)""")
def graph_one_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two OPTIONAL groups for one variable: sources with their long French titles, or if they have none, with their Spanish ones."""
    long = table(spark, sf_dir, "documents").where("n_chars > 2000").select(F.concat(F.lit("source/"), "source").alias("s"), F.lit("long").alias("p"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("o"), "lang")
    g = triples(spark, sf_dir).unionByName(long)
    return patterns.match(g, [Pattern("?source", "title", "?any", langs=("en", "de", ""))], [[Pattern("?source", "long", "?title", langs=("fr",))], [Pattern("?source", "title", "?title", langs=("es",))]], ["source", "title"], distinct=True)


#: Notations that each part has besides its own, with what they come to.
LATEX = [
    (r"\text{kg}\cdot\text{m}\cdot\text{s}^{-2}", "kg * m * s**-2"), (r"10^{-34}\text{ J}\cdot\text{s}", "10**-34 J * s"), (r"\frac{\text{N}}{\text{m}^2}", r"\frac{N}{m**2}"), ("6.02214076e23 mol-1", "6.02214076e23 mol**-1"),
    ("9.80665 m s-2", "9.80665 m s**-2"), ("$$E$$", "E"), (r"\left(\frac{\frac{a}{b}}{c}\right)", "(((a) / (b)) / (c))"), ("5−3", "5-3"), ("m2", "m2"), ("1e-3 s", "1e-3 s"), ("  ", ""),
]
#: Pairs of quantities that each part has besides its own, and whether they are equal.
UNITS = [("1 N", "1 kg * m / s**2", True), ("1 N", "1 J", False), ("1 mol^-1", "1 mol-1", True), ("100 degC", "373.15 K", True), ("1 km", "1000 m", True), ("1 km", "1001 m", False), ("3.6e6 J", "1 kW * h", True), ("1 eV", "1.602176634e-19 J", True), ("1 foo", "1 m", False), ("(2 m)**2", "4 m**2", True)]


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(r"""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'kg * m**-' || p_size WHEN 1 THEN '10**-' || p_size || ' J * s' ELSE '\frac{N}{m**' || (p_size % 9 + 1) || '}' END AS plain FROM part UNION ALL SELECT p_partkey, plain FROM part, (VALUES """ + ", ".join(f"({quoted(b)})" for _, b in LATEX) + ") v(plain)")
def latex_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' sizes as exponents of units in LaTeX, and the fixed notations for each part."""
    k = F.col("p_partkey") % 3
    source = (
        F.when(k == 0, F.format_string(r"\text{kg}\cdot\text{m}^{-%d}", "p_size"))
        .when(k == 1, F.format_string(r"10^{-%d}\text{ J}\cdot\text{s}", "p_size"))
        .otherwise(F.format_string(r"\frac{\text{N}}{\text{m}^%d}", F.col("p_size") % 9 + 1))
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(source, *[F.lit(a) for a, _ in LATEX])).alias("source"))
    return rows.select("p_partkey", U.plain_units(F.col("source")).alias("plain"))


@query("SELECT p_partkey, p_partkey % 4 < 2 AS same FROM part UNION ALL SELECT p_partkey, same FROM part, (VALUES " + ", ".join(f"({str(c).lower()})" for _, _, c in UNITS) + ") v(same)")
def unit_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' sizes in two units: equal for even quarters, of another magnitude or another dimension for the others; and the fixed pairs for each part."""
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    one = F.format_string("%d %s", size, F.when(k == 1, "kW * h").when(k == 3, "N").otherwise("km"))
    two = F.when(k == 1, F.format_string("%d J", size * 3_600_000)).when(k == 3, F.format_string("%d J", size)).otherwise(F.format_string("%d m", size * F.when(k == 2, 1100).otherwise(1000)))
    pair = lambda a, b: F.struct(a.alias("one"), b.alias("two"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(pair(one, two), *[pair(F.lit(a), F.lit(b)) for a, b, _ in UNITS])).alias("q"))
    return rows.select("p_partkey", U.equivalent(U.plain_units(F.col("q.one")), U.plain_units(F.col("q.two")))["equal"].alias("same"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN printf('%.2f', c_acctbal) || 'e-' || (c_nationkey + 1) WHEN 1 THEN printf('%.2f', c_acctbal) ELSE CAST(c_custkey AS VARCHAR) END AS value,
CASE c_custkey % 3 WHEN 0 THEN '0.' || (c_custkey % 90 + 10) || 'e-' || (c_nationkey + 1) WHEN 2 THEN CAST(c_custkey % 9 + 1 AS VARCHAR) END AS uncertainty FROM customer""")
def uncertainty_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances and keys in concise notation."""
    k = F.col("c_custkey") % 3
    said = (
        F.when(k == 0, F.format_string("%.2f(%d)e-%d", "c_acctbal", F.col("c_custkey") % 90 + 10, F.col("c_nationkey") + 1))
        .when(k == 1, F.format_string("%.2f", "c_acctbal"))
        .otherwise(F.format_string("%d(%d)", "c_custkey", F.col("c_custkey") % 9 + 1))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", N.concise_value(said).alias("v")).select("c_custkey", "v.*")


OUTLINE = r"""WITH p AS (SELECT page_id, url, octet_length(encode(html)) AS n, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS t FROM pages)
SELECT page_id, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f KB', floor(n / CAST(1024 AS DOUBLE) * 10 + 0.5) / 10) ELSE printf('%.1f MB', floor(n / CAST(1048576 AS DOUBLE) * 10 + 0.5) / 10) END AS size,
replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS title, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM p"""


@query(OUTLINE)
def page_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of a site: label, size in words, and escaped title."""
    t = F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", T.human_bytes(F.octet_length("html")).alias("size"), T.escaped_html(t).alias("title"), T.slug(F.col("url")).alias("slug"))
