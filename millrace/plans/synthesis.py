"""Queries that synthesise: scaffolds, augmented records and benchmark items, with parts and suppliers as entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import grading, scaffold, synthesis
from ._base import query, table


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as units: size gives the factor, container and type the dimension."""
    p = table(spark, sf_dir, "part")
    vector = numeric.dimension(F.concat(F.lit("L"), (F.col("p_size") % 4).cast("string"), F.lit("M1T-"), (F.col("p_partkey") % 3).cast("string")))
    kinds = F.when(F.col("p_partkey") % 2 == 0, F.array(F.col("p_brand"))).otherwise(F.array("p_brand", "p_type"))
    return p.select(F.concat(F.lit("unit/"), F.col("p_partkey").cast("string")).alias("uri"), F.col("p_name").alias("label"), F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("symbol"), vector.alias("dimension_vector"), F.struct(F.col("p_size").cast("double").alias("multiplier"), F.lit(0.0).alias("offset")).alias("conversion"), kinds.alias("has_quantity_kinds"))


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("uri"), F.col("p_brand").alias("label")).distinct()


def constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    exact = F.col("s_suppkey") % 3 == 0
    return s.select(F.concat(F.lit("constant/"), F.col("s_suppkey").cast("string")).alias("uri"), F.col("s_name").alias("name"), F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("symbol"), F.when(exact, "exact").otherwise("recommended").alias("category"), F.format_string("%.2f", "s_acctbal").alias("numeric_value"), F.when(~exact, "0.01").alias("standard_uncertainty"), F.lit("m s-1").alias("unit_symbol"))


@query("""SELECT archetype, count(*) AS scaffolds, count(DISTINCT entity) AS entities FROM (
SELECT 'p' || p_partkey AS entity, unnest(list_filter(['direct_identification', 'dimensional_decomposition', CASE WHEN p_size <> 1 THEN 'conversion_scaling' END, 'error_detection', 'semantic_tool_use', 'metrological_uncertainty'], lambda x: x IS NOT NULL)) AS archetype FROM part
UNION ALL SELECT 's' || s_suppkey, unnest(['direct_identification', 'dimensional_decomposition', 'semantic_tool_use', 'metrological_uncertainty']) FROM supplier) GROUP BY archetype""")
def scaffolds_by_archetype(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scaffold.generate(units(spark, sf_dir), kinds(spark, sf_dir), constants(spark, sf_dir))
    return s.groupBy("archetype").agg(F.count(F.lit(1)).alias("scaffolds"), F.count_distinct("entity_uri").alias("entities"))


@query("SELECT c.persona, 'offline' AS source, CAST(4 * (SELECT count(*) FROM supplier) AS BIGINT) AS records FROM (SELECT unnest([" + ", ".join(f"'{p}'" for p in scaffold.PERSONAS) + "]) AS persona) c")
def augmented_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = scaffold.augmented(scaffold.constant_scaffolds(constants(spark, sf_dir)), scaffold.personas(spark))
    return records.groupBy("persona", F.col("llm_generator").alias("source")).agg(F.count(F.lit(1)).alias("records"))


@query()
def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthesis.generate_all(spark, units(spark, sf_dir), constants(spark, sf_dir)).drop("options")


@query()
def gold_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline that answers right, graded and broken down: every choice item passes."""
    items = synthesis.generate_all(spark, units(spark, sf_dir), constants(spark, sf_dir))
    done = grading.graded(grading.gold(items)).select("task", F.col("format").alias("fmt"), "difficulty", "grade.passed")
    return grading.breakdown(done, ["task", "fmt", "difficulty"])
