"""Question-answer scaffolds from entities, and their spread over personas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric, text
from .relational import first_n

#: The six archetypes in order.
ARCHETYPES = ("direct_identification", "dimensional_decomposition", "conversion_scaling", "error_detection", "semantic_tool_use", "metrological_uncertainty")
#: The personas, in the order in which ids are searched for them.
PERSONAS = (
    "general_user", "physics_student", "firmware_iot_engineer", "data_scientist_analyst", "iso_compliance_auditor", "academic_metrologist", "nist_metrologist", "nrc_metrologist", "isc_science_policy",
    "iupap_physicist", "iupac_chemist", "iau_astronomer", "iucr_crystallographer", "imu_mathematician", "ursi_radio_scientist", "iutam_mechanics_engineer", "aerospace_propulsion_engineer", "particle_physicist",
    "iugg_geodesist_geophysicist", "igu_geographer", "isprs_photogrammetrist", "isde_digital_earth", "iuss_soil_scientist", "energy_environmental_scientist",
    "iubs_biologist", "iuis_immunologist", "iuphar_pharmacologist", "iups_physiologist", "iutox_toxicologist", "iuns_nutritionist", "iufost_food_scientist", "iomp_medical_physicist", "ifmbe_biomedical_engineer",
    "iupsys_psychologist", "isa_sociologist", "iussp_demographer", "wau_anthropologist", "four_s_science_studies", "iuhpst_historian_philosopher",
)


def _row(archetype: int, query: Column, answer: Column, difficulty: str, when: Column | None = None) -> Column:
    out = F.struct(F.lit(archetype).alias("n"), F.lit(ARCHETYPES[archetype - 1]).alias("archetype"), query.alias("canonical_query"), answer.alias("ground_truth_answer"), F.lit(difficulty).alias("difficulty"))
    return out if when is None else F.when(when, out)


def _fan_out(df: DataFrame, key: Column, rows: list[Column]) -> DataFrame:
    """One row per scaffold; its id is the entity's display key with the archetype's number."""
    out = df.select("uri", key.alias("_key"), F.explode(F.array_compact(F.array(*rows))).alias("r"))
    return out.select(F.concat(F.regexp_replace("_key", r"\s+", "-"), F.lit("_arch"), F.col("r.n").cast("string")).alias("id"), "r.archetype", F.col("uri").alias("entity_uri"), "r.canonical_query", "r.ground_truth_answer", "r.difficulty")


def unit_scaffolds(units: DataFrame, kinds: DataFrame) -> DataFrame:
    """Up to six rows per unit; conversion only if it has a factor other than one or an offset."""
    pairs = units.select("uri", F.posexplode("has_quantity_kinds").alias("pos", "kind"))
    names = pairs.join(kinds.select(F.col("uri").alias("kind"), F.col("label").alias("kind_label")), "kind").where(F.lower("kind_label") != "unknown")
    names = names.groupBy("uri").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "kind_label"))), lambda x: x["kind_label"]), ", ").alias("kinds"))
    u = units.join(names, "uri", "left").withColumn("kinds", F.coalesce("kinds", F.lit("a general quantity")))
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) and not p.startswith("@") else F.col(p[1:]) if isinstance(p, str) else p for p in parts])
    base, dims = numeric.si_latex(F.col("dimension_vector")), numeric.dimension_latex(F.col("dimension_vector"))
    factor, zero = F.col("conversion.multiplier"), F.col("conversion.offset")
    rows = [
        _row(1, c("Which quantity is measured in the unit ", "@label", " (", "@symbol", ")?"), c("The unit ", "@label", " (", "@symbol", ") measures ", "@kinds", "."), "introductory"),
        _row(2, c("Give the dimension of the unit ", "@label", " in base quantities and in SI base units."), c("Its dimension is $", dims, "$; in SI base units it is $", base, "$."), "intermediate"),
        _row(3, c("How is a value in ", "@label", " converted to the coherent SI unit?"), c("Multiply the value by ", factor.cast("string"), " and add ", zero.cast("string"), "; the result is in $", base, "$."), "intermediate", (factor != 1) | (zero != 0)),
        _row(4, c("Does the unit ", "@symbol", " alone tell which quantity is meant?"), c("No. Units with the dimension $", dims, "$ can belong to several kinds of quantity; ", "@symbol", " is used for ", "@kinds", "."), "advanced"),
        _row(5, c("How is the symbol of the unit ", "@label", " typeset?"), c("It is printed upright, with a space before it: $1\\,\\text{", "@symbol", "}$."), "introductory"),
        _row(6, c("A reading in ", "@label", " has a relative standard uncertainty of 1 %. What is it in SI base units?"), c("A relative uncertainty does not depend on the unit: it stays 1 % in $", base, "$."), "advanced"),
    ]
    return _fan_out(u, F.col("symbol"), rows)


def constant_scaffolds(constants: DataFrame) -> DataFrame:
    """Four rows per constant; an exact one has no uncertainty."""
    exact = F.col("category") == "exact"
    value = F.concat(F.col("numeric_value"), F.lit(" "), F.col("unit_symbol"))
    u = F.coalesce("standard_uncertainty", F.lit("0"))
    rows = [
        _row(1, F.concat(F.lit("What is the value of the "), "name", F.lit("?")), F.concat(F.lit("The "), "name", F.lit(" is "), value, F.when(exact, ", exactly.").otherwise(F.concat(F.lit(", with standard uncertainty "), u, F.lit(".")))), "introductory"),
        _row(2, F.concat(F.lit("In which unit is the "), "name", F.lit(" expressed?")), F.concat(F.lit("It is expressed in "), "unit_symbol", F.lit(".")), "intermediate"),
        _row(5, F.concat(F.lit("How is the "), "name", F.lit(" written with its uncertainty?")), F.when(exact, F.concat(F.lit("It is exact and is written without one: "), value, F.lit("."))).otherwise(F.concat(F.lit("Value and uncertainty share a unit: "), value, F.lit(" with u = "), u, F.lit("."))), "introductory"),
        _row(6, F.concat(F.lit("Which uncertainty does the "), "name", F.lit(" contribute to a result?")), F.when(exact, "None, as its value is fixed by definition.").otherwise(F.concat(F.lit("Its standard uncertainty "), u, F.lit(", weighted by the sensitivity coefficient."))), "advanced"),
    ]
    return _fan_out(constants, F.coalesce("symbol", "name"), rows)


def personas(spark: SparkSession) -> DataFrame:
    """(persona, title) of all personas."""
    return spark.createDataFrame([(p, p.replace("_", " ").title()) for p in PERSONAS], "persona string, title string")


def generate(units: DataFrame, kinds: DataFrame, constants: DataFrame, limit: int | None = None, category: str | None = None) -> DataFrame:
    """Scaffolds of all entities or of one category (units, constants); with a limit, of the first so many entities of each, taken before they fan out."""
    parts = []
    for name, entities, make in (("units", units, lambda e: unit_scaffolds(e, kinds)), ("constants", constants, constant_scaffolds)):
        if category in (None, name):
            parts.append(make(first_n(entities.withColumn("_g", F.lit(name)), ["_g"], ["uri"], limit).drop("_g") if limit else entities))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_personas(scaffolds: DataFrame, personas: DataFrame) -> DataFrame:
    """Every scaffold with every persona: the result itself is the product. Personas are broadcast only up to 1,000, counted first."""
    few = personas.limit(1001).count() <= 1000
    return scaffolds.crossJoin(F.broadcast(personas) if few else personas)


def augmented(scaffolds: DataFrame, personas: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """A record for each scaffold and persona: the cached paraphrase if there is one, else the persona's title before the query.

    ``personas`` (persona, title) has some forty rows as a rule.
    """
    both = with_personas(scaffolds, personas)
    both = both.withColumn("cache_key", text.cache_key(F.col("canonical_query"), F.col("persona")))
    if cache is None:
        both = both.withColumn("response", F.lit(None).cast("string"))
    else:
        both = both.join(cache.select("cache_key", "response"), "cache_key", "left")
    offline = F.concat(F.lit("["), F.coalesce("title", text.title(F.col("persona"))), F.lit("] "), "canonical_query")
    source = F.when(F.col("response").isNotNull(), "cache").otherwise("offline")
    return both.select(F.concat_ws("_", "id", "persona", F.lit("0")).alias("id"), F.col("id").alias("scaffold_id"), "archetype", "persona", F.coalesce("response", offline).alias("user_query"), "ground_truth_answer", "entity_uri", source.alias("llm_generator"))


def canonical(scaffolds: DataFrame) -> DataFrame:
    """The pass-through without augmentation: one general persona."""
    return scaffolds.select(F.concat("id", F.lit("_general_user_0")).alias("id"), F.col("id").alias("scaffold_id"), "archetype", F.lit("general_user").alias("persona"), F.col("canonical_query").alias("user_query"), "ground_truth_answer", "entity_uri", F.lit("canonical").alias("llm_generator"))
