"""Entities from triples and from JSON: graph patterns as joins, aliases as coalesce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric
from .turtle import TYPE


def local(iri: Column) -> Column:
    """The name behind the last slash or hash."""
    return F.regexp_extract(iri, r"([^/#]*)$", 1)


def optional(subjects: DataFrame, triples: DataFrame, predicates: Sequence[str], name: str, lang: str | None = None) -> DataFrame:
    """Left join of a property: several values give several rows. Of several predicates for one variable, the first that has a value counts.

    The language is filtered on the right side, before the join.
    """
    names = []
    for k, p in enumerate(predicates):
        side = triples.where(local(F.col("p")) == p)
        if lang:
            side = side.where(F.col("lang").isNull() | (F.col("lang") == lang))
        names.append(f"_{name}_{k}")
        subjects = subjects.join(side.select("s", F.col("o").alias(names[-1])), "s", "left")
    return subjects.withColumn(name, F.coalesce(*names)).drop(*names)


def gathered(triples: DataFrame, types: Sequence[str], single: dict[str, Sequence[str]], many: dict[str, Sequence[str]], last: bool = False) -> DataFrame:
    """One row per subject of one of the types: properties with one value (smallest, or greatest if ``last``), and sorted arrays of those with many.

    This is the optional pattern after its product has been folded back. Types and properties come out of one aggregation, so the triples are made once.
    """
    wanted = {p for ps in [*single.values(), *many.values()] for p in ps}
    typed = F.coalesce((F.col("p") == TYPE) & local(F.col("o")).isin(*types), F.lit(False))
    rows = triples.select(F.col("s").alias("uri"), F.when(F.col("s").isNotNull(), local(F.col("p"))).alias("_p"), "o", typed.alias("_typed")).where(F.col("_p").isin(*wanted) | F.col("_typed"))
    value = lambda p: F.when(F.col("_p") == p, F.col("o"))
    pick = F.max if last else F.min
    aggs = [F.coalesce(*[pick(value(p)) for p in ps]).alias(n) for n, ps in single.items()]
    told = F.count_if(F.col("_p").isin(*wanted)) > 0
    aggs += [F.when(told, F.array_sort(F.collect_set(F.when(F.col("_p").isin(*ps), F.col("o"))))).alias(n) for n, ps in many.items()]
    return rows.groupBy("uri").agg(F.bool_or("_typed").alias("_typed"), *aggs).where("_typed").drop("_typed")


def units(triples: DataFrame) -> DataFrame:
    """Units of a unit vocabulary."""
    out = gathered(
        triples, ["Unit", "DerivedUnit", "BaseUnit"],
        {"label": ["label"], "symbol": ["symbol", "hasSymbol"], "multiplier": ["conversionMultiplier"], "offset": ["conversionOffset"], "is_si": ["isSI"], "is_coherent": ["isCoherent"], "dimension": ["hasDimensionVector", "hasDimension"], "ucum": ["ucumCode"]},
        {"has_quantity_kinds": ["hasQuantityKind"], "exact_match_uris": ["exactMatch"]},
    )
    multiplier = F.coalesce(F.nullif(F.col("multiplier").try_cast("double"), F.lit(0.0)), F.lit(1.0))
    vector = numeric.dimension(F.coalesce(local(F.col("dimension")), F.lit("")))
    truth = lambda c: F.coalesce(F.col(c) == "true", F.lit(False))
    return out.select("uri", F.coalesce("label", local(F.col("uri"))).alias("label"), F.coalesce("symbol", local(F.col("uri"))).alias("symbol"), truth("is_si").alias("is_si"), truth("is_coherent").alias("is_coherent"), vector.alias("dimension_vector"), F.struct(multiplier.alias("multiplier"), F.coalesce(F.col("offset").try_cast("double"), F.lit(0.0)).alias("offset")).alias("conversion"), "has_quantity_kinds", F.col("ucum").alias("ucum_code"), "exact_match_uris")


def quantity_kinds(triples: DataFrame) -> DataFrame:
    out = gathered(triples, ["QuantityKind"], {"label": ["label"], "symbol": ["symbol", "hasSymbol"], "description": ["description", "plainTextDescription"], "dimension": ["hasDimensionVector", "hasDimension"]}, {"applicable_units": ["applicableUnit"], "broader_quantity_kinds": ["broader"], "exact_match_uris": ["exactMatch"]})
    return out.select("uri", F.coalesce("label", local(F.col("uri"))).alias("label"), "symbol", "description", numeric.dimension(F.coalesce(local(F.col("dimension")), F.lit(""))).alias("dimension_vector"), "applicable_units", "broader_quantity_kinds", "exact_match_uris")


def constants(triples: DataFrame, year: int = 2022) -> DataFrame:
    """Physical constants: of several rows of a constant the last counts."""
    out = gathered(triples, ["PhysicalConstant", "DefiningConstant", "Constant"], {"name": ["label", "name"], "symbol": ["symbol", "hasSymbol"], "raw": ["numericValue", "hasNumericalValue", "value"], "u": ["standardUncertainty"], "ur": ["relativeUncertainty"], "unit_symbol": ["unitSymbol", "hasUnit"], "year": ["evaluationYear"]}, {}, last=True)
    return constants_of(out, year)


#: Constants that are exact whatever their record says, in lower case; and uncertainties that mean none.
EXACT_NAMES = ("planck constant", "speed of light in vacuum", "elementary charge", "boltzmann constant", "avogadro constant", "hyperfine transition frequency of cs-133", "luminous efficacy")
NO_UNCERTAINTY = ("(exact)", "0", "none", "")


def constants_of(rows: DataFrame, year: int) -> DataFrame:
    """Values, uncertainties and exactness of rows (uri, name, symbol, raw, u, ur, unit_symbol, year, and exact if it is known)."""
    parsed = numeric.concise_value(F.coalesce("raw", F.lit("")))
    flagged = F.coalesce(F.col("exact"), F.lit(False)) if "exact" in rows.columns else F.lit(False)
    stated = F.lower(F.coalesce("u", F.lit("")))
    exact = flagged | F.trim(stated).isin(*NO_UNCERTAINTY) | F.coalesce(F.lower("name").isin(*EXACT_NAMES), F.lit(False))
    uncertainty = F.when(stated != "(exact)", F.coalesce(F.nullif("u", F.lit("")), parsed["uncertainty"]))
    return rows.select("uri", F.coalesce("name", local(F.col("uri"))).alias("name"), "symbol", F.when(exact, "exact").otherwise("recommended").alias("category"), parsed["value"].alias("numeric_value"), uncertainty.alias("standard_uncertainty"), F.col("ur").alias("relative_uncertainty"), F.coalesce("unit_symbol", F.lit("1")).alias("unit_symbol"), F.coalesce(F.col("year").try_cast("int"), F.lit(year)).alias("defining_year"))


#: Names under which third-party JSON has each field, in order.
ALIASES = {"name": ("name", "label", "quantity"), "raw": ("value", "numericValue", "numeric_value"), "u": ("uncertainty", "standardUncertainty", "standard_uncertainty"), "ur": ("relativeUncertainty", "relative_uncertainty"), "unit_symbol": ("unit", "unitSymbol", "unit_symbol"), "symbol": ("symbol",), "uri": ("uri", "id", "@id"), "year": ("year", "evaluationYear")}


def constants_from_json(spark: SparkSession, path: str, year: int = 2022) -> DataFrame:
    """Constants of a JSON array, or of an object with them under ``constants`` or ``data``; other years are left out."""
    fields = sorted({a for names in ALIASES.values() for a in names})
    item = T.StructType([T.StructField(f, T.StringType()) for f in fields] + [T.StructField("exact", T.BooleanType())])
    text = spark.read.text(path, wholetext=True)
    parse = lambda where: F.from_json(where, T.ArrayType(item))
    items = F.coalesce(parse(F.get_json_object("value", "$.constants")), parse(F.get_json_object("value", "$.data")), parse(F.col("value")))
    rows = text.select(F.explode(items).alias("i"))
    alias = {n: F.coalesce(*[F.col(f"i.`{a}`") for a in names]) for n, names in ALIASES.items()}
    rows = rows.select(*[c.alias(n) for n, c in alias.items()], F.col("i.exact").alias("exact")).where(F.coalesce(F.col("year").try_cast("int"), F.lit(year)) == year)
    return constants_of(rows.withColumn("uri", F.coalesce("uri", F.concat(F.lit("constant/"), F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-")))), year)


def without_placeholders(entities: DataFrame, label: str = "label") -> DataFrame:
    """Without entities that only say that something is unknown."""
    return entities.where(~(F.lower("uri").endswith("/unknown") | (F.lower(F.coalesce(label, F.lit(""))) == "unknown")))
