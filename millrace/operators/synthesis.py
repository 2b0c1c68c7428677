"""Benchmark synthesis: six tasks of multiple-choice and free-form items, from entities and small banks.

Draws come from hashes of seed and key, so an item does not depend on the order of rows or tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from .ordered import with_next
from .relational import first_n, lot

TASKS = ("constants", "dimensions", "conversions", "homogeneity", "conventions", "uncertainty")
#: Formulas with the dimension of either side; the third says whether they agree.
FORMULAS = [
    ("E = m c^2", "L2M1T-2", True), ("F = m a", "L1M1T-2", True), ("p = m v^2", "L1M1T-1", False), ("P = U I", "L2M1T-3", True), ("Q = m c \\Delta T", "L2M1T-2", True),
    ("v = a t^2", "L1T-1", False), ("p V = n R T", "L2M1T-2", True), ("E = h / \\lambda", "L2M1T-2", False), ("\\omega = 2 \\pi f", "T-1", True), ("F = q v B^2", "L1M1T-2", False),
]
SAME_DIMENSION = [("torque", "energy"), ("frequency", "activity"), ("absorbed dose", "dose equivalent"), ("pressure", "energy density"), ("heat capacity", "entropy")]
#: Named units: name, symbol, in base units.
NAMED = [
    ("newton", "N", "kg m s-2"), ("pascal", "Pa", "kg m-1 s-2"), ("joule", "J", "kg m2 s-2"), ("watt", "W", "kg m2 s-3"), ("coulomb", "C", "A s"), ("volt", "V", "kg m2 s-3 A-1"),
    ("farad", "F", "kg-1 m-2 s4 A2"), ("ohm", "Ω", "kg m2 s-3 A-2"), ("siemens", "S", "kg-1 m-2 s3 A2"), ("weber", "Wb", "kg m2 s-2 A-1"), ("tesla", "T", "kg s-2 A-1"), ("henry", "H", "kg m2 s-2 A-2"),
    ("hertz", "Hz", "s-1"), ("becquerel", "Bq", "s-1"), ("gray", "Gy", "m2 s-2"), ("sievert", "Sv", "m2 s-2"), ("lux", "lx", "cd sr m-2"), ("katal", "kat", "mol s-1"),
]
PREFIX_POWERS = {"quetta": 30, "ronna": 27, "yotta": 24, "zetta": 21, "exa": 18, "peta": 15, "tera": 12, "giga": 9, "mega": 6, "kilo": 3, "hecto": 2, "deca": 1, "deci": -1, "centi": -2, "milli": -3, "micro": -6, "nano": -9, "pico": -12, "femto": -15, "atto": -18, "zepto": -21, "yocto": -24, "ronto": -27, "quecto": -30}
RULES = [("unit symbols", "upright"), ("quantity symbols", "italic"), ("value and unit", "a space between them"), ("percent sign", "a space before it"), ("unit names", "lower case at the start"), ("compound prefixes", "not used")]
RULES += [
    ("the plural of unit symbols", "the same symbol, without s"), ("a full stop after a unit symbol", "only where a sentence ends"), ("long numbers", "groups of three digits with thin spaces"),
    ("units in a denominator", "negative exponents or one solidus"), ("multiples of the kilogram", "prefixes go with the gram"), ("a power of a prefixed unit", "it holds for the prefix as well"),
]
#: Doubled prefixes, and the one prefix that should stand there.
DOUBLED = [("kkg", "Mg"), ("mμs", "ns"), ("μμF", "pF"), ("kMW", "GW"), ("mkm", "m"), ("nnm", "am"), ("MkV", "GV"), ("μmg", "ng")]
#: Symbols that differ by case alone, with what each means.
CASES = [
    ("M", "mega", "m", "milli"), ("P", "peta", "p", "pico"), ("Z", "zetta", "z", "zepto"), ("Y", "yotta", "y", "yocto"),
    ("R", "ronna", "r", "ronto"), ("Q", "quetta", "q", "quecto"), ("K", "kelvin", "k", "kilo"), ("G", "giga", "g", "gram"),
]
#: Questions on the language of uncertainty, with the right answer and three wrong ones.
CONCEPTS = [
    ("Which evaluation uses the statistics of repeated readings?", "Type A", "Type B", "Expanded", "Relative"),
    ("By what is a rectangular half-width divided to give a standard uncertainty?", "the square root of 3", "2", "3", "the square root of 6"),
    ("By what is a triangular half-width divided to give a standard uncertainty?", "the square root of 6", "the square root of 3", "2", "6"),
    ("What does a coverage factor multiply?", "the combined standard uncertainty", "the measured value", "the number of readings", "the variance"),
    ("What does a larger number of readings reduce?", "the uncertainty of their mean", "the resolution of the instrument", "a calibration's uncertainty", "a systematic error"),
    ("About which level of confidence goes with k = 2 for a normal distribution?", "95 %", "68 %", "99.7 %", "50 %"),
]
TEMPERATURES = [("0 degC", "273.15 K"), ("100 degC", "373.15 K"), ("32 degF", "273.15 K"), ("212 degF", "373.15 K"), ("25 degC", "298.15 K")]


def item(task: str, fmt: str, key: Column, difficulty: str, question: Column, answer: Column, wrong: Sequence[Column] = (), seed: int = 42) -> Column:
    """struct of an item; ``wrong`` texts make it multiple-choice."""
    choice = numeric.options(answer, F.array(*wrong), F.concat_ws("_", F.lit(task), key), seed) if wrong else F.struct(F.lit(None).cast("array<struct<key:string,text:string,is_correct:boolean>>").alias("options"), F.lit(None).cast("string").alias("correct_key"))
    return F.struct(F.concat_ws("_", F.lit(task), F.lit(fmt), key).alias("id"), F.lit(task).alias("task"), F.lit(fmt).alias("format"), F.lit(difficulty).alias("difficulty"), question.alias("question"), choice["options"].alias("options"), choice["correct_key"].alias("correct_option_key"), answer.alias("ground_truth_answer"))


def rows_of(spark: SparkSession, bank: list[tuple], names: str) -> DataFrame:
    """A bank as a table; ``ord`` is its order."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(bank)], f"ord int, {names}")


def exploded(df: DataFrame, *items: Column) -> DataFrame:
    return df.select(F.explode(F.array_compact(F.array(*items))).alias("i")).select("i.*")


def cut(items: DataFrame, count: int) -> DataFrame:
    """Distinct questions, the first by id; then the first ``count`` by lot."""
    once = first_n(items, ["question"], ["id"], 1)
    return once.orderBy(lot(F.col("id")), "id").limit(count)


def constants_task(constants: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """Exact constants, both formats; recommended ones fill up."""
    c = constants.withColumn("v", F.col("numeric_value").try_cast("double")).where("v is not null and v <> 0")
    shown = lambda x: F.concat(F.format_string("%.6e", x), F.lit(" "), "unit_symbol")
    ask = F.concat(F.lit("What is the value of the "), "name", F.lit("?"))
    mcq = item("constants", "mcq", F.col("uri"), "introductory", ask, shown(F.col("v")), [shown(F.col("v") * 1000), shown(F.col("v") / 1000), shown(-F.col("v")), shown(F.col("v") * 1.0001)], seed)
    free = F.when(F.col("category") == "exact", item("constants", "free_form", F.col("uri"), "intermediate", F.concat(F.lit("State the exact value of the "), "name", F.lit(" with its unit.")), F.concat("numeric_value", F.lit(" "), "unit_symbol")))
    formats = F.array_compact(F.array(F.lit("mcq"), F.when(F.col("category") == "exact", "free_form")))
    dealt = c.withColumn("_fmt", F.explode(formats)).withColumn("_id", F.concat_ws("_", F.lit("constants"), "_fmt", "uri"))
    drawn = dealt.orderBy(F.col("category") != "exact", lot(F.col("_id"), seed), "_id").limit(count)  # items are made of the drawn rows alone
    return drawn.select(F.when(F.col("_fmt") == "mcq", mcq).otherwise(free).alias("i")).select("i.*")


def dimensions_task(units: DataFrame, count: int, seed: int = 42) -> DataFrame:
    u = units.where(~numeric.is_dimensionless(F.col("dimension_vector"))).orderBy(lot(F.col("uri"), seed), "uri").limit(count)
    d = F.col("dimension_vector")
    shift = lambda name, n: numeric.dimension_latex(F.struct(*[(d[x] + (n if x == name else 0)).alias(x) for x in numeric.DIMENSIONS]))
    ask = F.concat(F.lit("What is the dimension of the unit "), "label", F.lit("?"))
    mcq = item("dimensions", "mcq", F.col("uri"), "intermediate", ask, numeric.dimension_latex(d), [shift("T", 1), shift("L", -1), shift("M", 1)], seed)
    free = F.when(F.pmod(F.xxhash64("uri"), F.lit(2)) == 0, item("dimensions", "free_form", F.col("uri"), "intermediate", F.concat(F.lit("Write the unit "), "label", F.lit(" in SI base units.")), numeric.si_latex(d)))
    return cut(exploded(u, mcq, free), count)


def conversions_task(spark: SparkSession, units: DataFrame, count: int, seed: int = 42) -> DataFrame:
    t = rows_of(spark, TEMPERATURES, "given string, wanted string")
    fixed = exploded(t, item("conversions", "free_form", F.col("given"), "introductory", F.concat(F.lit("Convert "), "given", F.lit(" to kelvin.")), F.col("wanted")))
    u = units.where((F.col("conversion.multiplier") != 1) & (F.length("symbol") < 15)).orderBy(lot(F.col("uri"), seed), "uri").limit(max(0, count - len(TEMPERATURES)))
    m = F.col("conversion.multiplier")
    shown = lambda x: F.format_string("%.6e", x)
    ask = F.concat(F.lit("By which factor is a value in "), "label", F.lit(" multiplied to give SI base units?"))
    return fixed.unionByName(exploded(u, item("conversions", "mcq", F.col("uri"), "intermediate", ask, shown(m), [shown(1 / m), shown(m * 1000), shown(m / 1000)], seed)))


def homogeneity_task(spark: SparkSession, units: DataFrame, count: int, seed: int = 42) -> DataFrame:
    f = rows_of(spark, FORMULAS, "formula string, dims string, ok boolean")
    yes, no = F.lit("It is homogeneous."), F.lit("It is not homogeneous.")
    a = exploded(f, item("homogeneity", "mcq", F.col("formula"), "advanced", F.concat(F.lit("Is $"), "formula", F.lit("$ dimensionally homogeneous?")), F.when(F.col("ok"), yes).otherwise(no), [F.when(F.col("ok"), no).otherwise(yes), F.lit("It depends on the system of units."), F.lit("Dimensions do not apply to it.")], seed))
    k = rows_of(spark, SAME_DIMENSION, "one string, two string")
    b = exploded(k, item("homogeneity", "mcq", F.concat_ws("-", "one", "two"), "advanced", F.concat(F.lit("May "), "one", F.lit(" and "), "two", F.lit(" be added because their dimensions agree?")), F.lit("No, they are different kinds of quantity."), [F.lit("Yes, always."), F.lit("Yes, in SI units."), F.lit("No, their dimensions differ.")], seed))
    dealt = units.select("uri", "label", "dimension_vector", lot(F.col("uri"), seed).alias("lot"))
    pairs = with_next(dealt, ["lot", "uri"], ["label", "dimension_vector"]).where("next.dimension_vector <> dimension_vector").select("uri", "label", F.col("next.label").alias("next_label"))
    ask = F.concat(F.lit("Can a value in "), "label", F.lit(" equal a value in "), "next_label", F.lit("?"))
    once = pairs.groupBy(ask.alias("question")).agg(F.min(F.struct(F.concat_ws("_", F.lit("homogeneity"), F.lit("mcq"), "uri").alias("id"), "uri", "label", "next_label")).alias("p"))
    drawn = once.select("p.*").orderBy(lot(F.col("id")), "id").limit(count)  # what ``cut`` keeps of these, before items are made of them
    c = exploded(drawn, item("homogeneity", "mcq", F.col("uri"), "introductory", ask, F.lit("No, their dimensions differ."), [F.lit("Yes, after conversion."), F.lit("Yes, always."), F.lit("Only for small values.")], seed))
    d = rows_of(spark, DOUBLED, "wrong string, right string")
    others = lambda i: F.get(F.array(*[F.lit(x) for _, x in DOUBLED]), F.pmod(F.col("ord") + i, F.lit(len(DOUBLED))).cast("int"))
    e = exploded(d, item("homogeneity", "mcq", F.col("wrong"), "introductory", F.concat(F.lit("Which symbol should stand in place of "), "wrong", F.lit("?")), F.col("right"), [F.col("wrong"), others(2), others(5)], seed))
    return cut(a.unionByName(b).unionByName(c).unionByName(e), count)


def conventions_task(spark: SparkSession, count: int, seed: int = 42) -> DataFrame:
    n = rows_of(spark, NAMED, "name string, symbol string, base string")
    others = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.get(F.array(*[F.lit(b) for _, _, b in NAMED]), F.pmod(F.col("ord") + i * 5, F.lit(len(NAMED))).cast("int")))
    a = exploded(n, item("conventions", "mcq", F.col("name"), "intermediate", F.concat(F.lit("Which is the "), "name", F.lit(" in SI base units?")), F.col("base"), [F.get(others, F.lit(i)) for i in range(3)], seed))
    p = rows_of(spark, list(PREFIX_POWERS.items()), "prefix string, power int")
    ten = lambda e: F.concat(F.lit("10^"), e.cast("string"))
    b = exploded(p, item("conventions", "mcq", F.col("prefix"), "introductory", F.concat(F.lit("Which factor has the prefix "), "prefix", F.lit("?")), ten(F.col("power")), [ten(-F.col("power")), ten(F.col("power") + 3), ten(F.col("power") - 3)], seed))
    r = rows_of(spark, RULES, "subject string, rule string")
    c = exploded(r, item("conventions", "free_form", F.col("subject"), "introductory", F.concat(F.lit("What is the rule for "), "subject", F.lit("?")), F.col("rule")))
    k = rows_of(spark, CASES, "upper string, large string, lower string, small string")
    told = lambda x, y: F.concat_ws(" ", "upper", F.lit("is"), x, F.lit("and"), "lower", F.lit("is"), y)
    ask = F.concat(F.lit("What do the symbols "), "upper", F.lit(" and "), "lower", F.lit(" mean?"))
    d = exploded(k, item("conventions", "mcq", F.concat(F.lit("case "), "upper"), "introductory", ask, told(F.col("large"), F.col("small")), [told(F.col("small"), F.col("large")), told(F.col("large"), F.col("large")), told(F.col("small"), F.col("small"))], seed))
    return cut(a.unionByName(b).unionByName(c).unionByName(d), count)


#: Items of each kind of drawn uncertainty: quadrature, expanded, relative, mean of readings.
QUOTAS = (18, 14, 8, 7)


def uncertainty_task(spark: SparkSession, count: int, seed: int = 42) -> DataFrame:
    """Drawn budgets and the bank of concepts: so many of each kind as QUOTAS says, in that order; then quadrature and half-widths in turn until there are ``count``."""
    draw = lambda n, low, high: (F.pmod(F.conv(F.substring(lot(F.concat_ws("-", F.col("id"), F.lit(str(n))), seed), 1, 8), 16, 10).cast("long"), F.lit(high - low + 1)) + low).cast("double")
    r = spark.range(sum(QUOTAS) + count * 2).select("id", (draw(1, 1, 90) / 100).alias("a"), (draw(2, 1, 90) / 100).alias("b"), draw(3, 2, 30).alias("n"))
    s = lambda x: F.format_string("%.4f m", x)
    a, b, n, key = F.col("a"), F.col("b"), F.col("n"), F.col("id").cast("string")
    q = numeric.quadrature(a, b)
    kinds = [
        item("uncertainty", "mcq", key, "intermediate", F.format_string("Two independent contributions are %.2f m and %.2f m. What is the combined standard uncertainty?", a, b), s(q), [s(a + b), s(F.abs(a - b)), s(q / 2), s(q * q)], seed),
        item("uncertainty", "free_form", key, "introductory", F.format_string("A standard uncertainty is %.2f m. What is the expanded uncertainty for k = 2?", a), s(numeric.expanded(a))),
        item("uncertainty", "free_form", key, "advanced", F.format_string("In y = x^2 z, x has %.2f %% and z has %.2f %% relative uncertainty. What has y, in percent?", a, b), F.format_string("%.4f", numeric.relative_quadrature((a, 2), (b, 1)))),
        item("uncertainty", "free_form", key, "intermediate", F.format_string("%.0f readings have a standard deviation of %.2f m. What is the uncertainty of their mean?", n, a), s(a / F.sqrt(n))),
        item("uncertainty", "free_form", key, "introductory", F.format_string("A value lies evenly within %.2f m on either side. What is its standard uncertainty?", a), s(numeric.rectangular(a))),
    ]
    place, low = F.when(F.col("id") % 2 == 0, 0).otherwise(len(QUOTAS)), 0
    for k, n_of in enumerate(QUOTAS):
        place, low = F.when((F.col("id") >= low) & (F.col("id") < low + n_of), k).otherwise(place), low + n_of
    drawn = r.select(F.when(F.col("id") < low, place).otherwise(len(QUOTAS) + 1).cast("int").alias("kind"), "id", F.get(F.array(*kinds), place.cast("int")).alias("i"))
    bank = rows_of(spark, CONCEPTS, "question string, answer string, x string, y string, z string")
    told = bank.select(F.lit(len(QUOTAS)).alias("kind"), F.col("ord").cast("long").alias("id"), item("uncertainty", "mcq", F.concat(F.lit("concept "), F.col("ord").cast("string")), "intermediate", F.col("question"), F.col("answer"), [F.col("x"), F.col("y"), F.col("z")], seed).alias("i"))
    once = first_n(drawn.unionByName(told).select("kind", "id", F.col("i.question").alias("question"), "i"), ["question"], ["kind", "id"], 1)
    return once.orderBy("kind", "id").limit(count).select("i.*")


def generate_all(spark: SparkSession, units: DataFrame, constants: DataFrame, count: int = 50, seed: int = 42) -> DataFrame:
    """All six tasks of up to ``count`` items each."""
    parts = [constants_task(constants, count, seed), dimensions_task(units, count, seed), conversions_task(spark, units, count, seed), homogeneity_task(spark, units, count, seed), conventions_task(spark, count, seed), uncertainty_task(spark, count, seed)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
