"""Dimensions, uncertainties, exact decimals and the other arithmetic of measurement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base dimensions in their two orders of print.
DIMENSIONS = ("L", "M", "T", "I", "Theta", "N", "J")
SI_ORDER = ("M", "L", "T", "I", "Theta", "N", "J")
SI_UNITS = {"M": "kg", "L": "m", "T": "s", "I": "A", "Theta": "K", "N": "mol", "J": "cd"}
#: Names of a dimension in dimension strings: vectors of unit vocabularies have letters of their own for three of them.
NAMES = {"L": ("L",), "M": ("M",), "T": ("T",), "I": ("I", "E"), "Theta": ("Theta", "\u0398", "\u03b8", "H"), "N": ("N", "D"), "J": ("J",)}


def dimension(text: Column) -> Column:
    """Exponents of a dimension string like ``L2 M1 T-2`` or ``A0E0L2I0M1H0T-2D0``.

    The string is parted into runs of letters, each with the signed number behind it. A run counts for the dimension whose name it ends with, and for a dimension
    the first of its runs; what has no run is 0.
    """
    said = F.coalesce(text, F.lit(""))
    part = lambda k: F.regexp_extract_all(said, F.lit("([A-Za-z\u0398\u03b8]+)([+-]?[0-9]+)"), F.lit(k))
    runs = F.transform(F.arrays_zip(part(1).alias("name"), part(2).alias("power")), lambda r: F.struct(F.when(r["name"].endswith("Theta"), "Theta").otherwise(F.right(r["name"], F.lit(1))).alias("name"), r["power"].try_cast("int").alias("power")))
    first = lambda all_, d: F.get(F.filter(all_, lambda r: r["name"].isin(*NAMES[d])), F.lit(0))["power"]
    return _once(runs, lambda all_: F.struct(*[F.coalesce(first(all_, d), F.lit(0)).alias(d) for d in DIMENSIONS]))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _each(f) -> Column:
    return F.struct(*[f(d).alias(d) for d in DIMENSIONS])


def times(a: Column, b: Column) -> Column:
    return _each(lambda d: a[d] + b[d])


def over(a: Column, b: Column) -> Column:
    return _each(lambda d: a[d] - b[d])


def to_power(a: Column, n: int | Column) -> Column:
    return _each(lambda d: a[d] * n)


def is_dimensionless(a: Column) -> Column:
    return _once(a, lambda x: reduce(Column.__and__, [x[d] == 0 for d in DIMENSIONS]))


def _latex(a: Column, order: tuple[str, ...], names: dict[str, str]) -> Column:
    terms = [F.when(a[d] == 1, F.lit(names[d])).when(a[d] != 0, F.concat(F.lit(names[d] + "^{"), a[d].cast("string"), F.lit("}"))) for d in order]
    return F.when(is_dimensionless(a), F.lit("1")).otherwise(F.array_join(F.array_compact(F.array(*terms)), " \\cdot "))


def dimension_latex(a: Column) -> Column:
    return _latex(a, DIMENSIONS, {d: "\\Theta" if d == "Theta" else f"\\text{{{d}}}" for d in DIMENSIONS})


def si_latex(a: Column) -> Column:
    return _latex(a, SI_ORDER, {d: f"\\text{{{SI_UNITS[d]}}}" for d in DIMENSIONS})


NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def _only(s: Column, symbols: str) -> Column:
    """Whether a string has no other symbols than these."""
    return F.translate(s, symbols, "") == ""


def concise_value(text: Column) -> Column:
    """struct<value, uncertainty> of ``6.67430(15)e-11``: strings, exact. Without a bracket the value alone; other symbols go.

    The text is parted at its brackets: the mean before them, the uncertainty's last digits between them, and an exponent behind.
    """
    s = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    mean, rest = F.substring_index(s, "(", 1), F.substring_index(s, "(", -1)
    digits, power = F.substring_index(rest, ")", 1), F.substring_index(rest, ")", -1)
    whole = F.ltrim(F.substring_index(mean, ".", 1), F.lit("+-"))
    places = F.when(mean.contains("."), F.length(mean) - F.instr(mean, ".")).otherwise(F.lit(0))
    sound = (F.length(s) == F.length(mean) + F.length(digits) + F.length(power) + F.lit(2)) & s.contains("(") & s.contains(")")
    sound = sound & (whole != "") & _only(whole, "0123456789") & (F.length(mean) - F.length(F.ltrim(mean, F.lit("+-"))) <= 1) & (digits != "") & _only(digits, "0123456789")
    sound = sound & ((places == 0) | _only(F.substring_index(mean, ".", -1), "0123456789")) & (F.size(F.split(mean, "[.]")) <= 2) & ((power == "") | F.concat(F.lit("0"), power).rlike(NUMBER) & F.lower(F.substring(power, 1, 1)).isin("e"))
    suffix = F.when(power != "", F.concat(F.lit("e"), F.substring(power, F.lit(2), F.length(power)))).otherwise(F.lit(""))
    padded = F.lpad(F.regexp_replace(digits, "^0+(?=[0-9])", ""), F.greatest(places + F.lit(1), F.length(digits)), "0")
    at = F.length(padded) - places
    scaled = F.concat(F.regexp_replace(F.substring(padded, F.lit(1), at), "^0+(?=[0-9])", ""), F.lit("."), F.substring(padded, at + F.lit(1), places))
    u = F.when(places > 0, scaled).otherwise(digits)
    kept = F.array_join(F.filter(F.split(s, ""), lambda c: F.lit("0123456789.eE+-").contains(c)), "")
    value = F.when(sound, F.concat(mean, suffix)).when(s.rlike(NUMBER), s).otherwise(kept)
    return F.struct(value.alias("value"), F.when(sound, F.concat(u, suffix)).alias("uncertainty"))


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_decimal(text: Column) -> Column:
    """struct<negative, digits, power>: equal exactly when the numbers are; null if the text is no number."""

    def parts(s: Column) -> Column:
        mantissa = F.regexp_extract(s, r"^[+-]?([0-9.]*)", 1)
        power = F.coalesce(F.regexp_extract(s, "[eE]([+-]?[0-9]+)$", 1).try_cast("long"), F.lit(0))
        digits = F.ltrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
        places = F.when(mantissa.contains("."), F.length(mantissa) - F.instr(mantissa, ".")).otherwise(F.lit(0))
        return once(F.struct(s.startswith("-").alias("minus"), power.alias("power"), places.alias("places"), digits.alias("digits")), exact)

    def exact(p: Column) -> Column:
        short = F.rtrim(p["digits"], F.lit("0"))
        zero = short == ""
        power = p["power"] - p["places"] + F.length(p["digits"]) - F.length(short)
        return F.struct((p["minus"] & ~zero).alias("negative"), short.alias("digits"), F.when(zero, F.lit(0)).otherwise(power).cast("long").alias("power"))

    return once(F.replace(F.trim(text), F.lit(" "), F.lit("")), lambda s: F.when(s.rlike(NUMBER), parts(s)))


def same_decimal(a: Column, b: Column) -> Column:
    """Whether two strings are the same number, digit for digit."""
    return F.coalesce(canonical_decimal(a) == canonical_decimal(b), F.lit(False))


def converted(value: Column, multiplier: Column, offset: Column, interval: bool = False) -> Column:
    """Value in SI units; an interval has no offset."""
    return value * multiplier if interval else value * multiplier + offset


def quadrature(*parts: Column) -> Column:
    out = F.lit(0.0)
    for u in parts:
        out = out + u * u
    return F.sqrt(out)


def expanded(u: Column, k: Column | float = 2.0) -> Column:
    return u * k


def relative_quadrature(*parts: tuple[Column, int]) -> Column:
    """Of (relative uncertainty, exponent) pairs."""
    return quadrature(*[u * n for u, n in parts])


def type_a(x: Column) -> Column:
    """Aggregate: standard uncertainty of the mean."""
    return F.stddev_samp(x) / F.sqrt(F.count(x))


def rectangular(half_width: Column) -> Column:
    return half_width / F.sqrt(F.lit(3.0))


def triangular(half_width: Column) -> Column:
    return half_width / F.sqrt(F.lit(6.0))


def radar_point(score: Column, axis: Column, axes: int, radius: float = 100.0) -> Column:
    """struct<x, y> on a radar chart; the first axis points up, scores are percent."""
    part = F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)) / 100.0 * radius
    angle = axis * (2 * 3.141592653589793 / axes) - 3.141592653589793 / 2
    return F.struct((part * F.cos(angle)).alias("x"), (part * F.sin(angle)).alias("y"))


def options(correct: Column, wrong: Column, sample_id: Column, seed: int = 42) -> Column:
    """struct<options: array<struct<key, text, is_correct>>, correct_key>: the right text and three wrong ones at most, in an order drawn by hash."""
    wrong = F.slice(F.array_distinct(F.array_remove(wrong, correct)), 1, 3)
    drawn = F.array_sort(F.transform(F.concat(F.array(correct), wrong), lambda t: F.struct(F.sha2(F.concat_ws("_", F.lit(str(seed)), sample_id.cast("string"), t), 256).alias("lot"), t.alias("text"))))
    keyed = F.transform(drawn, lambda o, i: F.struct(F.substring(F.lit("ABCD"), i + F.lit(1), F.lit(1)).alias("key"), o["text"].alias("text"), (o["text"] == correct).alias("is_correct")))
    return F.struct(keyed.alias("options"), F.element_at(F.filter(keyed, lambda o: o["is_correct"]), 1)["key"].alias("correct_key"))


def linked(kinds: Column, kind: Column) -> Column:
    """Whether an entity's kind is among the kinds it may have; an entity without kinds is linked with none."""
    return F.coalesce(F.array_contains(kinds, kind), F.lit(False))
