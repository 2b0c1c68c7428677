"""Graph patterns over a triples table: variables, constants, OPTIONAL groups, languages and DISTINCT, as joins.

A pattern is a (subject, predicate, object) in which names that begin with ``?`` are variables. The patterns' rows are counted in one pass; joins begin with the rarest
pattern and go on with the rarest that shares a variable with what is joined so far, and a side is broadcast if it was counted to be small. Patterns that
share no variable are refused: they would be a cross join.

Cases: a triple with a null in a place that a pattern names does not match; a repeated triple matches as often as it stands there; of a variable that stands twice in a pattern both
places must be equal; without rows for a required pattern there are no results, without rows for an OPTIONAL group its variables are null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import BROADCAST_ROWS


@dataclass(frozen=True)
class Pattern:
    """Places of a triple; ``langs`` are the languages that the object may have, with '' for none. ``where`` (SQL on the variables' names) is tested before any join."""

    s: str
    p: str
    o: str
    langs: tuple[str, ...] | None = None
    where: str | None = None

    @property
    def variables(self) -> list[str]:
        return list(dict.fromkeys(x[1:] for x in (self.s, self.p, self.o) if x.startswith("?")))

    def holds(self) -> Column:
        """Whether a triple has the pattern's constants and language."""
        out, places = F.lit(True), (("s", self.s), ("p", self.p), ("o", self.o))
        for column, term in places:
            out = out & (F.col(column).isNotNull() if term.startswith("?") else F.col(column) == term)
        for k, (column, term) in enumerate(places):
            for other, same in places[k + 1 :]:
                if term.startswith("?") and term == same:
                    out = out & (F.col(column) == F.col(other))
        return out if self.langs is None else out & F.coalesce("lang", F.lit("")).isin(*self.langs)

    def rows(self, triples: DataFrame) -> DataFrame:
        found = triples.where(self.holds()).select(*[F.col(next(c for c, t in (("s", self.s), ("p", self.p), ("o", self.o)) if t == "?" + v)).alias(v) for v in self.variables])
        return found if self.where is None else found.where(self.where)


def counts(triples: DataFrame, patterns: Sequence[Pattern]) -> list[int]:
    """Rows of each pattern, in one pass."""
    return list(triples.agg(*[F.count_if(p.holds()).alias(str(k)) for k, p in enumerate(patterns)]).first())


def order_of(patterns: Sequence[Pattern], sizes: Sequence[int]) -> list[int]:
    """The order of the joins: the rarest pattern first, then the rarest that is connected."""
    left = sorted(range(len(patterns)), key=lambda k: (sizes[k], k))
    out = [left.pop(0)]
    bound = set(patterns[out[0]].variables)
    while left:
        k = next((k for k in left if bound & set(patterns[k].variables)), None)
        if k is None:
            raise ValueError("patterns share no variable: " + ", ".join(f"{patterns[k].s} {patterns[k].p} {patterns[k].o}" for k in left))
        left.remove(k)
        out.append(k)
        bound |= set(patterns[k].variables)
    return out


def sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def joined(triples: DataFrame, patterns: Sequence[Pattern], sizes: Sequence[int]) -> DataFrame:
    """All solutions of patterns that must hold together."""
    first, *rest = order_of(patterns, sizes)
    out = patterns[first].rows(triples)
    for k in rest:
        out = out.join(sized(patterns[k].rows(triples), sizes[k]), [v for v in patterns[k].variables if v in out.columns])
    return out


def bound_or_equal(left: DataFrame, right: DataFrame, sure: set[str], most: int | None) -> DataFrame:
    """A left join on shared variables; one that may be null on the left is bound by the right.

    A row on the right stands once for each set of variables that may be null on the left, so all conditions are equalities and no rows of a key are compared in pairs.
    """
    shared = [v for v in right.columns if v in left.columns]
    keys, unsure = [v for v in shared if v in sure], [v for v in shared if v not in sure]
    if not keys:
        raise ValueError("an OPTIONAL group shares no variable that is always bound")
    side = right.select(*[F.col(v).alias(f"_{v}") for v in right.columns])
    fits = [F.col(v) == F.col(f"_{v}") for v in keys]
    if unsure:
        nulls = F.array(*[F.col(v).isNull() for v in unsure])
        left, kept = left.withColumn("_nulls", nulls), left.columns
        sets = F.array(*[F.array(*[F.lit(x) for x in one]) for one in product((False, True), repeat=len(unsure))])
        side = side.withColumn("_open", F.explode(sets)).select("*", *[F.when(~F.get("_open", F.lit(k)), F.col(f"_{v}")).alias(f"_key_{v}") for k, v in enumerate(unsure)])
        fits += [F.col("_nulls") == F.col("_open"), *[F.col(v).eqNullSafe(F.col(f"_key_{v}")) for v in unsure]]
    else:
        kept = left.columns
    side = side if most is None else sized(side, most << len(unsure))
    out = left.join(side, reduce(Column.__and__, fits), "left")
    return out.select(*[F.coalesce(v, f"_{v}").alias(v) if v in unsure else F.col(v) for v in kept], *[F.col(f"_{v}").alias(v) for v in right.columns if v not in kept])


def narrowed(rows: DataFrame, wanted: set[str]) -> DataFrame:
    """Distinct rows of the wanted variables; as they are if all are wanted."""
    kept = [v for v in rows.columns if v in wanted]
    return rows if len(kept) == len(rows.columns) else rows.select(*kept).distinct()


def match(triples: DataFrame, required: Sequence[Pattern], optional: Sequence[Sequence[Pattern]] = (), select: Sequence[str] | None = None, distinct: bool = False) -> DataFrame:
    """The solutions as rows of variables.

    Each of ``optional`` is a group of patterns that hold together or not at all; several matches of a group give several rows, and groups multiply. Groups
    are taken in their order: a variable that an earlier group left null is bound by a later one. With ``distinct``, variables that are neither selected nor shared
    with a group to come go before each join, and what repeats without them.
    """
    flat = [*required, *[p for group in optional for p in group]]
    sizes = counts(triples, flat)
    out = joined(triples, required, sizes)
    sure, at = set(out.columns), len(required)
    named = lambda groups: {v for group in groups for p in group for v in p.variables}
    for k, group in enumerate(optional):
        own = sizes[at : at + len(group)]
        at += len(group)
        side = joined(triples, group, own)
        if distinct and select:
            out = narrowed(out, {*select, *named(optional[k:])})
            side = narrowed(side, {*select, *out.columns, *named(optional[k + 1 :])})
        out = bound_or_equal(out, side, sure, own[0] if len(group) == 1 else None)
    out = out.select(*select) if select else out
    return out.distinct() if distinct else out
