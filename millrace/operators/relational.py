"""Relational operators: precedence, lookups, samples, splits, quantiles and greedy deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most rows of a lookup side that may be broadcast; counted before.
BROADCAST_ROWS = 200_000


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str] | Column, how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """A join that broadcasts ``right`` if it has ``most`` rows or fewer, and shuffles otherwise."""
    few = right.limit(most + 1).count() <= most
    return left.join(F.broadcast(right) if few else right, on if isinstance(on, Column) else list(on), how)


def latest(df: DataFrame, key: Sequence[str], order: Column | str) -> DataFrame:
    """The row of each key with the greatest ``order``: an aggregation, so partial results are combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*")


def earliest(df: DataFrame, key: Sequence[str], order: Column | str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*")


def precedence_union(tiers: Sequence[DataFrame], key: Sequence[str], order: str) -> DataFrame:
    """Union in which a later table's row replaces an earlier one's with the same key; within a table the greatest ``order`` counts."""
    out = None
    for n, t in enumerate(tiers):
        t = t.withColumn("tier", F.lit(n))
        out = t if out is None else out.unionByName(t)
    return latest(out, key, F.struct("tier", order))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``old`` without the keys of ``new``, and all of ``new``."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def remaining(work: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    return work.join(done.select(*key).distinct(), list(key), "left_anti")


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group. Spark limits each task's rows by rank before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def lot(key: Column, seed: int = 42) -> Column:
    """A place in a seeded shuffle that any engine can recompute: SHA-256 of seed and key."""
    return F.sha2(F.concat(F.lit(f"{seed}_"), key.cast("string")), 256)


def hash_split(df: DataFrame, key: str, train: float = 0.85, val: float = 0.10, seed: int = 42) -> DataFrame:
    """Adds ``split``: the first floor(n * train) rows of a seeded shuffle, the next floor(n * val), and the rest.

    The cuts are found from counts by the lot's first four hex digits; only the rows of the slots in which a cut
    lies are ranked, so no task ranks the whole table.
    """
    drawn = df.withColumn("_lot", lot(F.col(key), seed)).withColumn("_slot", F.substring("_lot", 1, 4))
    slots = drawn.groupBy("_slot").agg(F.count(F.lit(1)).alias("_many"))  # 65,536 rows at most
    slots = slots.select("_slot", (F.sum("_many").over(Window.orderBy("_slot")) - F.col("_many")).alias("_before"), F.sum("_many").over(Window.partitionBy()).alias("_all"), "_many")
    first = F.floor(F.col("_all") * F.lit(train))
    second = first + F.floor(F.col("_all") * F.lit(val))
    inside = lambda at: (F.col("_before") < at) & (at < F.col("_before") + F.col("_many"))
    both = drawn.join(F.broadcast(slots), "_slot").withColumn("_cut", inside(first) | inside(second))
    ranked = both.where("_cut").withColumn("_place", F.col("_before") + F.row_number().over(Window.partitionBy("_slot").orderBy("_lot", key)) - 1)
    placed = both.where("not _cut").withColumn("_place", F.col("_before")).unionByName(ranked)
    split = F.when(F.col("_place") < first, "train").when(F.col("_place") < second, "val").otherwise("test")
    return placed.withColumn("split", split).select(*df.columns, "split")


def stratified(df: DataFrame, strata: Sequence[str], key: str, size: int, seed: int = 42) -> DataFrame:
    """About ``size`` rows in proportion: max(1, round(n * ratio)) of each stratum by lot, cut at ``size`` in a second lot.

    Each stratum's threshold is found by counts of the lots' leading bits (``selection``); only rows at a threshold are ranked.
    """
    from .selection import at_ranks

    n = df.count()
    if n <= size:
        return df
    names = [f"_s{k}" for k in range(len(strata))]
    lead = F.conv(F.substring(lot(F.col(key), seed), 1, 15), 16, 10).cast("long")
    drawn = df.withColumns({"_lead": lead, **{a: F.col(c) for a, c in zip(names, strata, strict=True)}})
    wanted = F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(size / n), 0))
    cuts = at_ranks(drawn.select(*names, "_lead"), names, "_lead", [("_cut", wanted - 1)])
    same = lambda x, y: reduce(lambda p, q: p & q, [F.col(f"{x}.{a}").eqNullSafe(F.col(f"{y}.{a}")) for a in names])
    held = lookup(drawn.alias("d"), cuts.alias("c"), same("d", "c"), "inner").select("d.*", "c._cut").where("_lead <= _cut")
    below = held.groupBy(*names).agg(F.count(F.lit(1)).alias("_upto"), F.count_if(F.col("_lead") < F.col("_cut")).alias("_below"))
    counts = drawn.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).select(*names, wanted.cast("long").alias("_k"))
    ties = lookup(held.where("_lead = _cut").alias("d"), below.alias("c"), same("d", "c"), "inner").select("d.*", "c._below")
    ties = lookup(ties.alias("d"), counts.alias("c"), same("d", "c"), "inner").select("d.*", "c._k")
    at_cut = Window.partitionBy(*names).orderBy(lot(F.col(key), seed), key)  # the rows whose lots begin alike, one as a rule
    ties = ties.withColumn("_place", F.row_number().over(at_cut)).where(F.col("_below") + F.col("_place") <= F.col("_k"))
    taken = held.where("_lead < _cut").select(*df.columns).unionByName(ties.select(*df.columns))
    return taken.orderBy(lot(F.col(key), seed + 1), key).limit(size)


def distribution(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Per group: n, min, mean, median, p95, p99, max, std. Quantiles are ``sorted[min(n - 1, floor(n * q))]``, std is the population's, mean and std have one digit."""
    from .selection import at_ranks, written

    groups, n = list(groups), F.col("n")
    rows = written(df.select(*groups, F.col(value).alias("_v")))
    index = lambda q: F.least(n - 1, F.floor(n * F.lit(q)))
    picked = at_ranks(rows, groups, "_v", [("median", index(0.5)), ("p95", index(0.95)), ("p99", index(0.99))], True)
    mean = F.sum("_v") / F.count("_v")
    std = F.sqrt(F.greatest(F.sum(F.col("_v").cast("double") * F.col("_v")) / F.count("_v") - mean * mean, F.lit(0.0)))
    sums = rows.where("_v is not null").groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("min"), F.bround(mean, 1).alias("mean"), F.max("_v").alias("max"), F.bround(std, 1).alias("std"))
    same = reduce(lambda p, q: p & q, [F.col(f"s.{g}").eqNullSafe(F.col(f"p.{g}")) for g in groups], F.lit(True))
    both = sums.alias("s").join(picked.alias("p"), same)
    return both.select(*[F.col(f"s.{g}").alias(g) for g in groups], "n", "min", "mean", "median", "p95", "p99", "max", "std")


def exact_dedup(df: DataFrame, text: Column, order: str) -> DataFrame:
    """The first row, by ``order``, of each normalised text. Only hashes and orders are shuffled to find it."""
    from ..functions.text import text_key

    keyed = df.withColumn("_key", text_key(text))
    kept = keyed.groupBy("_key").agg(F.min(order).alias(order))
    return keyed.join(kept, ["_key", order], "left_semi").drop("_key")


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 50) -> DataFrame:
    """Page ``number`` (from 0) of a sorted table."""
    return df.orderBy(*order).offset(number * size).limit(size)


def collated(column: Column, collation: str = "UNICODE") -> Column:
    """A sort key as browsers compare texts: letters before accents before case; ``UNICODE_CI_AI`` sees neither."""
    return F.collate(column.cast("string"), collation)


def utf16_length(column: Column) -> Column:
    """Length as browsers count it: symbols beyond the basic plane count twice."""
    return F.floor(F.octet_length(F.encode(column, "UTF-16BE")) / 2).cast("long")


def search(df: DataFrame, text: str, columns: Sequence[str], collation: str | None = None) -> DataFrame:
    """Rows with ``text`` in one of the columns, in any case; by a collation, where one is given."""
    hit = F.lit(False)
    for c in columns:
        said = F.coalesce(F.col(c).cast("string"), F.lit(""))
        hit = hit | (F.contains(F.lower(said), F.lit(text.lower())) if collation is None else F.contains(collated(said, collation), collated(F.lit(text), collation)))
    return df.where(hit)


def random_pick(df: DataFrame, key: str, seed: int = 42, of: int = 1) -> DataFrame:
    """``of`` rows of a seeded shuffle; each task keeps its own first few."""
    return df.orderBy(lot(F.col(key), seed), key).limit(of)


def diversity(words: DataFrame) -> DataFrame:
    """total_words, vocabulary and pairs of the arrays ``w``: one row per word, with the next one of its array or null, by 96 bits of hash each; groups of these are the pairs, and the words come out of the groups."""
    rows = words.select(F.inline(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("b")))).toDF("a", "b")
    more = F.shiftleft(F.hash("a").cast("long"), 32).bitwiseOR(F.hash("b").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    pairs = rows.select(F.xxhash64("a").alias("a"), F.when(F.col("b").isNotNull(), F.xxhash64("b")).alias("b"), more.alias("more")).groupBy("a", "b", "more").agg(F.count(F.lit(1)).alias("c"))
    distinct = pairs.groupBy("a", F.shiftright("more", 32)).agg(F.sum("c").alias("c"), F.count("b").alias("pairs"))
    return distinct.agg(F.sum("c").alias("total_words"), F.count(F.lit(1)).alias("vocabulary"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
