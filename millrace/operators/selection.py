"""Values at given ranks of each group, by refinement: no task sorts or holds a group.

A group's values lie between its least and greatest. Each round counts the values of an interval by slots, for all groups and ranks at once, and goes on with the slot that holds the
rank and with that slot's own least and greatest value. Slots are the leading bits of a value: sign and exponent first, and where the ends are within a factor of four,
``SLOTS`` equal parts of the interval, so eight rounds do for any doubles or longs. An interval with ``FEW`` values or fewer is gathered and
indexed. Rows are written once as (group, value) and read again each round.

Cases: null values are left out; null members of a group's key are equal; NaN is greater than all numbers; ranks that a group does not have give no row; without rows
there are no results.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .relational import lookup

SLOTS, FEW = 4096, 4096
#: Intervals that are broadcast, counted first.
INTERVALS = 100_000


def checkpoints(spark: SparkSession) -> None:
    """Sees that checkpoints go to the shared folder; only a session in one process gets a folder of its own."""
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))


def shared_path(spark: SparkSession) -> str:
    """A new folder's name in the shared folder."""
    checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def slot(v: Column, lo: Column, hi: Column) -> Column:
    """A number that does not fall as ``v`` rises from ``lo`` to ``hi``, and differs at both ends."""
    width = F.try_subtract(hi, lo).cast("double")
    a, b = F.abs(lo.cast("double")), F.abs(hi.cast("double"))
    near = (width > 0) & ((width <= SLOTS) | ((F.signum(lo.cast("double")) == F.signum(hi.cast("double"))) & (F.greatest(a, b) <= F.least(a, b) * 4)))
    part = F.floor(F.try_divide(F.try_subtract(v, lo).cast("double"), width) * SLOTS)
    x = v.cast("double")
    size = F.signum(x) * (F.lit(1100) + F.least(F.floor(F.log2(F.abs(x))), F.lit(1100)))
    leading = F.when(F.isnan(x), 5000).when(x == 0, 0).otherwise(size)
    return F.when(F.coalesce(near & ~F.isnan(hi.cast("double")), F.lit(False)), part).otherwise(leading).cast("long")


def written(rows: DataFrame) -> DataFrame:
    """Rows that are read several times, as a checkpoint."""
    checkpoints(rows.sparkSession)
    return rows.checkpoint()


def at_ranks(rows: DataFrame, groups: Sequence[str], value: str, ranks: Sequence[tuple[str, Column]], is_written: bool = False) -> DataFrame:
    """(groups, one column per named rank): the value of each rank (from 0, an expression of the group's ``n``) of each group with values."""
    key = F.struct(*[F.col(g) for g in groups]) if groups else F.struct(F.lit(0).alias("all"))
    rows = rows.where(F.col(value).isNotNull()).select(key.alias("g"), F.col(value).alias("v"))
    rows = rows if is_written else written(rows)
    ends = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks])).alias("r")
    state = ends.select("g", named, "lo", "hi", F.lit(0).cast("long").alias("before"), "n").select("g", "r.*", "lo", "hi", "before", "n").where("rank >= 0 and rank < n")
    state = written(state)

    def inside(which: DataFrame) -> DataFrame:
        """The rows of the intervals, each with its interval."""
        spans = which.select(F.col("g").alias("sg"), "lo", "hi").distinct()
        return lookup(rows, spans, (F.col("g") == F.col("sg")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")), "inner", INTERVALS).drop("sg")

    while True:
        large = (F.col("n") > FEW) & (F.col("lo") != F.col("hi"))
        open_ = state.where(large)
        if open_.isEmpty():
            break
        counted = inside(open_).groupBy("g", "lo", "hi", slot(F.col("v"), F.col("lo"), F.col("hi")).alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        slots = counted.groupBy("g", "lo", "hi").agg(F.array_sort(F.collect_list(F.struct("slot", "n", "least", "most"))).alias("slots"))  # SLOTS or 4,400 at most
        kind = f"struct<slot:bigint,n:bigint,least:{rows.schema['v'].dataType.simpleString()},most:{rows.schema['v'].dataType.simpleString()}>"

        def step(a: Column, x: Column) -> Column:
            """Past the slots before the rank's; then the slot stays."""
            found = F.col("rank") < a["before"] + x["n"]
            return F.when(a["hit"].isNotNull(), a).when(found, F.struct(a["before"].alias("before"), x.alias("hit"))).otherwise(F.struct((a["before"] + x["n"]).alias("before"), F.lit(None).cast(kind).alias("hit")))

        start = F.struct(F.col("before"), F.lit(None).cast(kind).alias("hit"))
        hit = open_.drop("n").join(slots, ["g", "lo", "hi"]).select("g", "name", "rank", F.aggregate("slots", start, step).alias("a"))
        moved = hit.select("g", "name", "rank", F.col("a.hit.least").alias("lo"), F.col("a.hit.most").alias("hi"), F.col("a.before").alias("before"), F.col("a.hit.n").alias("n"))
        state = state.where(~large).unionByName(moved).checkpoint()

    known = state.where("lo = hi").select("g", "name", F.col("lo").alias("v"))
    few = state.where("lo != hi")
    lists = inside(few).groupBy("g", "lo", "hi").agg(F.array_sort(F.collect_list("v")).alias("all"))  # FEW at most
    picked = few.join(lists, ["g", "lo", "hi"]).select("g", "name", F.get("all", (F.col("rank") - F.col("before")).cast("int")).alias("v"))
    wide = known.unionByName(picked).groupBy("g").agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name, _ in ranks])
    return wide.select(*[F.col(f"g.{g}").alias(g) for g in groups], *[name for name, _ in ranks])
