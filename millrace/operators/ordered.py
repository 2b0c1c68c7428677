"""Neighbours and streaks in an order, without a window over a group: rows are dealt by ranges, and ranges meet by their ends.

Neighbours: a range's rows see the next one of their range; the last sees the first row of the next range, of which there is one per range. Streaks: a run of answers
comes down to four numbers - its length, the right answers at its start and its end, and its best streak - and two runs that follow each other to those
of both, so a player's answers may lie in any number of ranges. The same summary is the state of a stream.

Cases: the order should be unique, rows that tie are neighbours in any order; null members of a group are equal; an answer that is null is wrong; the last row of a group has no next; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .selection import written


def ranges_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_next(df: DataFrame, order: Sequence[str], carry: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``next``: a struct of ``carry`` of the row that follows in the order of its group, null for the last."""
    keys = [*groups, *order]
    ranged = written(df.repartitionByRange(ranges_of(df), *keys).withColumn("_range", F.spark_partition_id()))
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.struct(*carry).alias("carry"))
    starts = ranged.groupBy("_range").agg(F.min_by(row, F.struct(*keys)).alias("first"))
    after = starts.select("_range", F.lead("first").over(Window.orderBy("_range")).alias("_first"))  # a row per range
    inside = F.lead(row).over(Window.partitionBy("_range").orderBy(*keys))
    both = ranged.withColumn("_next", inside).join(F.broadcast(after), "_range").withColumn("_next", F.coalesce("_next", "_first"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(f"_next.k{i}").eqNullSafe(F.col(g))
    return both.select(*df.columns, F.when(F.col("_next").isNotNull() & same, F.col("_next.carry")).alias("next"))


def summary(right: np.ndarray) -> tuple[int, int, int, int, int]:
    """length, prefix, suffix, best and rights of a run of answers."""
    n = len(right)
    wrong = np.flatnonzero(~right)
    if not len(wrong):
        return n, n, n, n, n
    gaps = np.diff(np.concatenate([[-1], wrong, [n]])) - 1
    return n, int(gaps[0]), int(gaps[-1]), int(gaps.max()), n - len(wrong)


def combined(a: tuple, b: tuple) -> tuple[int, int, int, int, int]:
    """The summary of two runs, one behind the other."""
    return a[0] + b[0], a[1] + b[1] if a[1] == a[0] else a[1], b[2] + a[2] if b[2] == b[0] else b[2], max(a[3], b[3], a[2] + b[1]), a[4] + b[4]


RUN = "length long, prefix long, suffix long, best long, rights long"


def runs(df: DataFrame, player: str, order: Sequence[str], right: Column) -> DataFrame:
    """(player, range, and the summary) of each player's answers in each range."""
    schema = T.StructType([df.schema[player], T.StructField("range", T.IntegerType()), *T._parse_datatype_string(RUN).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Answers come in order; a player's last run goes on in the next batch."""
        where, held, name = TaskContext.get().partitionId(), None, None
        for batch in batches:
            who = batch.column(0)
            code = who.dictionary_encode(null_encoding="encode").indices.to_numpy()
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
            told, out = batch.column(1).to_numpy(zero_copy_only=False), []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                own, player_ = summary(told[a:b]), who[a].as_py()
                if held is not None and player_ == name:
                    held = combined(held, own)
                else:
                    if held is not None:
                        out.append((name, held))
                    held, name = own, player_
            if out:
                yield rows_of(out, who.type, where)
        if held is not None:
            yield rows_of([(name, held)], who.type, where)

    def rows_of(out: list[tuple], kind: pa.DataType, where: int) -> pa.RecordBatch:
        cols = [pa.array([p for p, _ in out], kind), pa.array([where] * len(out), pa.int32()), *[pa.array([r[k] for _, r in out], pa.int64()) for k in range(5)]]
        return pa.RecordBatch.from_arrays(cols, names=[player, "range", *[f.split()[0] for f in RUN.split(", ")]])

    rows = df.select(player, *order, F.coalesce(right, F.lit(False)).alias("_right"))
    ranged = rows.repartitionByRange(ranges_of(df), player, *order).sortWithinPartitions(player, *order)
    return ranged.select(player, "_right").mapInArrow(run, schema)


def best_streaks(df: DataFrame, player: str, order: Sequence[str], right: Column) -> DataFrame:
    """Per player: answers, rights and the longest streak of right answers."""
    each = F.array_sort(F.collect_list(F.struct("range", *[f.split()[0] for f in RUN.split(", ")])))  # one for each range that has the player
    grouped = runs(df, player, order, right).groupBy(player).agg(each.alias("runs"))
    zero = F.struct(*[F.lit(0).cast("long").alias(f.split()[0]) for f in RUN.split(", ")])

    def merge(a: Column, b: Column) -> Column:
        prefix = F.when(a["prefix"] == a["length"], a["length"] + b["prefix"]).otherwise(a["prefix"])
        suffix = F.when(b["suffix"] == b["length"], a["suffix"] + b["length"]).otherwise(b["suffix"])
        best = F.greatest(a["best"], b["best"], a["suffix"] + b["prefix"])
        return F.struct((a["length"] + b["length"]).alias("length"), prefix.alias("prefix"), suffix.alias("suffix"), best.alias("best"), (a["rights"] + b["rights"]).alias("rights"))

    total = grouped.select(player, F.aggregate("runs", zero, merge).alias("t"))
    return total.select(player, F.col("t.length").alias("answers"), F.col("t.rights").alias("rights"), F.col("t.best").alias("best_streak"))


class StreakState(StatefulProcessor):
    """A player's summary so far; the answers of a batch are taken in their order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", RUN)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        all_ = pd.concat(list(rows)).sort_values("place", kind="stable")
        own = summary(all_["right"].to_numpy(bool))
        if self.state.exists():
            own = combined(tuple(self.state.get()), own)
        self.state.update(own)
        yield pd.DataFrame({"player": [key[0]], "answers": [own[0]], "rights": [own[4]], "best_streak": [own[3]], "streak": [own[2]]})

    def close(self) -> None:
        pass


def streak_stream(stream: DataFrame, player: str, order: str, right: Column) -> DataFrame:
    """A stream of (player, answers, rights, best_streak, streak), a row for each player that a batch brings answers of.

    Batches follow each other in the players' order. State is kept by RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    kind = stream.schema[player].dataType.simpleString()
    rows = stream.select(F.col(player).alias("player"), F.col(order).alias("place"), F.coalesce(right, F.lit(False)).alias("right"))
    return rows.groupBy("player").transformWithStateInPandas(StreakState(), f"player {kind}, answers long, rights long, best_streak long, streak long", "Update", "None")
