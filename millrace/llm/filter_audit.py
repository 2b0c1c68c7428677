"""Audit of how filters act together, in every order that they can be applied in.

Method: a product of incidence matrices. A document is the set of filters that it fails, a mask of five bits, and all that an order of
filters does to it depends on its mask alone. So a part is three histograms over the 32 masks: of all its documents, of its good ones and of its toxic
ones. Stacked as rows, these are multiplied by integer matrices of 32 x 600 (a row a mask, a column an order and a step): 1 where a
document of the mask is kept after the step, removed there, redundant there, or fails nothing but the step's filter. A product with a 600 x 5 matrix, which
sums a filter's removals over the orders, gives its Shapley numerator. Histograms are counted in two levels by Spark, at most 32 rows a part
reach a task, and the matrices are the same for all.

The filters' conditions are native expressions. Of equal texts, the rows of the smallest id pass the filter of copies and all others fail it. These rows are
found by a partial minimum per text and a join on text *and* id, so a text that a third of all rows share is no frequent key.

Cases: a null text is empty; null and empty values of the part column are one part; a row with a null id is no copy and has no copies; rows that repeat id and text pass
the filter of copies together and count each; a document is good (toxic) if any label of its id says so, labels without an id or value say nothing; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import checked_join, let, stash, words_of

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MASKS, STEPS = 1 << len(FILTERS), len(FILTERS)
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTCOMES)
#: Upper-case letters are counted by what their removal takes away.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fails(text: Column) -> Column:
    """The bits of A to D for a text that is not null."""

    def bits(words: Column) -> Column:
        few = F.size(words) < 50
        repeats = F.size(F.array_distinct(words)) * F.lit(100) < F.size(words) * F.lit(65)
        return F.when(few, 1).otherwise(0) + F.when(repeats, 2).otherwise(0)

    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    shouts = capitals.cast("long") * 100 > F.length(text).cast("long") * 5
    return let(words_of(text), bits) + F.when(shouts, 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, good, toxic) per row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"), fails(text).cast("int").alias("mask"))
    rows = stash(rows, "masks")
    firsts = rows.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("doc_id is not null")
    told = told.groupBy("doc_id").agg(*[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("good", "toxic")])
    out = checked_join(rows.join(firsts, ["sha", "doc_id"], "left"), told, ["doc_id"], "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return out.select("part", (F.col("mask") + copy).cast("int").alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def histograms(found: DataFrame) -> DataFrame:
    """Per part: an array of (mask, n, good, toxic), 32 at most."""
    cells = found.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def incidence() -> tuple[np.ndarray, np.ndarray]:
    """Four matrices of 32 x 600, 0 or 1 (kept, removed, redundant, unique), and one of 600 x 5, 1 where a column's filter is the row's."""
    columns = [(order, step) for order in ORDERS for step in range(STEPS)]
    own = np.array([1 << FILTERS.index(order[step]) for order, step in columns])
    before = np.array([sum(1 << FILTERS.index(c) for c in order[:step]) for order, step in columns])
    mask = np.arange(MASKS)[:, None]
    hit, earlier = (mask & own) != 0, (mask & before) != 0
    outcomes = np.stack([~hit & ~earlier, hit & ~earlier, hit & earlier, mask == own]).astype(np.int64)
    return outcomes, (own[:, None] == 1 << np.arange(STEPS)).astype(np.int64)


def multiplied(parts: DataFrame) -> DataFrame:
    """The report of ``parts`` (part, cells): 600 rows for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (kept, removed, redundant, unique), by_filter = incidence()
        orders, steps = np.repeat(ORDERS, STEPS), np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                few = batch.slice(at, 100)
                stacked = np.zeros((3, few.num_rows, MASKS), np.int64)
                for k, cells in enumerate(few.column(1).to_pylist()):
                    for c in cells:
                        stacked[:, k, c["mask"]] = c["n"], c["good"], c["toxic"]
                every, good, toxic = stacked
                lost = every @ removed
                shapley = (lost @ by_filter) @ by_filter.T
                columns = [every @ kept, lost, every @ redundant, every @ unique, good @ removed, toxic @ removed, shapley]
                names = few.column(0).take(pa.array(np.repeat(np.arange(few.num_rows), len(orders))))
                cols = [names, pa.array(np.tile(orders, few.num_rows)), pa.array(np.tile(steps, few.num_rows)), *[pa.array(c.reshape(-1)) for c in columns]]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "filter_order", "step", *OUTCOMES])

    return parts.mapInArrow(run, REPORT)


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order of the five filters and step, with what the step keeps, removes, finds removed already, and loses."""
    return multiplied(histograms(masks(docs, labels, part_col, id_col, text_col)))
