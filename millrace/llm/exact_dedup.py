"""Exact deduplication by content hash.

Method: rows are grouped by a 128-bit content hash; inside groups of two or more the bytes themselves are
compared, so a hash collision never merges different texts. Native DataFrame operations throughout.

Only narrow rows (id and hashes) of the whole table are shuffled. Texts are shuffled for groups of two or more
alone, after a map-side partial aggregation by text, so a group with a third of all rows is one row per task.

Cases: a null text equals an empty one; a null id never becomes the kept id unless the whole group has none, in
which case every row of that group has ``keep_id`` null and ``kept`` true; rows repeated with the kept id are all kept;
an empty table gives an empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, ascii_lower, checked_join, stash


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256. ``keep``: "min" or "max" id of a group stays."""
    best = {"min": F.min, "max": F.max}[keep]
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    narrow = stash(rows.select("doc_id", F.unhex(F.md5("norm")).alias("h128"), F.sha2("norm", 256).alias("sha")), "exact")
    out = checked_join(narrow, classes_of(rows, narrow, best), ["h128", "sha"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == keep_id, keep_id.isNull()).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def classes_of(rows: DataFrame, narrow: DataFrame, best) -> DataFrame:
    """(h128, sha, keep_id, group_size) of the texts that stand in two rows or more; ``sha`` tells texts apart whose bytes differ under one ``h128``."""
    groups = stash(narrow.groupBy("h128").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h128"), "groups")
    again = checked_join(rows.withColumn("h128", F.unhex(F.md5("norm"))), groups, ["h128"], "left_semi")
    equal = again.groupBy("h128", "norm").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return stash(equal.select("h128", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"), "classes")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """``docs`` without the rows that repeat another id's text; columns as they were.

    A row goes by its id and its text, so an id with several texts loses only those that are copies.
    """
    found = find_copies(docs, id_col, text_col, keep).where(~F.col("kept"))
    gone = stash(found.select("doc_id", "text_sha256").distinct(), "gone").toDF("id", "sha")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    norm = ascii_lower(F.coalesce(F.col(f"d.{text_col}"), F.lit("")))
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("g.id")) & (F.sha2(norm, 256) == F.col("g.sha"))
    return docs.alias("d").join((F.broadcast(gone) if few else gone).alias("g"), same, "left_anti").select(*docs.columns)
