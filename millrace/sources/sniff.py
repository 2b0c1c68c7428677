"""JSON of any shape: arrays, documents and lines, of flat records, chats, preference pairs or scorecards.

Nobody tells what a file holds. Each line is read as a VARIANT; a file in which half of the lines or more are objects or arrays by themselves is a file of lines, and any
other is one document, read whole. Arrays are taken apart, and so is an object that has its records in an array under one of ``CONTAINERS``. Records are told
apart by their members, and each shape gets the schema that ``schema_of_variant_agg`` merges from all of its records, in one aggregation.

Cases: blank lines and empty files hold nothing; a line or document that is not one JSON value, and an element that is no object, goes to ``bad`` with its file and text; a member with values of
several types stays a VARIANT, one that is always null is a string; numbers with a fraction are doubles; a path without records has no shapes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records
from ..operators.relational import lookup
from ..operators.selection import written

#: Members under which an object may have its records.
CONTAINERS = ("records", "items", "data", "constants", "results")
#: Shapes in the order that they are tried: members that a record of the shape has, and whether they are arrays.
SHAPES = (("scorecard", ("model_name", "overall_accuracy_pct"), False), ("chat", ("messages",), True), ("chat", ("conversations",), True), ("preference", ("prompt", "chosen", "rejected"), False))


@dataclass
class Sniffed:
    """``rows`` has (file, shape, v) and ``bad`` (file, text)."""

    rows: DataFrame
    bad: DataFrame

    def shapes(self) -> DataFrame:
        """Per shape: records, files, and the merged schema."""
        return self.rows.groupBy("shape").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("file").alias("files"), F.schema_of_variant_agg("v").alias("schema"))

    def typed(self, shape: str) -> DataFrame | None:
        """The records of a shape as columns, with their ``file``; None if there are none."""
        of = self.rows.where(F.col("shape") == shape)
        schema = of.agg(F.schema_of_variant_agg("v")).first()[0]
        if schema is None or not schema.startswith("OBJECT<"):
            return None
        return of.select("file", F.try_variant_get("v", "$", ddl(schema)).alias("r")).select("r.*", F.col("file").alias("_file")).withColumnRenamed("_file", "file")

    def viewer(self, system: str) -> DataFrame | None:
        """Records, chats and pairs as viewer rows."""
        out = None
        for shape in ("flat", "chat", "preference"):
            rows = self.typed(shape)
            if rows is not None:
                rows = rows if "id" in rows.columns else rows.withColumn("id", F.lit(None).cast("string"))
                shown = records.viewer_rows(rows.withColumn("id", F.col("id").cast("string")), system)
                out = shown if out is None else out.unionByName(shown)
        return out


def ddl(schema: str) -> str:
    """The schema of a variant as a type that it can be cast to."""
    named = re.sub(r"(^|: |ARRAY<)OBJECT<>", r"\1VARIANT", schema)
    named = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", named)
    return re.sub(r"(: |ARRAY<)DECIMAL\(\d+, ?\d+\)", r"\1DOUBLE", re.sub(r"(: |ARRAY<)VOID\b", r"\1STRING", named))


def parsed(text: Column) -> Column:
    """The one JSON value that a text is, as a variant; null if it is none or goes on behind it (a parser of its own would not mind)."""
    inside = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(inside) == 1, F.get(inside, F.lit(0)))


def kind(v: Column) -> Column:
    """object, array, or other; null for what is no JSON."""
    said = F.schema_of_variant(v)
    return F.when(said.startswith("OBJECT<"), "object").when(said.startswith("ARRAY<"), "array").when(v.isNotNull(), "other")


def member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def shape_of(v: Column) -> Column:
    out = F.lit("flat")
    for shape, names, arrays in reversed(SHAPES):
        has = F.lit(True)
        for name in names:
            has = has & (F.coalesce(kind(member(v, name)) == "array", F.lit(False)) if arrays else member(v, name).isNotNull())
        out = F.when(has, shape).otherwise(out)
    return out


def elements(found: DataFrame) -> DataFrame:
    """(file, text, v) with arrays, and records in containers, taken apart."""
    inner = F.lit(None).cast("array<variant>")
    for name in reversed(CONTAINERS):
        inner = F.when(kind(member(F.col("v"), name)) == "array", F.try_variant_get("v", f"$.{name}", "array<variant>")).otherwise(inner)
    plain = (shape_of(F.col("v")) == "flat") & (kind(F.col("v")) == "object")
    several = F.when(kind(F.col("v")) == "array", F.try_variant_get("v", "$", "array<variant>")).when(plain, inner)
    return found.select("file", "text", F.explode(F.coalesce(several, F.array("v"))).alias("v"))


def read_any(spark: SparkSession, path: str | list[str]) -> Sniffed:
    """All records under a path, whatever shape its files have."""
    read = lambda where, whole: spark.read.option("recursiveFileLookup", "true").text(where, wholetext=whole).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")).where(F.trim("text") != "")
    lines = read(path, False).withColumn("v", parsed(F.col("text")))
    files = written(lines.groupBy("file").agg((F.count_if(kind(F.col("v")).isin("object", "array")) * 2 >= F.count(F.lit(1))).alias("lines")))
    whole = [r["file"] for r in files.where("not lines").select("file").collect()]  # names of files, as Spark lists them
    by_line = lookup(lines, files.where("lines").select("file"), ["file"], "left_semi")
    found = by_line.select("file", "text", "v")
    if whole:
        found = found.unionByName(read(whole, True).withColumn("v", parsed(F.col("text"))))
    items = elements(found).withColumn("kind", kind(F.col("v")))
    good = items.where("kind = 'object'").select("file", shape_of(F.col("v")).alias("shape"), "v")
    bad = items.where("kind is null or kind != 'object'").select("file", F.coalesce(F.when(F.col("v").isNotNull(), F.to_json("v")), "text").alias("text"))
    return Sniffed(good, bad)
