"""JSON and JSONL sources and sinks, manifests and packages."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines; a bad line fails the read, or is left out."""
    return spark.read.json(path, schema=schema, mode="FAILFAST" if strict else "DROPMALFORMED")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.json(path, schema=schema, multiLine=True)


def read_splits(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All JSONL files of a folder with the split that their names tell."""
    name = F.lower(F.col("_metadata.file_name"))
    parent = F.lower(F.regexp_extract(F.col("_metadata.file_path"), r"split=([a-z]+)/", 1))
    split = F.when(parent != "", parent).when(name.contains("val"), "val").when(name.contains("test"), "test").when(name.contains("dpo") | name.contains("preference"), "dpo").otherwise("train")
    return spark.read.option("recursiveFileLookup", "true").json(path, schema=schema).withColumn("split", split)


def read_scorecards(spark: SparkSession, path: str, schema: T.StructType | str, exclude: Iterable[str] = ("manifest.json", "dataset_stats.json")) -> DataFrame:
    """JSON documents of a folder that look like scorecards (a model and an overall figure), by file name."""
    out = spark.read.json(path, schema=schema, multiLine=True, pathGlobFilter="*.json").withColumn("file", F.col("_metadata.file_name"))
    return out.where(~F.col("file").isin(*exclude) & F.col("model_name").isNotNull() & F.col("overall_accuracy_pct").isNotNull()).orderBy("file")


def write_jsonl(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    """JSON lines, in one folder per value of ``by``."""
    df.write.mode("overwrite").partitionBy(*by).json(path)


#: Exports of a split dataset: name, column that parts it, condition.
EXPORTS = (("by_persona", "persona", None), ("by_persona_train", "persona", "split = 'train'"), ("by_archetype", "archetype", None), ("by_category", "category", None))
#: Tasks over which one destination's rows are dealt.
DEAL = 16


def fanned(records: DataFrame, exports: Iterable[tuple[str, str, str | None]] = EXPORTS) -> DataFrame:
    """Each record once for every destination (export, key) that it goes to, in one pass; a null key goes to no file of its export."""
    to = [F.when(F.expr(where or "true") & F.col(column).isNotNull(), F.struct(F.lit(name).alias("export"), F.col(column).cast("string").alias("key"))) for name, column, where in exports]
    return records.withColumn("_to", F.explode(F.filter(F.array(*to), lambda x: x.isNotNull()))).select("*", "_to.export", "_to.key").drop("_to")


def write_partitions(records: DataFrame, path: str, exports: Iterable[tuple[str, str, str | None]] = EXPORTS) -> dict[str, int]:
    """The partitioned exports as JSON lines, one folder for each export and key, by one scan, one shuffle and one write.

    Returns counters of the same pass: ``records`` read and, by export, the rows written. A frequent key's rows are dealt over ``DEAL`` tasks.
    """
    exports = list(exports)
    read, wrote = Observation(f"read-{uuid.uuid4().hex}"), Observation(f"wrote-{uuid.uuid4().hex}")
    rows = fanned(records.observe(read, F.count(F.lit(1)).alias("records")), exports)
    rows = rows.observe(wrote, *[F.count_if(F.col("export") == name).alias(name) for name, _, _ in exports])
    dealt = rows.repartition("export", "key", F.pmod(F.xxhash64("id"), F.lit(DEAL)))
    dealt.write.mode("overwrite").partitionBy("export", "key").json(path)
    return {**read.get, **wrote.get}


def read_partitions(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """What ``write_partitions`` wrote, with ``export`` and ``key``, both strings."""
    whole = T.StructType([*(schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fields, T.StructField("export", T.StringType()), T.StructField("key", T.StringType())])
    return spark.read.json(path, schema=whole)


def openai(record: Column, system: str) -> Column:
    """Chat messages of a record struct (user_query, ground_truth_answer)."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", record["user_query"]), turn("assistant", record["ground_truth_answer"]))


def sharegpt(record: Column, system: str) -> Column:
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    return F.array(turn("system", F.lit(system)), turn("human", record["user_query"]), turn("gpt", record["ground_truth_answer"]))


def files(spark: SparkSession, path: str, include: list[str], exclude: list[str]) -> DataFrame:
    """Files under a path that the patterns choose: relative path, label, bytes, content, and sort rank."""
    root = path.rstrip("/")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rel = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^" + text.glob_regex(root + "/")[1:-1], "")
    rows = raw.select(rel.alias("relative_path"), F.col("length").alias("byte_size"), "content").where(text.included(F.col("relative_path"), include, exclude))
    rank = F.when(~F.col("relative_path").contains("/"), 0).when(F.col("relative_path").startswith("benchmark/"), 1).otherwise(2)
    return rows.withColumns({"label": text.file_label(F.col("relative_path")), "rank": rank})


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per file: relative_path, record_count (lines that are not blank), byte_size and sha256, by path."""
    raw = files(spark, path, ["*"], ["_SUCCESS", "*.crc"])
    lines = F.size(F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: F.trim(x) != "")).cast("long")
    return raw.select("relative_path", lines.alias("record_count"), "byte_size", F.sha2("content", 256).alias("sha256")).orderBy("relative_path")
