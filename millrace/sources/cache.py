"""The response cache: a Parquet table by key, with lookups as joins and upserts as latest-wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import latest

SCHEMA = "cache_key string, prompt string, response string, model string, created_at timestamp"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of each key; an empty cache if there is none yet."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], SCHEMA)
    return latest(spark.read.schema(SCHEMA).parquet(path), ["cache_key"], F.col("created_at"))


def put(entries: DataFrame, path: str) -> None:
    """Adds entries; a key's latest entry counts, so nothing is rewritten."""
    stamped = entries if "created_at" in entries.columns else entries.withColumn("created_at", F.current_timestamp())
    stamped.select("cache_key", "prompt", "response", "model", "created_at").write.mode("append").parquet(path)


def compact(spark: SparkSession, path: str, to: str) -> None:
    """Writes the latest entries alone to another folder."""
    read(spark, path).write.mode("overwrite").parquet(to)


def clear(spark: SparkSession, path: str) -> bool:
    """Removes the cache; whether there was one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
