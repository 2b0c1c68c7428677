"""Grading as a stream: new responses are graded as they land, with a checkpoint from which a run resumes.

Each micro-batch appends its grades under its number, so a batch that runs again after a failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.grading import graded

RESPONSES = "id string, model string, task string, format string, difficulty string, correct_option_key string, ground_truth_answer string, response string, latency double, created timestamp"


def responses(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """A stream of responses from JSON lines that land in a folder."""
    return spark.readStream.schema(RESPONSES).option("maxFilesPerTrigger", files).json(path)


def grade_stream(stream: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Grades what arrives; ``once`` stops when all that has landed is done."""

    def write(batch: DataFrame, number: int) -> None:
        graded(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def completed(spark: SparkSession, out: str) -> DataFrame:
    """The latest grade of each model's item."""
    from ..operators.relational import latest

    return latest(spark.read.parquet(out).drop("batch"), ["model", "id"], F.col("created"))


def windowed_accuracy(stream: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Accuracy of a stream (created, model, passed) per model and window; rows later than ``late`` are left out."""
    return stream.withWatermark("created", late).groupBy(F.window("created", width), "model").agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.round(100.0 * F.count_if("passed") / F.count(F.lit(1)), 2).alias("accuracy_pct"))
