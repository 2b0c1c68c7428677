"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a Java character class body.
WS = r"\x20\x09-\x0D"
#: Most rows that a side may have to be broadcast; 16 million longs are about 256 MB, so stay well below.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a session in one process (master ``local``, as in tests) gets a folder of its own where none is set; on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = current.get() if current.isDefined() else None
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: lineage ends there and no recomputation follows a lost executor.

    The table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Smaller Arrow batches, by rows and by bytes: texts can be long, and a batch has to fit a worker.

    Spark reads both settings when a plan runs, and operators return plans that run later, so they stay set for the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 32 << 20)


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """Joins with a broadcast of ``right`` if it has at most ``most`` rows (counted first), else by a shuffle."""
    few = right.limit(most + 1).count() <= most
    return left.join(F.broadcast(right) if few else right, list(on), how)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only. The cheap built-in serves texts that are all ASCII."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WS}]+"), lambda w: w != "")
