"""Scorecards as a stream: a source that sees cards which change in place, and a table with the latest of each model.

The source's offset says for each file when it was last changed and how long it is, so a card is read again when it has changed and only then. A batch that runs again after a
failure writes the same version of the table anew. Files are reached through Arrow's file systems (local paths and the stores that Arrow knows).

Cases: a file that is no scorecard, or is being written and no JSON yet, is left for its next change; a file that goes leaves its row; of several cards of a model in a batch the
one changed last counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ..operators import relational

SCHEMA = "model_name string, overall_accuracy_pct double, total long, passed long, card string, file string, changed long"
#: JSON files of a scorecard folder that are no scorecards.
OTHERS = ("manifest.json", "dataset_stats.json")


class CardReader(SimpleDataSourceStreamReader):
    """Scorecards are few and small, one per model, so the driver reads them."""

    def __init__(self, options: dict):
        from pyarrow import fs

        path = options["path"]
        self.store, self.root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")

    def initialOffset(self) -> dict:
        return {}

    def now(self) -> dict:
        """Each file's time of change (ns) and size."""
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        return {f.path: [f.mtime_ns or 0, f.size] for f in found if f.is_file and f.base_name.endswith(".json") and f.base_name not in OTHERS and not f.base_name.startswith(("_", "."))}

    def cards(self, start: dict, end: dict) -> Iterator[tuple]:
        for path, mark in sorted(end.items()):
            if start.get(path) == mark:
                continue
            try:
                with self.store.open_input_stream(path) as f:
                    card = json.loads(f.read())
                yield (card["model_name"], float(card["overall_accuracy_pct"]), card.get("total"), card.get("passed"), json.dumps(card, sort_keys=True), path, mark[0])
            except (FileNotFoundError, ValueError, KeyError, TypeError):
                continue

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = self.now()
        return iter(list(self.cards(start, end))), end  # Spark copies the iterator

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self.cards(start, end)

    def commit(self, end: dict) -> None:
        pass


class Scorecards(DataSource):
    """``spark.readStream.format("scorecards").load(folder)`` after ``spark.dataSource.register(Scorecards)``."""

    @classmethod
    def name(cls) -> str:
        return "scorecards"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> CardReader:
        return CardReader(self.options)


def latest_version(spark: SparkSession, out: str, before: int | None = None) -> int | None:
    """The newest whole version of the table, of those before one if that is said."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = make(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(make(f"{out}/version=*/_SUCCESS"))
    numbers = [int(f.getPath().getParent().getName().split("=")[1]) for f in found or []]
    return max((n for n in numbers if before is None or n < before), default=None)


def table(spark: SparkSession, out: str) -> DataFrame:
    """The latest card of each model."""
    n = latest_version(spark, out)
    return spark.createDataFrame([], SCHEMA) if n is None else spark.read.schema(SCHEMA).parquet(f"{out}/version={n}")


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keeps the table at ``out`` up to the folder's cards. Version ``n`` is made of the version before it and batch ``n``, whole or not at all."""
    spark.dataSource.register(Scorecards)

    def write(batch: DataFrame, number: int) -> None:
        before = latest_version(spark, out, number)
        new = relational.latest(batch, ["model_name"], F.struct("changed", "file"))
        old = spark.createDataFrame([], SCHEMA) if before is None else spark.read.schema(SCHEMA).parquet(f"{out}/version={before}")
        relational.upsert(old, new.select(*old.columns), ["model_name"]).coalesce(1).write.mode("overwrite").parquet(f"{out}/version={number}")

    writer = spark.readStream.format("scorecards").load(folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


__all__ = ["Scorecards", "follow", "latest_version", "table"]
