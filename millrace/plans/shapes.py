"""Queries that write tables as JSON of several shapes and read them back without being told which."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import selection
from ..sources import sniff
from ._base import query, table

#: Documents of a file that is one array.
BLOCK = 400


def in_four_shapes(spark: SparkSession, sf_dir: str) -> str:
    """Documents by ``doc_id % 4`` as flat lines (some broken), arrays over several lines, chat lines and scorecards in an object; the folder's path."""
    path, d = selection.shared_path(spark), table(spark, sf_dir, "documents")
    of = lambda k: d.where(F.col("doc_id") % 4 == k)
    block = F.floor(F.col("doc_id") / BLOCK).alias("block")

    def array(rows: DataFrame, record: Column, head: str, tail: str, to: str) -> None:
        text = F.concat(F.lit(head), F.array_join(F.collect_list(F.to_json(record)), ",\n  "), F.lit(tail))  # BLOCK documents at most
        rows.groupBy(block).agg(text.alias("value")).write.partitionBy("block").text(f"{path}/{to}")

    line = F.to_json(F.struct("doc_id", "lang", "text", (F.col("n_chars") / 2).alias("half")))
    broken = F.when(F.col("doc_id") % 40 == 0, F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(", ")))
    of(0).select(F.explode(F.array_compact(F.array(line, broken))).alias("value")).write.text(f"{path}/flat")
    array(of(1), F.struct("doc_id", "text", F.struct("lang", "source").alias("meta")), "[\n  ", "\n]\n", "arrays")
    turns = F.array(F.struct(F.lit("user").alias("role"), F.col("lang").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content")))
    of(2).select(F.to_json(F.struct(F.col("doc_id").alias("id"), turns.alias("messages"))).alias("value")).write.text(f"{path}/chat")
    array(of(3), F.struct(F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("model_name"), F.col("n_chars").alias("overall_accuracy_pct"), F.sha2("text", 256).alias("digest")), '{\n  "items": [\n  ', "\n]}\n", "cards")
    return path


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN 'chat' WHEN 3 THEN 'scorecard' ELSE 'flat' END AS shape, sha256(coalesce(text, '')) AS digest, CASE WHEN doc_id % 4 < 3 THEN lang END AS lang FROM documents
UNION ALL SELECT doc_id, 'bad', NULL, NULL FROM documents WHERE doc_id % 40 = 0""")
def sniffed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sniff.read_any(spark, in_four_shapes(spark, sf_dir))
    flat, chat, cards = (found.typed(s) for s in ("flat", "chat", "scorecard"))
    digest = lambda c: F.sha2(F.coalesce(c, F.lit("")), 256).alias("digest")
    out = flat.select("doc_id", F.lit("flat").alias("shape"), digest(F.col("text")), F.coalesce("lang", "meta.lang").alias("lang"))
    out = out.unionByName(chat.select(F.col("id").alias("doc_id"), F.lit("chat").alias("shape"), digest(F.get("messages", F.lit(1))["content"]), F.get("messages", F.lit(0))["content"].alias("lang")))
    out = out.unionByName(cards.select(F.substring("model_name", 2, 99).cast("long").alias("doc_id"), F.lit("scorecard").alias("shape"), "digest", F.lit(None).cast("string").alias("lang")))
    none = F.lit(None).cast("string")
    return out.unionByName(found.bad.select(F.regexp_extract("text", r"(\d+)", 1).cast("long").alias("doc_id"), F.lit("bad").alias("shape"), none.alias("digest"), none.alias("lang")))


@query("SELECT CASE doc_id % 4 WHEN 2 THEN 'chat' WHEN 3 THEN 'scorecard' ELSE 'flat' END AS shape, count(*) AS records FROM documents GROUP BY 1")
def sniffed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sniff.read_any(spark, in_four_shapes(spark, sf_dir)).shapes().select("shape", "records")
