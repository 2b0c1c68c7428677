"""Greedy near-duplicate removal by MinHash banding.

A row goes if it meets an already kept row in any band. In order, that keeps the lexicographically first maximal
independent set of the collision graph, which is not one row per connected component. The graph is a union of buckets, so
no pair is ever made: each round, a row that is first among the undecided in all its buckets is kept, and rows
that share a bucket with a kept row go. Rounds are as many as the longest chain of such decisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .selection import checkpoints

#: Tokens of a text that are permuted at once.
SLICE = 4096


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``a * hash + b`` (mod 2**64) over the tokens' hashes, for each permutation (a odd, b)."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        low = np.minimum(low, (a[:, None] * hashes[None, at : at + SLICE] + b[:, None]).min(axis=1))
    return low


def buckets(rows: DataFrame, permutations: int, bands: int, seed: int = 42) -> DataFrame:
    """(ord, bucket), one row per band, of rows (ord, hashes array<long>) that have tokens: each token is hashed once, and its hash is permuted."""
    draw = np.random.default_rng(seed)
    a, b = (draw.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(k) for k in (1, 0))
    schema = T.StructType([rows.schema["ord"], T.StructField("signature", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(h.values.to_numpy().view(np.uint64), a, b).view(np.int64) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["ord", "signature"])

    wide = permutations // bands
    keys = F.array(*[F.xxhash64(F.lit(k), F.slice("signature", k * wide + 1, wide)) for k in range(bands)])
    return rows.select("ord", "hashes").mapInArrow(run, schema).select("ord", F.explode(keys).alias("bucket"))


def greedy(df: DataFrame, text: Column, order: str, permutations: int = 64, bands: int = 4) -> DataFrame:
    """``df`` without the rows that collide with an earlier kept row. ``order`` is unique; rows without tokens all stay."""
    checkpoints(df.sparkSession)
    tokens = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda t: t != ""))
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    rows = df.select(F.col(order).alias("ord"), hashes.alias("hashes")).where(F.size("hashes") > 0)
    entries = buckets(rows, permutations, bands).checkpoint()  # used twice
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("bucket")
    left = entries.join(shared, "bucket", "left_semi").checkpoint()
    gone = None
    while not left.isEmpty():
        firsts = left.groupBy("bucket").agg(F.min("ord").alias("first"))
        marked = left.join(firsts, "bucket")
        kept = marked.groupBy("ord").agg(F.min(F.col("ord") == F.col("first")).alias("kept")).where("kept").select("ord")
        closed = left.join(kept, "ord", "left_semi").select("bucket").distinct()
        dropped = left.join(closed, "bucket", "left_semi").join(kept, "ord", "left_anti").select("ord").distinct().checkpoint()
        gone = dropped if gone is None else gone.union(dropped)
        left = left.join(kept, "ord", "left_anti").join(dropped, "ord", "left_anti").checkpoint()
    return df if gone is None else df.join(gone.select(F.col("ord").alias(order)), order, "left_anti").select(*df.columns)
