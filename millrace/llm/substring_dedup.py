"""Removal of passages that repeat anywhere in the corpus.

Method: FM-indexes over shards, each a wavelet matrix of the shard's Burrows-Wheeler transform; backward search gives the
matching statistics of the texts streamed through it, and intervals at the threshold are reported.

Texts are dealt to shards so that equal windows meet in one shard and no text has to visit every shard. Each window of
``length`` words has a minimizer: its ``k`` words with the smallest hash. Consecutive windows with the same
minimizer form a segment, and segments are dealt by the minimizer's hash; equal windows have equal minimizers. Segments whose
minimizer stands nowhere else hold no repeated window and go no further. Equal segments are counted, not moved:
if there are several, all their windows repeat. Only distinct segments that share a minimizer with others are put into a shard's index and streamed through it.

A window is in exactly one segment, so an occurrence in the index is an occurrence in the corpus.

Cases: a null text has no words; rows with equal or null ids are told apart by their text; a repeated row counts as a
repeat; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_batches, stash
from ._words import hashed_words, mix, word_hashes
from .fm_index import FMIndex

SEGMENT = "doc_id long, d long, start long, len int, m long, c long"
#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
#: Bits of a sort key that hold a word's place in its batch.
PLACE = 28
#: Distinct segments in a shard, on average.
SHARD = 16_000
#: Integers in all removal lists together that may be broadcast.
BROADCAST_INTS = 3_000_000


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def segments_of(words: np.ndarray, sizes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Segments of the windows of documents that stand one after another: document number, start in the document, words, minimizer hash, content hash."""
    n, width = len(words), length - k + 1
    first = np.concatenate([[0], np.cumsum(sizes)])
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    forward, back = powers(BASE, n), powers(INVERSE, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * forward[:n], dtype=np.uint64)])
    grams = mix((sums[k:] - sums[:-k]) * back[: n - k + 1])
    key = (grams >> np.uint64(PLACE)) << np.uint64(PLACE) | np.arange(len(grams), dtype=np.uint64)
    least, span = key, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    start = np.arange(len(least))
    valid = start + length <= first[doc + 1]
    doc, start = doc[valid], start[valid]
    place = (least[valid] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    if not len(start):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])]))
    last = np.concatenate([new[1:], [len(start)]]) - 1
    a, b = start[new], start[last] + length
    content = mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
    return doc[new], a - first[doc[new]], b - a, grams[place[new]], content


def segments(docs: DataFrame, length: int, k: int) -> DataFrame:
    """Segments of rows (doc_id, text bytes, d)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_hashes() as cache:
            for batch in batches:
                ids, ds = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
                nulls = np.array(batch.column(0).is_null())
                held: list[tuple[int, np.ndarray]] = []
                total = 0

                def flush() -> pa.RecordBatch:
                    rows = np.array([i for i, _ in held], np.int64)
                    doc, start, size, m, c = segments_of(np.concatenate([w for _, w in held]), np.array([len(w) for _, w in held]), length, k)
                    row = rows[doc]
                    names = pa.array(ids[row].astype(np.int64) if not nulls.any() else [None if nulls[r] else int(ids[r]) for r in row], pa.int64())
                    return pa.RecordBatch.from_arrays([names, pa.array(ds[row].astype(np.int64)), pa.array(start), pa.array(size.astype(np.int32)), pa.array(m.view(np.int64)), pa.array(c.view(np.int64))], names=["doc_id", "d", "start", "len", "m", "c"])

                for i, text in enumerate(batch.column(1)):
                    w = hashed_words(text.as_py() or b"", cache)
                    if len(w) >= length:
                        held.append((i, w))
                        total += len(w)
                    if total > 500_000:
                        yield flush()
                        held, total = [], 0
                if held:
                    yield flush()

    return docs.mapInArrow(run, SEGMENT)


def contents(docs: DataFrame, where: DataFrame) -> DataFrame:
    """(m, c, words): word hashes, little-endian, of the segments that ``where`` (doc_id, d, parts) asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_hashes() as cache:
            for batch in batches:
                m, c, out = [], [], []
                for text, parts in zip(batch.column(0), batch.column(1)):
                    w = hashed_words(text.as_py() or b"", cache)
                    for p in parts.as_py():
                        m.append(p["m"])
                        c.append(p["c"])
                        out.append(w[p["start"] : p["start"] + p["len"]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(c, pa.int64()), pa.array(out, pa.binary())], names=["m", "c", "words"])

    return docs.join(where, (docs.doc_id.eqNullSafe(where.doc_id)) & (docs.d == where.d)).select(docs.text, where.parts).mapInArrow(run, "m long, c long, words binary")


def covered(rows: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, list[int]]]:
    """Of a shard's distinct segments: (m, c, bounds of the words that lie in windows occurring twice or more)."""
    parts = [np.frombuffer(w, np.uint64) for _, _, w in rows]
    _, symbols = np.unique(np.concatenate(parts), return_inverse=True)
    size = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.zeros(begin[-1], np.int64)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    text[inside] = symbols + 1
    index = FMIndex(text, length)
    windows = np.maximum(size - length + 1, 0)
    owner = np.repeat(np.arange(len(rows)), windows)
    ends = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[owner] + length
    hit = np.flatnonzero(index.matching_statistics(text, ends, length) >= length)
    out, bounds = [], {}
    for row, end in zip(owner[hit].tolist(), (ends[hit] - begin[owner[hit]]).tolist()):
        b = bounds.setdefault(row, [])
        if b and end - length <= b[-1]:
            b[-1] = end
        else:
            b += [end - length, end]
    for row, b in bounds.items():
        out.append((rows[row][0], rows[row][1], b))
    return out


def repeated(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(doc_id, d, bounds): for rows (doc_id, text, d) with repeated windows, the words to go as [start, end, start, end, ...]."""
    found = stash(segments(docs, length, k), "segments")
    shared = found.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m")
    shared = stash(shared, "minimizers")  # a table, not an aggregate, so that the join may split a hot minimizer's rows
    found = stash(found.join(shared, "m", "left_semi"), "shared")
    kinds = found.groupBy("m", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "d", "start", "len")).alias("at"))
    kinds = stash(kinds, "kinds")
    several = kinds.groupBy("m").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("m")
    mixed = stash(kinds.join(several, "m", "left_semi"), "mixed")
    where = mixed.select("m", "c", "at.*").groupBy("doc_id", "d").agg(F.collect_list(F.struct("m", "c", "start", "len")).alias("parts"))
    shards = max(1, -(-mixed.count() // SHARD))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        for batch in batches:
            rows += list(zip(*[batch.column(j).to_pylist() for j in range(3)]))
        if rows:
            hits = covered(rows, length)
            m, c, bounds = zip(*hits) if hits else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(c, pa.int64()), pa.array(bounds, pa.list_(pa.int32()))], names=["m", "c", "bounds"])

    found_in = stash(contents(docs, where).repartition(shards, "m").mapInArrow(search, "m long, c long, bounds array<int>"), "covered")
    full = kinds.where("n > 1").select("m", "c", F.array(F.lit(0), F.col("at.len")).alias("bounds"))
    once = kinds.where("n = 1").select("m", "c").join(found_in, ["m", "c"])
    hits = found.join(full.union(once), ["m", "c"]).select("doc_id", "d", F.struct("start", "bounds").alias("part"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column(2).to_pylist():
                flat = sorted((p["start"] + a, p["start"] + b) for p in parts for a, b in zip(p["bounds"][::2], p["bounds"][1::2]))
                merged: list[int] = []
                for a, b in flat:
                    if merged and a <= merged[-1]:
                        merged[-1] = max(merged[-1], b)
                    else:
                        merged += [a, b]
                out.append(merged)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "d", "bounds"])

    by_doc = hits.groupBy("doc_id", "d").agg(F.collect_list("part").alias("parts"))
    return stash(by_doc.mapInArrow(merge, "doc_id long, d long, bounds array<int>"), "bounds")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, k: int = 8, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and, if asked for, the kept words as text), per row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    rows = rows.withColumn("d", F.xxhash64("text"))
    bounds = repeated(rows, length, k)
    few = (bounds.agg(F.sum(F.size("bounds") + F.lit(8))).first()[0] or 0) <= BROADCAST_INTS
    gone = bounds.select(F.col("doc_id").alias("id"), F.col("d").alias("e"), "bounds")
    both = rows.join(F.broadcast(gone) if few else gone, rows.doc_id.eqNullSafe(F.col("id")) & (F.col("d") == F.col("e")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, digest, texts = [], [], [], []
            for text, bounds in zip(batch.column(1), batch.column(2)):
                w = text.as_py().split()
                kept, last, removed = [], 0, 0
                b = bounds.as_py() or ()
                for s, e in zip(b[::2], b[1::2]):
                    kept += w[last:s]
                    removed += e - s
                    last = e
                joined = b" ".join(kept + w[last:])
                n.append(len(w))
                m.append(removed)
                digest.append(hashlib.sha256(joined).hexdigest())
                texts.append(joined.decode() if with_text else None)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols[: 4 + with_text], names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"][: 4 + with_text])

    return both.select("doc_id", "text", "bounds").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text)
