"""Best-fit packing of tokenized documents into fixed-length sequences.

Method: bounded-space online best-fit. A packing task keeps a fixed number of open bins; a bitset has one bit per
free space that some open bin has, so the fullest bin that still takes a piece is the lowest set bit at or above
the piece's length. If a new bin is needed and all are open, the fullest closes first.

A task of the first pass reads texts, tokenizes them (Arrow splits a batch and finds its distinct words; ids of words are kept
for the task, in bounded memory, and new ones are made many in one call) and emits one narrow row per piece. Those rows, not the texts, are dealt evenly to the packing tasks; the count of these
follows from the count of pieces, so a task's work and its share of half-full last bins stay bounded.

Cases: a null text is empty and gives the end id alone; an empty table gives no rows; a repeated row is packed
again; a null id stays null; texts of any length are cut into full pieces and a rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_batches, stash

END_ID = 1
#: Symbols that a chunk may end in and that no split pattern of the vocabulary joins with letters.
TAIL = ".,!?;:#*$%&|<>-)("
#: Letters that NFC leaves alone and that any library puts in lower case one by one, and alike.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "İ")
#: Entries of one generation of a task's cache; two generations. An executor has as many workers as cores.
CACHE = 80_000
#: New words that one call of the library encodes.
AT_ONCE = 250
#: Bytes of texts whose words are in memory at a time (one text, if it is longer).
RUN = 1 << 20
#: The normaliser and the splits under which white space parts a text and letters stand by themselves, in lower case.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITS = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ChunkIds(dict):
    """Little-endian unsigned 32-bit ids of white-space-free chunks, as the vocabulary's tokenizer gives them.

    No merge crosses white space, so a text's ids are those of its chunks in order. A chunk of Latin letters
    with symbols behind is split there and its letters lower-cased here; then the bare merge model suffices, which skips
    normalisation and splitting. All other chunks go to the whole tokenizer. A vocabulary with another normaliser or other
    splits is not ``by_chunk``: there whole texts go to the whole tokenizer.

    Letters and other chunks are entries of one cache, which has two generations: a full one becomes the old one, and what is
    asked for again moves on, so frequent entries stay. Symbols alone are kept apart.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.old: dict[str, bytes] = {}
        spec = json.load(open(path, encoding="utf-8"))
        self.whole = Tokenizer.from_file(path)
        self.by_chunk = spec["normalizer"] == NORMALIZER and (spec["pre_tokenizer"] or {}).get("pretokenizers", [None])[0] == SPLITS
        self.bare = Tokenizer(self.whole.model)  # one model in memory for both
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.tails: dict[str, bytes] = {"": b""}
        #: Whether an id stands at a word's end; no id does in a model that does not mark it.
        suffix, vocab = spec["model"].get("end_of_word_suffix"), spec["model"]["vocab"] if self.by_chunk else {}
        self.last = np.zeros(max(vocab.values(), default=-1) + 1, bool)
        if suffix:
            self.last[[i for piece, i in vocab.items() if piece.endswith(suffix)]] = True

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def put(self, chunk: str, ids: bytes) -> None:
        if len(chunk) > 64:
            return
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids

    def again(self, chunk: str) -> bytes | None:
        """Ids of a chunk that is not in this generation; None if it is in neither."""
        if (ids := self.old.pop(chunk, None)) is not None:
            self.put(chunk, ids)
        return ids

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters, out of one call: every word ends in an id that marks an end, or each gets its own call."""
        ids = np.array(self.bare.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return [self.pack(self.bare.encode(w, add_special_tokens=False).ids) for w in words]
        flat, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words of lower-case letters; of the empty word none."""
        out, new = list(map(self.get, words)), []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            out[k] = self.again(words[k]) if words[k] else b""
            if out[k] is None:
                new.append(k)
        for at in range(0, len(new), AT_ONCE):
            some = new[at : at + AT_ONCE]
            for k, ids in zip(some, self.encoded([words[k] for k in some])):
                out[k] = ids
                self.put(words[k], ids)
        return out

    def of_others(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks of any kind."""
        out = []
        for chunk in chunks:
            if (ids := self.tails.get(chunk)) is None and (ids := self.get(chunk)) is None and (ids := self.again(chunk)) is None:
                ids = self.pack(self.whole.encode(chunk, add_special_tokens=False).ids)
                if len(self.tails) < 10_000 and len(chunk) <= 64 and not chunk.strip(TAIL):
                    self.tails[chunk] = ids
                else:
                    self.put(chunk, ids)
            out.append(ids)
        return out

    def of_chunks(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct chunks: those of the letters in front, then those of the symbols behind; of a chunk of another form as a whole."""
        base = pc.ascii_rtrim(chunks, characters=TAIL)
        plain = pc.and_(pc.equal(pc.utf8_ltrim(base, characters=LETTERS), ""), pc.not_equal(base, ""))
        letters = pc.if_else(plain, pc.utf8_lower(base), "").dictionary_encode()
        others = pc.if_else(plain, pc.utf8_ltrim(chunks, characters=LETTERS), chunks).dictionary_encode()
        front, behind = (pa.array(ids(part.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(part.indices) for ids, part in ((self.of_letters, letters), (self.of_others, others)))
        return pc.binary_join_element_wise(front, behind, pa.scalar(b"", pa.large_binary()))

    def of_texts(self, texts: pa.LargeStringArray) -> tuple[memoryview, list[int]]:
        """Ids of texts (not null) on end, and the byte where each text's begin, with the end of all behind."""
        if self.by_chunk:
            chunks = pc.ascii_split_whitespace(texts)  # parts at the six of bytes.split
            distinct = chunks.values.dictionary_encode()
            ids, firsts = self.of_chunks(distinct.dictionary).take(distinct.indices), chunks.offsets.to_numpy()
        else:
            ids = pa.array([self.pack(self.whole.encode(t, add_special_tokens=False).ids) for t in texts.to_pylist()], pa.large_binary())
            firsts = np.arange(len(texts) + 1)
        _, ends, flat = ids.buffers()
        return memoryview(flat or b""), np.frombuffer(ends, np.int64)[firsts + ids.offset].tolist()


    def forget(self) -> None:
        """Drops all entries; the vocabulary stays."""
        self.clear()
        self.old.clear()
        self.tails = {"": b""}


@lru_cache(maxsize=1)
def chunk_ids(path: str) -> ChunkIds:
    """One vocabulary per worker process; it outlives a task."""
    return ChunkIds(path)


@contextmanager
def task_ids(path: str) -> Iterator[ChunkIds]:
    """A cache for one task; a worker that goes on to another operator holds the vocabulary alone."""
    cache = chunk_ids(path)
    try:
        yield cache
    finally:
        cache.forget()


def token_bytes(text: bytes, cache: ChunkIds, end_id: int | None = END_ID) -> bytes:
    """A text's ids as little-endian unsigned 32-bit integers, with the end id behind."""
    ids, _ = cache.of_texts(pa.array([text.decode()], pa.large_string()))
    return bytes(ids) + (b"" if end_id is None else end_id.to_bytes(4, "little"))


def runs(texts: pa.LargeStringArray, most: int = RUN) -> Iterator[pa.LargeStringArray]:
    """Slices, in order, of at most ``most`` bytes or of one text."""
    upto, lo = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
        yield texts[lo:hi]
        lo = hi


def pieces(docs: DataFrame, path: str, size: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most ``size`` ids: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END_ID.to_bytes(4, "little")
        with task_ids(path) as cache:
            for batch in batches:
                rows: list[tuple] = []
                doc = iter(batch.column(0).to_pylist())
                for texts in runs(batch.column(1).fill_null(b"").cast(pa.large_string())):
                    ids, starts = cache.of_texts(texts)
                    for a, b in zip(starts, starts[1:]):
                        n, i = (b - a) // 4 + 1, next(doc)
                        for k, at in enumerate(range(0, n, size)):
                            crc, length = zlib.crc32(ids[a + 4 * at : min(b, a + 4 * (at + size))]), min(size, n - at)
                            rows.append((i, k, at, length, zlib.crc32(end, crc) if at + length == n else crc))
                    del ids
                    pa.default_memory_pool().release_unused()  # else the pool keeps about 100 MB in each worker
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(cut, PIECE_SCHEMA)


class OpenBins:
    """At most ``most`` open bins of ``size`` places; bit f of ``free`` says that some open bin has f places free."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.made, self.free = size, most, 0, 0, 0
        self.by_free: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """Number of the bin and the place in it."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number, used = self.by_free[space].pop()
            if not self.by_free[space]:
                self.free &= ~(1 << space)
            self.open -= 1
        else:
            if self.open >= self.most:
                fullest = (self.free & -self.free).bit_length() - 1
                self.by_free[fullest].pop()
                if not self.by_free[fullest]:
                    self.free &= ~(1 << fullest)
                self.open -= 1
            number, used, space = self.made, 0, self.size
            self.made += 1
        left = space - length
        if left:  # a full bin closes by itself
            self.by_free[left].append((number, used + length))
            self.free |= 1 << left
            self.open += 1
        return number, used


def pack(pieces: DataFrame, size: int = 4096, open_bins: int = 512, rows_per_task: int = 400_000) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length``.

    A task orders what it reads batch by batch (1,000 rows), longest first: short pieces of a batch then fill what the long
    ones leave, and no more than a batch and the open bins are in memory.
    """
    pieces = stash(pieces, "pieces")
    count = pieces.count()
    tasks = max(1, -(-count // rows_per_task))
    names, kinds = pieces.columns, pieces.schema

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, base = OpenBins(size, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = batch.column(names.index("length")).to_numpy()
            order = (-lengths).argsort(kind="stable")
            where = [(0, 0)] * len(lengths)
            for k in order.tolist():
                where[k] = bins.put(int(lengths[k]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([base + b for b, _ in where], pa.int64()), pa.array([at for _, at in where], pa.int64())], names=[*names, "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructField, StructType

    small_batches(pieces.sparkSession)
    schema = StructType([*kinds.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return pieces.repartition(tasks).mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, path: str, size: int = 4096, open_bins: int = 512) -> DataFrame:
    """Tokenizes and packs whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path, size), size, open_bins)
