"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Method: the machines of ``machines`` are compiled from a model file and composed with each input; the output is the tropical-semiring shortest path.

1. The normaliser: user symbols, the rewriting table by longest match, and spaces as marks (one for a run if the model says so, one in front or behind).
   It has one path for each input, so input and normaliser compose to a chain.
2. The pieces: a trie over code points. For a unigram model a piece weighs minus its score; a user symbol weighs next to nothing.
3. Fallback: an arc per code point that is no piece, written as its UTF-8 bytes, or as the unknown piece (one for a run) if the model has no bytes.
4. Merging: a merge (BPE) model is no additive model, so a machine over pieces lets a piece follow another only if merging their
   concatenation gives just these two. Exactly one path is then left, that which merging would take; weights stay, but decide nothing. A unigram model has a
   machine of one state here. User symbols of a merge model part the chain, as no merge takes them.

Chain, pieces and merging are composed as the path search reaches their states. Totals of a unigram model are held in single precision, as
the library holds them; between paths of equal weight it may still choose another.

Where two symbols stand side by side in no piece, no path of a merge model crosses: chains are cut there, texts first before runs of spaces
where the normaliser has neither table nor user symbols, and the chunks' paths are kept per worker in bounded memory.

Cases: a null text is empty and has no pieces; repeated rows are encoded again; null ids stay null; empty tables give empty
results; extra columns are ignored; texts of any length are encoded whole. A merge model with pieces marked unused is refused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_batches
from .machines import SPACE, Anything, Merging, Normaliser, Pieces, shortest

CACHE = 400_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: What a symbol without a piece weighs beyond the heaviest piece (a fixed value of the model format), and what a user symbol weighs (as the library was seen to choose).
UNKNOWN_PENALTY, USER_WEIGHT = 10.0, -0.1


class Transducer:
    """The compiled machines of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = [p.type or NORMAL for p in model.pieces]
        self.pieces = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        #: What each id spells by itself, and the ids of bytes that spell nothing without their neighbours.
        self.spelled = [" ⁇ " if k == UNKNOWN else "" if k == CONTROL else p for p, k in zip(self.pieces, kinds)]
        for i, b in self.byte_of.items():
            self.spelled[i] = chr(b)
        self.high = frozenset(i for i, b in self.byte_of.items() if b >= 0x80)
        self.spec, self.suffix = model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix
        merges = model.trainer_spec.model_type == BPE
        if model.trainer_spec.model_type not in (UNIGRAM, BPE) or (merges and UNUSED in kinds):
            raise ValueError("only unigram models and merge models without unused pieces are supported")
        user = [p for p, k in zip(self.pieces, kinds) if k == USER]
        self.normaliser = Normaliser(self.spec, self.suffix, user)
        normal = [s for s, k in zip(self.scores, kinds) if k == NORMAL]
        fallback = UNKNOWN_PENALTY - min(normal, default=0.0)
        weights = {i: -self.scores[i] if kinds[i] == NORMAL else USER_WEIGHT for i in self.ids.values()}
        self.machine = Pieces(self.ids, weights, fallback * 1000 if merges else fallback)  # merging never leaves a symbol over that a piece could take
        self.follow = Merging(self.pieces, self.scores, self.ids) if merges else Anything()
        #: User symbols, at which a merge model's chain is parted.
        self.apart = self.normaliser.user if merges else None
        plain = merges and not user and not self.spec.precompiled_charsmap and not self.spec.remove_extra_whitespaces and self.spec.escape_whitespaces
        #: Whether a text's chain may not be cut at spaces.
        self.whole = not plain or self.suffix or any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Symbols that stand side by side in some piece; no path and no merge crosses a place between two others.
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)} if merges else None
        self.parts, self.old_parts = {}, {}
        self.chunks, self.old_chunks = {}, {}  # two generations: a full one becomes the old one, from which what is used again moves up
        # a cut before spaces that follow another symbol
        self.cut = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+")

    def shortest(self, chain: str) -> list[int]:
        """Ids on the shortest path of the machines composed with ``chain``."""
        out: list[int] = []
        for begin, end, piece in shortest(chain, self.machine, self.follow):
            out += [piece] if piece >= 0 else self.fallback(chain[begin:end])
        return out

    def fallback(self, symbol: str) -> list[int]:
        """A symbol without a piece: its bytes, or the unknown piece if the model has none."""
        return [self.bytes[b] for b in symbol.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def packed(self, chain: str) -> bytes:
        """A chain's ids, from those of its parts between places that nothing crosses."""
        if self.apart is not None:
            out, begin = [], 0
            for m in self.apart.finditer(chain):
                out += [self.between(chain[begin : m.start()]), self.ids[m[0]].to_bytes(4, "little")]
                begin = m.end()
            return b"".join([*out, self.between(chain[begin:])])
        return self.between(chain)

    def between(self, chain: str) -> bytes:
        if self.joined is None or not chain:
            return self.part(chain)
        joined, parts, begin = self.joined, [], 0
        for i in range(1, len(chain)):
            if chain[i - 1 : i + 1] not in joined:
                parts.append(chain[begin:i])
                begin = i
        parts.append(chain[begin:])
        return b"".join(map(self.part, parts))

    def chunk(self, chunk: str) -> bytes:
        """Ids of a piece of text that another one stands before."""
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = self.old_chunks.get(chunk)
            if ids is None:
                ids = self.packed(self.normaliser.run(chunk, Normaliser.INSIDE)[0])
            if len(self.chunks) >= CACHE:
                self.chunks, self.old_chunks = {}, self.chunks
            if len(chunk) <= 64:
                self.chunks[chunk] = ids
        return ids

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.old_parts.get(part)
            if ids is None:
                ids = b"".join(i.to_bytes(4, "little") for i in self.shortest(part))
            if len(self.parts) >= CACHE:
                self.parts, self.old_parts = {}, self.parts
            if len(part) <= 64:
                self.parts[part] = ids
        return ids

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.whole and self.bytes:
            first, *others = self.cut.findall(text) or [""]
            known, new = self.chunks.get, self.chunk
            return b"".join([self.packed(self.normaliser.run(first)[0]), *[known(c) or new(c) for c in others]])
        ids = self.packed(self.normaliser.whole(text))
        if self.bytes:
            return ids
        one, out = self.unknown.to_bytes(4, "little"), []
        for i in range(0, len(ids), 4):
            if (x := ids[i : i + 4]) != one or not out or out[-1] != one:  # a run of unknown symbols is one piece
                out.append(x)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return memoryview(self.encode_packed(text)).cast("I").tolist()

    def decode(self, ids: list[int]) -> str:
        """The inverse machine: pieces to symbols, runs of byte pieces to what they encode, marks to spaces, the one in front away."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.spelled.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                if (b := self.byte_of.get(i)) is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                out.append(self.spelled[i])
            text = "".join([*out, run.decode("utf-8", "replace")])
        if self.spec.add_dummy_prefix or self.spec.remove_extra_whitespaces:
            text = text.removeprefix(SPACE)
        return text.replace(SPACE, " ")


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per worker process."""
    return Transducer(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids ``array<int>``, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            ids = [machine.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([machine.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    small_batches(encoded.sparkSession)
    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, ids_crc32 (unsigned 32-bit little-endian ids), exact (whether decoding gives the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            n, crc, exact = [], [], []
            for text in batch.column(1).to_pylist():
                ids = machine.encode_packed(text or "")
                n.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                exact.append(machine.decode(memoryview(ids).cast("I").tolist()) == (text or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(exact)], names=["doc_id", "n_pieces", "ids_crc32", "exact"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, exact boolean")
