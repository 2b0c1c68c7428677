"""Cross-entropy difference scores of documents.

Method: two interpolated bigram models, target and background, matched in order, smoothing and vocabulary. The
target is trained on the documents labelled good, the background on all. A document's score is the mean
difference of the per-token losses, target minus background: low scores look like the target.

Both models share one vocabulary: the words of the target documents, and one class for all others. Words and (previous, word)
pairs are told apart by 64-bit hashes and counted exactly; the counts grow with the corpus, none is cut or brought to the driver.

Texts become blocks of at most ``BLOCK`` tokens (a longer text goes on in the next block), written once as a table bucketed by
block. A block asks for the totals of its distinct keys: sorted keys with the block's own counts, dealt to shards by ranges of the
hash, as packed arrays. A key stands once in a block's request, so a shard's size follows the number of keys, whatever is frequent.
A shard sums what it is sent and answers each block with totals in the order asked, without the keys. Blocks meet the answers
where they lie. One such round is for words; the next is for pairs, with words outside the vocabulary in their class.

Cases: a null or empty text has the end symbol alone as its token; null ids are scored but are never target documents;
labels with null ids or values are ignored; without labels the target model is uniform; repeated rows count each time; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checked_join, shared_dir, small_batches, stash
from ._words import WordHashes, hashed_words, mix, word_hashes

#: Weight of the bigram estimate, and what is added to every unigram count.
BIGRAM_WEIGHT = 0.7
ADDED = 0.5
#: A text's end (which also stands before its first word) and words outside the vocabulary, as hashes of words that no text has.
END, OTHER = xxhash.xxh3_64_intdigest(b""), xxhash.xxh3_64_intdigest(b" ")
#: Tokens of a block, keys that a shard is meant to be sent, and bytes of a text that are parted into words at once.
BLOCK = 1_000_000
SHARD = 2_000_000
SLICE = 4 << 20

SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCKS = "block long, n long, n_target long, n_words long, hashes binary, codes binary, rows binary, ids binary, flags binary, lengths binary"
REQUESTS = "shard long, block long, asks boolean, keys binary, t binary, b binary"
ANSWERS = "block long, shard long, pairs boolean, t binary, b binary, known long, known_t long, known_b long"


@dataclass
class Model:
    """Both models: the blocks that they are counted from, the answers to these, and the sums of the counts t (target) and b (background)."""

    docs: DataFrame
    blocks: DataFrame
    words: DataFrame  # the blocks' answers on words
    cut: tuple[int, int] | None  # count and hash of the vocabulary's last word, if its size is bounded
    others: tuple[int, int]  # t, b of OTHER
    totals: tuple[int, int]
    symbols: int


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as compressed planes of bytes."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours, which are small where values ascend; ``np.cumsum`` undoes them."""
    return np.diff(values, prepend=values.dtype.type(0))


def target_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, good: str) -> DataFrame:
    """(doc_id, text bytes, target): whether a row's document is labelled good."""
    chosen = labels.where(F.expr(good) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    return checked_join(texts(docs, id_col, text_col), chosen, ["doc_id"], "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))


def tokens(text: bytes, cache: WordHashes) -> Iterator[np.ndarray]:
    """END, then the hashes of the words, parted a slice at a time."""
    yield np.array([END], np.uint64)
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = space.start() if space else len(text)
        yield hashed_words(text[at:end], cache)
        at = end


def block_row(block: int, stream: np.ndarray, runs: list[tuple]) -> dict:
    """A block: every element of ``stream`` but the last stands before a token; the last is the last token. ``runs`` has (row, id, target, length)."""
    hashes, codes, counts = np.unique(stream, return_inverse=True, return_counts=True)
    order = np.lexsort((hashes, -counts))  # frequent words get small codes
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    row, ids, target, length = (list(c) for c in zip(*runs))
    flags = np.array([2 * t + (i is None) for i, t in zip(ids, target)], np.int64)
    return {
        "block": block, "n": len(stream) - 1, "n_target": sum(n for n, t in zip(length, target) if t), "n_words": len(hashes),
        "hashes": pack(steps(hashes[order])), "codes": pack(place[codes].astype(np.int64)), "rows": pack(steps(np.array(row, np.int64))),
        "ids": pack(steps(np.array([i or 0 for i in ids], np.int64))), "flags": pack(flags), "lengths": pack(np.array(length, np.int64)),
    }


def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks of the rows (doc_id, text, target), written once, bucketed so that they need not move to meet their answers."""
    spark = rows.sparkSession
    schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        runs: list[list] = []
        held, number = 0, TaskContext.get().partitionId() << 33

        def emit(n: int) -> pa.RecordBatch:
            """The first ``n`` elements become a block; its last token is the element after them, or END."""
            nonlocal parts, runs, held, number
            stream = np.concatenate([*parts, np.array([END], np.uint64)])
            inside, left = [], n
            while left:
                taken = min(left, runs[0][3])
                inside.append((*runs[0][:3], taken))
                left -= taken
                runs[0][3] -= taken
                if not runs[0][3]:
                    runs.pop(0)
            out = pa.RecordBatch.from_pylist([block_row(number, stream[: n + 1], inside)], schema)
            parts, held, number = [stream[n:-1]], held - n, number + 1
            return out

        with word_hashes() as cache:
            for batch in batches:
                for row, doc, text, target in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    runs.append([row, doc, target, 0])
                    for part in tokens(text, cache):
                        parts.append(part)
                        runs[-1][3] += len(part)
                        held += len(part)
                        while held > BLOCK:  # what is left over belongs to the run being filled, so that stays
                            yield emit(BLOCK)
            if held:
                yield emit(held)

    found = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "target").mapInArrow(run, BLOCKS)
    name, n = f"blocks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/{name}"
    found.write.bucketBy(n, "block").option("path", path).format("parquet").saveAsTable(name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.table(name)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's word hashes, the codes of its stream, and which of its tokens are in target documents."""
    hashes = np.cumsum(unpack(row["hashes"], np.uint64), dtype=np.uint64)
    return hashes, unpack(row["codes"]), np.repeat(unpack(row["flags"]) >= 2, unpack(row["lengths"]))


def asked(row: dict, keys: np.ndarray, t: np.ndarray, b: np.ndarray, shards: int, asks: bool, counts: bool) -> list[dict]:
    """Requests of a block for ascending ``keys``, one for each shard that has some; the block's own counts go with them if they count."""
    if not counts:
        t = b = np.zeros(len(keys), np.int64)
    shard, first = np.unique((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), return_index=True)
    edges = zip(shard.tolist(), first, [*first[1:], len(keys)])
    return [{"shard": s, "block": row["block"], "asks": asks, "keys": pack(steps(keys[i:j])), "t": pack(t[i:j]), "b": pack(b[i:j])} for s, i, j in edges]


REQUEST_SCHEMA = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("asks", pa.bool_()), ("keys", pa.binary()), ("t", pa.binary()), ("b", pa.binary())])
ANSWER_SCHEMA = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("pairs", pa.bool_()), ("t", pa.binary()), ("b", pa.binary()), ("known", pa.int64()), ("known_t", pa.int64()), ("known_b", pa.int64())])


def shards_for(column: str, *blocks: DataFrame) -> int:
    keys = sum(b.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0] for b in blocks)
    return max(1, -(-keys // SHARD))


def word_requests(blocks: DataFrame, shards: int, asks: bool, counts: bool) -> DataFrame:
    """What blocks ask about their words, with how often each is a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, codes, target = unpacked(row)
                order = np.argsort(hashes)
                t, b = np.bincount(codes[1:][target], minlength=len(hashes)), np.bincount(codes[1:], minlength=len(hashes))
                yield pa.RecordBatch.from_pylist(asked(row, hashes[order], t[order], b[order], shards, asks, counts), REQUEST_SCHEMA)

    return blocks.select("block", "hashes", "codes", "flags", "lengths").mapInArrow(run, REQUESTS)


def summed(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """A shard's keys, their totals, and where the keys of each request are among them."""
    parts = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in group["keys"].to_pylist()]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    totals = []
    for c in ("t", "b"):
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, np.concatenate([unpack(v) for v in group[c].to_pylist()]))
        totals.append(total)
    return keys, *totals, place, np.cumsum([0, *map(len, parts)]).tolist()


def known_words(hashes: np.ndarray, t: np.ndarray, cut: tuple[int, int] | None) -> np.ndarray:
    """Which words the vocabulary has; END is always told apart."""
    inside = t > 0
    if cut is not None:
        inside &= (t > cut[0]) | ((t == cut[0]) & (hashes.view(np.int64) <= cut[1]))
    return inside | (hashes == np.uint64(END))


def answers(requests: DataFrame, pairs: bool, cut: tuple[int, int] | None = None) -> DataFrame:
    """Totals for each request that asks, and for each shard a row without block: its known words and their counts."""

    def run(group: pa.Table) -> pa.Table:
        keys, t, b, place, at = summed(group)
        shard, rows = group["shard"][0].as_py(), []
        for k, (block, asks) in enumerate(zip(group["block"].to_pylist(), group["asks"].to_pylist())):
            if asks:
                here = place[at[k] : at[k + 1]]
                rows.append({"block": block, "shard": shard, "pairs": pairs, "t": pack(t[here]), "b": pack(b[here])})
        if not pairs:
            known = known_words(keys, t, cut)
            rows.append({"shard": shard, "pairs": pairs, "known": int(np.sum(known & (keys != np.uint64(END)))), "known_t": int(t[known].sum()), "known_b": int(b[known].sum())})
        return pa.Table.from_pylist(rows, ANSWER_SCHEMA)

    return requests.groupBy("shard").applyInArrow(run, ANSWERS)


def last_word(requests: DataFrame, size: int) -> tuple[int, int] | None:
    """Count and hash of the last of the ``size`` most frequent target words; None if there are no more."""

    def run(group: pa.Table) -> pa.Table:
        keys, t, _, _, _ = summed(group)
        inside = (t > 0) & (keys != np.uint64(END))
        return pa.table({"t": t[inside], "h": keys[inside].view(np.int64)})

    first = requests.groupBy("shard").applyInArrow(run, "t long, h long").orderBy(F.desc("t"), "h").limit(size)
    last = first.agg(F.count("*").alias("n"), F.max(F.struct((-F.col("t")).alias("t"), "h")).alias("last")).first()
    return (-last["last"]["t"], last["last"]["h"]) if last["n"] == size and size else None


def answered(table: pa.Table, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
    """A block's totals t and b, in the order of its ascending keys."""
    rows = sorted((r for r in table.select(["shard", "pairs", "t", "b"]).to_pylist() if r["pairs"] == pairs), key=lambda r: r["shard"])
    return np.concatenate([unpack(r["t"]) for r in rows]), np.concatenate([unpack(r["b"]) for r in rows])


def classed(row: dict, table: pa.Table, cut: tuple[int, int] | None):
    """Of a block that has its answers on words: totals of its words (-1 for OTHER), codes, target tokens, and a key for each token's pair."""
    hashes, codes, target = unpacked(row)
    order = np.argsort(hashes)
    t, b = np.empty_like(codes, shape=len(hashes)), np.empty_like(codes, shape=len(hashes))
    t[order], b[order] = answered(table, False)
    known = known_words(hashes, t, cut)
    names = np.where(known, hashes, np.uint64(OTHER))
    with np.errstate(over="ignore"):
        keys = mix(mix(names)[codes[:-1]] + names[codes[1:]])
    return np.where(known, t, -1), np.where(known, b, -1), codes, target, keys


def pair_requests(blocks: DataFrame, words: DataFrame, cut: tuple[int, int] | None, shards: int, asks: bool, counts: bool) -> DataFrame:
    """What blocks ask about their pairs, with how often each stands there."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            _, _, _, target, keys = classed(row, right, cut)
            found, place, b = np.unique(keys, return_inverse=True, return_counts=True)
            out += asked(row, found, np.bincount(place[target], minlength=len(found)), b.astype(np.int64), shards, asks, counts)
        return pa.Table.from_pylist(out, REQUEST_SCHEMA)

    small = blocks.select("block", "hashes", "codes", "flags", "lengths")
    return small.groupBy("block").cogroup(words.where("block is not null").groupBy("block")).applyInArrow(run, REQUESTS)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good: str = "quality = 1 and toxic = 0", size: int | None = None) -> Model:
    """Both models, from all of ``docs``; a vocabulary of the ``size`` most frequent target words if asked for (ties by hash), of all by default."""
    small_batches(docs.sparkSession)
    blocks = blocks_of(target_rows(docs, labels, id_col, text_col, good))
    requests = word_requests(blocks, shards_for("n_words", blocks), True, True)
    cut = last_word(requests, size) if size is not None else None
    words = stash(answers(requests, False, cut), "words")
    total = lambda df, *names: tuple(df.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).first())
    n, in_t, in_b = total(words.where("block is null"), "known", "known_t", "known_b")
    t, b = total(blocks, "n_target", "n")
    return Model(docs, blocks, words, cut, (t - in_t, b - in_b), (t, b), n + 2)


def losses(model: Model, k: int, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """-log2 of each token's probability in one model, from the totals of its pair, of the word before and of its own word."""
    context, word = (np.where(c < 0, model.others[k], c) for c in (context, word))
    alone = (word + ADDED) / (model.totals[k] + ADDED * model.symbols)
    # every token is the context of one bigram but for the last, whose place the start takes: contexts count as unigrams do
    return -np.log2(np.where(context > 0, BIGRAM_WEIGHT * pair / np.maximum(context, 1) + (1 - BIGRAM_WEIGHT) * alone, alone))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, target_loss and background_loss (bits per token), score (their difference)."""
    small_batches(docs.sparkSession)
    cut, figures = model.cut, Model(None, None, None, model.cut, model.others, model.totals, model.symbols)
    if docs is model.docs:
        blocks, words = model.blocks, model.words
        requests = pair_requests(blocks, words, cut, shards_for("n", blocks), True, True)
    else:  # the model's blocks say their counts, the documents' ask
        blocks = blocks_of(texts(docs, id_col, text_col).withColumn("target", F.lit(False)))
        n = shards_for("n_words", model.blocks, blocks)
        words = stash(answers(word_requests(model.blocks, n, False, True).unionByName(word_requests(blocks, n, True, False)), False, cut), "words")
        n = shards_for("n", model.blocks, blocks)
        requests = pair_requests(model.blocks, model.words, cut, n, False, True).unionByName(pair_requests(blocks, words, cut, n, True, False))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            t, b, codes, _, keys = classed(row, right, cut)
            place = np.unique(keys, return_inverse=True)[1]
            ids, flags, lengths = np.cumsum(unpack(row["ids"])), unpack(row["flags"]), unpack(row["lengths"])
            starts = np.cumsum(lengths) - lengths
            bits = [np.add.reduceat(losses(figures, k, pair[place], c[codes[:-1]], c[codes[1:]]), starts) for k, (pair, c) in enumerate(zip(answered(right, True), (t, b)))]
            out.append(pa.table({"row": np.cumsum(unpack(row["rows"])), "doc_id": pa.array(ids, mask=flags % 2 == 1), "n": lengths, "t": bits[0], "b": bits[1]}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], k) for c, k in (("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("t", pa.float64()), ("b", pa.float64()))})

    said = words.where("block is not null").unionByName(answers(requests, True))
    rows = blocks.drop("n", "n_target", "n_words").groupBy("block").cogroup(said.groupBy("block")).applyInArrow(run, "row long, doc_id long, n long, t double, b double")
    rows = rows.groupBy("row", "doc_id").agg(F.sum("n").alias("n_tokens"), F.sum("t").alias("t"), F.sum("b").alias("b"))
    mean = lambda c: F.col(c) / F.col("n_tokens")
    return rows.select("doc_id", "n_tokens", mean("t").alias("target_loss"), mean("b").alias("background_loss"), (mean("t") - mean("b")).alias("score"))
