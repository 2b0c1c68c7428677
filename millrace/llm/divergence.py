"""How far the sources of a language differ in their words, exactly and in integers.

Method: integer dictionaries. Term counts per (language, source, term) are dealt out by ranges of (language, term) and sorted, so a range holds its terms in UTF-8 order.
A task reads its range as a stream and cuts it into chunks of ``CHUNK`` kept terms: the chunk's dictionary is the sorted array of kept terms, ids are places in it by
searchsorted, and a source's counts are a vector over the ids by bincount. Chunk numbers ascend with the ranges, so (chunk, id)
orders as the term does and ties are settled on integers. For each chunk the vectors of up to ``PANEL`` sources stand together as a panel; panels of a language are held
against each other chunk by chunk, and the sums over terms are added up over chunks.

No task sees a language whole: work is dealt by (language, chunk, panel, panel). Terms are counted per task first, in at most ``HELD`` entries, then by Spark, so a
word or source that is in every row is one entry per task. All results are integers below 2**63 as long as a group has fewer than 9.2e15 occurrences.

Cases: null text, language and source are ''; a group without terms has pairs and no terms; a language without kept terms has pairs of value 0; a document is a row, so
repeated rows count each; an empty table gives no rows; texts may be of any length; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import checked_join, small_batches, stash

#: Kept terms of a chunk; sources of a panel; entries that a task counts before it passes them on.
CHUNK, PANEL, HELD = 4096, 128, 400_000
#: Panels' member lists that may be broadcast; each has at most PANEL sources.
FEW_PANELS = 2000
UNIT = 1_000_000_000
#: A-Z to a-z; other ASCII that is no letter to a blank; all other bytes as they are.
TO_TERMS = bytes(b if b > 0x7F or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n_docs, n) as far as a task counts at once; one row without a term for each group that it meets."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n_docs", pa.int64()), ("n", pa.int64())])

    def rows(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, uses) in groups.items():
            terms = [None, *uses]
            cols = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *map(seen.__getitem__, uses)], pa.int64()), pa.array([0, *uses.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                seen, uses = groups.setdefault((lang, source), (Counter(), Counter()))
                held -= len(uses)
                words = text.translate(TO_TERMS).split()
                uses.update(words)
                seen.update(set(words))
                held += len(uses)
                if held > HELD or len(groups) > HELD:
                    yield from rows(groups)
                    groups, held = {}, 0
        yield from rows(groups)

    return docs.mapInArrow(run, "lang string, source string, term string, n_docs long, n long")


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n_docs, n) of the whole table, with one row without a term per group; written once."""
    small_batches(docs.sparkSession)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    rows = docs.select(*named, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return stash(partial_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")), "term-counts")


def chunked(counts: DataFrame, least_docs: int) -> DataFrame:
    """Chunks of kept terms: a row with source null has the dictionary (terms) and the language's totals (counts); each other has a source's ids and counts."""
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.int64()), ("source", pa.string()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("terms", pa.list_(pa.string()))])

    def encoded(held: list[pa.RecordBatch], chunk: int) -> pa.RecordBatch:
        """The chunk of whole terms of one language, in order."""
        rows = pa.Table.from_batches(held).combine_chunks()
        terms, n = rows.column("term").combine_chunks(), rows.column("n").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)]))  # the dictionary: where each term starts
        ids = np.searchsorted(first, np.arange(len(terms)), side="right") - 1
        totals = np.bincount(ids, n, len(first)).astype(np.int64) if n.sum() < 1 << 53 else np.add.reduceat(n, first)
        sources = rows.column("source").combine_chunks().dictionary_encode()
        which = sources.indices.to_numpy()
        order = np.argsort(which, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(which[order])) + 1)
        names = [None, *sources.dictionary.to_pylist()]
        ids_of, counts = [None, *[ids[at] for at in parts]], [totals, *[n[at] for at in parts]]
        dictionary = [terms.take(pa.array(first)).to_pylist(), *[None] * len(parts)]
        return pa.RecordBatch.from_arrays([pa.array([rows.column("lang")[0].as_py()] * len(names)), pa.array([chunk] * len(names), pa.int64()), pa.array(names, pa.string()), pa.array(ids_of, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())), pa.array(dictionary, pa.list_(pa.string()))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        terms, chunk = 0, TaskContext.get().partitionId() << 33
        last = None
        for batch in batches:
            key = [batch.column("lang"), batch.column("term")]
            moves = [np.concatenate([[last is None or last[k] != c[0].as_py()], pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)]) for k, c in enumerate(key)]
            new_lang, new_term = moves[0], moves[0] | moves[1]
            last = [c[-1].as_py() for c in key]
            at = 0
            for cut in np.flatnonzero(new_term):
                if (terms == CHUNK or new_lang[cut]) and (held or cut > at):
                    if cut > at:
                        held.append(batch.slice(at, cut - at))
                    yield encoded(held, chunk)
                    held, terms, at, chunk = [], 0, cut, chunk + 1
                terms += 1
            held.append(batch.slice(at))
        if held:
            yield encoded(held, chunk)

    n = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n_docs").alias("all_docs")).where(F.col("all_docs") >= least_docs).select("lang", "term")
    rows = counts.where("term is not null").join(kept, ["lang", "term"], "left_semi").select("lang", "term", "source", "n")
    ranged = stash(rows, "kept-counts").repartitionByRange(n, "lang", "term").sortWithinPartitions("lang", "term")
    return stash(ranged.mapInArrow(run, "lang string, chunk long, source string, ids array<int>, counts array<long>, terms array<string>"), "chunks")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + 2) / total), by long division in three digits of 1000, so that nothing overflows."""
    q, r = np.zeros_like(counts), counts + 2
    q, r = r // total, r % total
    for _ in range(3):
        r = r * 1000
        q, r = q * 1000 + r // total, r % total
    return q + 1


def panels_of(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, chunk, panel, d, totals, terms, members, cells): a chunk's dictionary with the vectors of a panel's sources; ``d`` stand for N + 2V."""
    words, vectors = chunks.where("source is null"), chunks.where("source is not null")
    size = words.groupBy("lang").agg(F.sum(F.size("terms")).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    own = vectors.groupBy("lang", "source").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("own"))
    # a row per group: numbered within its language
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = groups.join(own, ["lang", "source"], "left").withColumn("place", place).withColumns({"panel": F.floor(F.col("place") / PANEL).cast("int"), "slot": (F.col("place") % PANEL).cast("int")})
    numbered = stash(numbered.select("lang", "source", "panel", "slot", F.coalesce("own", F.lit(0)).alias("own")), "groups")
    members = numbered.groupBy("lang", "panel").agg(F.array_sort(F.collect_list(F.struct("slot", "source", "own"))).alias("members"))
    members = members.join(size, "lang").select("lang", "panel", (F.col("n") + 2 * F.col("v")).alias("d"), (2 * F.col("v")).alias("twice"), "members")
    cells = checked_join(vectors, numbered.select("lang", "source", "panel", "slot"), ["lang", "source"]).groupBy("lang", "chunk", "panel").agg(F.collect_list(F.struct("slot", "ids", "counts")).alias("cells"))
    heads = checked_join(words.select("lang", "chunk", "terms", F.col("counts").alias("totals")), members, ["lang"], most=FEW_PANELS)
    return stash(heads.join(cells, ["lang", "chunk", "panel"], "left"), "panels")


def dense(row: dict, at: str = "") -> np.ndarray:
    """p of each member of a panel (rows) for each term of the chunk (columns)."""
    size = len(row["totals"])
    out = np.zeros((len(row[f"members{at}"]), size), np.int64)
    for cell in row[f"cells{at}"] or ():
        out[cell["slot"], np.asarray(cell["ids"])] = cell["counts"]
    return out


def term_rows(panels: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value) of a chunk's ``most`` terms per group that are commoner in the group than in the language, by value and then id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("lang", "d", "twice", "members", "cells", "totals")}
                terms, counts = batch.column("terms")[k].values, dense(row)
                q = shares(np.array(row["totals"], np.int64), np.int64(row["d"]))
                found: list[list] = [[], [], [], []]
                for m, own in zip(row["members"], counts, strict=True):
                    p = shares(own, np.int64(m["own"] + row["twice"]))
                    ids = np.flatnonzero((own > 0) & (p > q))
                    f = (p[ids] - q[ids]) ** 2 // (p[ids] + q[ids])
                    first = np.lexsort((ids, -f))[:most]
                    found[0] += [row["lang"]] * len(first)
                    found[1] += [m["source"]] * len(first)
                    found[2] += [terms[i].as_py() for i in ids[first].tolist()]
                    found[3] += f[first].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.string()), pa.array(found[3], pa.int64())], names=["lang", "source", "item", "value"])

    return panels.mapInArrow(run, "lang string, source string, item string, value long")


def pair_sums(panels: DataFrame) -> DataFrame:
    """(lang, panel, other, a, b, value): what a chunk adds to each pair of sources, once for both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                both = [shares(dense(row, at), np.array([[m["own"] + row["twice"]] for m in row[f"members{at}"]], np.int64)) for at in ("", "_b")]
                same = row["panel"] == row["panel_b"]
                a, b, value = [], [], []
                for i, p in enumerate(both[0]):
                    others = both[1][i + 1 :] if same else both[1]
                    gap = p - others
                    f = (gap * gap // (p + others)).sum(axis=1)
                    a += [i] * len(f)
                    b += range(i + 1 if same else 0, len(both[1]))
                    value += f.tolist()
                n = len(a)
                cols = [pa.array([row["lang"]] * n, pa.string()), pa.array([row["panel"]] * n, pa.int32()), pa.array([row["panel_b"]] * n, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "panel", "other", "a", "b", "value"])

    one = panels.select("lang", "chunk", "panel", "twice", "totals", "members", "cells")
    two = panels.select("lang", "chunk", F.col("panel").alias("panel_b"), F.col("members").alias("members_b"), F.col("cells").alias("cells_b"))
    tiles = one.join(two, ["lang", "chunk"]).where("panel <= panel_b")
    return tiles.mapInArrow(run, "lang string, panel int, other int, a int, b int, value long")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 10, most: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: each other source of the language by distance, and the ``most`` terms that mark the source."""
    counts = term_counts(docs, lang_col, source_col, text_col)
    groups = counts.where("term is null").select("lang", "source")
    panels = panels_of(chunked(counts, least_docs), groups)
    marks = term_rows(panels, most)

    sums = pair_sums(panels).groupBy("lang", "panel", "other", "a", "b").agg(F.sum("value").alias("value"))
    slots = panels.select("lang", "panel", "members").dropDuplicates(["lang", "panel"]).select("lang", "panel", F.explode("members").alias("m")).select("lang", "panel", "m.slot", "m.source")
    left = slots.withColumnsRenamed({"slot": "a", "source": "one"})
    right = slots.withColumnsRenamed({"panel": "other", "slot": "b", "source": "two"})
    named = checked_join(checked_join(sums, left, ["lang", "panel", "a"]), right, ["lang", "other", "b"]).select("lang", "one", "two", "value")
    both = named.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item")))).alias("x"), "value").select("lang", "x.source", "x.item", "value")
    bare = groups.join(panels.select("lang").distinct(), "lang", "left_anti")  # languages without kept terms
    zero = bare.alias("g").join(bare.alias("h"), "lang").where("g.source != h.source").select("lang", "g.source", F.col("h.source").alias("item"), F.lit(0).cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = both.unionByName(zero).withColumn("part", F.lit("pair")).withColumn("rank", rank)
    marks = marks.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= most)  # a task passes on no more than that of a group
    return pairs.unionByName(marks).select("lang", "source", "part", "item", "value", "rank")
