"""Approximate nearest neighbours by balanced posting lists.

Method: centroids are fitted on a bounded sample by splitting it at medians, so that every leaf has as many vectors as the next: lists of a sample's vectors are balanced. A
graph over the centroids, each linked to its nearest and to a few far ones, lies in memory and is searched best-first with a beam. Every vector is filed in the list of its
nearest centroid; a boundary vector, about as near to further centroids, is replicated to their lists too, unless a list already chosen lies between. A query is looked up
in the graph and reads the lists whose centroids are at most ``RATIO`` times as far as the nearest. Scores are computed on the original
vectors in double precision. What the index leaves to chance is which lists are read; what is in them is scored exactly.

A list is dealt out in cells of about ``PART`` vectors and ``ASKING`` queries, so no task holds a list whole however full it is. Of equal vectors only those
with the ``most + 1`` smallest ids can be among anyone's ``most`` nearest, and only these are filed; queries with equal vectors are searched once and answered each.

Bounds: the sample has at most ``SAMPLE`` vectors (smallest hashes of the id), the centroids are at most ``LISTS``; both are what reaches the driver and is
sent to all tasks (LISTS * dimension floats). Every vector is filed.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id; the dimension is that of most
vectors (of several, the largest), others take no part; repeated rows (id and vector) count once; of an id with several vectors each is searched for and with, and the
nearest counts; with fewer candidates than asked for all are returned, in so far as the lists hold them; without vectors there are no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import checked_join, small_batches, stash

SAMPLE, LISTS = 65_536, 4096
#: Vectors of a list that are aimed at, as long as LISTS allows.
FILL = 256
PART, ASKING = 8192, 2048
#: Neighbours that a task holds before it passes them on; what its cells find for a query is merged until then.
HELD = 500_000
#: A list is read if its centroid is at most so many times as far as the nearest one.
RATIO = 1.15
#: A vector is filed in at most so many lists, whose centroids are at most so many times as far as the nearest.
REPLICAS, NEAR = 3, 1.05
LINKS, FAR_LINKS, BEAM = 24, 8, 64
#: Centroids that the search for a query keeps, so the most lists that it reads.
READ = 512


@dataclass
class Graph:
    """Centroids and, for each, the centroids it is linked to."""

    centroids: np.ndarray  # float32, lists x dimension
    links: np.ndarray  # int32, lists x links
    entries: np.ndarray  # where a search starts

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each query, nearest first, and their distances. Best-first, four steps at a time, until no beam has an unseen end."""
        size, q = len(self.centroids), queries.astype(np.float32)
        beam, n, rows = min(beam, size), len(q), np.arange(len(q))[:, None]
        norms = (self.centroids**2).sum(axis=1)
        own = (q**2).sum(axis=1, keepdims=True)

        def far(ids: np.ndarray) -> np.ndarray:
            return own + norms[ids] - 2 * np.einsum("qd,qkd->qk", q, self.centroids[ids])

        known = np.zeros((n, size), bool)
        known[:, self.entries] = True
        ids = np.broadcast_to(self.entries, (n, len(self.entries)))
        away, opened = far(ids), np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(away, axis=1)[:, :beam]
            ids, away, opened = (np.take_along_axis(x, order, 1) for x in (ids, away, opened))
            waiting = ~opened & np.isfinite(away)
            if not waiting.any():
                break
            step = np.argsort(~waiting, axis=1, kind="stable")[:, :4]
            go = np.take_along_axis(waiting, step, 1)
            np.put_along_axis(opened, step, True, 1)
            next_ids = self.links[np.take_along_axis(ids, step, 1)]
            fresh = go[:, :, None] & ~known[rows[:, :, None], next_ids]
            next_ids, fresh = next_ids.reshape(n, -1), fresh.reshape(n, -1)
            known[rows, next_ids] |= fresh
            order = np.argsort(np.where(fresh, next_ids, size), axis=1, kind="stable")  # one met twice in a step counts once
            next_ids, fresh = np.take_along_axis(next_ids, order, 1), np.take_along_axis(fresh, order, 1)
            fresh[:, 1:] &= (next_ids[:, 1:] != next_ids[:, :-1]) | ~fresh[:, :-1]
            ids = np.concatenate([ids, next_ids], axis=1)
            away = np.concatenate([away, np.where(fresh, far(next_ids), np.inf)], axis=1)
            opened = np.concatenate([opened, ~fresh], axis=1)
        return ids, np.sqrt(np.maximum(away, 0))


def halved(vectors: np.ndarray, leaves: int, draw: np.random.Generator) -> list[np.ndarray]:
    """The vectors' numbers in ``leaves`` equal parts: each part is cut in two at a quantile of the line between two means."""
    done, open_ = [], [(np.arange(len(vectors)), leaves)]
    while open_:
        rows, n = open_.pop()
        if n == 1:
            done.append(rows)
            continue
        left, x = n // 2, vectors[rows]
        a, b = x[draw.choice(len(rows), 2, replace=False)]
        for _ in range(8):
            order = np.argsort(x @ (b - a), kind="stable")
            cut = len(rows) * left // n
            a, b = x[order[:cut]].mean(axis=0), x[order[cut:]].mean(axis=0)
        open_ += [(rows[order[:cut]], left), (rows[order[cut:]], n - left)]
    return done


def fit(sample: np.ndarray, lists: int, seed: int = 3) -> Graph:
    """Balanced centroids of the sample and their graph."""
    draw = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    centroids = np.array([sample[rows].mean(axis=0) for rows in halved(sample, lists, draw)], np.float32)
    near = min(LINKS, lists - 1)
    links = np.empty((lists, near + min(FAR_LINKS, lists)), np.int32)
    norms = (centroids**2).sum(axis=1)
    for at in range(0, lists, 512):
        away = norms - 2 * centroids[at : at + 512] @ centroids.T
        away[np.arange(len(away)), at + np.arange(len(away))] = np.inf
        links[at : at + 512, :near] = np.argpartition(away, max(near - 1, 0), axis=1)[:, :near]
    links[:, near:] = draw.integers(0, lists, (lists, links.shape[1] - near))
    return Graph(centroids, links, draw.choice(lists, min(16, lists), replace=False).astype(np.int32))


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    return np.asarray(column.flatten(), kind).reshape(len(column), -1)


def sound(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def vectors_of(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, h) of the rows that take part."""
    vector = F.col(vector_col)
    good = rows.where(F.col(id_col).isNotNull() & sound(vector)).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), F.xxhash64(vector).alias("h"))
    size = good.groupBy(F.size("vector").alias("size")).count().agg(F.max_by("size", F.struct("count", "size"))).first()[0]  # a row per dimension
    return good.where(F.size("vector") == (size or 0))


def thinned(vectors: DataFrame, most: int) -> DataFrame:
    """``vectors`` without those that ``most`` equal ones with smaller ids stand before, and without repeated rows of such crowds."""
    crowds = stash(vectors.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > most).select("h"), "crowds")
    if crowds.isEmpty():
        return vectors
    crowded = checked_join(vectors, crowds, ["h"], "left_semi")
    place = F.row_number().over(Window.partitionBy("h").orderBy("vec_id"))  # only the first few of a task's rows are shuffled
    ids = crowded.select("h", "vec_id").distinct().withColumn("place", place).where(F.col("place") <= most).drop("place")
    # of rows that repeat id and hash, one stays
    kept = stash(checked_join(crowded, stash(ids, "first-ids"), ["h", "vec_id"]).groupBy("h", "vec_id").agg(F.first("vector").alias("vector")).select("vec_id", "vector", "h"), "crowd-vectors")
    return checked_join(vectors, crowds, ["h"], "left_anti").unionByName(kept)


def filed(vectors: DataFrame, graph: Graph, id_col: str, ratio: float, beam: int, replicas: int | None = None) -> DataFrame:
    """(list, id, vector): each vector once for each of its lists, by the ratio of its distances.

    With ``replicas`` there are at most so many, and a list goes to whose centroid a chosen one is nearer than the vector.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(graph)
    kind = vectors.schema["vector"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), np.float32)
            ids, away = g.search(x, beam)
            good = np.isfinite(away) & (away <= away[:, :1] * ratio)
            good[:, 0] = True
            if replicas:
                ids, away, good = ids[:, : 4 * replicas], away[:, : 4 * replicas], good[:, : 4 * replicas]
                spots = g.centroids[ids]
                for k in range(1, ids.shape[1]):
                    between = ((spots[:, :k] - spots[:, k : k + 1]) ** 2).sum(axis=2) < away[:, k : k + 1] ** 2
                    good[:, k] &= ~(between & good[:, :k]).any(axis=1) & (good[:, :k].sum(axis=1) < replicas)
            row, col = np.nonzero(good)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row, col], pa.int32()), batch.column(0).take(at), batch.column(1).take(at)], names=["list", id_col, "vector"])

    small_batches(vectors.sparkSession)
    return vectors.select(id_col, "vector").mapInArrow(run, f"list int, {id_col} long, vector {kind.simpleString()}")


def cells(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """(list, part, asking, vec_id, h, vector): both sides of each cell that has queries, queries with vec_id null."""
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy("list").agg(F.count(F.lit(1)).alias("q")), "list")
    sizes = F.broadcast(stash(sizes.select("list", F.ceil(F.col("n") / PART).cast("int").alias("parts"), F.ceil(F.col("q") / ASKING).cast("int").alias("askers")), "lists"))  # LISTS rows at most
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = postings.join(sizes, "list").select("list", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"), each("askers").alias("asking"), "vec_id", F.lit(None).cast("long").alias("h"), "vector")
    asks = asked.join(sizes, "list").select("list", each("parts").alias("part"), F.pmod(F.xxhash64("h"), "askers").cast("int").alias("asking"), F.lit(None).cast("long").alias("vec_id"), "h", "vector")
    return held.unionByName(asks)


def nearest(dealt: DataFrame, most: int) -> DataFrame:
    """(h, vec_id, score): for each query the ``most`` nearest vectors of the cells that a task has, ties to smaller ids."""

    def best(ids: np.ndarray, x: np.ndarray, hs: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By the expanded square first, then exactly for all that rounding leaves in doubt."""
        rough = (q**2).sum(axis=1, keepdims=True) + (x**2).sum(axis=1) - 2 * q @ x.T
        if rough.shape[1] > most:
            limit = np.partition(rough, most - 1, axis=1)[:, most - 1 : most]
            row, col = np.nonzero(rough <= limit + 1e-9 * (np.abs(limit) + (q**2).sum(axis=1, keepdims=True)))
        else:
            row, col = (a.reshape(-1) for a in np.indices(rough.shape))
        score = np.sqrt(((q[row] - x[col]) ** 2).sum(axis=1))
        return first(hs[row], ids[col], score)

    def first(h: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first ``most`` of each query, each vector once."""
        order = np.lexsort((ids, score, h))
        h, ids, score = h[order], ids[order], score[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])
        h, ids, score = h[once], ids[once], score[once]
        few = np.arange(len(h)) - np.searchsorted(h, h) < most
        return h[few], ids[few], score[few]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells come in order, each with its queries first."""
        cell, hs, q = None, [], []
        held: list[tuple] = []
        merge = lambda: first(*[np.concatenate(x) for x in zip(*held, strict=True)])
        passed = lambda found: pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["h", "vec_id", "score"])
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if cell is None or (key[a] != cell).any():
                    cell, hs, q = key[a], [], []
                run_ = batch.slice(a, b - a)
                asks = run_.column(3).is_null()
                some = run_.filter(asks)
                if some.num_rows:
                    hs.append(some.column(4).to_numpy())
                    q.append(matrix(some.column(5)))
                rest = run_.filter(pa.compute.invert(asks))
                if rest.num_rows and hs:
                    hs, q = [np.concatenate(hs)], [np.concatenate(q)]
                    held.append(best(rest.column(3).to_numpy(), matrix(rest.column(5)), hs[0], q[0]))
                    if sum(len(f[0]) for f in held) > HELD:
                        held = [merge()]
                        if len(held[0][0]) > HELD // 2:
                            yield passed(held.pop())
        if held:
            yield passed(merge())

    ordered = dealt.repartition("list", "part", "asking").sortWithinPartitions("list", "part", "asking", F.col("vec_id").isNotNull())
    return ordered.mapInArrow(run, "h long, vec_id long, score double")


def search(rows: DataFrame, asking: Column, most: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", ratio: float = RATIO) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for each row for which ``asking`` (of vec_id) holds."""
    vectors = stash(vectors_of(rows, id_col, vector_col), "vectors")
    members = vectors.where(asking).select("h", F.col("vec_id").alias("query_id")).distinct()
    index = thinned(vectors, most + 1)
    count = vectors.count()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not count:
        return empty
    graph = fit(matrix(sample.column("vector").combine_chunks(), np.float32), min(LISTS, -(-count // FILL)))
    queries = vectors.where(asking).groupBy("h").agg(F.first("vector").alias("vector"))
    asked = stash(filed(queries, graph, "h", ratio, READ), "asked")
    postings = filed(index, graph, "vec_id", NEAR, BEAM, REPLICAS)
    found = nearest(cells(stash(postings, "postings"), asked), most + 1).groupBy("h", "vec_id").agg(F.min("score").alias("score"))
    # a query's own row may be among them, so one more than asked for
    place = F.row_number().over(Window.partitionBy("h").orderBy("score", "vec_id"))
    first = found.withColumn("place", place).where(F.col("place") <= most + 1).groupBy("h").agg(F.collect_list(F.struct("score", "vec_id")).alias("found"))
    each = checked_join(members, stash(first, "answers"), ["h"], most=100_000).select("query_id", F.explode("found").alias("f")).select("query_id", "f.*").where("query_id != vec_id")
    each = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # an id with several vectors
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
