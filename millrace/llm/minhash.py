"""Near-duplicate detection by min-max hashing.

Method: a signature keeps, under each of ``PERMUTATIONS`` hash permutations of a document's shingles, the minimum
and the maximum: two unbiased estimators for one evaluation. The signature is cut into bands; documents that
agree on a band meet in a bucket. Links are confirmed on full shingle sets.

Documents with equal sets are one class first, so copies cost one row. Within a bucket no full list of pairs is made:
1. every class is held against its bucket's hub: of the bucket, the class that meets most others anywhere. The order is one for all buckets, so
   the buckets of a group share a hub, and a class meets few hubs;
2. links are contracted to components at once. In buckets that still hold several components, the classes outside the largest one
   (the outsiders) are held against the hub among themselves, again and again until a round adds no link;
3. the rest is exact: each outsider left is paired with the classes of other components in its bucket that it could be linked to by the
   bounds below, the pairs are made distinct, and their sets are compared once, by id. Pairs that bring the same class and
   component together become one link. Large buckets are dealt out in parts of ``PART`` classes.
No pair that meets in a bucket and could bring two components together is left out. The third step looks at numbers alone, a few longs a
pair, but at each pair of an outsider and another class of its bucket that is not in its component: its work grows with the product.

The bounds on a pair: set sizes (exact); the sizes without lone shingles, which no other class in such buckets has, so that they are in no
intersection (exact); what both sets can share of their bucket's hub, whose shingles that either lacks are marked in ``8 * 64`` bits, and beside it
(exact); and the 2-bit codes of the signature, six standard deviations wide. A pair at the threshold fails to meet in any bucket with
probability under ``MISS``.

Cases: a null or empty text has an empty set and links with nothing; a row with a null id is never linked on
its own account and is kept; rows that share an id are one node, whatever their texts; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, checked_join, small_batches, stash
from ._words import hashed_words, mix, shingle_hashes, word_hashes
from .components import components, merged

PERMUTATIONS = 64
MISS = 1e-6
#: Classes of a bucket that one task holds against outsiders.
PART = 2000
FEATURES = "doc_id long, t long, n long, h1 long, h2 long, bands array<long>, s0 long, s1 long, s2 long, s3 long"
CODES = ("s0", "s1", "s2", "s3")


def band_rows(threshold: float, values: int = 2 * PERMUTATIONS, miss: float = MISS) -> int:
    """The most rows of a band at which a pair at the threshold is missed with probability ``miss`` at most."""
    return max(r for r in range(1, 17) if (1 - threshold**r) ** (values // r) <= miss or r == 1)


class MinMax:
    """Minimum and maximum of ``a * x + b`` (mod 2**32) for each of the permutations (a, b)."""

    def __init__(self, count: int = PERMUTATIONS, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.a = (draw.integers(0, 1 << 31, (count, 1), np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = draw.integers(0, 1 << 32, (count, 1), np.uint32)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        x, low, high = (hashes >> np.uint64(32)).astype(np.uint32), None, None
        for at in range(0, len(x), 2048):
            y = x[None, at : at + 2048] * self.a + self.b
            a, b = y.min(axis=1), y.max(axis=1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        return np.concatenate([low, high])


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash for each band, with the band's number in it."""
    count = len(signature) // rows
    parts = signature[: count * rows].reshape(count, rows).astype(np.uint64)
    h = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        h = mix(h + parts[:, j])
    return h.view(np.int64)


def codes(signature: np.ndarray) -> np.ndarray:
    """Two bits of each value: longs with the first bits, then longs with the second."""
    two = (signature * np.uint32(0x9E3779B1)) >> np.uint32(30)
    bits = np.concatenate([np.packbits((two >> np.uint32(1)).astype(bool)), np.packbits((two & np.uint32(1)).astype(bool))])
    return bits.view(np.int64)


def set_hash(hashes: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that stand for a set."""
    return hashes.sum(dtype=np.uint64), mix(hashes).sum(dtype=np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float) -> DataFrame:
    """Per row: id, a hash of the text, set size, a 128-bit hash of the set, band hashes, and the signature's codes."""
    rows = band_rows(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minmax = MinMax()
        with word_hashes() as cache:
            for batch in batches:
                out: list[list] = [[] for _ in range(8)]
                for text in batch.column(1):
                    h = shingle_hashes(hashed_words((text.as_py() or b"").lower(), cache), k)
                    out[0].append(len(h))
                    if len(h):
                        s = minmax.signature(h)
                        total = [int(x) for x in set_hash(h)]
                        out[3].append(bands(s, rows))
                        four = codes(s)
                    else:
                        total, four = [0, 0], np.zeros(4, np.int64)
                        out[3].append(None)
                    out[1].append(total[0])
                    out[2].append(total[1])
                    for j in range(4):
                        out[4 + j].append(four[j])
                as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                cols = [batch.column(0), batch.column(2), pa.array(out[0], pa.int64()), as_long(out[1]), as_long(out[2]), pa.array(out[3], pa.list_(pa.int64())), *[pa.array(np.array(x, np.int64)) for x in out[4:]]]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "t", "n", "h1", "h2", "bands", *CODES])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"), F.xxhash64(text_col)).mapInArrow(run, FEATURES)


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, set) of the classes ``wanted`` (rep, doc_id, h1, h2); ``docs`` is (doc_id, text). An id with several texts names the one whose hash is the class's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_hashes() as cache:
            for batch in batches:
                sets = [shingle_hashes(hashed_words((t.as_py() or b"").lower(), cache), k) for t in batch.column(1)]
                own = [tuple(x.view(np.int64).item() for x in set_hash(s)) == (a, b) for s, a, b in zip(sets, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
                found = pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["rep", "set"])
                yield found.filter(pa.array(own, pa.bool_()))

    texts = checked_join(docs, wanted, ["doc_id"]).select("rep", F.col("text").cast("binary"), "h1", "h2")
    return texts.mapInArrow(run, "rep long, set array<long>")


def could_link(x: str, y: str, percent: int) -> Column:
    """The bounds that every linked pair meets: sizes, and codes up to six standard deviations."""
    p = 0.75 * (1 - percent / 100)
    most = int(2 * PERMUTATIONS * p + 6 * (2 * PERMUTATIONS * p * (1 - p)) ** 0.5)
    a, b = (lambda c: F.col(f"{x}.{c}")), (lambda c: F.col(f"{y}.{c}"))
    differ = sum((F.bit_count(a(u).bitwiseXOR(b(u)).bitwiseOR(a(v).bitwiseXOR(b(v)))) for u, v in (("s0", "s2"), ("s1", "s3"))), F.lit(0))
    return (F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * percent) & (differ <= most)


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full ``sets`` (rep, set) meet the threshold."""
    one, two = sets.select(F.col("rep").alias("a"), F.col("set").alias("x")), sets.select(F.col("rep").alias("b"), F.col("set").alias("y"))
    enough = F.size(F.array_intersect("x", "y")) * (100 + percent) >= (F.size("x") + F.size("y")) * percent
    return pairs.join(one, "a").join(two, "b").where(enough).drop("x", "y")


def confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``classes`` that could be linked, and are by their full sets."""
    p, q = classes.alias("p"), classes.alias("q")
    near = pairs.join(p, F.col("a") == F.col("p.rep")).join(q, F.col("b") == F.col("q.rep")).where(could_link("p", "q", percent)).select("a", "b")
    near = stash(near, "pairs")
    ends = near.select(F.col("a").alias("rep")).union(near.select("b")).distinct()
    sets = stash(sets_of(texts, checked_join(classes, ends, ["rep"], "left_semi").select("rep", "doc_id", "h1", "h2"), k), "sets")
    return stash(compared(near, sets, percent).select("a", "b").distinct(), "confirmed")


def lone_shingles(sets: DataFrame) -> DataFrame:
    """(rep, lone): how many shingles of each of the ``sets`` no other one has."""
    once = sets.select("rep", F.explode("set").alias("shingle")).groupBy("shingle").agg(F.min("rep").alias("rep"), F.max("rep").alias("other")).where("rep = other")
    return once.groupBy("rep").agg(F.count(F.lit(1)).alias("lone"))


LACKS = tuple(f"l{j}" for j in range(8))


def against_hubs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (rep, hub) with the size of the hub's set, how many of its shingles the class has, and which it lacks: bits by the shingle's lowest nine."""
    one, two = sets.select("rep", F.col("set").alias("x")), sets.select(F.col("rep").alias("hub"), F.col("set").alias("y"))
    both = pairs.join(one, "rep").join(two, "hub").select("rep", "hub", F.size("y").alias("hub_n"), F.array_except("y", "x").alias("lacks"))
    bits = lambda j: F.aggregate(F.filter("lacks", lambda v: F.shiftright(v.bitwiseAND(511), 6) == j), F.lit(0).cast("long"), lambda a, v: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(63).cast("int"))))
    return both.select("rep", "hub", "hub_n", (F.col("hub_n") - F.size("lacks")).alias("has"), *[bits(j).alias(c) for j, c in enumerate(LACKS)])


def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def of_classes(features: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes of equal sets (rep, doc_id, n, h1, h2, bands, codes), and links between classes that share an id, if any do.

    A class's ``rep`` is its smallest id. An id with several sets stands for the first by hash; for each other one it gets a
    stand-in (from the smallest long up), so that no two classes have the same rep.
    """
    full = features.where("n > 0 and doc_id is not null")
    firsts = [F.first(c).alias(c) for c in ("n", "bands", *CODES)]
    several = full.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("first"), F.max(F.struct("h1", "h2")).alias("last")).where("first != last")
    several = stash(several.select("doc_id", "first"), "several")
    if several.isEmpty():
        classes = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), *firsts)
        return stash(classes.select("rep", F.col("rep").alias("doc_id"), "n", "h1", "h2", "bands", *CODES), "classes"), None
    extra = checked_join(full.select("doc_id", "h1", "h2"), several, ["doc_id"]).where(F.struct("h1", "h2") != F.col("first")).select("doc_id", "h1", "h2").distinct()
    extra = stash(extra.withColumn("other", F.lit(-(1 << 63)) + F.monotonically_increasing_id()), "extra")
    nodes = checked_join(full, extra, ["doc_id", "h1", "h2"], "left")
    least = F.min(F.struct(F.col("other").isNotNull().alias("last"), F.coalesce("other", "doc_id").alias("rep"), "doc_id"))
    classes = nodes.groupBy("h1", "h2").agg(least.alias("least"), *firsts)
    classes = stash(classes.select("least.rep", "least.doc_id", "n", "h1", "h2", "bands", *CODES), "classes")
    sharing = checked_join(full, several, ["doc_id"], "left_semi").select("doc_id", "h1", "h2").distinct().join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
    least = sharing.groupBy("doc_id").agg(F.min("rep").alias("hub"))
    return classes, stash(ordered(sharing.join(least, "doc_id"), "rep", "hub"), "sharing")


def linked(classes: DataFrame, texts: DataFrame, k: int, percent: int, given: DataFrame | None = None) -> DataFrame:
    """(node, label) for every class that is linked to another, by the ``given`` links or by its set."""
    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    members = stash(entries.join(shared, "bucket"), "members")
    degrees = members.groupBy("rep").agg(F.sum("many").alias("degree"))
    rank = F.struct("degree", F.xxhash64("rep").alias("lot"))
    members = stash(members.join(degrees, "rep").select("bucket", "rep", "many", rank.alias("rank")), "members")
    hubs = members.groupBy("bucket").agg(F.max_by("rep", "rank").alias("hub"))
    links = confirm(ordered(members.join(hubs, "bucket"), "rep", "hub"), classes, texts, k, percent)
    labels = components(links if given is None else links.union(given))

    # buckets that still hold several components
    labelled = members.join(labels, members.rep == labels.node, "left").select("bucket", "rep", "many", "rank", F.coalesce("label", "rep").alias("label"))
    sizes = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").drop("kinds")
    apart = stash(labelled.join(mixed.join(hubs, "bucket"), "bucket"), "apart")

    def now(rows: DataFrame) -> DataFrame:
        """The rows with the labels that hold by now."""
        moved = labels.withColumnsRenamed({"label": "next", "node": "via"})
        return rows.join(moved, rows.label == moved.via, "left").withColumn("label", F.coalesce("next", "label")).drop("next", "via")

    outside = apart.where("label != main")
    while True:
        next_hubs = outside.groupBy("bucket").agg(F.max_by(F.struct("rep", "label"), "rank").alias("next"))
        pairs = ordered(outside.join(next_hubs, "bucket").where("label != next.label").select("rep", F.col("next.rep").alias("hub")), "rep", "hub")
        links = confirm(pairs, classes, texts, k, percent)
        if links.isEmpty():
            break
        labels = merged(labels, links)
        outside = stash(now(outside), "outside")

    # the exact rest
    ids = apart.select("rep").distinct()
    sets = stash(sets_of(texts, checked_join(classes, ids, ["rep"], "left_semi").select("rep", "doc_id", "h1", "h2"), k), "sets")
    bounds = classes.join(ids, "rep", "left_semi").join(lone_shingles(sets), "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("common"), *CODES)
    bounds = stash(bounds.where(F.col("common") * 100 >= F.col("n") * percent), "bounds")  # else it can be linked to nothing
    parts = F.ceil(F.col("many") / PART).cast("int")
    beside = (F.col("common") - F.col("has")).alias("beside")  # shingles that another class has, but not the hub
    shares = against_hubs(apart.select("rep", "hub").distinct(), sets).join(bounds, "rep").select("rep", "hub", "hub_n", "n", "common", beside, *LACKS, *CODES)
    held = stash(now(apart).join(stash(shares, "shares"), ["rep", "hub"]).withColumn("parts", parts), "held")
    other = held.withColumn("part", F.pmod(F.xxhash64("rep"), "parts")).alias("m")
    out = held.where("label != main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("o")
    lacked = sum((F.bit_count(F.col(f"o.{c}").bitwiseOR(F.col(f"m.{c}"))) for c in LACKS), F.lit(0))
    most = F.least("o.common", "m.common", F.col("o.hub_n") - lacked + F.least("o.beside", "m.beside"))
    enough = most * (100 + percent) >= (F.col("o.n") + F.col("m.n")) * percent
    meet = (F.col("o.bucket") == F.col("m.bucket")) & (F.col("o.part") == F.col("m.part")) & (F.col("o.label") != F.col("m.label"))
    close = out.join(other, meet & enough & could_link("o", "m", percent))
    pairs = close.groupBy(F.col("o.rep").alias("a"), F.col("m.rep").alias("b")).agg(F.min("m.label").alias("label"))
    more = compared(pairs, sets, percent).groupBy("a", "label").agg(F.min("b").alias("b")).select("a", "b")
    more = stash(more, "confirmed")
    return labels if more.isEmpty() else merged(labels, more)


def grouped(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, share_ids: bool) -> DataFrame:
    """Per row: doc_id, t (a hash of the text), n_shingles, component_id, kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    features = stash(signatures(texts, "doc_id", "text", k, percent / 100), "features")
    classes, sharing = of_classes(features)
    labels = linked(classes, texts, k, percent, sharing if share_ids else None)

    named = classes.join(labels, classes.rep == labels.node, "left").select("h1", "h2", "doc_id", F.coalesce("label", "rep").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    named = stash(named.join(least, "label").select("h1", "h2", "component"), "named")
    out = features.select("doc_id", "t", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, per row. Linked: 100 * intersection >= percent * union, or the same id (not by an empty set)."""
    return grouped(docs, id_col, text_col, k, percent, True).drop("t")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the rows of one id of each group; columns as they were.

    Here an id links nothing: of an id with several texts, those go that are near a smaller id's, and the others stay.
    """
    gone = grouped(docs, id_col, text_col, k, percent, False).where("not kept").select("doc_id", "t").distinct()
    gone = stash(gone, "gone")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    kept = docs.alias("d").join((F.broadcast(gone) if few else gone).alias("g"), (F.col(f"d.{id_col}").cast("long") == F.col("g.doc_id")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("g.t")), "left_anti")
    return kept.select(*docs.columns)
