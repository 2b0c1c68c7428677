"""Filter audit, source divergence and nearest neighbours against brute force."""

import numpy as np
import pytest
from millrace.llm import divergence, filter_audit, posting_lists
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F

from . import brute
from .conftest import vectors

REPORT = ("part", "filter_order", "step", *filter_audit.OUTCOMES)
ROWS = ("lang", "source", "part", "item", "value", "rank")


def tuples(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_audit_query(spark, sf, rows):
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and doc_id is not null").collect()}
    want = brute.audit(rows, [None if i % 5 else "src0" for i, _ in rows], good, set())
    assert len(want) == 2 * 600 and any(w[7] for w in want)
    assert tuples(QUERIES["op12_filter_audit"](spark, sf), REPORT) == want


def test_audit_of_copies_ties_and_nulls(spark):
    """Copies over parts, repeated ids, null ids, labels that repeat and say nothing, and a text of 50 words at every limit."""
    at_limit = " ".join(f"w{k}" for k in range(50))
    repeats = " ".join(["a b c"] * 20 + ["d"])
    texts = [(1, at_limit), (2, at_limit), (2, at_limit), (None, at_limit), (5, None), (4, ""), (6, "ABC" + at_limit), (7, repeats + " #"), (8, repeats), (8, at_limit), (9, "É" * 60), (0, " ")]
    parts = ["x", "y", None, "", "x", "y", "x", "x", "z", "z", "z", "z"]
    docs = spark.createDataFrame([(i, t, p, 1) for (i, t), p in zip(texts, parts)], "doc_id long, text string, source string, mask int")
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (5, None, 1), (None, 1, 1), (8, 1, None)], "doc_id long, quality int, toxic int")
    assert tuples(filter_audit.audit(docs, labels), REPORT) == brute.audit(texts, parts, {2, 8}, {2, 5})


def test_incidence_adds_up():
    (kept, removed, redundant, unique), by_filter = filter_audit.incidence()
    assert kept.shape == (32, 600) and ((kept + removed + redundant) <= 1).all() and (unique.sum(axis=0) == 1).all()
    last = kept[:, 4::5] + removed.reshape(32, 120, 5).sum(axis=2)
    assert (last == 1).all()  # each mask is kept to the end or removed once
    assert (by_filter.sum(axis=0) == 120).all()


def corpus():
    draw = np.random.default_rng(2)
    words = ["The", "the", "é", "É", "über", "naïve", "x1y", "日本", "a-b", "Z", "zz", "ab", "aé", "rare"] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = []
    for k in range(260):
        lang = ["en", "en", "en", None, "de", "xx"][k % 6] if k < 250 else "few"
        source = ["s1", "s2", "s10", "", None, "ß"][(k // 6) % 6]
        words_ = draw.choice(words, draw.integers(0, 40), p=None)
        rows.append((" ".join(words_), lang, source))
    return rows + [(None, "en", "s1"), ("", "en", "silent"), ("   ", None, None), ("\x00a\x7fb", "en", "s2"), ("the " * 3000, "en", "s1"), ("one", "lonely", "s")] + [rows[0]] * 30


@pytest.mark.parametrize("chunk,panel,held", [(4096, 128, 400_000), (3, 2, 5)])
def test_divergence(spark, monkeypatch, chunk, panel, held):
    """Also with many chunks and panels, and counts passed on at once."""
    for name, value in (("CHUNK", chunk), ("PANEL", panel), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, rank int").repartition(3)
    got = tuples(divergence.divergence(docs), ROWS)
    assert got == brute.divergence(rows)
    assert any(r[0] == "few" and r[2] == "pair" and r[4] == 0 for r in got)


def test_divergence_query(spark, sf, rows):
    assert tuples(QUERIES["op13_divergence"](spark, sf), ROWS) == brute.divergence([(t, "en", None if i % 5 else "src0") for i, t in rows])


def test_shares_do_not_overflow():
    counts, total = np.array([0, 1, 10**12, 9 * 10**15 - 4], np.int64), 9 * 10**15
    assert divergence.shares(counts, np.int64(total)).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]


def nearest(rows, most=10):
    """The nearest of the query ids, by brute force."""
    good = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    ids, x, out = np.array([i for i, _ in good]), np.array([v for _, v in good]), {}
    for q in {i for i in ids.tolist() if i % 100 == 0}:
        away = np.min([np.sqrt(((x - x[k]) ** 2).sum(axis=1)) for k in np.flatnonzero(ids == q)], axis=0)
        best = {}
        for i, d in zip(ids.tolist(), away.tolist()):
            if i != q:
                best[i] = min(best.get(i, d), d)
        out[q] = sorted((d, i) for i, d in best.items())[:most]
    return out


def check(got, want):
    """Ranks, order and scores are right; returns the recall."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(by) == set(want)
    hit = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        truth = {i: d for d, i in want[q]}
        hit += sum(i in truth for _, _, i in found)
        assert all(abs(d - truth[i]) < 1e-12 for _, d, i in found if i in truth) and len({i for *_, i in found}) == len(found)
    return hit / sum(map(len, want.values()))


def test_neighbours_query(spark, sf):
    assert check(QUERIES["op11_posting_lists"](spark, sf).collect(), nearest(vectors())) >= 0.95


def test_neighbours_in_many_small_cells(spark, monkeypatch):
    """Lists of few vectors, dealt out in small cells: every list is read, so all neighbours are found, copies and ties included."""
    for name, value in (("FILL", 20), ("PART", 7), ("ASKING", 2), ("HELD", 90)):
        monkeypatch.setattr(posting_lists, name, value)
    rows = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>, label int, h string, vector int")
    want = nearest(vectors())
    got = posting_lists.search(rows, F.col("vec_id") % 100 == 0, ratio=100.0).collect()
    assert check(got, want) == 1.0
    assert {q: [i for _, i in w] for q, w in want.items()} == {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in want}


def test_few_neighbours(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = posting_lists.search(rows, F.col("vec_id") % 100 == 0, ratio=100.0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 3, 1.0), (0, 2, 100, 2**0.5), (100, 1, 3, 1.0), (100, 2, 0, 2**0.5)]


def test_lists_are_balanced_and_the_graph_finds_the_nearest():
    draw = np.random.default_rng(1)
    x = (draw.normal(size=(12, 32))[draw.integers(0, 12, 6000)] + 0.5 * draw.normal(size=(6000, 32))).astype(np.float32)
    sizes = [len(p) for p in posting_lists.halved(x, 100, draw)]
    assert len(sizes) == 100 and sum(sizes) == 6000 and max(sizes) - min(sizes) <= 7
    graph = posting_lists.fit(x, 300)
    ids, away = graph.search(x[:500], posting_lists.BEAM)
    true = np.argsort(((x[:500, None] - graph.centroids[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert (np.diff(away, axis=1) >= 0).all()
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids.tolist(), true.tolist())]) > 0.98
