"""Values at ranks, distributions and stratified samples against sorted lists."""

import math
import random

import pytest
from millrace.operators import grading, relational, selection
from pyspark.sql import functions as F


@pytest.fixture(params=[4096, 3])
def few(request, monkeypatch):
    """With the usual bound one gathering does; with a small one all goes by rounds."""
    monkeypatch.setattr(selection, "FEW", request.param)
    return request.param


def ordered(values):
    return sorted(values, key=lambda v: (v != v, v))


def ranks():
    return [("first", F.lit(0)), ("mid", F.floor(F.col("n") / 2)), ("last", F.col("n") - 1), ("beyond", F.col("n"))]


def test_doubles(spark, few):
    r = random.Random(3)
    groups = {
        "wide": [math.copysign(10 ** r.uniform(-300, 300), r.random() - 0.5) for _ in range(150)], "near": [1 + k * 2**-52 for k in range(90)], "one": [5.0] * 60, "tiny": [5e-324, 0.0, -0.0, 1e-323, -5e-324] * 4,
        "odd": [float("inf"), float("-inf"), float("nan"), 1.0, 2.0, float("nan")], None: [float(k % 7) for k in range(40)], "single": [3.5], "hot": [r.gauss(0, 1) for _ in range(700)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("wide", None)]
    r.shuffle(rows)
    out = {x.g: (x.first, x.mid, x.last, x.beyond) for x in selection.at_ranks(spark.createDataFrame(rows, "g string, x double").repartition(3), ["g"], "x", ranks()).collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        o = ordered(vs)
        assert repr([v + 0.0 for v in out[g][:3]]) == repr([o[0] + 0.0, o[len(o) // 2] + 0.0, o[-1] + 0.0]) and out[g][3] is None, g


def test_longs_and_no_group(spark, few):
    top = (1 << 63) - 1
    values = [-top - 1, top, top - 1, top - 2, 0, 7, -7] + [1 << k for k in range(62)] + [top - 5] * 9
    out = selection.at_ranks(spark.createDataFrame([(v,) for v in values], "x long"), [], "x", ranks()).first()
    o = sorted(values)
    assert (out["first"], out["mid"], out["last"]) == (o[0], o[len(o) // 2], o[-1])
    assert selection.at_ranks(spark.createDataFrame([], "x long"), [], "x", ranks()).collect() == []


def test_distribution_and_telemetry(spark, few):
    r = random.Random(5)
    rows = [(m, r.choice([r.uniform(0.01, 9), 2.5, -1.0])) for m in ["hot"] * 800 + ["a", "b", "b", "c"] * 5 + ["even"] * 2]
    df = spark.createDataFrame(rows, "model string, latency double")
    got = {t.model: (t.n, t.p50, t.p95) for t in grading.telemetry(df).collect()}
    for m in {m for m, v in rows if v > 0}:
        v = sorted(x for g, x in rows if g == m and x > 0)
        k = len(v)
        want = (k, (v[(k - 1) // 2] + v[k // 2]) / 2, v[int(k * 0.95) if k >= 20 else k - 1])
        assert got[m][0] == k and all(abs(x - y) < 1e-3 for x, y in zip(got[m][1:], want[1:])), m
    for d in relational.distribution(df, "latency", ["model"]).collect():
        v = sorted(x for g, x in rows if g == d.model)
        assert (d.n, d.min, d.max) == (len(v), v[0], v[-1]) and [d.median, d.p95, d.p99] == [v[min(len(v) - 1, int(len(v) * q))] for q in (0.5, 0.95, 0.99)]


def test_stratified(spark, few):
    """One stratum with most rows, strata of one row, null strata and repeated keys."""
    import hashlib

    rows = [(i, "hot" if i % 3 else f"s{i % 40}", None if i % 5 else "x") for i in range(900)] + [(7, "dup", "y")] * 30
    df = spark.createDataFrame(rows, "k long, a string, b string")
    lot = lambda seed, k: hashlib.sha256(f"{seed}_{k}".encode()).hexdigest()
    strata = {}
    for row in rows:
        strata.setdefault(row[1:], []).append(row)
    taken = [r for s in strata.values() for r in sorted(s, key=lambda r: (lot(42, r[0]), r[0]))[: max(1, round(len(s) * (100 / len(rows))))]]
    want = sorted(taken, key=lambda r: (lot(43, r[0]), r[0]))[:100]
    assert sorted(map(str, map(tuple, relational.stratified(df, ["a", "b"], "k", 100).collect()))) == sorted(map(str, want))
    assert relational.stratified(df, ["a", "b"], "k", 5000).count() == len(rows)


def test_no_window_over_a_group(spark):
    df = spark.createDataFrame([("m", 1.0)], "model string, latency double")
    for plan in (grading.telemetry(df), relational.distribution(df, "latency", ["model"])):
        assert "Window" not in plan._jdf.queryExecution().toString()
