"""Neighbours and streaks over ranges, and the streak as a stream, against plain loops."""

import json
import random

import numpy as np
import pytest
from millrace.operators import ordered
from pyspark.sql import functions as F


def plain(answers):
    best = run = 0
    for a in answers:
        run = run + 1 if a else 0
        best = max(best, run)
    return len(answers), sum(map(bool, answers)), best


def test_summaries_combine():
    """However a run is cut, the parts come to the whole, in any bracketing."""
    r = random.Random(1)
    for _ in range(300):
        answers = np.array([r.random() < 0.7 for _ in range(r.randint(0, 12))], bool)
        i, j = sorted(r.randint(0, len(answers)) for _ in range(2))
        a, b, c = (ordered.summary(x) for x in (answers[:i], answers[i:j], answers[j:]))
        whole = ordered.summary(answers)
        assert ordered.combined(ordered.combined(a, b), c) == ordered.combined(a, ordered.combined(b, c)) == whole
        assert (whole[0], whole[4], whole[3]) == plain(answers.tolist())


def answers():
    r = random.Random(2)
    rows = [(r.choice(["hot"] * 8 + ["a", "b", None]), k, r.choice([True, True, True, False, None])) for k in range(900)]
    return rows + [("always", k, True) for k in range(40)] + [("never", k, False) for k in range(3)] + [("one", 1, True)]


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_best_streaks(spark, ranges):
    """A player with most of the answers lies in several ranges."""
    rows = answers()
    want = {p: plain([a for q, _, a in sorted(rows, key=lambda r: r[1]) if q == p]) for p, *_ in rows}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        df = spark.createDataFrame(rows, "player string, k int, ok boolean").repartition(3)
        spread = ordered.runs(df, "player", ["k"], F.col("ok")).where("player = 'hot'").count()
        got = {r.player: (r.answers, r.rights, r.best_streak) for r in ordered.best_streaks(df, "player", ["k"], F.col("ok")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want and (spread > 3) == (ranges == "7")
    assert ordered.best_streaks(df.limit(0), "player", ["k"], F.col("ok")).collect() == []


def test_neighbours(spark):
    """In one order and by groups, null groups and empty ranges included."""
    r = random.Random(3)
    rows = [(r.choice(["g"] * 9 + ["h", None]), k * 7 % 500, f"v{k}") for k in range(300)] + [("alone", 1, "x")]
    df = spark.createDataFrame(rows, "g string, k int, v string").repartition(5)
    got = {r.v: r.next and r.next.v for r in ordered.with_next(df, ["k", "v"], ["v"]).collect()}
    line = sorted(rows, key=lambda r: (r[1], r[2]))
    assert got == {a[2]: b[2] if b else None for a, b in zip(line, [*line[1:], None])}
    got = {r.v: r.next and r.next.v for r in ordered.with_next(df, ["k", "v"], ["v"], ["g"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        own = [r for r in line if r[0] == g]
        want |= {a[2]: b[2] if b else None for a, b in zip(own, [*own[1:], None])}
    assert got == want
    assert ordered.with_next(df.limit(0), ["k"], ["v"]).collect() == []


def test_stream_is_as_the_batch_and_goes_on_after_a_stop(spark, tmp_path):
    rows = [(p or "nobody", k, a) for p, k, a in answers()]
    rows.sort(key=lambda r: r[1])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    (tmp_path / "in").mkdir()
    seen = {}

    def step(part):
        (tmp_path / "in" / f"{part[0][1]}.json").write_text("\n".join(json.dumps({"player": p, "k": k, "ok": a}) for p, k, a in part))
        stream = spark.readStream.schema("player string, k int, ok boolean").json(str(tmp_path / "in"))
        keep = lambda batch, _: seen.update({r.player: (r.answers, r.rights, r.best_streak) for r in batch.collect()})
        ordered.streak_stream(stream, "player", "k", F.col("ok")).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    for at in (0, 300, 700):
        step(rows[at : {0: 300, 300: 700, 700: len(rows)}[at]])
    assert seen == {p: plain([a for q, _, a in rows if q == p]) for p, *_ in rows}
