"""Scorecards that change in place, and calls under way at once."""

import json
import os
import time

from millrace.operators import inference, relational
from millrace.streaming import scorecards


def test_three_versions_of_a_card(spark, tmp_path):
    """One row per model throughout, with restarts between; a batch that runs again changes nothing."""
    (tmp_path / "in").mkdir()
    out, at = str(tmp_path / "out"), [0]

    def put(name, model, accuracy, **more):
        at[0] += 1
        path = tmp_path / "in" / name
        path.write_text(json.dumps({"model_name": model, "overall_accuracy_pct": accuracy, **more}))
        os.utime(path, ns=(at[0] * 10**9, at[0] * 10**9))

    def rows():
        scorecards.follow(spark, str(tmp_path / "in"), out, str(tmp_path / "ck")).awaitTermination()
        return {r.model_name: (r.overall_accuracy_pct, r.total) for r in scorecards.table(spark, out).collect()}

    put("a_scorecard.json", "a", 50, total=4, passed=2)
    put("manifest.json", "none", 1)
    (tmp_path / "in" / "half.json").write_text('{"model_name": "h", ')
    assert rows() == {"a": (50.0, 4)}
    put("a_scorecard.json", "a", 75.5)
    put("b_scorecard.json", "b", 10)
    assert rows() == {"a": (75.5, None), "b": (10.0, None)}
    put("a_scorecard.json", "a", 80)
    put("a2.json", "a", 90)
    put("half.json", "h", 3)
    (tmp_path / "in" / "b_scorecard.json").unlink()
    assert rows() == {"a": (90.0, None), "b": (10.0, None), "h": (3.0, None)}
    assert rows() == {"a": (90.0, None), "b": (10.0, None), "h": (3.0, None)}
    n = scorecards.latest_version(spark, out)
    assert scorecards.table(spark, out).count() == 3 and scorecards.latest_version(spark, out, n) == n - 1


def test_calls_in_a_window(spark, tmp_path):
    """A slow call holds up none but its own, transient failures are tried again, and the second client answers what the first refuses."""
    log = str(tmp_path / "log")

    def noted(who, prompt):
        with open(log, "a") as f:
            f.write(f"{who} {prompt}\n")

    def first(prompt):
        noted("first", prompt)
        if prompt == "0":
            time.sleep(1.5)
        if prompt == "3":
            raise ValueError("HTTP 401")
        if prompt == "5" and open(log).read().split("\n").count("first 5") < 2:
            raise ValueError("HTTP 429")
        if prompt == "7":
            raise ValueError("HTTP 503")
        if prompt == "8":
            raise ValueError("bad prompt")
        return f"one {prompt}", 1, 2

    def second(prompt):
        noted("second", prompt)
        if prompt == "8":
            raise ValueError("bad again")
        return f"two {prompt}", 3, 4

    rows = spark.createDataFrame([(k, str(k) if k != 9 else None) for k in range(12)], "k int, prompt string").coalesce(1)
    done = spark.sparkContext.accumulator(0)
    asked = inference.ask_each(rows, "prompt", [("a", first), ("b", second)], window=4, attempts=3, wait=0.01, progress=done)
    asked.write.parquet(str(tmp_path / "said"))
    said = spark.read.parquet(str(tmp_path / "said")).collect()
    by = {r.k: r for r in said}
    assert done.value == 12 and len(by) == 12 and said[0].k != 0 and by[0].latency >= 1.5 > by[1].latency
    assert (by[3].response, by[3].client, by[3].attempts) == ("two 3", "b", 2) and (by[5].response, by[5].attempts) == ("one 5", 2) and (by[7].client, by[7].attempts) == ("b", 4)
    assert by[8].response == "ERROR_CALLING_MODEL: bad again" and by[8].client is None and by[9].response == "one "
    calls = open(log).read().split("\n")
    left = relational.remaining(rows, spark.read.parquet(str(tmp_path / "said")).where("client is not null"), ["k"])
    assert [r.k for r in inference.ask_each(left, "prompt", [("b", lambda p: (p, 0, 0))]).collect()] == [8] and open(log).read().split("\n") == calls
    assert inference.ask_each(rows.limit(0), "prompt", [("a", first)]).collect() == []
