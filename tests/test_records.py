"""Records in exchange formats, tracks on disk and names of models."""

import json

import pytest
from millrace.operators import records as R
from millrace.plans import views
from pyspark.sql import functions as F


def test_viewer_rows_of_every_shape(spark):
    lines = [
        {"id": "a", "prompt": "p", "chosen": "c", "rejected": "r", "rejection_reason": "why"},
        {"id": "b", "messages": [{"role": "system", "content": "S"}, {"role": "user", "content": "one"}, {"role": "user", "content": "two"}, {"role": "assistant", "content": "yes"}]},
        {"id": "c", "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"id": "d", "canonical_query": "q", "answer": "x", "split": "val"},
        {"id": "e", "messages": []},
    ]
    frame = spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    got = {r.id: r for r in R.viewer_rows(frame, "sys").collect()}
    pick = lambda i: (got[i].split, got[i].system_prompt, got[i].user_query, got[i].ground_truth_answer, got[i].is_dpo)
    assert pick("a") == ("dpo", "sys", "p", "c", True) and got["a"].rejected == "r" and got["a"].rejection_reason == "why"
    assert pick("b") == ("train", "S", "two", "yes", False)
    assert pick("c") == ("train", "sys", "h", "g", False)
    assert pick("d") == ("val", "sys", "q", "x", False)
    assert pick("e") == ("train", "sys", "", "", False) and got["e"].approx_tokens == 1


def test_metadata_and_names(spark):
    row = spark.range(1).select(
        R.metadata(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3"))).alias("m"),
        R.metadata(F.create_map(F.lit("a"), F.lit("1")), F.lit(None).cast("map<string,string>")).alias("n"),
        R.model_name(F.lit("Google"), F.lit("gemini/x")).alias("p"), R.model_name(F.lit("vllm"), F.lit("x")).alias("q"),
        R.api_base(F.lit("ollama"), F.lit("http://a:1/v1/")).alias("r"), R.api_base(F.lit("lm_studio"), F.lit("")).alias("s"), R.api_base(F.lit("z"), F.lit(None).cast("string")).alias("t"),
    ).first()
    assert (row.m, row.n, row.p, row.q, row.r, row.s, row.t) == ({"a": "1", "b": "3"}, {"a": "1"}, "gemini/x", "openai/x", "http://a:1", "http://localhost:1234/v1", None)


def test_tracks_and_records_come_back(spark, tmp_path):
    items = spark.createDataFrame([(1, "mcq"), (2, "free_form"), (3, "mcq")], "id int, format string")
    R.write_tracks(items, f"{tmp_path}/t")
    back = spark.read.json(f"{tmp_path}/t").groupBy("track").count().collect()
    assert {r.track: r["count"] for r in back} == {"all": 3, "mcq": 2, "open": 1}
    (tmp_path / "a.json").write_text(json.dumps([{"id": "x", "persona": "p", "user_query": "q", "ground_truth_answer": "g"}]))
    (tmp_path / "c.jsonl").write_text(json.dumps({"id": "y", "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "v"}], "metadata": {"persona": "z"}}) + "\n")
    got = R.read_records(spark, f"{tmp_path}/a.json", f"{tmp_path}/c.jsonl", "id string, persona string, user_query string, ground_truth_answer string, n_tokens long").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("x", "p", "q", "g", None), ("y", "z", "u", "v", None)]
    assert R.present(spark, [f"{tmp_path}/*.json", f"{tmp_path}/*.ttl"]) == {f"{tmp_path}/*.json": 1, f"{tmp_path}/*.ttl": 0}


@pytest.mark.parametrize(("target", "search", "want"), [("all", "", {"m1", "m2"}), ("local", "", {"m1"}), ("cloud", "", {"m2"}), ("baseline", "", {"My Baseline", "m3"}), ("all", "GPU9", {"m2"})])
def test_leaderboard_view(spark, target, search, want):
    rows = [("m1", "local", "p", None, "os"), ("m2", None, "p", "gpu9", None), ("My Baseline", "cloud", "p", "g", "o"), ("m3", "baseline", "p", "g", "o")]
    frame = spark.createDataFrame(rows, "model string, exec_type string, provider string, gpu string, os string")
    assert {r.model for r in views.leaderboard_view(frame, target, search).collect()} == want


def test_sorts_and_picks(spark):
    from millrace.operators import relational

    frame = spark.createDataFrame([("a", None, None), ("b", 1.0, 5.0), ("c", 2.0, 3.0)], "model string, accuracy double, latency double")
    order = lambda col, down: [r.model for r in views.sorted_leaders(frame, col, down).collect()]
    assert order("accuracy", True) == ["c", "b", "a"] and order("latency", False) == ["c", "b", "a"] and order("model", True) == ["c", "b", "a"]
    assert relational.random_pick(frame, "model", 7).collect() == relational.random_pick(frame.orderBy("accuracy"), "model", 7).collect()


def test_personas_beyond_a_thousand_and_tasks_beyond_a_hundred(spark):
    tasks = spark.createDataFrame([(f"t{i}",) for i in range(130)], "task string")
    results = spark.createDataFrame([("m", "t1", True), ("n", "t2", False)], "model string, task string, passed boolean")
    assert views.zero_filled(results, tasks).count() == 260


def test_reports_keep_rows_without_persona(spark):
    from millrace.plans import reports

    rows = [("p_q", "a", "live"), ("p_q", None, None), (None, "a", "cache")]
    titles = spark.createDataFrame([("x", "X")], "persona string, title string")
    got = {r.persona: r for r in reports.group_report(spark.createDataFrame(rows, "persona string, archetype string, llm_generator string"), "persona", "archetype", titles).collect()}
    assert (got["p_q"].records, got["p_q"].by_archetype, got["p_q"].generators, got["p_q"].title) == (2, {"": 1, "a": 1}, {"": 1, "live": 1}, "P Q")
    assert (got[None].records, got[None].by_archetype, got[None].share_pct) == (1, {"a": 1}, 33.33)


def test_collation(spark):
    """Accents and case as browsers sort them (the order of ``localeCompare``), search without them, and lengths of symbols beyond the basic plane."""
    from millrace.operators import relational

    words = ["éclair", "zèbre", "Eclair", "eclair", "Zebra", "apple", "Äpfel", "apfel", "résumé", "resume", "Resume", "ñandú", "nandu", "n", "_x", "10", "9"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.w for r in relational.page(df, [relational.collated(F.col("w")), F.col("w")], 0).collect()]
    assert got == ["_x", "10", "9", "apfel", "Äpfel", "apple", "eclair", "Eclair", "éclair", "n", "nandu", "ñandú", "resume", "Resume", "résumé", "Zebra", "zèbre"]
    assert {r.w for r in relational.search(df, "RESUME", ["w"], "UNICODE_CI_AI").collect()} == {"résumé", "resume", "Resume"}
    assert {r.w for r in relational.search(df, "é", ["w"]).collect()} == {"éclair", "résumé"}
    assert spark.createDataFrame([("a🙂é",), (None,)], "w string").select(relational.utf16_length(F.col("w")).alias("n")).collect()[0].n == 4
