"""Jobs: settings, fetched sources, the benchmark on disk, evaluation with resume, regrading and scorecards."""

import json

from millrace.operators import inference, synthesis
from millrace.plans import jobs
from millrace.plans.synthesis import constants, units
from millrace.sources import fetch
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_settings(tmp_path):
    path = tmp_path / "s.yaml"
    assert jobs.settings(str(path)) == (jobs.Settings(), "./dataset")
    path.write_text("project:\n  output_dir: out\naugmenter:\n  enabled: false\nexporter:\n  train_ratio: 0.7\n  val_ratio: 0.2\nother: [1]\n")
    said, out = jobs.settings(str(path))
    assert out == "out" and said == jobs.Settings(augment=False, train=0.7, val=0.2)


def test_fetch(spark, tmp_path):
    asked = []

    def fetcher(url, headers):
        asked.append((url, headers["Accept"]))
        if "gone" in url:
            raise OSError("404")
        return json.dumps([{"name": "speed of light", "value": "299792458", "unit": "m/s", "year": "2022"}]).encode()

    want = [fetch.Source("a.json", "http://x/a"), fetch.Source("b.json", "http://x/gone", "text/turtle")]
    done, failed = fetch.ensure(spark, want, str(tmp_path), fetcher)
    assert done == [f"{tmp_path}/a.json"] and failed == {"b.json": "404"} and asked[1] == ("http://x/gone", "text/turtle")
    assert fetch.ensure(spark, want[:1], str(tmp_path)) == ([], {})
    assert set(fetch.download(spark, fetch.SI, str(tmp_path))[1]) == {s.name for s in fetch.SI}
    assert fetch.constants_of_year(spark, "http://x/c", 2022, str(tmp_path), fetcher).count() == 1 and asked[-1][0].endswith("?year=2022")
    assert fetch.constants_of_year(spark, "http://x/c", 2018, str(tmp_path)) is None


def test_evaluation_goes_on_where_it_stopped(spark, tmp_path):
    items = jobs.build_benchmark(spark, units(spark, SF), constants(spark, SF), f"{tmp_path}/b", 10)
    read = spark.read.json(f"{tmp_path}/b/tracks").groupBy("track").count().collect()
    sizes = {r.track: r["count"] for r in read}
    assert sizes["all"] == items.count() == sizes["mcq"] + sizes["open"]
    right = {r.question: r.correct_option_key or r.ground_truth_answer for r in items.collect()}
    log = str(tmp_path / "asked")

    def provider(prompts):
        with open(log, "a") as f:
            f.writelines("1\n" for _ in prompts)
        return [(json.dumps({"answer": right[p.split("Question: ", 1)[1].split("\n\n")[0]], "explanation": "x"}), 4, 2) for p in prompts]

    out = f"{tmp_path}/e"
    held = f"{out}/_run={jobs.fingerprint(items, 'm')}/step=3"
    part = items.where(F.pmod(F.xxhash64("id"), F.lit(8)) == 3)
    had = part.count()
    from millrace.operators import grading, records

    asked = inference.ask(part.withColumns({"model": F.lit("m"), "prompt": records.prompt(F.col("question"), F.col("options"))}), "prompt", provider)
    grading.graded(asked).write.parquet(held)
    open(log, "w").close()
    card = jobs.evaluate(items, "m", provider, out)
    assert len(open(log).readlines()) == card["total"] - had and card["total"] == items.count()
    mcq = card["by_format"]["mcq"]
    assert mcq["passed"] == mcq["total"] and sum(v["total"] for v in card["by_task"].values()) == card["total"]
    assert json.load(open(f"{out}/scorecard.json"))["overall_accuracy_pct"] == card["overall_accuracy_pct"] and not (tmp_path / "e" / f"_run={jobs.fingerprint(items, 'm')}").exists()
    again = jobs.regrade(spark, out, f"{tmp_path}/r")
    assert again["passed"] == card["passed"] and again["by_task"] == card["by_task"]
    assert "| mcq |" in jobs.shown(card) and card["environment"]["cores"] >= 1
    cards = spark.createDataFrame([("m", 1.0), ("n", 2.0)], "model_name string, overall_accuracy_pct double")
    assert {tuple(r) for r in jobs.refreshed(cards, f"{out}").collect()} == {("m", card["overall_accuracy_pct"]), ("n", 2.0)}


def test_evaluation_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], synthesis.uncertainty_task(spark, 1).schema)
    assert jobs.evaluate(none, "m", inference.echo, f"{tmp_path}/e", 2)["total"] == 0


def test_banks_and_quotas(spark):
    got = synthesis.uncertainty_task(spark, 60).collect()
    assert len(got) == 60 and sum(r.id.startswith("uncertainty_mcq_concept") for r in got) == 6
    assert sum("expanded" in r.question for r in got) in range(10, 15) and len({r.question for r in got}) == 60
    assert len(synthesis.uncertainty_task(spark, 20).collect()) == 20
    every = synthesis.conventions_task(spark, 1000).collect()
    assert len(every) == 18 + 24 + 12 + 8
    for r in every:
        if r.options:
            assert sum(o.is_correct for o in r.options) == 1 and len({o.text for o in r.options}) == len(r.options)
    doubled = [r for r in synthesis.homogeneity_task(spark, units(spark, SF), 10_000).collect() if r.question.startswith("Which symbol")]
    assert len(doubled) == 8 and all(len({o.text for o in r.options}) == len(r.options) for r in doubled)
