"""Operators against hand-made cases."""

import json

import pytest
from millrace.operators import grading, near_dedup, relational, scaffold, synthesis
from millrace.plans import build
from millrace.sources import archive, entities, jsonio, turtle
from millrace.streaming import grading as streaming
from pyspark.sql import functions as F

TTL = """
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix v: <http://x.org/v#> . @base <http://x.org/> .
# a comment
<unit/S> a v:BaseUnit ; rdfs:label "second"@en ; v:hasSymbol "s" ; v:hasDimension "T1" .
<unit/FT> a v:Unit ; rdfs:label \"\"\"foot "ft" \"\"\" ; v:symbol "ft" ; v:conversionMultiplier 0.3048 ; v:conversionOffset 0.0 ; v:isSI false ; v:hasQuantityKind <k/Length> , <k/Height> .
<k/Length> a v:QuantityKind ; rdfs:label "Length" ; v:hasDimensionVector <d/L1> ; v:applicableUnit <unit/FT> .
<c/h> a v:DefiningConstant ; rdfs:label "Planck constant" ; v:hasNumericalValue "6.62607015e-34" ; v:list ( 1 2 ) ; v:of [ v:a "x\\u00e9" ] .
"""


def test_turtle(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TTL)
    (tmp_path / "bad.ttl").write_text("this is { no turtle")
    spark.dataSource.register(turtle.TurtleSource)
    rows = spark.read.format("turtle").load(str(tmp_path))
    assert rows.count() == len(list(turtle.parse(TTL)))
    triples = turtle.triples(spark, str(tmp_path / "*.ttl"))
    assert sorted(map(str, rows.drop("src").collect())) == sorted(map(str, triples.drop("src").collect())) or rows.count() == triples.count()
    u = {r.symbol: r for r in entities.units(triples).collect()}
    assert u["s"].dimension_vector["T"] == 1 and u["ft"].conversion.multiplier == 0.3048 and len(u["ft"].has_quantity_kinds) == 2
    k = entities.quantity_kinds(triples).first()
    assert (k.label, k.dimension_vector["L"], len(k.applicable_units)) == ("Length", 1, 1)
    c = entities.constants(triples).first()
    assert (c.name, c.category, c.numeric_value) == ("Planck constant", "exact", "6.62607015e-34")
    with pytest.raises(turtle.TurtleError):
        list(turtle.parse("<a> <b> ."))


def test_json_constants(spark, tmp_path):
    rows = [{"label": "G", "value": "6.67430(15)e-11", "uncertainty": "0.00015e-11", "unit": "m3", "year": "2022"}, {"quantity": "c", "value": "299792458", "uncertainty": "(exact)", "unit": "m s-1"}, {"name": "old", "value": "1", "year": "2018"}]
    (tmp_path / "c.json").write_text(json.dumps({"constants": rows}))
    out = {r.name: r for r in entities.constants_from_json(spark, str(tmp_path / "c.json")).collect()}
    assert set(out) == {"G", "c"} and out["G"].category == "recommended" and out["c"].category == "exact"


def test_near_dedup_keeps_chains(spark):
    """Rows two and three meet row one or two only in turn: first, last of a chain stay."""
    base = [f"w{i}" for i in range(200)]
    swap = lambda w, n, mark: [mark + x if i < n else x for i, x in enumerate(w)]
    a, b = base, swap(base, 1, "q")
    rows = [(1, " ".join(a)), (2, " ".join(a) + " "), (3, " ".join(b)), (4, "other words here"), (5, None), (6, "")]
    kept = [r.i for r in near_dedup.greedy(spark.createDataFrame(rows, "i int, t string"), F.col("t"), "i", 64, 16).orderBy("i").collect()]
    assert kept[0] == 1 and 2 not in kept and 3 not in kept and kept[-3:] == [4, 5, 6]


def test_greedy_is_the_first_independent_set(spark):
    """Against the sequential definition, on the same bands."""
    import random

    r = random.Random(2)
    base = [[f"w{r.randrange(60)}" for _ in range(12)] for _ in range(8)]
    rows = [(i, " ".join(x if r.random() > 0.06 else "z" for x in base[i % 8])) for i in range(80)]
    frame = spark.createDataFrame(rows, "i int, t string")
    hashed = frame.select(F.col("i").alias("ord"), F.transform(F.array_distinct(F.split(F.lower("t"), " ")), lambda t: F.xxhash64(t)).alias("hashes"))
    keys = {}
    for x in near_dedup.buckets(hashed, 32, 8).collect():
        keys.setdefault(x.ord, set()).add(x.bucket)
    seen, want = set(), []
    for i, _ in rows:
        if not seen & keys[i]:
            want.append(i)
            seen |= keys[i]
    assert [x.i for x in near_dedup.greedy(frame, F.col("t"), "i", 32, 8).orderBy("i").collect()] == want


def test_signatures_agree_as_sets_do():
    """The share of equal values estimates the similarity; slices of a long text add up."""
    import numpy as np

    draw = np.random.default_rng(4)
    a, b = (draw.integers(0, 1 << 63, 2000, np.uint64) * np.uint64(2) + np.uint64(k) for k in (1, 0))
    both, one, two = (draw.integers(0, 1 << 63, n, np.uint64) for n in (6000, 1000, 2000))
    x, y = (near_dedup.signature(np.concatenate([both, own]), a, b) for own in (one, two))
    assert abs((x == y).mean() - 6000 / 9000) < 0.05
    assert (near_dedup.signature(both[:4097], a, b) == np.minimum(near_dedup.signature(both[:4096], a, b), near_dedup.signature(both[4096:4097], a, b))).all()


@pytest.mark.parametrize("n", [0, 1, 19, 20, 137])
def test_split_cuts(spark, n):
    out = relational.hash_split(spark.range(n), "id").groupBy("split").count().collect()
    c = {r.split: r["count"] for r in out}
    assert [c.get(s, 0) for s in ("train", "val", "test")] == [int(n * 0.85), int(n * 0.1), n - int(n * 0.85) - int(n * 0.1)]


def test_upsert_and_precedence(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(tuple(r) for r in relational.upsert(old, new, ["k"]).collect()) == [("a", 1), ("b", 3), ("c", 4)]
    assert sorted((r.k, r.v) for r in relational.precedence_union([old, new], ["k"], "v").collect()) == [("a", 1), ("b", 3), ("c", 4)]


def entities_of(spark):
    units = spark.createDataFrame([("unit/kwh", "kilowatt hour", "kWh", (2, 1, -2, 0, 0, 0, 0), (3.6e6, 0.0), ["k/e"]), ("unit/m", "metre", "m", (1, 0, 0, 0, 0, 0, 0), (1.0, 0.0), [])], "uri string, label string, symbol string, dimension_vector struct<L:int,M:int,T:int,I:int,Theta:int,N:int,J:int>, conversion struct<multiplier:double,offset:double>, has_quantity_kinds array<string>")
    kinds = spark.createDataFrame([("k/e", "Energy")], "uri string, label string")
    constants = spark.createDataFrame([("constant/c", "speed of light", "c", "exact", "299792458", None, "m s-1"), ("constant/G", "gravitational constant", "G", "recommended", "6.67430e-11", "0.00015e-11", "m3 kg-1 s-2")], "uri string, name string, symbol string, category string, numeric_value string, standard_uncertainty string, unit_symbol string")
    return units, kinds, constants


def test_scaffolds(spark):
    rows = scaffold.generate(*entities_of(spark)).collect()
    assert {r.archetype for r in rows} == set(scaffold.ARCHETYPES) and len(rows) == 6 + 5 + 8
    assert all(len(r.canonical_query) > 10 and len(r.ground_truth_answer) > 20 for r in rows)
    assert any("Energy" in r.ground_truth_answer for r in rows)


def test_benchmark(spark):
    units, _, constants = entities_of(spark)
    items = synthesis.generate_all(spark, units, constants, 12).collect()
    assert {i.task for i in items} == set(synthesis.TASKS)
    assert len({i.id for i in items}) == len(items)
    for i in items:
        if i.format == "mcq":
            assert [o.key for o in i.options] == list("ABCD")[: len(i.options)] and len(i.options) == 4 or i.task == "homogeneity"
            assert len({o.text for o in i.options}) == len(i.options) and sum(o.is_correct for o in i.options) == 1
            assert next(o.key for o in i.options if o.is_correct) == i.correct_option_key


def test_grades(spark):
    rows = [("mcq", "B", "x", "The correct answer is (B)"), ("mcq", "B", "x", "A"), ("mcq", "B", "x", "none"), ("free_form", None, "1 N", '{"answer": "1 kg m s-2"}'), ("free_form", None, "1 N", "2 N"), ("free_form", None, "1 N", "1 J"), ("free_form", None, "1 N", ""), ("free_form", None, "1 N", "ERROR_CALLING_MODEL: x"), ("free_form", None, "Upright", " upright ")]
    out = grading.graded(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, format string, correct_option_key string, ground_truth_answer string, response string")).orderBy("i").collect()
    assert [r.grade.error_type for r in out] == [None, "mcq_choice_mismatch", "unparseable_response", None, "magnitude_mismatch", "dimensional_mismatch", "empty_response", "provider_error", None]
    assert [r.grade.passed for r in out] == [True, False, False, True, False, False, False, False, True]


def test_scorecard_figures(spark):
    rows = spark.createDataFrame([("constants", True, 1.0), ("constants", False, 2.0), ("dimensions", True, 1.5)], "task string, passed boolean, latency double")
    b = {r.task: (r.total, r.passed, r.accuracy_pct) for r in grading.breakdown(rows, ["task"]).collect()}
    assert b == {None: (3, 2, 66.67), "constants": (2, 1, 50.0), "dimensions": (1, 1, 100.0)}
    t = grading.telemetry(rows.withColumn("model", F.lit("m"))).first()
    assert (t.avg_latency, t.p50, t.p95) == (1.5, 1.5, 2.0)


def test_pairs_use_the_latest_report(spark):
    records = spark.createDataFrame([("1", "a", "u", "q", "g"), ("2", "a", "u", "q", "g")], "id string, archetype string, entity_uri string, user_query string, ground_truth_answer string")
    reports = spark.createDataFrame([("1", False, True, ["r"], 0), ("1", True, False, [], 1), ("2", True, False, [], 0), ("2", False, True, ["r", "s"], 1)], "record_id string, passed boolean, is_dpo_eligible boolean, rejection_reasons array<string>, at int")
    out = grading.preference_pairs(records, reports, "at").collect()
    assert [(r.id, r.rejection_reason) for r in out] == [("dpo_2", "r; s")]


def test_build_and_exports(spark, tmp_path):
    personas = spark.createDataFrame([("student", "Student"), ("engineer", "Engineer")], "persona string, title string")
    out = build.build(*entities_of(spark), personas, str(tmp_path / "out"), settings=build.Settings(near=False))
    assert out.records.count() == 38 and out.statistics["summary"]["records"] == 38
    m = jsonio.manifest(spark, str(tmp_path / "out" / "openai")).collect()
    assert sum(r.record_count for r in m) == 38 and all(len(r.sha256) == 64 for r in m)
    back = jsonio.read_splits(spark, str(tmp_path / "out" / "openai"), "id string, messages array<struct<role:string,content:string>>")
    assert back.where("split = 'train'").count() == int(38 * 0.85)
    site = jsonio.files(spark, str(tmp_path / "out" / "sharegpt"), ["*.json"], [])
    rows = archive.package(site, str(tmp_path / "site.zip")).collect()
    assert rows and all(r["compressed_size"] <= r["byte_size"] + 20 for r in rows)
    parts = jsonio.read_partitions(spark, str(tmp_path / "out" / "partitions"), "id string, split string")
    assert {r.export: r["count"] for r in parts.groupBy("export").count().collect()} == {"by_persona": 38, "by_persona_train": int(38 * 0.85), "by_archetype": 38, "by_category": 38}


def test_stream_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    row = lambda i, said: {"id": str(i), "model": "m", "task": "t", "format": "mcq", "correct_option_key": "A", "response": said, "latency": 1.0, "created": "2026-01-01T00:00:00Z"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(row(i, "A")) for i in range(3)))
    streaming.grade_stream(streaming.responses(spark, src), out, ck).awaitTermination()
    (tmp_path / "in" / "2.json").write_text(json.dumps(row(9, "B")))
    streaming.grade_stream(streaming.responses(spark, src), out, ck).awaitTermination()
    assert sorted((r.id, r.grade.passed) for r in streaming.completed(spark, out).collect()) == [("0", True), ("1", True), ("2", True), ("9", False)]


def test_units_come_out_of_one_aggregation(spark):
    """Before, the texts were parsed three times, for subjects, types and properties."""
    text = "@prefix v: <http://x.org/v/> . v:a a v:Unit ; v:label \"A\" ; v:hasQuantityKind v:k , v:j , v:k . v:b a v:Unit . v:c v:label \"C\" . v:d a v:Unit , v:BaseUnit ; v:label \"E\" , \"D\" ."
    found = entities.units(turtle.triples_of(spark.createDataFrame([(text, "x"), ("no turtle", "y")], "value string, src string")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("MapInPandas") == 1 and "Join" not in plan
    v = "http://x.org/v/"
    rows = {r.uri: (r.label, r.has_quantity_kinds) for r in found.collect()}
    assert rows == {v + "a": ("A", [v + "j", v + "k"]), v + "b": ("b", None), v + "d": ("D", [])}
