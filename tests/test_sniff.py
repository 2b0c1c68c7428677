"""Files of every shape, read without being told which."""

import json

import pytest
from millrace.sources import sniff


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("shapes")
    put = lambda name, text: ((top / name).parent.mkdir(exist_ok=True, parents=True), (top / name).write_text(text))
    flat = [{"id": f"r{k}", "user_query": f"q\n{k}", "answer": "a", "n": k, "x": 1.5 * k, "mixed": k if k % 2 else str(k), "none": None} for k in range(5)]
    put("lines.jsonl", "\n".join(map(json.dumps, flat)) + '\n{"id": "broken\n\n   \n[1, {"id": "inside"}]\n7\n')
    put("deep/array.json", json.dumps([{"id": "p", "deep": {"a": [1, 2]}, "OBJECT<": 1}, {"id": "q", "only": True}], indent=2))
    put("one-per-line.json", '[\n{"id": "s1"},\n{"id": "s2"},\n{"id": "s3"}\n]')
    put("chat.jsonl", json.dumps({"id": "c", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]}) + "\n" + json.dumps({"id": 9, "conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]}))
    put("dpo.json", json.dumps({"data": [{"id": "d", "prompt": "p", "chosen": "c", "rejected": "r", "rejection_reason": "w"}]}, indent=1))
    put("m_scorecard.json", json.dumps({"model_name": "m", "overall_accuracy_pct": 91.5, "items": [{"id": "not a record"}]}, indent=4))
    put("empty.json", "")
    put("two.json", '{"id": "t1",\n "n": 1}\n{"id": "t2",\n "n": 2}\n')
    put("text.md", "# no JSON\nat all")
    return str(top)


def test_shapes(spark, folder):
    found = sniff.read_any(spark, folder)
    assert {r.shape: (r.records, r.files) for r in found.shapes().collect()} == {"flat": (11, 3), "chat": (2, 1), "preference": (1, 1), "scorecard": (1, 1)}
    flat = {r.id: r for r in found.typed("flat").collect()}
    assert set(flat) == {f"r{k}" for k in range(5)} | {"inside", "p", "q", "s1", "s2", "s3"}
    assert flat["r3"].n == 3 and flat["r3"].x == 4.5 and flat["r3"].user_query == "q\n3" and flat["r3"].none is None and flat["q"].only is True and flat["p"].deep.a == [1, 2]
    assert json.loads(flat["r3"].mixed.toJson()) == 3 and json.loads(flat["r2"].mixed.toJson()) == "2"
    card = found.typed("scorecard").first()
    assert card.model_name == "m" and card.overall_accuracy_pct == 91.5 and card.file.endswith("m_scorecard.json")
    assert sorted(r.text for r in found.bad.collect()) == sorted(['{"id": "broken', "1", "7", "# no JSON\nat all", '{"id": "t1",\n "n": 1}\n{"id": "t2",\n "n": 2}\n'])


def test_viewer_rows(spark, folder):
    rows = {r.id: r for r in sniff.read_any(spark, folder).viewer("S").collect()}
    assert (rows["c"].user_query, rows["c"].ground_truth_answer) == ("hi", "ho") and (rows["9"].user_query, rows["9"].ground_truth_answer) == ("x", "y")
    assert rows["d"].is_dpo and rows["d"].rejected == "r" and rows["r1"].user_query == "q\n1" and not rows["r1"].is_dpo and len(rows) == 14


def test_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n \n")
    found = sniff.read_any(spark, str(tmp_path))
    assert found.shapes().collect() == [] and found.typed("flat") is None and found.viewer("S") is None and found.bad.collect() == []


def test_types():
    assert sniff.ddl("OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: VOID>>, d: DECIMAL(3,2), e: OBJECT<>, `f: VOID`: STRING>") .startswith("STRUCT<a: BIGINT, b: ARRAY<STRUCT<c: STRING>>, d: DOUBLE, e: VARIANT")
