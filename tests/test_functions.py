"""Scalar functions against known values and plain Python."""

import math
import re
import statistics
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.functions import answers as A
from millrace.functions import numeric as N
from millrace.functions import text as T
from millrace.functions import units as U
from pyspark.sql import functions as F


def apply(spark, f, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in frame.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_tokens(spark):
    texts = ["", None, "a", "Grüße, Welt!", "x = 1.5 m/s²", "日本 語", "🙂 ok"]
    want = [max(1, int(len(re.findall(r"\w+|[^\w\s]", t)) * 1.1)) if t else 0 for t in texts]
    assert apply(spark, T.approx_tokens, texts) == want


def test_math_balance(spark):
    assert apply(spark, T.well_formed, ["$c$", "$c", "\\$5", "{a}", "{a", "\\{ }", ""]) == [True, False, True, True, False, False, True]
    assert apply(spark, T.math_problems, ["$ {"])[0] == ["Unbalanced inline/block math '$' delimiters (found 1).", "Unbalanced curly braces '{}' (open: 1, close: 0)."]


def test_bytes_globs_and_labels(spark):
    assert apply(spark, T.human_bytes, [5, 2048, 3 * 1024**2, 5 * 1024**3], "long") == ["5 B", "2.0 KB", "3.0 MB", "5.0 GB"]
    assert apply(spark, lambda c: T.included(c, ["*.html", "by_*"], ["x*"]), ["a/index.html", "by_a/b", "x.html", "q"]) == [True, True, False, False]
    assert apply(spark, T.file_label, ["index.html", "benchmark/a_scorecard.json", "val.jsonl", "zz"]) == ["Web Portal Landing", "Model Evaluation Scorecard", "Dataset Split / Samples", "Website Asset"]


def test_dimensions(spark):
    d = apply(spark, N.dimension, ["L2 M1 T-2", "A0E0L2I0M1H0T-2D0", "", "E0I1", "Theta3"])
    assert [tuple(x) for x in d] == [(2, 1, -2, 0, 0, 0, 0), (2, 1, -2, 0, 0, 0, 0), (0,) * 7, (0,) * 7, (0, 0, -0, 0, 3, 0, 0)]
    assert apply(spark, lambda c: N.dimension_latex(N.dimension(c)), ["L1M1T-2", ""]) == ["\\text{L} \\cdot \\text{M} \\cdot \\text{T}^{-2}", "1"]
    assert apply(spark, lambda c: N.si_latex(N.dimension(c)), ["L1M1T-2H1"]) == ["\\text{kg} \\cdot \\text{m} \\cdot \\text{s}^{-2} \\cdot \\text{K}"]


def test_concise_values(spark):
    got = apply(spark, N.concise_value, ["6.67430(15)e-11", "0.0072973525693(11)", "12(3)", "1.5", "2.5(123)"])
    assert [tuple(x) for x in got] == [("6.67430e-11", "0.00015e-11"), ("0.0072973525693", "0.0000000000011"), ("12", "3"), ("1.5", None), ("2.5", "12.3")]


number = st.decimals(allow_nan=False, allow_infinity=False, places=None, min_value=Decimal("-1e30"), max_value=Decimal("1e30")).map(str)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(number, number), min_size=150, max_size=150))
def test_decimals(spark, pairs):
    pairs = pairs + [("1e3", "1000"), ("1.50", "1.5"), ("-0", "0.0"), ("6.62607015e-34", "66.2607015E-35"), ("1", "1.0000000000000000000000000001")]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in frame.orderBy("i").select(N.same_decimal(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal(a) == Decimal(b) for a, b in pairs]
    assert frame.where(~N.same_decimal(F.col("a"), F.col("a"))).count() == 0


@pytest.mark.parametrize(
    ("left", "right", "same"),
    [("1 N", "1 kg * m / s**2", True), ("1 N", "1 J", False), ("6.02214076e23 mol**-1", "6.02214076e23 / mol", True), ("100 degC", "373.15 K", True), ("32 degF", "273.15 K", True), ("9.80665 m/s**2", "9.80665 m s**-2", True), ("0 m", "0 m", True), ("5 m", "5.0004 m", True), ("5 m", "5.01 m", False), ("1 kilometer", "1000 m", True)],
)
def test_units(left, right, same):
    assert U.compare(left, right)[0] is same


def test_unit_errors():
    assert "Dimensional incompatibility" in U.compare("1 N", "1 J")[1]
    assert "Magnitude mismatch" in U.compare("1 m", "2 m")[1]
    assert "Unit evaluation error" in U.compare("1 blorb", "2 m")[1]
    assert U.compare("10 degC", "10 K", delta=True)[0]


def test_choices(spark):
    texts = ["B", "(c)", "Option D", '{"answer": "A", "explanation": " why "}', '```json\n{"choice": "(b)"}\n```', "<think>A</think> **C**", '<think>x</think>{"key": "d", "notes": "n"}', "none", "", None, "The correct answer is: B because A is wrong"]
    got = apply(spark, A.mcq, texts)
    assert [r["key"] for r in got] == ["B", "C", "D", "A", "B", "C", "D", None, None, None, "B"]
    assert [r["explanation"] for r in got][3] == "why" and got[6]["explanation"] == "n"


def test_free_forms(spark):
    texts = ['{"answer": "5 m", "explanation": "x"}', "So \\boxed{\\frac{1}{2} m} it is", "\\hbar = 1.05e-34 J s", "", "a long text that says nothing of the kind at all whatever", '{"value": 3}', "<think>1</think>7 kg"]
    assert [r["answer"] for r in apply(spark, A.freeform, texts)] == ["5 m", "\\frac{1}{2} m", "1.05e-34 J s", "", texts[4], "3", "7 kg"]


def test_paraphrases_and_mappings(spark):
    got = apply(spark, A.paraphrases, ['["What is the metre really?", "no"]', "Here are some:\n1. What is a second, please?\n- How long is a metre now?\n"])
    assert got == [["What is the metre really?"], ["What is a second, please?", "How long is a metre now?"]]
    assert apply(spark, A.mapping, ['x {"Physics Student": "q1", "b-c": "q2"} y'])[0] == {"physics_student": "q1", "b_c": "q2"}


def test_statistics(spark):
    from millrace.operators.relational import distribution

    for values in ([1], [1, 2], [1, 2, 3, 4], [5, 5, 1], list(range(100)), [3] * 20 + [9]):
        frame = spark.createDataFrame([(v,) for v in values], "v long")
        r, s, n = distribution(frame, "v").first(), sorted(values), len(values)
        assert (r.median, r.p95, r.p99) == tuple(s[min(n - 1, int(n * q))] for q in (0.5, 0.95, 0.99))
        assert r["std"] == round(statistics.pstdev(values), 1) or math.isclose(r["std"], statistics.pstdev(values), abs_tol=0.051)


def test_unit_notation():
    deep = "a"
    for _ in range(9):
        deep = rf"\frac{{{deep}}}{{b}}"
    assert U.plain(deep) == "(" * 9 + "a" + ") / (b)" * 9
    assert [U.plain(x) for x in (r"$\text{kg} \cdot \text{m}^{2} \, \text{s}^{-2}$", "J s", "mol-1", "1.5e-34 J", r"\[ \mathrm{m}\times\mathrm{s}^-1 \]", "kg·m−1", r"\left( a \right)", r"\frac{1}", "", None, "{a", r"\Omega^{2}", "5 m2")] == [
        "kg * m**2 s**-2", "J s", "mol**-1", "1.5e-34 J", "m * s**-1", "kg * m**-1", "( a )", r"\frac{1}", "", "", "{a", r"\Omega**2", "5 m2",
    ]


def test_letters_in_prose(spark):
    texts = ["Answer: (B)", "answer = **d**", "The correct answer is _A_, not B", "Correct option is C", 'x {"answer": "D", broken', "So (a) or [b]", "maybe [b] but option c", "B) is it", "I take a break", "no", 'text ```json\n{"answer": {"x": 1}, "option": "C"}\n``` more']
    assert [r["key"] for r in apply(spark, A.mcq, texts)] == ["B", "D", "A", "C", "D", "A", "B", "B", "A", None, "C"]


def test_endpoints(spark):
    """Endpoint, model, asked type; then type, provider, URL, local."""
    cases = [
        ("http://localhost:11434/v1", "m:4b", None, "local", "Ollama (Local Host)", "http://localhost:11434/v1", True), ("http://localhost:11434/v1", "m:cloud", None, "cloud", "Ollama Cloud (Proxy via Local Host)", "http://localhost:11434/v1", False),
        ("http://127.0.0.1:8000/v1?k=1", "m", None, "local", "vLLM (Local Host)", "http://127.0.0.1:8000/v1", True), ("https://api.openai.com/v1", "m", None, "cloud", "OpenAI API (Cloud)", "https://api.openai.com/v1", False),
        ("https://x.example.org/v1", "m", None, "cloud", "Remote Cloud Endpoint (x.example.org)", "https://x.example.org/v1", False), ("http://gpu.lan:9000", "m", "local", "local", "Local Server", "http://gpu.lan:9000", True),
        (None, "m", None, "local", "Local Inference", None, True), ("https://api.openai.com/v1", "gold", None, "baseline", "In-Memory Deterministic Baseline", None, True),
    ]
    frame = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k int, url string, model string, asked string")
    got = frame.orderBy("k").select(T.endpoint_class(F.col("url"), F.col("model"), F.col("asked")).alias("e")).select("e.*").collect()
    assert [tuple(r) for r in got] == [c[3:] for c in cases]
