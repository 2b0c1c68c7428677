"""Graph patterns against all assignments, tried one by one."""

from itertools import product

import pytest
from millrace.operators import patterns
from millrace.operators.patterns import Pattern

ROWS = [
    ("a", "type", "T", None), ("b", "type", "T", None), ("c", "type", "U", None), ("a", "label", "one", "en"), ("a", "label", "eins", "de"), ("b", "label", "zwei", "de"), ("a", "kind", "k1", None), ("a", "kind", "k2", None),
    ("k1", "label", "K1", ""), ("k2", "label", "K2", "en"), ("c", "kind", "k1", None), ("b", "alias", "bee", None), ("a", "alias", "one", None), ("d", "same", "d", None), ("d", "same", "e", None), (None, "kind", "k1", None), ("c", None, "k", None), ("a", "kind", "k1", None),
]


@pytest.fixture(scope="module")
def graph(spark):
    return spark.createDataFrame(ROWS, "s string, p string, o string, lang string")


def solutions(rows, required):
    """All ways to give each pattern a triple so that the variables agree."""
    out = []
    for chosen in product(rows, repeat=len(required)):
        bound = {}
        for (s, p, o, lang), x in zip(chosen, required):
            for term, value in ((x.s, s), (x.p, p), (x.o, o)):
                if value is None or (bound.setdefault(term, value) != value if term.startswith("?") else term != value):
                    break
            else:
                if x.langs is None or (lang or "") in x.langs:
                    continue
            break
        else:
            out.append({k[1:]: v for k, v in bound.items()})
    return out


def optional(left, groups):
    """Left joins in order; unbound variables are bound by a later group."""
    for found in groups:
        names = {k for f in found for k in f}
        out = []
        for row in left:
            fits = [f for f in found if all(row.get(k) is None or row[k] == v for k, v in f.items())]
            out += [{**row, **f} for f in fits] or [{**dict.fromkeys(names), **row}]
        left = out
    return left


def same(df, want):
    cols = sorted(df.columns)
    key = lambda r: [str(x) for x in r]
    assert sorted(([r[c] for c in cols] for r in df.collect()), key=key) == sorted(([w[c] for c in cols] for w in want), key=key)


@pytest.mark.parametrize("required", [
    [Pattern("?x", "type", "T"), Pattern("?x", "label", "?l")],
    [Pattern("?x", "type", "T"), Pattern("?x", "label", "?l", langs=("en", ""))],
    [Pattern("?x", "kind", "?k"), Pattern("?k", "label", "?l"), Pattern("?x", "type", "?t")],
    [Pattern("?x", "same", "?x")],
    [Pattern("a", "?p", "?o")],
    [Pattern("?x", "kind", "?k"), Pattern("?y", "kind", "?k")],
])
def test_required(spark, graph, required):
    same(patterns.match(graph, required), solutions(ROWS, required))


@pytest.mark.parametrize("most", [0, 1000])
def test_optional_groups_multiply_and_bind(spark, graph, monkeypatch, most):
    """Broadcast and shuffled sides give the same rows."""
    monkeypatch.setattr(patterns, "BROADCAST_ROWS", most)
    required = [Pattern("?x", "type", "?t")]
    groups = [[Pattern("?x", "label", "?l", langs=("en",))], [Pattern("?x", "alias", "?l")], [Pattern("?x", "kind", "?k"), Pattern("?k", "label", "?kl")]]
    want = optional(solutions(ROWS, required), [solutions(ROWS, g) for g in groups])
    same(patterns.match(graph, required, groups), want)
    names = {(w["x"], w["kl"]) for w in want}
    assert {tuple(r) for r in patterns.match(graph, required, groups, ["x", "kl"], distinct=True).collect()} == names


def test_the_rarest_pattern_is_joined_first(spark, graph):
    many, few, far = Pattern("?x", "?p", "?o"), Pattern("?x", "alias", "?a"), Pattern("?o", "label", "?l")
    assert patterns.counts(graph, [many, few, far]) == [16, 2, 5]
    assert patterns.order_of([many, few, far], [16, 2, 5]) == [1, 0, 2]


def test_what_is_refused_and_what_is_empty(spark, graph):
    with pytest.raises(ValueError):
        patterns.match(graph, [Pattern("?x", "type", "T"), Pattern("?y", "alias", "?z")])
    with pytest.raises(ValueError):
        patterns.match(graph, [Pattern("?x", "type", "T")], [[Pattern("?y", "alias", "?z")]])
    assert patterns.match(graph.limit(0), [Pattern("?x", "type", "T")], [[Pattern("?x", "kind", "?k")]]).collect() == []
    assert patterns.match(graph, [Pattern("?x", "type", "T")], [[Pattern("?x", "none", "?k")]], ["x", "k"]).where("k is null").count() == 2


def test_optional_groups_of_one_variable_make_no_pairs(spark, monkeypatch):
    """Before, a source's titles met each other: 1,600 rows for 40 titles, and a join by conditions on the third."""
    rows = [("s", "title", f"t{k}", "en") for k in range(40)] + [("s", "long", f"t{k}", "fr") for k in range(40)] + [("s", "title", f"t{k}", "es") for k in range(20, 60)] + [("u", "title", "x", "en"), ("u", "title", "y", "es")]
    seen, real = [], patterns.bound_or_equal
    monkeypatch.setattr(patterns, "bound_or_equal", lambda left, *rest: seen.append(left.count()) or real(left, *rest))
    monkeypatch.setattr(patterns, "BROADCAST_ROWS", 0)
    groups = [[Pattern("?s", "long", "?t", langs=("fr",))], [Pattern("?s", "title", "?t", langs=("es",))]]
    found = patterns.match(spark.createDataFrame(rows, "s string, p string, o string, lang string"), [Pattern("?s", "title", "?any", langs=("en",))], groups, ["s", "t"], distinct=True)
    assert sorted(map(tuple, found.collect())) == sorted([("s", f"t{k}") for k in range(40)] + [("u", "y")])
    assert seen == [2, 41]
    assert ", LeftOuter, (" not in found._jdf.queryExecution().executedPlan().toString()
