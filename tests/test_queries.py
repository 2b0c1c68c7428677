"""Every registered query of the engine itself against its DuckDB SQL."""

import duckdb
import numpy as np
import pytest
from millrace.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return None if v != v else round(float(v), 6)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else str(v)


def rows(columns, records):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(([plain(r[i]) for i in at] for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    assert registry.flagship(spark, SF).count() > 0


def test_parts_are_dealt_before_they_become_turtle(spark):
    """Before, a small file of parts was one task, which parsed all texts."""
    from millrace.plans import ingestion

    assert ingestion.parts_graph(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_items_are_made_of_drawn_rows_alone(spark):
    """Before, options were made for every constant and every pair of units, and then most were left out."""
    from millrace.operators import synthesis
    from millrace.plans.synthesis import constants, units

    sf = "/root/testdata/sf0.001"
    below = lambda df: (lambda plan: plan[plan.rindex("Sort [") :])(df._jdf.queryExecution().optimizedPlan().toString())
    assert "%.6e" not in below(synthesis.constants_task(constants(spark, sf), 5))
    assert "Only for small values." not in below(synthesis.homogeneity_task(spark, units(spark, sf), 5))


def test_every_part_has_all_notations(spark):
    """Before, the fixed notations that the query once read were gone."""
    from millrace.plans import ingestion

    rows = ingestion.latex_sanitize(spark, "/root/testdata/sf0.001").where("p_partkey = 1").collect()
    assert len(rows) == 12 and {p for _, p in ingestion.LATEX} < {r.plain for r in rows}


def test_every_part_has_all_pairs_of_quantities(spark):
    """Before, scales, unknown units and powers of brackets were gone from the query."""
    from millrace.plans import ingestion

    rows = ingestion.unit_equivalence(spark, "/root/testdata/sf0.001").where("p_partkey = 4").collect()
    assert sorted(r.same for r in rows) == sorted([True, *[same for _, _, same in ingestion.UNITS]])
