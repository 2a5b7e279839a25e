import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from verification import oracle, registry
from verification.check import compare, connect

SMALL = "/root/testdata/sf0.001"
ROOT = Path(entry.__file__).parent
ITERATIVE = {"choose_k", "segment_customers", "uplift_scores", "equal_budget_comparison"}


def test_every_query_but_the_iterative_has_sql():
    assert set(registry.QUERIES) - set(oracle.SQL) == ITERATIVE
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - ITERATIVE))
def test_query_equals_sql(spark, duck, name):
    ok, _, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert ok, note


@pytest.mark.parametrize("name", ["not_null_report_damaged", "unique_report_damaged", "fk_report_damaged", "rule_report_damaged"])
def test_damage_shows_in_every_line(spark, name):
    lines = entry.queries()[name](spark, SMALL).collect()
    assert lines and [(r.table_name, r.rule) for r in lines if r.violations == 0] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_library_stays_distributed():
    """No Python UDFs, no cross joins, no local checkpoints, no pandas in the library."""
    for path in (ROOT / "cohortlift").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        text = path.read_text()
        for banned in (r"\budf\(", "pandas", "crossJoin", "localCheckpoint", "toPandas", r"\.rdd\b", r"F\.rand"):
            assert not re.search(banned, text), (path, banned)


def test_segments_and_uplift_models(spark):
    sizes = [r["count"] for r in entry.queries()["segment_customers"](spark, SMALL).groupBy("cluster").count().collect()]
    assert 2 <= len(sizes) <= 6
    scores = entry.queries()["uplift_scores"](spark, SMALL)
    assert scores.count() == sum(sizes)
    low, high = scores.selectExpr("min(uplift)", "max(uplift)").first()
    assert -1 <= low <= high <= 1
