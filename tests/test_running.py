import random

import pytest

from cohortlift.operators import running, uplift


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(running, "RANGES", 3)
    monkeypatch.setattr(running, "RANGE_ROWS", 40)


def test_totals_equal_a_plain_loop(spark, small_ranges):
    random.seed(3)
    rows = [(random.choice(["a", "b", None]), i, random.choice([None, 1, 2, 2, 2, 7]), random.randrange(100)) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, k long, x int, amount long")
    got = {r["k"]: r for r in running.running_totals(df, ["x", "k"], {"run": "amount"}, ["g"], ["x"]).collect()}
    assert len(got) == 700
    for g in ("a", "b", None):
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        total = 0
        for place, r in enumerate(members, 1):
            total += r[3]
            found = got[r[1]]
            assert (found["position"], found["group_size"], found["run"]) == (place, len(members), total)
        assert {got[r[1]]["run_total"] for r in members} == {total}


def test_no_window_runs_in_one_partition(spark, small_ranges):
    df = spark.range(500).selectExpr("id AS k", "id % 7 AS x")
    ungrouped = running.running_totals(df, ["x", "k"], {"run": "x"})
    assert "SinglePartition" not in plan_of(ungrouped) and "Window" not in plan_of(ungrouped)
    assert sorted(r["position"] for r in ungrouped.collect()) == list(range(1, 501))
    scores = spark.range(500).selectExpr("id AS customer_sk", "(id % 50) / 100D AS score")
    lines = plan_of(uplift.targeting_cutoff(scores, "score", 10.0, 1.0)).splitlines()
    # the best total is one row; nothing else may come together
    assert all("partial_max" in lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line) and not any("Window" in line for line in lines)


def test_empty_and_single_rows(spark):
    df = spark.createDataFrame([], "g string, k long, x long")
    assert running.running_totals(df, ["x", "k"], {"run": "x"}).count() == 0
    assert running.running_totals(df, ["x", "k"], {"run": "x"}, ["g"]).count() == 0
    one = spark.createDataFrame([("a", 1, None)], "g string, k long, x long")
    assert tuple(running.running_totals(one, ["x", "k"], {"run": "x"}).first()[3:]) == (1, 1, 0, 0)


@pytest.mark.parametrize("n, tiles", [(10, 3), (3, 5), (5, 5), (23, 4)])
def test_grouped_tiles_equal_ntile(spark, n, tiles):
    df = spark.range(2 * n + 1).selectExpr("id AS k", "id % 2 AS g", "hash(id) % 5 AS x").repartition(3)
    got = running.grouped_ntile(df, ["g"], "x", "k", tiles, "t", descending=True).collect()
    df.createOrReplaceTempView("tiles_in")
    want = spark.sql(f"SELECT k, ntile({tiles}) OVER (PARTITION BY g ORDER BY x DESC, k) AS t FROM tiles_in").collect()
    assert sorted((r["k"], r["t"]) for r in got) == sorted((r["k"], r["t"]) for r in want)


def test_ties_spread_over_ranges(spark, small_ranges):
    """One value on all rows of one group: the key splits them."""
    df = spark.range(400).selectExpr("'hot' AS g", "id AS k", "1L AS x")
    placed = running.running_totals(df, ["x", "k"], {"run": "x"}, ["g"])
    assert sorted(r["run"] for r in placed.collect()) == list(range(1, 401))


@pytest.mark.parametrize("budget, contacted", [(None, 30), (25.0, 25), (0.5, 0), (1000.0, 30)])
def test_cutoff_stops_at_the_highest_profit(spark, budget, contacted):
    """30 of 100 customers are worth more than a contact; one without a score is never worth it."""
    scores = spark.range(100).selectExpr("id AS customer_sk", "CASE WHEN id = 99 THEN NULL WHEN id < 30 THEN 0.2 ELSE 0.05 END AS score")
    got = uplift.targeting_cutoff(scores, "score", 10.0, 1.0, budget).collect()
    assert sum(r["contact"] for r in got) == contacted and len(got) == 100
    assert [r["customer_sk"] for r in sorted(got, key=lambda r: r["position"])][-1] == 99
    assert max(r["profit_gel"] for r in got) == pytest.approx(30.0)


def test_nothing_earns(spark):
    scores = spark.createDataFrame([(1, 0.01), (2, -0.5)], "customer_sk long, score double")
    assert [r["contact"] for r in uplift.targeting_cutoff(scores, "score", 10.0, 1.0).collect()] == [0, 0]
