"""Rows made by an explode: Spark takes them for as small as what they were made from, and leaves them in its tasks."""

import re

from cohortlift.operators import quality
from verification import adapter, registry

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_of_holdings_are_not_broadcast(spark):
    joins = re.findall(r"(\w+Join) \[(\w+)#", plan_of(registry.QUERIES["account_snapshot"](spark, SMALL)))
    assert joins[0] == ("SortMergeJoin", "customer_sk")


def test_monthly_balances_are_not_broadcast(spark):
    assert re.search(r"SortMergeJoin \[customer_sk#\w+\], \[customer_sk#\w+\], Inner", plan_of(registry.QUERIES["balance_by_group"](spark, SMALL)))


def test_a_load_broadcasts_no_keys_of_customers_or_merchants(spark):
    star = adapter.TestStar(spark, SMALL)
    tables = star.tables()
    # the keys of all parents, the merchants, the first month of each holder, the holders
    assert set(re.findall(r"(\w+Join) \[ref#.*LeftAnti", plan_of(quality.fk_report(tables)))) == {"SortMergeJoin"}
    checks = plan_of(quality.dq_suite(tables))
    assert re.search(r"SortMergeJoin \[merchant_sk#\w+\], \[merchant_sk#\w+\], Inner", checks)
    assert re.search(r"SortMergeJoin \[customer_sk#\w+\], \[customer_sk#\w+\], Inner", checks)
    assert re.findall(r"(\w+Join) \[customer_sk#.*LeftAnti", plan_of(star.fact_campaign_response)) == ["SortMergeJoin"]


def test_account_fact_is_spread_by_customer(spark, monkeypatch):
    monkeypatch.setattr(adapter, "CUSTOMERS_PER_TASK", 20)
    star = adapter.TestStar(spark, SMALL)
    tasks = star.fact_account_monthly.selectExpr("spark_partition_id() AS task", "customer_sk").distinct().groupBy("task").count().collect()
    customers = star.raw("customer").count()
    assert len(tasks) > 4 and sum(t["count"] for t in tasks) == customers and max(t["count"] for t in tasks) < customers / 3
    # the keys of the fact are counted where its customers are: its rows are not shuffled
    assert not re.search(r"hashpartitioning\(customer_sk#\w+, product_sk", plan_of(registry.QUERIES["unique_report"](spark, SMALL)))
    assert not re.search(r"hashpartitioning\(customer_sk#\w+, month_end_date", plan_of(registry.QUERIES["balance_path"](spark, SMALL)))


def test_models_store_only_the_columns_they_take(spark):
    stored = registry._stored_matrix(adapter.TestStar(spark, SMALL))
    assert stored.columns == ["customer_sk", *registry.SEGMENT_COLUMNS]
    whole = registry._matrix(adapter.TestStar(spark, SMALL)).select(stored.columns)
    assert whole.exceptAll(stored).count() == stored.exceptAll(whole).count() == 0


def test_tables_read_once_are_not_stored_first(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(adapter, "materialise", lambda df: kept.append(df) or df)
    registry.QUERIES["manifest"](spark, SMALL)
    registry.QUERIES["catalog_statistics"](spark, SMALL)
    assert not kept


def test_dated_customers_are_not_broadcast(spark):
    joins = re.findall(r"(\w+Join) \[(as_of#\w+, customer_sk|month_end_date)#\w+\].*?(Build\w+|LeftOuter)", plan_of(registry.QUERIES["monthly_feature_snapshots"](spark, SMALL)))
    assert [j[0] for j in joins if j[1] != "month_end_date"] == ["SortMergeJoin"] * 5
    assert [(j[0], j[2]) for j in joins if j[1] == "month_end_date"] == [("BroadcastHashJoin", "BuildRight")]
