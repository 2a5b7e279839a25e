import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlift.operators import quality
from cohortlift.schema import KEYS, REFERENCES, RULES, Key, Rule
from tests.conftest import by_key


@pytest.fixture(scope="module")
def clean(star, spark):
    """The small star, stored, with the planted current-account warning cleared."""
    from cohortlift.session import materialise
    tables = {n: materialise(df) for n, df in star.tables().items()}
    held = tables["fact_account_monthly"]
    tables["fact_account_monthly"] = materialise(held.withColumn(
        "balance_gel", F.when(F.col("product_sk") == 1, F.abs("balance_gel")).otherwise(F.col("balance_gel"))))
    target = tables["fact_campaign_response"].agg(F.avg("contacted").cast("decimal(4,3)")).first()[0]
    tables["dim_campaign"] = tables["dim_campaign"].withColumn("treatment_share", F.lit(target).cast("decimal(4,3)"))
    return tables


def broken(tables, check):
    """``tables`` with one row that breaks ``check``."""
    t = dict(tables)

    def add(table, **values):
        one = t[table].limit(1)
        for c, v in values.items():
            one = one.withColumn(c, F.lit(v).cast(t[table].schema[c].dataType))
        t[table] = t[table].unionByName(one)

    if check == "customers_without_transactions":
        add("dim_customer", customer_sk=10**9)
    elif check == "negative_transaction_amounts":
        add("fact_transaction", amount_gel=-1)
    elif check == "non_purchase_with_merchant":
        row = t["dim_merchant"].where("merchant_sk > 0").first()
        add("fact_transaction", txn_type="inflow", merchant_sk=row["merchant_sk"], mcc_category=row["mcc_category"])
    elif check == "category_disagrees_with_merchant":
        add("fact_transaction", txn_type="purchase", merchant_sk=1, mcc_category="n/a")
    elif check == "control_customers_contacted":
        add("fact_campaign_response", assignment="control", contacted=0, contact_date=dt.date(2001, 1, 2), annual_value_gel=0)
        t["dim_campaign"] = t["dim_campaign"]
    elif check == "campaign_targeted_existing_cardholders":
        silent = t["fact_campaign_response"].where("responded = 0").first()["customer_sk"]
        add("fact_account_monthly", customer_sk=silent, product_sk=3, month_end_date=dt.date(2000, 12, 31), balance_gel=0)
    elif check == "revenue_without_response":
        add("fact_campaign_response", responded=0, annual_value_gel=5, contacted=1, assignment="treatment")
    elif check == "transactions_outside_window":
        add("fact_transaction", date_sk=19000101)
    elif check == "current_accounts_below_floor":
        add("fact_account_monthly", product_sk=1, balance_gel="-500.01")
    else:
        t["dim_campaign"] = t["dim_campaign"].withColumn("treatment_share", F.lit(0.2).cast("decimal(4,3)"))
    return t


CHECKS = ("customers_without_transactions", "negative_transaction_amounts", "non_purchase_with_merchant",
          "category_disagrees_with_merchant", "control_customers_contacted", "campaign_targeted_existing_cardholders",
          "revenue_without_response", "transactions_outside_window", "current_accounts_below_floor", "treatment_share_off_target")


def test_clean_star_passes(clean):
    report = quality.dq_suite(clean).collect()
    assert {r["check_name"] for r in report} == set(CHECKS)
    assert all(r["status"] == "PASS" for r in report), report
    assert [r["severity"] for r in report] == ["ERROR"] * 8 + ["WARNING"] * 2


@pytest.mark.parametrize("check", CHECKS)
def test_each_check_finds_its_violation(clean, check):
    report = by_key(quality.dq_suite(broken(clean, check)), "check_name")
    failing = {n for n, r in report.items() if r["violations"]}
    assert check in failing and len(failing - {"treatment_share_off_target"}) <= 1, failing


def test_constraints(clean):
    report = quality.constraint_report(clean)
    assert report.where("violations > 0").count() == 0
    kinds = {r["kind"]: r["count"] for r in report.groupBy("kind").count().collect()}
    assert kinds["foreign"] == len(REFERENCES) - 1 and kinds["check"] == len(RULES) == 36
    assert kinds["primary"] + kinds["unique"] == len(KEYS) - 1


def test_orphans_are_counted_per_reference(clean):
    tables = broken(clean, "transactions_outside_window")
    report = {(r["table_name"], r["rule"]): r["violations"] for r in quality.fk_report(tables).collect()}
    assert report.pop(("fact_transaction", "date_sk -> dim_date")) == 1 and set(report.values()) == {0}
    one = quality.check_fk(tables["fact_transaction"], tables["dim_date"], next(r for r in REFERENCES if r.column == "date_sk"))
    assert one.first()["violations"] == 1


def test_null_rule_passes_and_false_rule_counts(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert quality.check_expr(df, "t", [Rule("t", "positive", "x > 0")]).first()["violations"] == 1


def test_unique_and_foreign(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 2), (None, 2)], "a int, b int")
    assert quality.check_unique(df, Key("t", ("a", "b"))).first()["violations"] == 1
    orphans = quality.orphan_rows(df, "b", spark.createDataFrame([(1,)], "k int"), "k").collect()
    assert [tuple(r) for r in orphans] == [(2, 3)]


def test_reconcile(spark):
    a, b = spark.range(3), spark.range(4)
    got = by_key(quality.reconcile_counts({"x": a, "y": a}, {"x": b, "y": a}, {"x": 1}), "table_name")
    assert got["x"]["status"] == "ok" and got["y"]["status"] == "ok"
    assert by_key(quality.reconcile_counts({"x": a}, {"x": b}), "table_name")["x"]["status"] == "MISMATCH"


def test_leak_gate(spark, clean):
    assert quality.leak_gate(clean) == []
    assert quality.leak_gate({"t": clean["dim_customer"].withColumn("persona", F.lit("x"))}) == ["t.persona"]
    assert "digital_engagement_flag" not in quality.model_columns(clean["dim_customer"]).columns


def test_shares_check(spark):
    rows = [("a", "x", 0.4), ("a", "y", 0.6), ("b", "x", 0.5), ("b", "y", 0.4), ("c", "q", 1.0)]
    known = spark.createDataFrame([("x",), ("y",)], "m string")
    got = by_key(quality.shares_check(spark.createDataFrame(rows, "g string, m string, s double"), "g", "m", "s", known), "g")
    assert [got[g]["status"] for g in "abc"] == ["PASS", "FAIL", "FAIL"] and got["c"]["unknown_members"] == 1
