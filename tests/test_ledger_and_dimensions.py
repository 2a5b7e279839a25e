import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlift.operators import dimensions, ledger
from tests.conftest import by_key


def test_golden_ledger(spark):
    flows = spark.createDataFrame([
        (1, 1, 900.0, 100.0), (1, 3, 3000.0, 10.0), (1, 2, 50.0, 2500.0), (2, 1, 5.0, 9.0), (2, 2, 0.0, 900.0), (2, 3, 100.0, 0.0),
    ], "customer_sk long, month int, inflow double, outflow double")
    openings = spark.createDataFrame([(1, 1000.0, 1000.0, 1, 800.0), (2, 20.0, 20.0, 0, 0.0)],
                                     "customer_sk long, opening_gel double, buffer_gel double, has_savings int, opening_savings_gel double")
    got = {(r["customer_sk"], r["month"]): (r["current_account_gel"], r["savings_gel"]) for r in ledger.ledger_rollforward(flows, openings).collect()}
    want = {(1, 1): (1480, 1123.2), (1, 2): (-500, 1127.6928), (1, 3): (1894, 1728.203571), (2, 1): (16, 0), (2, 2): (-500, 0), (2, 3): (-400, 0)}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_dense_months(spark):
    who = spark.createDataFrame([(1,), (2,)], "customer_sk long")
    flows = spark.createDataFrame([(1, dt.date(2020, 3, 1), 5), (1, dt.date(2021, 1, 1), 9)], "customer_sk long, month date, inflow int")
    got = ledger.densify_months(who, flows, "2020-02-15", 3, ["inflow"]).collect()
    assert sorted((r["customer_sk"], str(r["month"]), r["inflow"]) for r in got) == [
        (1, "2020-02-01", 0), (1, "2020-03-01", 5), (1, "2020-04-01", 0), (2, "2020-02-01", 0), (2, "2020-03-01", 0), (2, "2020-04-01", 0)]


def test_snapshot_goes_live_when_opened(spark):
    held = spark.createDataFrame([(1, 1, -1), (1, 3, 2)], "customer_sk long, product_sk long, open_month_idx int")
    rows = ledger.account_snapshot(ledger.live_holdings(held, "2020-01-01", 3), F.lit(1.005)).collect()
    assert sorted((r["product_sk"], r["date_sk"], r["opened_this_month"]) for r in rows) == [
        (1, 20200131, 0), (1, 20200229, 0), (1, 20200331, 0), (3, 20200331, 1)]


def test_loan_is_paid_off(spark):
    df = spark.range(0, 50, 12).select(F.round(ledger.loan_remaining(F.lit(360.0), F.col("id"), F.lit(0)), 6).alias("b"))
    assert [abs(r["b"]) for r in df.orderBy("b").collect()] == [360, 240, 120, 0, 0]


def test_standardize(spark):
    df = spark.createDataFrame([(1, 2.0, 7), (2, 4.0, 7), (3, 6.0, 7)], "k int, x double, y int")
    got = ledger.standardize(df, ["x", "y"]).orderBy("k").collect()
    assert [round(r["x_z"], 6) for r in got] == [-1.224745, 0, 1.224745] and all(r["y_z"] == 0.0 for r in got)


def test_calendar(spark):
    days = dimensions.with_unknown_date(dimensions.calendar_window(spark, "2024-01-01", 1, 1))
    got = by_key(dimensions.with_unknown_date(days), "date_sk")
    assert len(got) == 31 + 29 + 1 and got[0]["full_date"] is None and got[0]["day_name"] == "Unknown"
    leap = got[20240229]
    assert (leap["day_of_week"], leap["day_name"], leap["is_weekend"], leap["is_month_end"], leap["quarter"], leap["month_name"], leap["year_month"]) == (
        4, "Thursday", 0, 1, 1, "February", "2024-02")
    assert got[20240106]["is_weekend"] == 1


def test_merchants_products_campaign(spark):
    merchants = by_key(dimensions.merchant_dim(spark, 40), "merchant_sk")
    assert len(merchants) == 401 and merchants[0]["mcc_category"] == "n/a"
    assert (merchants[41]["merchant_name"], merchants[41]["mcc_code"]) == ("Dining Merchant 01", 5812)
    assert merchants[400]["merchant_name"] == "Travel Merchant 40"
    row = dimensions.campaign_dim(dimensions.product_dim(spark), "2026-01-15", "n", "sms").first()
    assert (row["target_product_sk"], str(row["end_date"]), str(row["measurement_end_date"])) == (3, "2026-01-25", "2026-03-26")
