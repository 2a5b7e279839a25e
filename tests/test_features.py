import datetime as dt
from decimal import Decimal

import pytest

from cohortlift.operators import features as f
from cohortlift.operators import profiles
from verification.adapter import AS_OF
from tests.conftest import by_key

DAY = "2026-05-31"
BALANCE = "customer_sk long, product_sk long, month_end_date date, balance_gel decimal(14,2)"


def buy(c, d, cat="dining", a=10, m=1, ch="pos"):
    return (c, d, "purchase", ch, cat, m, a)


def test_single_purchase(spark, txn_of):
    got = by_key(f.transaction_features(txn_of([buy(1, "2026-05-30", a=12.5)]), DAY))[1]
    assert got["ticket_volatility_gel"] is None and got["median_ticket_gel"] == 12.5
    assert got["purchases_per_active_month"] == 1.0 and got["weekend_txn_share"] == 1.0 and got["recency_days"] == 1


def test_transaction_counts(spark, txn_of):
    rows = [buy(1, "2026-03-02", a=1, m=1), buy(1, "2026-03-03", a=2, m=1), buy(1, "2026-04-01", a=9, m=2), buy(1, "2026-05-31", a=500, m=7)]
    got = by_key(f.transaction_features(txn_of(rows), DAY))[1]
    assert (got["purchase_count"], got["active_months"], got["distinct_merchants"], got["max_ticket_gel"]) == (3, 2, 2, 9.0)
    assert got["total_spend_gel"] == 12.0 and got["median_ticket_gel"] == 2.0 and got["avg_ticket_gel"] == 4.0


def test_absent_and_unlisted_categories(spark, txn_of):
    txn = txn_of([buy(1, "2026-01-01", "dining", 30), buy(1, "2026-01-01", "fuel", 10), buy(2, "2026-01-01", "casino", 5),
                  buy(3, "2026-01-01", "casino", 30), buy(3, "2026-01-02", "travel", 10)])
    shares, profile = by_key(f.category_shares(txn, DAY)), by_key(profiles.spend_profile(txn, DAY))
    assert (shares[1]["sh_dining"], shares[1]["sh_travel"]) == (0.75, 0.0) and profile[1]["sh_travel"] is None
    assert all(v == 0.0 for k, v in shares[2].items() if k.startswith("sh_"))
    assert shares[3]["sh_travel"] == 1.0 and profile[3]["sh_travel"] == 0.25


def test_channels(spark, txn_of):
    txn = txn_of([buy(1, "2026-01-01", a=60, ch="mobile_app"), (1, "2026-01-02", "cash_withdrawal", "atm", "n/a", 0, 20),
                  (1, "2026-01-03", "cash_withdrawal", "branch", "n/a", 0, 20), (2, "2026-01-03", "inflow", "transfer", "n/a", 0, 20),
                  buy(3, "2026-01-01", a=60, ch="branch")])
    got = by_key(f.channel_features(txn, DAY))
    assert sorted(got) == [1, 3]
    assert (got[1]["digital_value_share"], got[1]["cash_value_share"], got[1]["withdrawal_count"], got[1]["avg_withdrawal_gel"]) == (0.6, 0.2, 2, 20.0)
    assert (got[3]["withdrawal_count"], got[3]["avg_withdrawal_gel"]) == (0, 0.0)
    report = by_key(profiles.channel_profile(txn, DAY))
    assert report[1]["cash_value_share"] == 0.4 and report[1]["channels_used"] == 3 and report[3]["avg_withdrawal_gel"] is None


def test_income(spark, txn_of):
    inflow = lambda c, d, a: (c, d, "inflow", "transfer", "n/a", 0, a)
    got = by_key(f.income_features(txn_of([inflow(1, "2026-01-05", 100), inflow(1, "2026-01-20", 100), inflow(1, "2026-02-20", 100),
                                           inflow(2, "2026-02-20", "0.50"), buy(3, "2026-01-01")]), DAY))
    assert sorted(got) == [1, 2]
    assert got[1]["avg_monthly_inflow_gel"] == 150.0 and got[1]["inflow_volatility_gel"] == pytest.approx(70.710678, abs=1e-6)
    assert got[1]["months_with_inflow"] == 2 and got[1]["min_monthly_inflow_gel"] == 100.0
    assert got[2]["inflow_volatility_gel"] is None and got[2]["inflow_cv"] == 0.0


def test_momentum_window_ends_are_clipped(spark, txn_of):
    rows = [buy(1, "2026-02-28", a=1), buy(1, "2026-02-27", a=10), buy(1, "2025-11-30", a=100), buy(1, "2025-11-29", a=1000)]
    got = by_key(f.momentum_features(txn_of(rows), DAY))[1]
    assert (got["spend_last_3m"], got["spend_prior_3m"], got["txns_last_3m"]) == (1.0, 110.0, 1)
    assert got["spend_momentum"] == pytest.approx(-109 / 110)


def test_zero_mean_balance(spark, star):
    rows = [(1, 1, dt.date(2026, 1, 31), Decimal(-5)), (1, 1, dt.date(2026, 2, 28), Decimal(5)), (1, 4, dt.date(2026, 2, 28), Decimal(900)),
            (1, 1, dt.date(2026, 5, 31), Decimal(77))]
    snap = spark.createDataFrame(rows, BALANCE)
    got = by_key(f.balance_features(snap, star.dim_product, DAY))[1]
    report = by_key(profiles.balance_profile(snap, star.dim_product, DAY))[1]
    assert got["balance_cv"] == pytest.approx(7.0710678) and report["balance_cv"] is None
    assert (got["balance_trend_gel"], got["months_negative"], got["avg_balance_gel"]) == (10.0, 1, 0.0)


def test_holdings_at_latest_snapshot(spark, star):
    rows = [(1, 1, dt.date(2026, 4, 30), Decimal(10)), (1, 4, dt.date(2026, 3, 31), Decimal(9)), (2, 6, dt.date(2026, 4, 30), Decimal(-70)),
            (2, 1, dt.date(2026, 4, 30), Decimal(0)), (3, 1, dt.date(2026, 5, 31), Decimal(5))]
    got = by_key(f.holding_features(spark.createDataFrame(rows, BALANCE), star.dim_product, DAY))
    assert sorted(got) == [1, 2] and got[1]["has_savings"] == 0 and got[1]["products_held"] == 1
    assert (got[2]["has_loan"], got[2]["total_assets_gel"], got[2]["total_liabilities_gel"]) == (1, 0.0, 70.0)


def _near(a, b):
    return a == b if isinstance(a, str) or a is None else a == pytest.approx(b, rel=1e-9, abs=1e-9)


def _matrix_by_blocks(txn, snapshot, customers, products, as_of):
    """The matrix from the single blocks; the fused plan must equal it."""
    out = customers.select(f.KEY, *f.CUSTOMER_COLUMNS)
    for part in (f.transaction_features(txn, as_of), f.category_shares(txn, as_of), f.channel_features(txn, as_of),
                 f.income_features(txn, as_of), f.momentum_features(txn, as_of),
                 f.balance_features(snapshot, products, as_of), f.holding_features(snapshot, products, as_of)):
        out = out.join(part, f.KEY, "left")
    return out.na.fill(0)


def test_fused_matrix_equals_blocks_and_ignores_the_future(spark, star):
    args = (star.fact_account_monthly, star.dim_customer, star.dim_product)
    fused = by_key(f.feature_matrix(star.fact_transaction, *args, AS_OF))
    blocks = by_key(_matrix_by_blocks(star.fact_transaction, *args, AS_OF))
    future = star.fact_transaction.withColumn("txn_date", f.F.date_add("txn_date", 4000)).where(f.F.col("txn_date") >= f.day(AS_OF))
    assert future.count() > 0
    later = by_key(f.feature_matrix(star.fact_transaction.unionByName(future), *args, AS_OF))
    assert len(fused) == star.dim_customer.count() and len(next(iter(fused.values()))) == 61
    for other in (blocks, later):
        assert sorted(fused) == sorted(other)
        assert all(_near(row[c], other[k][c]) for k, row in fused.items() for c in row)
    assert not any(v is None for row in fused.values() for v in row.values())
    assert "digital_engagement_flag" not in next(iter(fused.values()))


def test_snapshots_equal_single_dates(spark, star):
    args = (star.fact_account_monthly, star.dim_customer, star.dim_product)
    dates = ["1993-01-31", "1999-01-01", "2000-06-15"]
    got = f.monthly_feature_snapshots(star.fact_transaction, *args, dates[::-1])
    assert got.count() == 3 * star.dim_customer.count()
    for d in dates:
        want = by_key(f.feature_matrix(star.fact_transaction, *args, d))
        mine = by_key(got.where(f.F.col("as_of") == f.day(d)).drop("as_of"))
        assert sorted(mine) == sorted(want)
        assert all(_near(row[c], want[k][c]) for k, row in mine.items() for c in row), d


def test_snapshots_of_equal_amounts_have_no_spread(spark, txn_of):
    txn = txn_of([buy(1, f"2026-{m:02d}-05", a=0.1) for m in range(1, 6)])
    customers = spark.createDataFrame(
        [(1, 30, 2, 1, "low", "salaried", "x"), (2, 30, 2, 1, "low", "salaried", "x")],
        "customer_sk long, age int, tenure_years int, existing_product_count int, income_band string, employment string, city string")
    products = spark.createDataFrame([], "product_sk long, product_name string")
    got = by_key(f.monthly_feature_snapshots(txn, spark.createDataFrame([], BALANCE), customers, products, [DAY]))
    assert [(got[k]["purchase_count"], got[k]["ticket_volatility_gel"], got[k]["total_spend_gel"]) for k in (1, 2)] == [(5, 0.0, 0.5), (0, 0.0, 0.0)]


def test_medians_are_exact_at_any_number_of_purchases_and_dates(spark, txn_of):
    """A hot customer with more purchases than any sketch keeps apart, and dates without any purchase before them."""
    import random
    random.seed(11)
    days = ["2020-01-%02d" % d for d in range(1, 29)]
    rows = [(1, random.choice(days), "purchase", "pos", "dining", 1, random.randrange(1, 100_000) / 100) for _ in range(21_000)]
    rows += [(c, days[c % 28], "purchase", "pos", "fuel", 1, c) for c in range(2, 40)] + [(99, "2020-01-05", "inflow", "transfer", "n/a", 0, 7)]
    dates = ["2019-01-01", "2020-01-10", "2020-02-01"]
    got = {(str(r["as_of"]), r["customer_sk"]): r["median_ticket_gel"] for r in f.medians_at(txn_of(rows).repartition(8), dates).collect()}
    for date in dates:
        for customer in (1, 2, 3, 39, 99):
            amounts = sorted(r[6] for r in rows if r[0] == customer and r[2] == "purchase" and r[1] < date)
            assert got.get((date, customer)) == (amounts[(len(amounts) + 1) // 2 - 1] if amounts else None), (date, customer)


def test_matrix_scans_the_fact_three_times_and_windows_only_within_customers(spark, star):
    import re
    txn = star.stored_transactions
    frames = [f.feature_matrix(txn, star.fact_account_monthly, star.dim_customer, star.dim_product, AS_OF),
              f.monthly_feature_snapshots(txn, star.fact_account_monthly, star.dim_customer, star.dim_product, ["1998-03-20", "1999-07-01", "2001-01-01"])]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"FileScan parquet \[[^\]]*txn_date", plan)) <= 3
        windows = [line for line in plan.splitlines() if re.search(r"[- ]Window \[", line)]
        assert all("[customer_sk" in line.rsplit("specifiedwindowframe", 1)[-1] or re.search(r"\], \[customer_sk#\d+L?\]", line) for line in windows)
        assert "percentile" not in plan
