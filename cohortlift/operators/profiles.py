"""Reporting profiles of spend, channels, balances and product holding.

They differ from the model features where a report wants it: an absent category or an undefined
ratio stays NULL, and shares are of everything spent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.functions.expressions import DateLike, before, exact_mean, ratio, rounded, sum_if
from cohortlift.operators.features import KEY, balance_history, product_balances
from cohortlift.schema import CATEGORIES, DIGITAL_CHANNELS


def spend_profile(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Share of each listed category in all purchase spend; NULL where nothing was spent on it.

    Equal to a pivot over the listed values, but one aggregation instead of two and a window.
    """
    gel = F.col("amount_gel")
    spent = before(txn, "txn_date", as_of).where(F.col("txn_type") == "purchase").groupBy(KEY).agg(
        F.sum(gel).alias("all_spend"),
        *[F.sum(F.when(F.col("mcc_category") == c, gel)).alias(c) for c in CATEGORIES])
    return spent.select(KEY, *[ratio(F.col(c), F.col("all_spend")).alias(f"sh_{c}") for c in CATEGORIES])


def channel_profile(txn: DataFrame, as_of: DateLike, round_digits: bool = False) -> DataFrame:
    """Outflow by channel kind. Cash is told by the transaction type, not by the channel."""
    gel, cash = F.col("amount_gel"), F.col("txn_type") == "cash_withdrawal"
    debits = before(txn, "txn_date", as_of).where(F.col("direction") == "debit")
    # By channel first: sums and counts stay in generated code, and the channels of a customer become rows to count.
    channels = debits.groupBy(KEY, "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum(gel).alias("gel"),
        F.count(F.when(cash, gel)).alias("cash_n"), sum_if(cash, gel).alias("cash_gel"))
    outflow, is_digital = F.sum("gel"), F.col("channel").isin(*DIGITAL_CHANNELS)
    profile = channels.groupBy(KEY).agg(
        F.sum("n").alias("debit_txn_count"),
        outflow.cast("double").alias("total_outflow_gel"),
        ratio(sum_if(is_digital, F.col("gel")), outflow).alias("digital_value_share"),
        ratio(F.sum("cash_gel"), outflow).alias("cash_value_share"),
        ratio(sum_if(F.col("channel") == "branch", F.col("n")), F.sum("n")).alias("branch_txn_share"),
        F.count("channel").cast("int").alias("channels_used"),
        ratio(F.sum("cash_gel"), F.sum("cash_n")).alias("avg_withdrawal_gel"))
    if round_digits:
        profile = rounded(profile, {"total_outflow_gel": 2, "digital_value_share": 4, "cash_value_share": 4,
                                    "branch_txn_share": 4, "avg_withdrawal_gel": 2})
    return profile


def balance_profile(snapshot: DataFrame, products: DataFrame, as_of: DateLike, round_digits: bool = False) -> DataFrame:
    """Current-account level, spread and drift; the coefficient of variation is NULL on a zero mean."""
    history = balance_history(product_balances(snapshot, products, "Current Account", as_of))
    profile = history.withColumn("balance_cv", ratio(F.col("balance_volatility_gel"), F.abs("avg_balance_gel")))
    if round_digits:
        profile = rounded(profile, {"avg_balance_gel": 2, "balance_volatility_gel": 2, "min_balance_gel": 2,
                                    "max_balance_gel": 2, "balance_cv": 4, "balance_trend_gel": 2})
    return profile


def profile_separation_report(customers: DataFrame, spend: DataFrame, channels: DataFrame, balances: DataFrame,
                              round_digits: bool = False) -> DataFrame:
    """Whether the profiles differ by income band: mean shares and balance, richest band first."""
    measures = {
        "groceries": "sh_groceries", "dining": "sh_dining", "travel": "sh_travel", "healthcare": "sh_healthcare",
        "digital": "digital_value_share", "cash": "cash_value_share", "avg_balance": "avg_balance_gel"}
    joined = customers.select(KEY, "income_band").join(spend, KEY).join(channels, KEY).join(balances, KEY)
    report = joined.groupBy("income_band").agg(
        F.count(F.lit(1)).alias("customers"), *[F.avg(c).alias(n) for n, c in measures.items()])
    if round_digits:
        report = rounded(report, {**dict.fromkeys(measures, 3), "avg_balance": 0})
    return report.orderBy(F.desc("avg_balance"), "income_band")


def product_penetration(snapshot: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Share of all customers who hold each product at each month end."""
    total = customers.agg(F.count(F.lit(1))).scalar()
    held = snapshot.groupBy("month_end_date", "product_sk").agg(F.count(F.lit(1)).alias("holders"))
    return held.join(products.select("product_sk", "product_name", "product_group"), "product_sk").select(
        "month_end_date", "product_name", "product_group", "holders", ratio(F.col("holders"), total).alias("penetration"))


def penetration_by_group(snapshot: DataFrame, customers: DataFrame, products: DataFrame, group: str) -> DataFrame:
    """Share of the customers of each group who ever held each product."""
    ever = snapshot.select(KEY, "product_sk").distinct()
    sizes = customers.groupBy(group).agg(F.count(F.lit(1)).alias("customers"))
    held = ever.join(customers.select(KEY, group), KEY).groupBy(group, "product_sk").agg(F.count(F.lit(1)).alias("holders"))
    return held.join(sizes, group).join(products.select("product_sk", "product_name"), "product_sk").select(
        group, "product_name", "holders", ratio(F.col("holders"), F.col("customers")).alias("penetration"))
