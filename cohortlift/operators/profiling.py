"""Distribution reports used to look at a table before trusting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.functions.expressions import month_start, ratio, share_of_total
from cohortlift.operators.ranking import grouped_medians, quantiles


def event_mix(df: DataFrame, kind: str) -> DataFrame:
    """Rows and share of all rows per value of ``kind``."""
    return share_of_total(df.groupBy(kind).agg(F.count(F.lit(1)).alias("n")), "n", "share")


def share_vs_expected(df: DataFrame, group: str, expected: DataFrame) -> DataFrame:
    """Realised share of each group beside the expected one (``group``, ``expected_share``); a group on one side only has 0 on the other."""
    actual = event_mix(df, group).select(group, F.col("share").alias("actual_share"))
    out = expected.join(actual, group, "full").na.fill({"actual_share": 0.0, "expected_share": 0.0})
    return out.select(group, "actual_share", "expected_share", (F.col("actual_share") - F.col("expected_share")).alias("gap"))


def monthly_volume(df: DataFrame, date: str) -> DataFrame:
    """Rows per calendar month, and each month relative to the busiest."""
    volume = df.groupBy(month_start(F.col(date)).cast("date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return volume.withColumn("of_peak", ratio(F.col("n"), volume.agg(F.max("n")).scalar()))


def mix_crosstab(pairs: DataFrame, row: str, column: str, values: list[str], weight: str = "n") -> DataFrame:
    """Share of each listed value of ``column`` within every ``row`` group, from counted pairs."""
    total = F.sum(weight)
    return pairs.groupBy(row).agg(*[
        F.coalesce(ratio(F.sum(F.when(F.col(column) == v, F.col(weight))), total), F.lit(0.0)).alias(v) for v in values])


def mix_by_label(df: DataFrame, attributes: DataFrame, label: str, column: str, values: list[str],
                 key: str = "customer_sk") -> DataFrame:
    """The crosstab of a customer label and a fact column.

    Facts are counted per customer and value before the label is joined, so the join moves the
    counts and not the facts.
    """
    counts = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    return mix_crosstab(counts.join(attributes.select(key, label), key), label, column, values)


def amount_distribution(df: DataFrame, measure: str) -> DataFrame:
    """Exact median and 95th percentile (interpolated), mean and maximum of a measure."""
    median, p95 = quantiles(df, measure, [0.5, 0.95])
    x = F.col(measure)
    return df.agg(
        F.lit(median).cast("double").alias("median"), ratio(F.sum(x), F.count(x)).alias("mean"),
        F.lit(p95).cast("double").alias("p95"), F.max(x).cast("double").alias("max"))


def avg_ticket_by_category(txn: DataFrame) -> DataFrame:
    """Average purchase by category, dearest first."""
    x = F.col("amount_gel")
    return txn.where(F.col("txn_type") == "purchase").groupBy("mcc_category").agg(
        ratio(F.sum(x), F.count(x)).alias("avg_ticket_gel")).orderBy(F.desc("avg_ticket_gel"), "mcc_category")


def balance_by_group(balances: DataFrame, attributes: DataFrame, group: str) -> DataFrame:
    """Mean, exact median and deviation of the balances of each customer group.

    Merge hint: both sides grow with the customers, and Spark takes rows made by an explode for as small as what they were made from.
    """
    x = F.col("balance_gel")
    joined = balances.hint("merge").join(attributes.select("customer_sk", group), "customer_sk").select(group, "balance_gel")
    spread = joined.groupBy(group).agg(
        ratio(F.sum(x), F.count(x)).alias("mean"), F.stddev_samp(x.cast("double")).alias("sd"))
    return spread.join(grouped_medians(joined, group, "balance_gel"), group)


def balance_path(snapshot: DataFrame, products: list[int]) -> DataFrame:
    """Balances as a row per customer and month end with a column per product."""
    return snapshot.groupBy("customer_sk", "month_end_date").agg(*[
        F.avg(F.when(F.col("product_sk") == p, F.col("balance_gel").cast("double"))).alias(f"product_{p}") for p in products])


def range_by_group(df: DataFrame, group: str, measures: list[str]) -> DataFrame:
    """Size, share of all rows, and extremes of the measures per group."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[
        f(m).alias(f"{n}_{m}") for m in measures for n, f in (("min", F.min), ("max", F.max))])
    return share_of_total(sizes, "n", "share")


def mean_by_group(df: DataFrame, group: str, measures: list[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(F.col(m).cast("double")).alias(f"avg_{m}") for m in measures])
