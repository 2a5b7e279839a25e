"""Recency, frequency and monetary segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.functions.expressions import DateLike, all_of, before, day, exact_mean, ratio, rounded, share_of_total
from cohortlift.operators.merge import upsert
from cohortlift.operators.ranking import Tile, add_ntiles
from cohortlift.session import materialise

QUINTILES = 5
SCORES = (
    Tile("recency_days", QUINTILES, "r_score", descending=True),
    Tile("frequency", QUINTILES, "f_score"),
    Tile("monetary_gel", QUINTILES, "m_score"),
)

# ---- fixed values: segments by score range, first match wins ----------------------------------
SEGMENTS = (
    ("Champions", {"r_score": (4, 5), "f_score": (4, 5), "m_score": (4, 5)}),
    ("Loyal", {"r_score": (3, 5), "f_score": (3, 5)}),
    ("New / Promising", {"r_score": (4, 5), "f_score": (1, 2)}),
    ("At Risk", {"r_score": (1, 2), "f_score": (3, 5)}),
    ("Hibernating", {"r_score": (1, 2), "f_score": (1, 2)}),
)
OTHER_SEGMENT = "Needs Attention"


def rfm_base(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Days since the last purchase, number of purchases, spend and average ticket per customer."""
    return before(txn, "txn_date", as_of).where(F.col("txn_type") == "purchase").groupBy("customer_sk").agg(
        F.datediff(day(as_of), F.max("txn_date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount_gel").alias("monetary_gel"),
        exact_mean(F.col("amount_gel")).alias("avg_ticket_gel"),
    )


def rfm_score(base: DataFrame) -> DataFrame:
    """Quintiles of the three measures; 5 is best, so recency is ranked from the longest down."""
    return add_ntiles(materialise(base), "customer_sk", list(SCORES)).withColumn(
        "rfm_cell", 100 * F.col("r_score") + 10 * F.col("f_score") + F.col("m_score"))


def rfm_segment(scored: DataFrame, round_digits: bool = False) -> DataFrame:
    """The named segment of every scored customer."""
    label = F.lit(OTHER_SEGMENT)
    for name, ranges in reversed(SEGMENTS):
        label = F.when(all_of([F.col(c).between(*r) for c, r in ranges.items()]), name).otherwise(label)
    out = scored.withColumn("rfm_segment", label).withColumn("monetary_gel", F.col("monetary_gel").cast("double"))
    return rounded(out, {"monetary_gel": 2, "avg_ticket_gel": 2}) if round_digits else out


def customer_rfm(txn: DataFrame, as_of: DateLike, round_digits: bool = False) -> DataFrame:
    return rfm_segment(rfm_score(rfm_base(txn, as_of)), round_digits)


def rfm_snapshot_refresh(snapshot: DataFrame, rfm: DataFrame, as_of: DateLike, delete_missing: bool = False) -> DataFrame:
    """The snapshot after a refresh: customers in ``rfm`` updated or added, all others kept."""
    stamped = rfm.withColumn("snapshot_date", day(as_of)).select(*snapshot.columns)
    return upsert(snapshot, stamped, ["customer_sk"], delete_missing)


def rfm_segment_report(snapshot: DataFrame, round_digits: bool = False) -> DataFrame:
    """Size, behaviour and worth of every segment."""
    segments = snapshot.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        exact_mean(F.col("recency_days")).alias("avg_recency_days"),
        exact_mean(F.col("frequency")).alias("avg_purchases"),
        # Cents as decimals: the sum does not depend on the order of the rows.
        F.sum(F.col("monetary_gel").cast("decimal(24,2)")).alias("total_spend_gel"),
        F.count("monetary_gel").alias("_spenders"))
    out = share_of_total(share_of_total(segments, "customers", "pct_of_base"), "total_spend_gel", "pct_of_spend").select(
        "rfm_segment", "customers", "pct_of_base", "avg_recency_days", "avg_purchases",
        ratio(F.col("total_spend_gel"), F.col("_spenders")).alias("avg_spend_gel"),
        F.col("total_spend_gel").cast("double").alias("total_spend_gel"), "pct_of_spend")
    if round_digits:
        out = rounded(out, {"pct_of_base": 3, "avg_recency_days": 1, "avg_purchases": 0, "avg_spend_gel": 0,
                            "total_spend_gel": 0, "pct_of_spend": 3})
    return out.orderBy(F.desc("total_spend_gel"), "rfm_segment")
