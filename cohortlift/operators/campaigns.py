"""Every campaign at once, each as of its own start.

The fact is read once, up to the last start, and reduced to customers and periods. A period lies between two starts, so it is
before or after each campaign as a whole; only these reduced rows are multiplied by the campaigns that follow them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.expressions import exact_mean, ratio, rounded
from cohortlift.operators.campaign import NO_HISTORY, Z_95, difference_error
from cohortlift.operators.features import CENTS, KEY, PURCHASE, monthly_feature_snapshots
from cohortlift.operators.rfm import SCORES, rfm_segment
from cohortlift.operators.running import grouped_ntile
from cohortlift.session import materialise

CAMPAIGN = "campaign_sk"


def before_last_start(df: DataFrame, campaigns: DataFrame, date_col: str, month_col: str = "txn_month") -> DataFrame:
    """Rows before the last start. It is a scalar subquery, which prunes the months of a partitioned table when the scan begins."""
    last = campaigns.agg(F.max("start_date")).scalar()
    kept = df.where(F.col(date_col) < last)
    return kept.where(F.col(month_col) < last) if month_col in df.columns else kept


def rfm_base_by_campaign(txn: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Recency, frequency, spend and average ticket of every customer before the start of every campaign.

    The starts, one entry a campaign, are a scalar subquery of sorted (start_date, campaign_sk).
    """
    starts = campaigns.where("start_date IS NOT NULL").agg(F.sort_array(F.collect_list(F.struct("start_date", CAMPAIGN)))).scalar()
    rows = before_last_start(txn, campaigns, "txn_date").where(PURCHASE).select(KEY, "txn_date", "amount_gel", starts.alias("starts"))
    passed = F.size(F.filter("starts", lambda c: c["start_date"] <= F.col("txn_date")))
    periods = rows.groupBy(KEY, passed.alias("passed")).agg(
        F.max("txn_date").alias("last"), F.count(F.lit(1)).alias("n"), F.expr(f"sum({CENTS})").alias("cents"))
    later = F.slice(F.col("starts"), F.col("passed") + 1, F.greatest(F.size("starts") - F.col("passed"), F.lit(0)))
    seen = periods.withColumn("starts", starts).select(KEY, "last", "n", "cents", F.inline(later))
    spend = F.sum("cents").cast("decimal(22,0)")
    return seen.groupBy(CAMPAIGN, "start_date", KEY).agg(
        F.datediff("start_date", F.max("last")).alias("recency_days"), F.sum("n").alias("frequency"),
        (spend / 100).cast("decimal(22,2)").alias("monetary_gel"), ratio(spend / 100, F.sum("n")).alias("avg_ticket_gel"))


def rfm_by_campaign(txn: DataFrame, campaigns: DataFrame, round_digits: bool = False) -> DataFrame:
    """Scores and segments of every customer per campaign; quintiles are of the customers with a history at its start."""
    out = rfm_base_by_campaign(txn, campaigns)
    for tile in SCORES:
        out = grouped_ntile(out, [CAMPAIGN], tile.score, KEY, tile.tiles, tile.out, tile.descending)
    cell = 100 * F.col("r_score") + 10 * F.col("f_score") + F.col("m_score")
    return rfm_segment(out.withColumn("rfm_cell", cell), round_digits)


def lift_by_segment(responses: DataFrame, segments: DataFrame, round_digits: bool = False) -> DataFrame:
    """Lift per campaign and segment at its start, and what it recommends; customers without a history form a segment of their own."""
    by = [CAMPAIGN, KEY]
    tagged = responses.join(segments.select(*by, "rfm_segment"), by, "left").withColumn("segment", F.coalesce("rfm_segment", F.lit(NO_HISTORY)))
    in_t, in_c, col = F.col("assignment") == "treatment", F.col("assignment") == "control", F.col
    arms = tagged.groupBy(CAMPAIGN, "segment").agg(
        F.count_if(in_t).alias("n_t"), F.count_if(in_c).alias("n_c"), exact_mean(F.when(in_t, col("responded"))).alias("treatment_rate"),
        exact_mean(F.when(in_c, col("responded"))).alias("control_rate"))
    gap = col("treatment_rate") - col("control_rate")
    margin = Z_95 * difference_error(col("treatment_rate"), col("n_t"), col("control_rate"), col("n_c"))
    out = arms.withColumns({"incremental_rate": gap, "ci_low": gap - margin, "ci_high": gap + margin}).select(
        CAMPAIGN, "segment", (col("n_t") + col("n_c")).alias("customers"), "treatment_rate", "control_rate", "incremental_rate", "ci_low", "ci_high",
        F.when(col("ci_low") > 0, "TARGET").when(col("ci_high") < 0, "SUPPRESS").otherwise("NO EVIDENCE").alias("recommendation"))
    if round_digits:
        out = rounded(out, dict.fromkeys(("treatment_rate", "control_rate", "incremental_rate", "ci_low", "ci_high"), 4))
    return out.orderBy(CAMPAIGN, F.desc_nulls_last("incremental_rate"), "segment")


def response_curves(responses: DataFrame, round_digits: bool = False) -> DataFrame:
    """How take-up of the treated accumulates by days since contact, for every campaign; windows run over the days of one."""
    daily = responses.where("assignment = 'treatment' AND responded = 1").groupBy(
        CAMPAIGN, F.datediff("response_date", "contact_date").alias("days_since_contact")).agg(F.count(F.lit(1)).alias("responders"))
    of_campaign = Window.partitionBy(CAMPAIGN)
    total = F.sum("responders").over(of_campaign)
    out = daily.withColumns({"cumulative": F.sum("responders").over(of_campaign.orderBy("days_since_contact")), "total": total})
    out = out.select(CAMPAIGN, "days_since_contact", "responders", "cumulative", ratio(F.col("responders"), F.col("total")).alias("pct_of_total"),
                     ratio(F.col("cumulative"), F.col("total")).alias("cumulative_pct"))
    if round_digits:
        out = rounded(out, {"pct_of_total": 4, "cumulative_pct": 4})
    return out.orderBy(CAMPAIGN, "days_since_contact")


def features_by_campaign(txn: DataFrame, snapshot: DataFrame, customers: DataFrame, products: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The feature matrix of every customer as of the start of every campaign.

    The distinct starts, one value a campaign at most, are read first: as literals they prune files when the query is planned.
    """
    dated = materialise(campaigns.where("start_date IS NOT NULL").select(CAMPAIGN, F.col("start_date").alias("as_of")))
    dates = [r["as_of"] for r in dated.select("as_of").distinct().collect()]
    if not dates:
        raise ValueError("no campaign has a start date")
    return dated.join(monthly_feature_snapshots(txn, snapshot, customers, products, dates), "as_of")
