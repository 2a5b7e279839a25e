"""Campaign eligibility, randomised assignment and the causal read of a holdout experiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlift.functions.expressions import exact_mean, hash_slot, ratio, rounded
from cohortlift.operators.ranking import quantiles

Z_95 = 1.96
SLOTS = 10_000
NO_HISTORY = "No History"


def campaign_eligible(customers: DataFrame, holdings: DataFrame, target_product_sk: int) -> DataFrame:
    """Customers who hold no target product."""
    holders = holdings.where(F.col("product_sk") == target_product_sk).select("customer_sk")
    return customers.join(holders.hint("merge"), "customer_sk", "left_anti")


def assign_holdout(customers: DataFrame, share: float = 0.70, salt: str = "campaign-1") -> DataFrame:
    """An independent draw per customer, fixed by key and salt, so a retried task repeats it."""
    slot = hash_slot(F.concat_ws("|", F.lit(salt), F.col("customer_sk").cast("string")), SLOTS)
    treated = slot < F.lit(int(round(share * SLOTS)))
    return customers.withColumns({
        "assignment": F.when(treated, "treatment").otherwise("control"),
        "contacted": treated.cast("int"),
    })


def campaign_arms(responses: DataFrame) -> DataFrame:
    """Take-up, revenue and cost per campaign and arm."""
    return responses.groupBy("campaign_sk", "assignment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("responded").alias("responders"),
        exact_mean(F.col("responded")).alias("response_rate"),
        F.sum("card_opened").alias("cards_opened"),
        F.sum("annual_value_gel").cast("double").alias("revenue_gel"),
        F.sum("contact_cost_gel").cast("double").alias("cost_gel"),
    )


def difference_error(p_t: Column, n_t: Column, p_c: Column, n_c: Column) -> Column:
    """Standard error of a difference of two independent proportions; NULL if an arm is empty."""
    return F.sqrt(ratio(p_t * (1 - p_t), n_t) + ratio(p_c * (1 - p_c), n_c))


def campaign_lift(responses: DataFrame, round_digits: bool = False) -> DataFrame:
    """Lift of treatment over control with its 95% interval and what it earned, per campaign."""
    def arm(name: str, measure: str) -> Column:
        return F.max(F.when(F.col("assignment") == name, F.col(measure)))

    t, c = "treatment", "control"
    arms = campaign_arms(responses).groupBy("campaign_sk").agg(
        arm(t, "customers").alias("treated"), arm(c, "customers").alias("control"),
        arm(t, "response_rate").alias("treatment_rate"), arm(c, "response_rate").alias("control_rate"),
        arm(t, "responders").alias("naive_conversions"), arm(t, "cost_gel").alias("campaign_cost_gel"),
        arm(t, "revenue_gel").alias("naive_revenue_gel"))
    col = F.col
    lift = (
        arms.withColumn("incremental_rate", col("treatment_rate") - col("control_rate"))
        .withColumn("std_error", difference_error(col("treatment_rate"), col("treated"), col("control_rate"), col("control")))
        .withColumn("ci_low", col("incremental_rate") - Z_95 * col("std_error"))
        .withColumn("ci_high", col("incremental_rate") + Z_95 * col("std_error"))
        .withColumn("incremental_conversions", col("incremental_rate") * col("treated"))
        .withColumn("incremental_revenue_gel",
                    col("incremental_conversions") * ratio(col("naive_revenue_gel"), col("naive_conversions")))
    )
    out = lift.select(
        "campaign_sk", "treated", "control", "treatment_rate", "control_rate", "incremental_rate", "std_error",
        "ci_low", "ci_high", F.when(col("ci_low") > 0, "YES").otherwise("NO").alias("significant"),
        "naive_conversions", "incremental_conversions",
        ratio(col("naive_conversions"), col("incremental_conversions")).alias("naive_overstatement_x"),
        "campaign_cost_gel", "naive_revenue_gel", "incremental_revenue_gel",
        ratio(col("incremental_revenue_gel") - col("campaign_cost_gel"), col("campaign_cost_gel")).alias("incremental_roi"),
        ratio(col("campaign_cost_gel"), col("incremental_conversions")).alias("cost_per_incremental_gel"))
    if round_digits:
        rates = ("treatment_rate", "control_rate", "incremental_rate", "std_error", "ci_low", "ci_high")
        whole = ("incremental_conversions", "campaign_cost_gel", "naive_revenue_gel", "incremental_revenue_gel")
        out = rounded(out, {**dict.fromkeys(rates, 4), **dict.fromkeys(whole, 0), "naive_overstatement_x": 1,
                            "incremental_roi": 2, "cost_per_incremental_gel": 2})
    return out


def _arms_by(df: DataFrame, group: str) -> DataFrame:
    in_t, in_c = F.col("assignment") == "treatment", F.col("assignment") == "control"
    return df.groupBy(group).agg(
        F.count_if(in_t).alias("n_t"), F.count_if(in_c).alias("n_c"),
        exact_mean(F.when(in_t, F.col("responded"))).alias("treatment_rate"),
        exact_mean(F.when(in_c, F.col("responded"))).alias("control_rate"),
    )


def campaign_lift_by_segment(responses: DataFrame, snapshot: DataFrame, campaign_sk: int,
                             round_digits: bool = False) -> DataFrame:
    """Lift per RFM segment and what it recommends; customers without a segment form one of their own."""
    tagged = (
        responses.where(F.col("campaign_sk") == campaign_sk)
        .join(snapshot.select("customer_sk", "rfm_segment"), "customer_sk", "left")
        .select("assignment", "responded", F.coalesce("rfm_segment", F.lit(NO_HISTORY)).alias("segment")))
    col = F.col
    gap = col("treatment_rate") - col("control_rate")
    margin = Z_95 * difference_error(col("treatment_rate"), col("n_t"), col("control_rate"), col("n_c"))
    out = (
        _arms_by(tagged, "segment")
        .withColumns({"incremental_rate": gap, "ci_low": gap - margin, "ci_high": gap + margin})
        .select(
            "segment", (col("n_t") + col("n_c")).alias("customers"), "treatment_rate", "control_rate",
            "incremental_rate", "ci_low", "ci_high",
            F.when(col("ci_low") > 0, "TARGET").when(col("ci_high") < 0, "SUPPRESS").otherwise("NO EVIDENCE")
            .alias("recommendation")))
    if round_digits:
        out = rounded(out, dict.fromkeys(
            ("treatment_rate", "control_rate", "incremental_rate", "ci_low", "ci_high"), 4))
    return out.orderBy(F.desc_nulls_last("incremental_rate"), "segment")


def response_curve(responses: DataFrame, campaign_sk: int, round_digits: bool = False) -> DataFrame:
    """How take-up of the treated accumulates by days since contact.

    The running total is over one row per day of the response window, never over customers.
    """
    daily = (
        responses.where((F.col("campaign_sk") == campaign_sk) & (F.col("assignment") == "treatment") & (F.col("responded") == 1))
        .groupBy(F.datediff("response_date", "contact_date").alias("days_since_contact"))
        .agg(F.count(F.lit(1)).alias("responders")))
    total = daily.agg(F.sum("responders")).scalar()
    running = F.sum("responders").over(Window.orderBy("days_since_contact"))
    out = daily.select("days_since_contact", "responders", running.alias("cumulative")).select(
        "*", ratio(F.col("responders"), total).alias("pct_of_total"), ratio(F.col("cumulative"), total).alias("cumulative_pct"))
    if round_digits:
        out = rounded(out, {"pct_of_total": 4, "cumulative_pct": 4})
    return out.orderBy("days_since_contact")


def lift_by_group(responses: DataFrame, attributes: DataFrame, group: str) -> DataFrame:
    """Response rate of each arm, the lift and the size of every group."""
    joined = responses.join(attributes.select("customer_sk", group), "customer_sk")
    return _arms_by(joined, group).select(
        group, F.col("treatment_rate").alias("treatment"), F.col("control_rate").alias("control"),
        (F.col("treatment_rate") - F.col("control_rate")).alias("lift"), (F.col("n_t") + F.col("n_c")).alias("n"),
    ).orderBy(F.desc_nulls_last("lift"), group)


def activation_rates(responses: DataFrame, arm: str = "treatment") -> DataFrame:
    """Opened, activated, and activated among opened, within one arm of every campaign."""
    return responses.where(F.col("assignment") == arm).groupBy("campaign_sk").agg(
        exact_mean(F.col("card_opened")).alias("opened_rate"),
        exact_mean(F.col("activated")).alias("activated_rate"),
        ratio(F.sum("activated"), F.sum("card_opened")).alias("activated_of_opened"))


def truth_in_interval(responses: DataFrame, truth: DataFrame) -> DataFrame:
    """Whether the planted effect lies in the interval of the observed lift. Evaluation only.

    Probabilities are bounded, so the effect that can be realised is
    ``clip(p0 + tau, 0, 1) - p0``, not ``tau``.
    """
    realised = F.least(F.greatest(F.col("true_p0") + F.col("true_tau"), F.lit(0.0)), F.lit(1.0)) - F.col("true_p0")
    planted = (
        responses.where(F.col("assignment") == "treatment").join(truth, "customer_sk").groupBy("campaign_sk")
        .agg(F.avg("true_tau").alias("mean_tau"), F.avg(realised).alias("realisable_lift")))
    gap = F.col("incremental_rate") - F.col("realisable_lift")
    return campaign_lift(responses).join(planted, "campaign_sk").select(
        "campaign_sk", "incremental_rate", "ci_low", "ci_high", "mean_tau", "realisable_lift",
        F.col("realisable_lift").between(F.col("ci_low"), F.col("ci_high")).alias("inside"),
        gap.alias("gap"), ratio(F.abs(gap), F.col("std_error")).alias("gap_in_se"))


def value_index(df: DataFrame, measure: str, out: str = "value_index") -> DataFrame:
    """``measure`` relative to its exact median over all rows."""
    median = quantiles(df, measure, [0.5])[0]
    return df.withColumn(out, ratio(F.col(measure), F.lit(median)))


def summary(responses: DataFrame, truth: DataFrame) -> DataFrame:
    """The headline read per campaign: population, lift, economics and, for evaluation, the planted effect.

    Unlike ``campaign_lift`` the ratios are guarded by a tiny floor instead of becoming NULL.
    """
    col = F.col
    lift = campaign_lift(responses)
    planted = truth_in_interval(responses, truth).select("campaign_sk", "mean_tau", "realisable_lift")
    conversions = col("incremental_conversions")
    value = ratio(col("naive_revenue_gel"), col("naive_conversions"))
    return lift.join(planted, "campaign_sk", "left").select(
        "campaign_sk", (col("treated") + col("control")).alias("eligible"), "treated", "control",
        col("std_error").alias("lift_se"), col("ci_low").alias("lift_ci_low"), col("ci_high").alias("lift_ci_high"),
        col("treatment_rate").alias("treatment_response_rate"), col("control_rate").alias("control_response_rate"),
        col("incremental_rate").alias("observed_lift"), col("mean_tau").alias("true_mean_tau_treated"),
        col("realisable_lift").alias("true_realisable_lift"), "naive_conversions", "incremental_conversions",
        (col("naive_conversions") / F.greatest(conversions, F.lit(1e-9))).alias("overstatement_factor"),
        value.alias("avg_annual_value_gel"), "campaign_cost_gel", "incremental_revenue_gel",
        ((conversions * value - col("campaign_cost_gel")) / F.greatest(col("campaign_cost_gel"), F.lit(1e-9))).alias("roi"))
