import pytest
from pyspark.sql import functions as F

from cohortlift.operators import campaign, evaluation, uplift
from tests.conftest import by_key

RESP = ("customer_sk long, campaign_sk long, assignment string, contacted int, responded int, card_opened int, activated int, "
        "annual_value_gel double, contact_cost_gel double")


def responses(spark, arms):
    """(arm, responded, count) triples."""
    rows, k = [], 0
    for arm, hit, n in arms:
        for _ in range(n):
            rows.append((k, 1, arm, int(arm == "treatment"), hit, hit, hit, 100.0 * hit, 2.5 * (arm == "treatment")))
            k += 1
    df = spark.createDataFrame(rows, RESP)
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("annual_value_gel", "contact_cost_gel")})


def test_golden_lift(spark):
    from verification.adapter import TestStar
    got = campaign.campaign_lift(TestStar(spark, "/root/testdata/sf0.01").fact_campaign_response, round_digits=True).first()
    assert (got["treated"], got["control"], got["naive_conversions"], got["significant"]) == (848, 364, 268, "YES")
    assert (got["incremental_rate"], got["std_error"], got["ci_low"], got["ci_high"]) == (0.0688, 0.0277, 0.0145, 0.123)
    assert (got["incremental_conversions"], got["naive_overstatement_x"], got["incremental_revenue_gel"]) == (58, 4.6, 14700)
    assert (got["incremental_roi"], got["cost_per_incremental_gel"], got["campaign_cost_gel"]) == (5.93, 36.35, 2120)


def test_equal_rates_have_no_overstatement(spark):
    got = campaign.campaign_lift(responses(spark, [("treatment", 1, 5), ("treatment", 0, 5), ("control", 1, 4), ("control", 0, 4)])).first()
    assert got["incremental_rate"] == 0 and got["naive_overstatement_x"] is None and got["cost_per_incremental_gel"] is None
    assert got["significant"] == "NO" and got["ci_low"] < 0 < got["ci_high"]


def test_no_treated_responder_and_no_control(spark):
    got = campaign.campaign_lift(responses(spark, [("treatment", 0, 5), ("control", 1, 4), ("control", 0, 4)])).first()
    assert got["incremental_revenue_gel"] is None and got["naive_conversions"] == 0
    alone = campaign.campaign_lift(responses(spark, [("treatment", 1, 5), ("treatment", 0, 5)])).first()
    assert alone["incremental_rate"] is None and alone["std_error"] is None and alone["significant"] == "NO"


def test_segment_with_one_arm_comes_last(spark):
    resp = responses(spark, [("treatment", 1, 40), ("treatment", 0, 10), ("control", 1, 5), ("control", 0, 45), ("treatment", 0, 3)])
    segments = spark.createDataFrame([(k, "A") for k in range(100)], "customer_sk long, rfm_segment string")
    rows = campaign.campaign_lift_by_segment(resp, segments, 1).collect()
    assert [(r["segment"], r["recommendation"]) for r in rows] == [("A", "TARGET"), ("No History", "NO EVIDENCE")]
    assert rows[1]["incremental_rate"] is None and rows[1]["customers"] == 3


def test_negative_segment_is_suppressed(spark):
    resp = responses(spark, [("treatment", 1, 5), ("treatment", 0, 45), ("control", 1, 40), ("control", 0, 10)])
    segments = spark.createDataFrame([(k, "A") for k in range(100)], "customer_sk long, rfm_segment string")
    assert campaign.campaign_lift_by_segment(resp, segments, 1).first()["recommendation"] == "SUPPRESS"


def test_assignment_is_stable_and_near_its_share(spark):
    customers = spark.range(20000).select(F.col("id").alias("customer_sk"))
    a, b = (by_key(campaign.assign_holdout(customers.repartition(n), 0.7)) for n in (3, 7))
    assert a == b
    share = sum(r["contacted"] for r in a.values()) / len(a)
    assert abs(share - 0.7) < 0.02
    other = by_key(campaign.assign_holdout(customers, 0.7, salt="campaign-2"))
    assert other != a


def test_response_curve(spark, star):
    rows = campaign.response_curve(star.fact_campaign_response, 1).collect()
    assert [r["days_since_contact"] for r in rows] == sorted(r["days_since_contact"] for r in rows)
    assert rows[-1]["cumulative_pct"] == 1.0 and rows[-1]["cumulative"] == sum(r["responders"] for r in rows)
    assert abs(sum(r["pct_of_total"] for r in rows) - 1) < 1e-9


def test_leak_scan(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("label"), (F.col("id") % 3 * 2).alias("copy"), F.lit(1).alias("flat"), F.col("id").alias("real"))
    got = by_key(evaluation.leak_scan(df, ["copy", "flat", "real"], "label"), "feature")
    assert got["copy"]["f_statistic"] == float("inf") and got["copy"]["leaked"] == 1
    assert got["flat"]["f_statistic"] == 0.0 and got["flat"]["leaked"] == 0
    assert 0 < got["real"]["f_statistic"] < 1


def test_agreement_extremes(spark):
    same = spark.range(90).select((F.col("id") % 3).alias("a"), (F.col("id") % 3 + 10).alias("b"), (F.floor(F.col("id") / 3) % 3).alias("c"))
    perfect = evaluation.clustering_agreement(same, "a", "b").first()
    assert [round(v, 12) for v in perfect] == [1.0, 1.0, 1.0]
    unrelated = evaluation.clustering_agreement(same, "a", "c").first()
    assert unrelated["adjusted_rand_index"] < 0.01 and abs(unrelated["normalized_mutual_information"]) < 1e-9


def test_plan_skips_negative_uplift_and_stops_at_cost(spark):
    rows = [(0, 1, 0.5), (1, 1, 0.4), (2, 2, 0.1), (3, 2, 0.02), (4, 3, 0.001), (5, 4, -0.3)]
    plan = by_key(uplift.targeting_plan(spark.createDataFrame(rows, "customer_sk long, bin int, score double"), "score", 100.0, 2.5), "bin")
    assert [plan[b]["contact"] for b in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert plan[4]["contactable"] == 0 and plan[4]["cumulative_profit"] == pytest.approx(85 + 7)


def test_uplift_score_beats_random(spark):
    """The first 60 customers respond only to treatment, the other 60 as often without it."""
    resp = responses(spark, [("treatment", 1, 30), ("control", 0, 30), ("treatment", 1, 5), ("treatment", 0, 25), ("control", 1, 5), ("control", 0, 25)])
    scores = resp.select("customer_sk", F.when(F.col("customer_sk") < 60, 0.9).otherwise(0.1).alias("score"))
    curve = uplift.qini_curve(uplift.rank_bins(scores, "score", 2), resp)
    assert uplift.qini_area(curve).first()[0] > 0
    reverse = uplift.rank_bins(scores.withColumn("score", -F.col("score")), "score", 2)
    assert uplift.qini_area(uplift.qini_curve(reverse, resp)).first()[0] < 0
    last = curve.orderBy(F.desc("bin")).first()
    assert last["qini"] == pytest.approx(30.0) and last["random"] == pytest.approx(30.0)
