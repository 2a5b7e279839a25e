import datetime as dt

from cohortlift.operators import campaign, campaigns, rfm
from cohortlift.sources import star as store
from verification.adapter import AS_OF, CAMPAIGNS


def test_each_campaign_equals_its_own_read(spark, star):
    every = campaigns.rfm_by_campaign(star.fact_transaction, star.dim_campaigns)
    for sk, start, _ in CAMPAIGNS:
        alone = rfm.customer_rfm(star.fact_transaction, start)
        assert sorted(map(tuple, every.where(f"campaign_sk = {sk}").select(*alone.columns).collect())) == sorted(map(tuple, alone.collect()))
    segments = every.select("campaign_sk", "customer_sk", "rfm_segment")
    lifted = campaigns.lift_by_segment(star.campaign_responses, segments, round_digits=True)
    alone = campaign.campaign_lift_by_segment(star.fact_campaign_response, rfm.customer_rfm(star.fact_transaction, AS_OF), 1, round_digits=True)
    assert sorted(map(str, lifted.where("campaign_sk = 1").drop("campaign_sk").collect())) == sorted(map(str, alone.collect()))
    curve = campaigns.response_curves(star.campaign_responses).where("campaign_sk = 1").drop("campaign_sk")
    assert sorted(map(tuple, curve.collect())) == sorted(map(tuple, campaign.response_curve(star.fact_campaign_response, 1).collect()))


def test_months_after_the_last_start_are_not_read(spark, star, tmp_path):
    """The last start is found when the query runs, and prunes the months of the partitioned fact then."""
    store.write_table(star.fact_transaction, str(tmp_path), "fact_transaction")
    txn = store.read_table(spark, str(tmp_path), "fact_transaction")
    early = star.dim_campaigns.where("start_date < '1997-01-01'")
    df = campaigns.rfm_base_by_campaign(txn, early)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "txn_month" in line)
    filters = scan.split("PartitionFilters")[1].split("PushedFilters")[0].lower()
    assert "txn_month" in filters and "subquery" in filters
    assert rows and {r["start_date"] for r in rows} == {dt.date(1996, 11, 1)}


def test_two_campaigns_on_one_day_and_none(spark, txn_of):
    txn = txn_of([(1, "2020-01-05", "purchase", "pos", "dining", 1, 10), (1, "2020-02-01", "purchase", "pos", "dining", 1, 5), (2, "2020-03-01", "purchase", "pos", "fuel", 1, 2)])
    camps = spark.createDataFrame([(1, dt.date(2020, 2, 1)), (2, dt.date(2020, 2, 1)), (3, dt.date(2020, 3, 2)), (4, None), (5, dt.date(2019, 1, 1))], "campaign_sk long, start_date date")
    got = sorted((r["campaign_sk"], r["customer_sk"], r["recency_days"], r["frequency"], float(r["monetary_gel"])) for r in campaigns.rfm_base_by_campaign(txn, camps).collect())
    assert got == [(1, 1, 27, 1, 10.0), (2, 1, 27, 1, 10.0), (3, 1, 30, 2, 15.0), (3, 2, 1, 1, 2.0)]
    assert campaigns.rfm_base_by_campaign(txn, camps.where("campaign_sk = 4")).count() == 0
    assert campaigns.rfm_by_campaign(txn, camps).where("campaign_sk = 3").count() == 2
