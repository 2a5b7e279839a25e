import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from cohortlift.operators import features, rfm
from cohortlift.operators.merge import VersionedTable
from cohortlift.plans.analytics import CampaignAnalytics, campaign_start
from cohortlift.plans.load import load_star, read_star
from cohortlift.schema import TABLES
from cohortlift.sources import star as store
from verification.adapter import AS_OF
from tests.conftest import by_key


@pytest.fixture(scope="module")
def staged(spark, star, tmp_path_factory):
    """The small star as a staging area holds it: flags as booleans, amounts as doubles, columns shuffled, no Unknown date."""
    root = str(tmp_path_factory.mktemp("staged"))
    for name, df in star.tables().items():
        if name == "dim_date":
            df = df.where("date_sk <> 0").withColumn("is_weekend", F.col("is_weekend") == 1)
        if name == "fact_transaction":
            df = df.withColumn("amount_gel", F.col("amount_gel").cast("double"))
        if name == "fact_campaign_response":
            df = df.withColumn("responded", F.col("responded") == 1).withColumn("contact_date", F.col("contact_date").cast("timestamp_ntz"))
        df.select(*reversed(df.columns)).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture(scope="module")
def loaded(spark, staged, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("loaded"))
    return root, load_star(spark, staged, root)


def test_load_is_sound_and_repeatable(spark, star, staged, loaded):
    root, report = loaded
    assert report.problems().count() == 0
    assert {r["table_name"]: r["loaded_rows"] for r in report.counts.collect()}["dim_date"] == star.dim_date.count()
    before = sorted(map(tuple, report.manifest.collect()))
    again = load_star(spark, staged, root)
    assert sorted(map(tuple, again.manifest.collect())) == before
    for name, df in read_star(spark, root).items():
        assert [(f.name, f.dataType) for f in df.schema if f.name != "txn_month"] == [(f.name, f.dataType) for f in TABLES[name]]


def test_months_prune(spark, loaded):
    txn = store.read_table(spark, loaded[0], "fact_transaction")
    plan = features.before(txn, "txn_date", "1996-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "txn_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "LessThan(txn_date" in plan


def test_month_replacement_keeps_other_months(spark, loaded, tmp_path):
    txn = store.read_table(spark, loaded[0], "fact_transaction").drop("txn_month").where("txn_date < '1996-01-01'")
    store.write_table(txn, str(tmp_path), "fact_transaction")
    total = txn.count()
    march = txn.where("month(txn_date) = 3").limit(5)
    store.replace_months(march, str(tmp_path))
    now = store.read_table(spark, str(tmp_path), "fact_transaction")
    assert now.where("month(txn_date) = 3").count() == 5
    assert now.count() == total - txn.where("month(txn_date) = 3").count() + 5


def test_conform_repairs_types(spark):
    df = spark.createDataFrame([(float("nan"), True), (2.5, False)], "amount double, flag boolean")
    from pyspark.sql.types import StructType
    schema = StructType().add("flag", "integer").add("amount", "decimal(8,2)")
    assert [tuple(r) for r in store.conform(df, schema).collect()] == [(1, None), (0, pytest.approx(store_decimal("2.50")))]
    with pytest.raises(ValueError):
        store.conform(df.drop("flag"), schema)


def store_decimal(text):
    from decimal import Decimal
    return Decimal(text)


def test_campaign_start(spark, star):
    assert campaign_start(star.dim_campaign, 1) == dt.date(2001, 1, 1)
    with pytest.raises(ValueError):
        campaign_start(star.dim_campaign, 2)


def test_whole_campaign(spark, star, loaded, tmp_path):
    job = CampaignAnalytics.open(spark, loaded[0], 1)
    assert job.as_of == AS_OF
    table = VersionedTable(spark, str(tmp_path / "snapshot"))
    assert job.refresh_snapshot(table) == 1 and job.refresh_snapshot(table) == 2
    snapshot = table.current()
    assert snapshot.count() == job.customer_rfm().count()
    assert sum(r["customers"] for r in job.lift_by_segment(snapshot).collect()) == star.fact_campaign_response.count()
    job.write_features(str(tmp_path / "features"))
    stored = spark.read.parquet(str(tmp_path / "features"))
    assert len(stored.columns) == 61 and stored.count() == star.dim_customer.count()
    for dates in (["1999-01-01", "2000-06-15"], ["2000-06-15"]):
        job.write_feature_snapshots(str(tmp_path / "dated"), dates)
    dated = spark.read.parquet(str(tmp_path / "dated"))
    assert len(dated.columns) == 62 and dated.count() == 2 * star.dim_customer.count()
    assert job.lift(round_digits=True).count() == 1 and job.arms().count() == 2
    assert job.separation_report(round_digits=True).count() == 4
    assert job.quality_report().count() == 10 and job.response_curve().count() > 5


def test_statistics(spark):
    spark.sql("DROP TABLE IF EXISTS cohortlift_stats")
    spark.range(10).write.saveAsTable("cohortlift_stats")
    store.analyze(spark, "cohortlift_stats")
    info = spark.sql("DESCRIBE EXTENDED cohortlift_stats id").collect()
    assert any(r["info_value"] == "10" for r in info if r["info_name"] == "distinct_count")
    spark.sql("DROP TABLE cohortlift_stats")


# ---- physical plans ---------------------------------------------------------------------------
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_matrix_windows_stay_within_customers_and_nothing_is_python_or_crossed(spark, loaded):
    plan = plan_of(CampaignAnalytics.open(spark, loaded[0], 1).feature_matrix())
    windows = [line for line in plan.splitlines() if re.search(r"[- ]Window \[", line)]
    assert windows and all("windowspecdefinition(customer_sk#" in line for line in windows)
    for banned in ("Python", "Cartesian", "NestedLoop", "SinglePartition"):
        cleaned = plan.replace("Exchange SinglePartition", "", 1) if banned == "SinglePartition" else plan
        # One single-row aggregate is allowed: the latest snapshot date.
        assert banned not in cleaned or banned == "SinglePartition", banned


def test_facts_are_reduced_before_every_shuffle(spark, loaded):
    """Below every exchange of the transaction fact stands a partial aggregate."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txn = store.read_table(spark, loaded[0], "fact_transaction")
        frames = [rfm.rfm_base(txn, AS_OF), features.category_shares(txn, AS_OF), features.distinct_merchants(txn, AS_OF),
                  features.income_features(txn, AS_OF), features.median_ticket(txn, AS_OF)]
        for df in frames:
            lines = plan_of(df).splitlines()
            for i, line in enumerate(lines):
                if "Exchange" in line:
                    assert "Aggregate" in lines[i + 1], "\n".join(lines)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_reads_only_needed_columns(spark, loaded):
    txn = store.read_table(spark, loaded[0], "fact_transaction")
    plan = plan_of(features.distinct_merchants(txn, AS_OF))
    read = plan.split("ReadSchema: ")[1]
    assert "amount_gel" not in read and "channel" not in read and "merchant_sk" in read


def test_hot_customer(spark, txn_of):
    """One customer owns most rows; results equal those of the same rows spread over a plain count."""
    days = ["2020-01-%02d" % d for d in range(1, 29)]
    rows = [(1, days[i % 28], "purchase", "pos", "dining", i % 50, 1 + i % 7) for i in range(6000)]
    rows += [(c, days[c % 28], "purchase", "pos", "fuel", 1, 5) for c in range(2, 400)]
    got = by_key(features.transaction_features(txn_of(rows).repartition(16), "2020-02-01"))
    assert got[1]["purchase_count"] == 6000 and got[1]["distinct_merchants"] == 50
    assert got[1]["total_spend_gel"] == float(sum(r[6] for r in rows if r[0] == 1)) and len(got) == 399
