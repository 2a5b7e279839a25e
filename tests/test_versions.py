import os

import pytest
from pyspark.sql import functions as F

from cohortlift.operators import features, quality
from cohortlift.operators.merge import BucketedTable
from cohortlift.plans.analytics import CampaignAnalytics
from cohortlift.plans.load import PublishedStar
from cohortlift.session import materialise
from cohortlift.sources import lineage
from cohortlift.sources import star as store
from verification.adapter import AS_OF

ACCEPTED = ("customers_without_transactions",)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), ["k"], 16)
    assert table.read() is None
    assert table.merge(spark.range(500).selectExpr("id AS k", "'old' AS v")).number == 1
    before = files(tmp_path)
    changed = spark.createDataFrame([(3, "new"), (900, "added")], "k long, v string")
    version = table.merge(changed)
    after = files(tmp_path)
    assert all(after[f] == t for f, t in before.items())
    touched = {r["bucket"] for r in changed.select(table.bucket().alias("bucket")).collect()}
    assert {b for b, w in version.written.items() if w == 2} == touched and len(touched) <= 2
    assert all(f"bucket={b}/" in f for f in after.keys() - before.keys() for b in [f.split("bucket=")[1].split("/")[0]] if int(b) in touched)
    rows = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 501 and rows[3] == "new" and rows[900] == "added" and rows[4] == "old"
    # the version before is still there, and an interrupted write changes nothing
    assert table.read(1).count() == 500
    spark.range(3).selectExpr("id AS k", "'lost' AS v", "0 AS bucket").write.partitionBy("bucket").parquet(str(tmp_path / "data/written=3"))
    assert table.read().count() == 501
    assert table.merge(changed.where("k = 3")).number == 3 and table.read().count() == 501
    assert {b: n for b, n in table.read().groupBy("bucket").count().collect()}.keys() == set(range(16))
    with pytest.raises(ValueError):
        BucketedTable(spark, str(tmp_path), ["k"], 8).merge(changed)


def test_missing_rows_can_be_dropped(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), ["a", "b"], 4)
    table.merge(spark.range(50).selectExpr("id AS a", "'x' AS b", "id AS v"))
    table.merge(spark.range(3).selectExpr("id AS a", "'x' AS b", "-id AS v"), delete_missing=True)
    assert sorted(r["v"] for r in table.read().collect()) == [-2, -1, 0]
    table.merge(spark.range(0).selectExpr("id AS a", "'x' AS b", "id AS v"))
    assert table.read().count() == 3


def test_a_load_is_published_whole_or_not_at_all(spark, star, tmp_path):
    root = str(tmp_path)
    published = PublishedStar(spark, root)
    assert published.current() is None
    tables = star.tables(stored=True)
    report = published.load(tables, ACCEPTED, star.gt_customer_persona)
    assert report.counts.count() == 8 and {r["status"] for r in report.counts.collect()} == {"ok"}
    opened = published.current()
    bad = {**tables, "fact_transaction": tables["fact_transaction"].withColumn("amount_gel", -F.col("amount_gel"))}
    with pytest.raises(ValueError, match="amount_not_negative"):
        published.load(bad, ACCEPTED)
    assert published.versions.known() == [1]
    with pytest.raises(ValueError, match="truth_coverage"):
        published.load(tables, ACCEPTED, star.gt_customer_persona.limit(10))
    published.load({**tables, "fact_campaign_response": tables["fact_campaign_response"].limit(40)}, (*ACCEPTED, "treatment_share_off_target"))
    assert published.current()["fact_campaign_response"].count() == 40
    assert opened["fact_campaign_response"].count() == tables["fact_campaign_response"].count()


def test_verdict_names_every_kind_of_problem(spark, star):
    from cohortlift.plans.load import _report

    tables = star.tables(stored=True)
    bad = {**tables, "dim_customer": tables["dim_customer"].withColumn("city", F.repeat(F.lit("x"), 60)).withColumn("true_tau", F.lit(1.0))}
    rules = {r["rule"] for r in _report(tables, bad, {}).problems(ACCEPTED).collect()}
    assert {"city", "true_tau"} <= rules


def test_fingerprint_changes_with_one_cell(spark, star):
    parts = store.manifest_parts(star.tables(stored=True))
    first = star.stored_transactions.agg(F.min("txn_date")).first()[0]
    one = star.stored_transactions.withColumn("amount_gel", F.when((F.col("txn_date") == first) & (F.col("amount_gel") > 0), F.col("amount_gel") + F.lit("0.01").cast("decimal(3,2)")).otherwise(F.col("amount_gel")).cast("decimal(12,2)"))
    other = store.manifest_parts({**star.tables(stored=True), "fact_transaction": one})
    changed = store.changed_parts(parts, other).collect()
    assert [(r["table_name"], r["part"], r["change"]) for r in changed] == [("fact_transaction", first.replace(day=1), "changed")]
    shuffled = {n: df.repartition(3) for n, df in star.tables(stored=True).items()}
    assert store.changed_parts(parts, store.manifest_parts(shuffled)).count() == 0
    whole = {r["table_name"]: r["fingerprint"] for r in store.merged(parts).collect()}
    assert whole == {r["table_name"]: r["fingerprint"] for r in store.manifest(star.tables(stored=True)).collect()}
    gone = store.changed_parts(parts, parts.where("table_name <> 'dim_date'")).collect()
    assert [(r["table_name"], r["change"]) for r in gone] == [("dim_date", "removed")]


def test_a_matrix_that_reads_sealed_rows_is_refused(spark, star, tmp_path):
    root = str(tmp_path / "star")
    for name, df in star.tables(stored=True).items():
        store.write_table(df, root, name)
    sealed = str(tmp_path / "sealed/persona")
    star.gt_customer_persona.write.parquet(sealed)
    labels = spark.read.parquet(sealed)
    job = CampaignAnalytics.open(spark, root, 1)
    job.write_features(str(tmp_path / "features"))
    matrix, allowed = job.feature_matrix(), [root]
    assert lineage.refused(matrix, allowed) == []
    assert {s.rsplit("/", 1)[1] for s in lineage.sources_of(matrix)} == {"fact_transaction", "fact_account_monthly", "dim_customer", "dim_product"}
    # joined, through a stored table, and through a scalar subquery: the columns of the label are gone each time
    joined = matrix.join(labels, "customer_sk").drop("persona")
    stored = materialise(matrix).join(materialise(labels.where("persona = 'building'")), "customer_sk", "left_semi")
    asked = matrix.where(F.col("customer_sk") > labels.agg(F.min("customer_sk")).scalar())
    for df in (joined, stored, asked):
        assert quality.leak_gate({"matrix": df}) == []
        with pytest.raises(ValueError, match="sealed/persona"):
            lineage.require_sources(df, allowed)
    assert lineage.refused(materialise(matrix), allowed) == []
    rows = spark.createDataFrame([(1,)], "customer_sk long")
    assert lineage.refused(rows, allowed) == ["<LogicalRDD>"]
    # a folder whose name only begins like an allowed one is another
    assert lineage.refused(matrix, [root + "x"]) and features.KEY in matrix.columns and AS_OF
