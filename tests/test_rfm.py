import datetime as dt

import pytest

from cohortlift.operators import rfm
from cohortlift.operators.merge import VersionedTable, upsert
from tests.conftest import by_key


@pytest.mark.parametrize("scores, segment", [
    ((4, 4, 4), "Champions"), ((3, 3, 1), "Loyal"), ((5, 2, 5), "New / Promising"), ((2, 3, 1), "At Risk"),
    ((1, 1, 5), "Hibernating"), ((3, 2, 2), "Needs Attention"), ((5, 5, 3), "Loyal"),
])
def test_segments(spark, scores, segment):
    df = spark.createDataFrame([(1, *scores, 1.0, 1.0)], "customer_sk long, r_score int, f_score int, m_score int, monetary_gel double, avg_ticket_gel double")
    assert rfm.rfm_segment(df).first()["rfm_segment"] == segment


def test_base_is_strictly_before(spark, txn_of):
    rows = [(1, "2020-01-01", "purchase", "pos", "dining", 5, 10), (1, "2020-01-09", "purchase", "pos", "dining", 5, "20.50"),
            (1, "2020-01-08", "inflow", "transfer", "n/a", 0, 999)]
    late = [(1, "2020-01-10", "purchase", "pos", "dining", 5, 77), (2, "2020-02-01", "purchase", "pos", "dining", 5, 1)]
    want = {"customer_sk": 1, "recency_days": 1, "frequency": 2, "avg_ticket_gel": 15.25}
    for given in (rows, rows + late):
        got = rfm.rfm_base(txn_of(given), "2020-01-10").drop("monetary_gel").collect()
        assert [r.asDict() for r in got] == [want]


def test_golden_segment_report(spark):
    from verification.adapter import AS_OF, TestStar
    star = TestStar(spark, "/root/testdata/sf0.01")
    report = rfm.rfm_segment_report(rfm.customer_rfm(star.fact_transaction, AS_OF), round_digits=True).collect()
    assert sum(r["customers"] for r in report) == 1497
    assert abs(sum(r["pct_of_spend"] for r in report) - 1) < 0.005
    totals = [r["total_spend_gel"] for r in report]
    assert totals == sorted(totals, reverse=True)


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "k int, v string, w int")
    merged = upsert(target, source, ["k"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a", None), (2, None, 5), (3, "c", 6)]
    assert sorted(map(tuple, upsert(merged, source, ["k"]).collect())) == sorted(map(tuple, merged.collect()))
    assert sorted(r["k"] for r in upsert(target, source, ["k"], delete_missing=True).collect()) == [2, 3]


def test_versioned_refresh(spark, tmp_path, txn_of):
    table = VersionedTable(spark, str(tmp_path / "snapshot"))
    assert table.current() is None
    day = dt.date(2020, 1, 1)
    first = txn_of([(c, "2019-12-01", "purchase", "pos", "dining", 1, c) for c in range(1, 6)])
    rows = rfm.customer_rfm(first, day).withColumn("snapshot_date", rfm.day(day))
    assert table.merge(rows, ["customer_sk"]) == 1
    changed = rows.where("customer_sk <= 2").withColumn("frequency", rfm.F.lit(99).cast("long"))
    added = rows.where("customer_sk = 5").withColumn("customer_sk", rfm.F.lit(9).cast("long"))
    assert table.merge(changed.unionByName(added), ["customer_sk"]) == 2
    now = by_key(table.current())
    assert sorted(now) == [1, 2, 3, 4, 5, 9] and now[1]["frequency"] == 99 and now[4]["frequency"] == 1


def test_unfinished_version_is_ignored(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3))
    (tmp_path / "t" / "v=2").mkdir()
    assert table.current().count() == 3
    assert table.write(spark.range(5)) == 2 and table.current().count() == 5
