"""The analytical jobs over a loaded star: feature store, segment snapshot and campaign read."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.operators import campaign, features, profiles, quality, rfm
from cohortlift.operators.merge import VersionedTable
from cohortlift.plans.load import read_star
from cohortlift.schema import TABLES
from cohortlift.sources.lineage import require_sources


def campaign_start(campaigns: DataFrame, campaign_sk: int) -> dt.date:
    """The start of one campaign, the as-of date of everything computed for it.

    Read as a value, not joined: a literal prunes partitions when the query is planned.
    """
    rows = campaigns.where(F.col("campaign_sk") == campaign_sk).select("start_date").take(2)
    if len(rows) != 1:
        raise ValueError(f"campaign {campaign_sk}: {len(rows)} rows")
    return rows[0][0]


@dataclass(frozen=True)
class CampaignAnalytics:
    """Every result for one campaign, as lazy frames over one star."""

    tables: dict[str, DataFrame]
    campaign_sk: int
    as_of: dt.date
    #: Where the observable tables lie; feature matrices are only written if they read nothing else.
    root: str | None = None

    @classmethod
    def open(cls, spark: SparkSession, root: str, campaign_sk: int) -> CampaignAnalytics:
        tables = read_star(spark, root)
        return cls(tables, campaign_sk, campaign_start(tables["dim_campaign"], campaign_sk), root)

    @property
    def _txn(self) -> DataFrame:
        return self.tables["fact_transaction"]

    @property
    def _snapshot(self) -> DataFrame:
        return self.tables["fact_account_monthly"]

    def customer_rfm(self, round_digits: bool = False) -> DataFrame:
        return rfm.customer_rfm(self._txn, self.as_of, round_digits)

    def refresh_snapshot(self, table: VersionedTable) -> int:
        """Merges the current segments into the stored snapshot; returns its new version."""
        stamped = self.customer_rfm(round_digits=True).withColumn("snapshot_date", F.lit(self.as_of))
        return table.merge(stamped.select(*TABLES["customer_rfm_snapshot"].fieldNames()), ["customer_sk"])

    def feature_matrix(self) -> DataFrame:
        matrix = features.feature_matrix(
            self._txn, self._snapshot, self.tables["dim_customer"], self.tables["dim_product"], self.as_of)
        return quality.model_columns(matrix)

    def write_features(self, path: str) -> None:
        """One row per customer, written by the executors that computed it."""
        self._gated(self.feature_matrix()).write.mode("overwrite").parquet(path)

    def _gated(self, matrix: DataFrame) -> DataFrame:
        """``matrix``, unless it reads anything but the tables of the star: labels lie elsewhere."""
        return matrix if self.root is None else require_sources(matrix, [f"{self.root}/{t}{end}" for t in self.tables for end in ("", ".parquet")])

    def write_feature_snapshots(self, path: str, as_of_dates: list[str]) -> None:
        """The matrix at several dates, one partition per date; adaptive execution sizes the files, other dates in ``path`` stay."""
        matrix = features.monthly_feature_snapshots(
            self._txn, self._snapshot, self.tables["dim_customer"], self.tables["dim_product"], as_of_dates)
        dated = self._gated(quality.model_columns(matrix)).hint("rebalance", "as_of")
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path)

    def spend_profile(self) -> DataFrame:
        return profiles.spend_profile(self._txn, self.as_of)

    def channel_profile(self, round_digits: bool = False) -> DataFrame:
        return profiles.channel_profile(self._txn, self.as_of, round_digits)

    def balance_profile(self, round_digits: bool = False) -> DataFrame:
        return profiles.balance_profile(self._snapshot, self.tables["dim_product"], self.as_of, round_digits)

    def separation_report(self, round_digits: bool = False) -> DataFrame:
        return profiles.profile_separation_report(
            self.tables["dim_customer"], self.spend_profile(), self.channel_profile(), self.balance_profile(), round_digits)

    def arms(self) -> DataFrame:
        return campaign.campaign_arms(self.tables["fact_campaign_response"])

    def lift(self, round_digits: bool = False) -> DataFrame:
        return campaign.campaign_lift(self.tables["fact_campaign_response"], round_digits)

    def lift_by_segment(self, snapshot: DataFrame, round_digits: bool = False) -> DataFrame:
        return campaign.campaign_lift_by_segment(
            self.tables["fact_campaign_response"], snapshot, self.campaign_sk, round_digits)

    def response_curve(self, round_digits: bool = False) -> DataFrame:
        return campaign.response_curve(self.tables["fact_campaign_response"], self.campaign_sk, round_digits)

    def quality_report(self) -> DataFrame:
        return quality.dq_suite(self.tables)
