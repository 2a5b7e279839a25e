"""Load of a staged star: typed copy, then one validation over the finished tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.operators import quality
from cohortlift.sources import star
from cohortlift.sources.pointer import Versions


@dataclass(frozen=True)
class LoadReport:
    counts: DataFrame
    constraints: DataFrame
    checks: DataFrame
    lengths: DataFrame
    leaked: tuple[str, ...]
    manifest: DataFrame
    coverage: DataFrame | None = None

    def problems(self, accepted: tuple[str, ...] = ()) -> DataFrame:
        """The verdict on a load: (table_name, rule) of mismatched counts, broken constraints, texts that are too long, failed checks of
        severity ERROR, sealed columns and gaps in the labels, apart from the ``accepted`` rules; empty when the load is sound."""
        broken = self.constraints.select("table_name", "rule", "violations").unionByName(self.lengths.select("table_name", "rule", "violations"))
        failed = self.checks.where("severity = 'ERROR' AND violations > 0").selectExpr("'' AS table_name", "check_name AS rule")
        bad = self.counts.where("status <> 'ok'").selectExpr("table_name", "'row_count' AS rule")
        bad = bad.unionByName(broken.where("violations > 0").select("table_name", "rule")).unionByName(failed)
        if self.leaked:
            bad = bad.unionByName(bad.sparkSession.createDataFrame([tuple(c.split(".", 1)) for c in self.leaked], "table_name string, rule string"))
        if self.coverage is not None:
            gaps = self.coverage.where("without_label + repeated_label + unknown_customer > 0")
            bad = bad.unionByName(gaps.selectExpr("'' AS table_name", "'truth_coverage' AS rule"))
        return bad.where(~F.col("rule").isin(*accepted)) if accepted else bad


def load_star(spark: SparkSession, source_root: str, target_root: str) -> LoadReport:
    """Copies every table of ``source_root`` to ``target_root``, dimensions first, and reports on the result.

    Each table is replaced whole, so a repeated load repeats no row. Keys and rules are checked
    once over the stored tables rather than row by row during the copy. The reports are lazy.
    """
    source = {}
    for table in star.LOAD_ORDER:
        source[table] = spark.read.parquet(star.location(spark, source_root, table))
        star.write_table(star.prepare(table, source[table]), target_root, table)
    loaded = read_star(spark, target_root)
    known = source["dim_date"].where("date_sk = 0").limit(1).count()
    return _report(source, loaded, {"dim_date": 1 - known})


def _report(source: dict[str, DataFrame], loaded: dict[str, DataFrame], seeded: dict[str, int], truth: DataFrame | None = None) -> LoadReport:
    return LoadReport(
        counts=quality.reconcile_counts(source, loaded, seeded), constraints=quality.constraint_report(loaded), checks=quality.dq_suite(loaded),
        lengths=quality.length_report(loaded), leaked=tuple(quality.leak_gate(loaded)), manifest=star.manifest(loaded),
        coverage=None if truth is None else quality.truth_coverage(loaded["dim_customer"], truth))


class PublishedStar:
    """A star that is loaded in stages: written beside the current version, checked there, and made current by one rename.

    ``v=<n>/<table>`` holds the tables of version n. Readers keep the version they opened; a load that fails its checks, or is
    interrupted, leaves the one before it current.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.versions = spark, root.rstrip("/"), Versions(spark, root)

    def _tables(self, number: int) -> dict[str, DataFrame]:
        return read_star(self.spark, f"{self.root}/v={number}")

    def current(self, number: int | None = None) -> dict[str, DataFrame] | None:
        """The tables of a version, the latest by default; None before the first load."""
        found = self.versions.read(number)
        return None if found is None else self._tables(found["version"])

    def load(self, source: dict[str, DataFrame], accepted: tuple[str, ...] = (), truth: DataFrame | None = None) -> LoadReport:
        """Writes all tables of ``source``, dimensions first, and publishes them if the verdict, apart from ``accepted`` rules, is empty."""
        number = (self.versions.known() or [0])[-1] + 1
        for table in star.LOAD_ORDER:
            star.write_table(star.prepare(table, source[table]), f"{self.root}/v={number}", table)
        loaded = self._tables(number)
        report = _report(source, loaded, {"dim_date": 1 - source["dim_date"].where("date_sk = 0").limit(1).count()}, truth)
        problems = [tuple(r) for r in report.problems(accepted).limit(20).collect()]
        if problems:
            raise ValueError(f"version {number} is not published: {problems}")
        self.versions.put(number, {"version": number, "tables": list(star.LOAD_ORDER)})
        return report


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {table: star.read_table(spark, root, table) for table in star.LOAD_ORDER}
