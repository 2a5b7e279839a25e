"""Scoring against labels: agreement of segmentations, and a scan for leaked features.

Together with ``campaign.truth_in_interval`` the only code meant to see sealed labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.expressions import ratio


def clustering_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Adjusted Rand index, normalised mutual information and purity of two labellings.

    Everything follows from the contingency counts; one row per (cluster, label) pair leaves
    the rows, and only those are summed.
    """
    cells = df.groupBy(F.col(cluster).alias("c"), F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("c").agg(F.sum("n").alias("n"), F.max("n").alias("top"))
    cols = cells.groupBy("l").agg(F.sum("n").alias("n"))

    n = F.col("n").cast("double")
    pairs = F.sum(n * (n - 1) / 2)
    log_sum = F.sum(n * F.ln(n))
    a = cells.agg(F.sum(n).alias("total"), pairs.alias("same"), log_sum.alias("h_cells"), F.lit(0.0).alias("top"))
    b = rows.agg(F.lit(0.0).alias("total"), pairs.alias("same"), log_sum.alias("h_cells"), F.sum(F.col("top").cast("double")).alias("top"))
    c = cols.agg(F.lit(0.0).alias("total"), pairs.alias("same"), log_sum.alias("h_cells"), F.lit(0.0).alias("top"))
    parts = {"cells": a, "rows": b, "cols": c}
    long = None
    for name, part in parts.items():
        tagged = part.withColumn("part", F.lit(name))
        long = tagged if long is None else long.unionByName(tagged)

    def of(part: str, measure: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(measure)))

    wide = long.agg(
        of("cells", "total").alias("total"), of("cells", "same").alias("s_ij"), of("rows", "same").alias("s_i"),
        of("cols", "same").alias("s_j"), of("cells", "h_cells").alias("h_ij"), of("rows", "h_cells").alias("h_i"),
        of("cols", "h_cells").alias("h_j"), of("rows", "top").alias("top"))
    t = F.col("total")
    expected = ratio(F.col("s_i") * F.col("s_j"), t * (t - 1) / 2)
    entropy_c = F.ln(t) - F.col("h_i") / t
    entropy_l = F.ln(t) - F.col("h_j") / t
    mutual = F.ln(t) + (F.col("h_ij") - F.col("h_i") - F.col("h_j")) / t
    return wide.select(
        ratio(F.col("s_ij") - expected, (F.col("s_i") + F.col("s_j")) / 2 - expected).alias("adjusted_rand_index"),
        ratio(mutual, (entropy_c + entropy_l) / 2).alias("normalized_mutual_information"),
        ratio(F.col("top"), t).alias("purity"))


def leak_scan(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One-way ANOVA F of every feature over the label groups, and whether it looks leaked.

    A feature without any variance inside the groups but some between them determines the label:
    its F is infinite. All features are aggregated side by side by label, in one pass; only the few results become rows. The
    spread inside a group is taken around the group's own mean, so a constant group has exactly none.
    """
    wide = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(*[
        F.struct(F.lit(f).alias("feature"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"),
                 F.min(x).alias("low"), F.max(x).alias("high")).alias(f"f{i}")
        for i, (f, x) in enumerate((f, F.col(f).cast("double")) for f in features)])
    groups = wide.select("label", F.inline(F.array(*[F.col(f"f{i}") for i in range(len(features))]))).where("n > 0")
    n, of_feature = F.col("n").cast("double"), Window.partitionBy("feature")
    # deviations of group means are taken around the grand mean: squares of large means would cancel
    groups = groups.withColumn("grand", F.sum(n * F.col("mean")).over(of_feature) / F.sum(n).over(of_feature))
    pooled = groups.groupBy("feature").agg(
        F.sum(n).alias("total"), F.count(F.lit(1)).alias("k"), F.sum(n * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
        (F.min("low") == F.max("high")).alias("flat"),
        F.sum(F.when(F.col("low") == F.col("high"), 0.0).otherwise(n * F.col("var"))).alias("within"))
    between = F.when(F.col("flat"), 0.0).otherwise(F.col("between"))
    df_between, df_within = F.col("k") - 1, F.col("total") - F.col("k")
    f_stat = F.when(between == 0, F.lit(0.0)).when(F.col("within") == 0, F.lit(float("inf"))).otherwise(
        ratio(ratio(between, df_between), ratio(F.col("within"), df_within)))
    return pooled.select("feature", f_stat.alias("f_statistic")).withColumn(
        "leaked", (F.col("f_statistic") == float("inf")).cast("int"))
