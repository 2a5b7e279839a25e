"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of any orderable type -> (node, label): each linked node but the smallest of its component, and that smallest.

    A large star hangs all larger neighbours of a node on its smallest neighbour, a small star hangs the node and its smaller neighbours
    there. Both replace links by as many links at most, so nothing grows; the minimum of a node is combined before the shuffle, and the
    joins can be split where a node has a great many links. The rounds end when no link changes; each is written to the shared folder.
    Links of a node to itself, repeated links and links with a null do no harm; no links give no rows.
    """
    ends = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    stars = stored(links.where("a <> b").select(*ends).distinct())
    seen = None
    while (state := tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())) != seen and state[0]:
        seen = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = stored(small.unionByName(least.withColumnRenamed("low", "v")).distinct())
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
