"""Behavioural segmentation with MLlib k-means, the number of clusters chosen without labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.session import materialise

SEED = 42
SCORES = "k int, cost double, silhouette double, chosen int"


def _prepare(features: DataFrame, columns: list[str], key: str) -> DataFrame:
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)])
    return materialise(pipeline.fit(features).transform(features).select(key, "features"))


def knee(scores: list[tuple[int, float, float]]) -> int:
    """The number of clusters at the knee of the cost: where the curve lies farthest below the straight line between its ends.

    Equal distances go to the better silhouette, then to fewer clusters. A curve that never bends below the line has no knee: the best
    silhouette decides.
    """
    scores = sorted(scores)
    (k0, c0, _), (k1, c1, _) = scores[0], scores[-1]
    fall, width = c0 - c1, k1 - k0

    def depth(k: int, cost: float) -> float:
        return round((1 - (k - k0) / width) - (cost - c1) / fall, 12) if fall > 0 and width else 0.0

    if all(depth(k, c) <= 0 for k, c, _ in scores):
        return max(scores, key=lambda s: (s[2], -s[0]))[0]
    return max(scores, key=lambda s: (depth(s[0], s[1]), s[2], -s[0]))[0]


def _square_distance(columns: list[str], center) -> Column:
    return sum(((F.col(c) - F.lit(float(center[c]))) * (F.col(c) - F.lit(float(center[c]))) for c in columns), F.lit(0.0))


def cluster_quality(points: DataFrame, columns: list[str], centroids: DataFrame, label: str) -> DataFrame:
    """Points, cost and mean silhouette of each of the given centroids' clusters; ``label`` names them.

    A point belongs to the nearest centroid, ties to the first label. The mean squared distance of a point to all points of a cluster follows
    from the cluster's size, sum and sum of squares, so one pass gives these and a second one the silhouettes: no pairs of points. Rows with
    a missing value take no part, a cluster of one point has silhouette 0. Centroids and their sums, a row a cluster, pass through the driver.
    """
    centers = sorted(centroids.select(label, *columns).collect(), key=lambda r: r[label])
    present = points.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])).select(*[F.col(c).cast("double").alias(c) for c in columns])
    away = F.array(*[F.struct(_square_distance(columns, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)])
    placed = present.withColumn("near", F.array_min(away)).select(*columns, "near.d", "near.i")
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    sums = placed.groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d").alias("cost"), F.sum(norm).alias("squares"), *[F.sum(c).alias(f"sum_{c}") for c in columns]).collect()

    def mean_distance(s, others: int) -> Column:
        dot = sum((F.col(c) * F.lit(s[f"sum_{c}"]) for c in columns), F.lit(0.0))
        return (norm * F.lit(float(s["n"])) + F.lit(s["squares"]) - 2 * dot) / F.lit(float(max(1, others)))

    own, other = F.lit(None).cast("double"), []
    for s in sums:
        mine = F.col("i") == s["i"]
        own = F.when(mine, mean_distance(s, s["n"] - 1)).otherwise(own)
        other.append(F.when(~mine, mean_distance(s, s["n"])))
    nearest = F.least(*other, F.lit(float("inf"))) if other else F.lit(float("inf"))
    alone = reduce(lambda a, b: a | b, [F.col("i") == s["i"] for s in sums if s["n"] == 1], F.lit(False))
    larger = F.greatest("own", "nearest")
    score = F.when(alone | (F.col("nearest") == float("inf")) | (larger == 0), 0.0).otherwise((F.col("nearest") - F.col("own")) / larger)
    found = placed.withColumns({"own": own, "nearest": nearest}).groupBy("i").agg(
        F.count(F.lit(1)).alias("points"), F.sum("d").alias("cost"), F.avg(score).alias("silhouette"))
    names = F.array(*[F.lit(c[label]) for c in centers])
    return found.select(F.element_at(names, F.col("i") + 1).alias(label), "points", "cost", "silhouette")


def choose_k(features: DataFrame, columns: list[str], ks: list[int], key: str = "customer_sk") -> DataFrame:
    """Within-cluster cost and silhouette of each candidate number of clusters, and which of them is chosen: the ``knee``.

    No label takes part. Scaled features are stored once and read by every fit.
    """
    scaled = _prepare(features, columns, key)
    evaluator = ClusteringEvaluator(metricName="silhouette")
    scores = []
    for k in ks:
        model = KMeans(k=k, seed=SEED).fit(scaled)
        scores.append((k, float(model.summary.trainingCost), float(evaluator.evaluate(model.transform(scaled)))))
    chosen = knee(scores)
    return features.sparkSession.createDataFrame([(*s, int(s[0] == chosen)) for s in scores], SCORES)


def segment_customers(features: DataFrame, columns: list[str], k: int, key: str = "customer_sk") -> DataFrame:
    """The cluster of every customer."""
    scaled = _prepare(features, columns, key)
    model = KMeans(k=k, seed=SEED, predictionCol="cluster").fit(scaled)
    return model.transform(scaled).select(key, "cluster")
