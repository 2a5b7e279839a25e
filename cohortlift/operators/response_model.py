"""Response models by a fixed number of Newton steps, each from one pass over the rows.

A step needs only the sums of a logistic regression's gradient and curvature: they combine on the map side, their number depends on the
features alone, and every arm has its own. So the fit repeats itself on any partitioning, and any SQL engine can check it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.session import materialise

ARMS = ("treatment", "control")


def _terms(columns: list[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]


def _probability(columns: list[str], beta: np.ndarray) -> Column:
    score = sum((F.lit(float(b)) * x for b, x in zip(beta, _terms(columns), strict=True)), F.lit(0.0))
    return 1 / (1 + F.exp(-score))


def newton_models(rows: DataFrame, columns: list[str], steps: int = 6, ridge: float = 1.0, label: str = "responded", arm: str = "assignment") -> dict[str, np.ndarray]:
    """Coefficients (intercept first) of a logistic regression per arm after ``steps`` Newton steps from zero.

    ``ridge`` weighs the squares of all coefficients but the intercept, which also keeps separable data finite. Rows with a missing value take
    no part; an arm without rows keeps zeros. ``rows`` are read once a step: pass a stored frame.
    """
    x = _terms(columns)
    size = len(x)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    used = rows.where(F.col(label).isNotNull())
    for c in columns:
        used = used.where(F.col(c).isNotNull())
    beta = {a: np.zeros(size) for a in ARMS}
    penalty = np.diag([0.0] + [ridge] * len(columns))
    for _ in range(steps):
        p = F.when(F.col(arm) == ARMS[0], _probability(columns, beta[ARMS[0]])).otherwise(_probability(columns, beta[ARMS[1]]))
        with_p = used.where(F.col(arm).isin(*ARMS)).withColumn("_p", p)
        weight, error = F.col("_p") * (1 - F.col("_p")), F.col(label).cast("double") - F.col("_p")
        sums = with_p.groupBy(arm).agg(
            *[F.sum(error * x[i]).alias(f"g{i}") for i in range(size)], *[F.sum(weight * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs]).collect()
        for s in sums:
            gradient = np.array([s[f"g{i}"] for i in range(size)]) - penalty @ beta[s[arm]]
            curve = penalty.copy()
            for i, j in pairs:
                curve[i, j] += s[f"h{i}_{j}"]
                curve[j, i] = curve[i, j]
            beta[s[arm]] = beta[s[arm]] + np.linalg.lstsq(curve, gradient, rcond=None)[0]
    return beta


def newton_uplift(features: DataFrame, responses: DataFrame, columns: list[str], steps: int = 6, ridge: float = 1.0, key: str = "customer_sk") -> DataFrame:
    """(key, propensity, uplift) of every customer of ``features``: the treated model alone, and less the model of the controls.

    A customer with a missing feature has no score.
    """
    training = materialise(features.select(key, *columns).join(responses.select(key, "assignment", "responded"), key))
    beta = newton_models(training, columns, steps, ridge)
    treated, control = (_probability(columns, beta[a]) for a in ARMS)
    return features.select(key, treated.alias("propensity"), (treated - control).alias("uplift"))
