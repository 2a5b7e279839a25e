import math
import random

import numpy as np
import pytest

from cohortlift.operators import response_model, segmentation


@pytest.mark.parametrize("scores, wanted", [
    ([(2, 100.0, 0.3), (3, 40.0, 0.5), (4, 35.0, 0.4), (5, 31.0, 0.4), (6, 28.0, 0.3)], 3),
    ([(6, 28.0, 0.3), (2, 100.0, 0.3), (3, 40.0, 0.5), (4, 35.0, 0.4)], 3),
    ([(2, 30.0, 0.2), (3, 20.0, 0.6), (4, 10.0, 0.6)], 3),
    ([(2, 10.0, 0.2), (3, 10.0, 0.1)], 2),
    ([(4, 1.0, 0.9)], 4),
])
def test_knee(scores, wanted):
    assert segmentation.knee(scores) == wanted


def test_quality_equals_all_pairs(spark):
    random.seed(5)
    points = [(random.gauss(c, 1.0), random.gauss(-c, 0.5)) for c in (0, 4, 9) for _ in range(40)] + [(100.0, 100.0)]
    centers = [("a", 0.0, 0.0), ("b", 4.0, -4.0), ("c", 9.0, -9.0), ("lonely", 100.0, 100.0), ("empty", -500.0, 0.0)]
    df = spark.createDataFrame([*points, (None, 1.0)], "x double, y double")
    got = {r["name"]: r for r in segmentation.cluster_quality(df, ["x", "y"], spark.createDataFrame(centers, "name string, x double, y double"), "name").collect()}
    square = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
    near = {p: min(centers, key=lambda c: (square(p, c[1:]), c[0]))[0] for p in points}
    members = {n: [p for p in points if near[p] == n] for n, *_ in centers}
    for name, x, y in centers[:4]:
        own = members[name]
        values = []
        for p in own:
            if len(own) == 1:
                values.append(0.0)
                continue
            a = sum(square(p, q) for q in own) / (len(own) - 1)
            b = min(sum(square(p, q) for q in other) / len(other) for n, other in members.items() if n != name and other)
            values.append((b - a) / max(a, b))
        assert got[name]["points"] == len(own) and got[name]["cost"] == pytest.approx(sum(square(p, (x, y)) for p in own))
        assert got[name]["silhouette"] == pytest.approx(sum(values) / len(values))
    assert set(got) == {"a", "b", "c", "lonely"}
    assert segmentation.cluster_quality(df.where("false"), ["x", "y"], spark.createDataFrame(centers, "name string, x double, y double"), "name").count() == 0


def rows_of_arms():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(3000):
        x, z, treated = rng.normal(), rng.normal(), i % 3 != 0
        p = 1 / (1 + math.exp(-(-0.5 + 0.8 * x - 0.3 * z + (0.6 * x if treated else 0))))
        rows.append((i, float(x), float(z), "treatment" if treated else "control", int(rng.random() < p)))
    return rows


def test_newton_equals_plain_numpy(spark):
    rows = rows_of_arms()
    df = spark.createDataFrame(rows, "customer_sk long, x double, z double, assignment string, responded int").repartition(5)
    got = response_model.newton_models(df, ["x", "z"], steps=5, ridge=2.0)
    for arm in ("treatment", "control"):
        design = np.array([[1, r[1], r[2]] for r in rows if r[3] == arm])
        y = np.array([r[4] for r in rows if r[3] == arm])
        beta = np.zeros(3)
        for _ in range(5):
            p = 1 / (1 + np.exp(-design @ beta))
            gradient = design.T @ (y - p) - np.diag([0, 2.0, 2.0]) @ beta
            beta = beta + np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.diag([0, 2.0, 2.0]), gradient)
        assert got[arm] == pytest.approx(beta, abs=1e-8)
        # at the optimum the penalised gradient is zero
        assert abs(design.T @ (y - 1 / (1 + np.exp(-design @ beta))) - np.diag([0, 2.0, 2.0]) @ beta).max() < 1e-4


def test_scores_and_odd_rows(spark):
    rows = rows_of_arms()
    features = spark.createDataFrame([r[:3] for r in rows] + [(9999, None, 1.0)], "customer_sk long, x double, z double")
    responses = spark.createDataFrame([(r[0], r[3], r[4]) for r in rows], "customer_sk long, assignment string, responded int")
    scores = {r["customer_sk"]: r for r in response_model.newton_uplift(features, responses, ["x", "z"]).collect()}
    assert len(scores) == 3001 and scores[9999]["uplift"] is None
    high = [scores[r[0]]["uplift"] for r in rows if r[1] > 1]
    low = [scores[r[0]]["uplift"] for r in rows if r[1] < -1]
    assert sum(high) / len(high) > 0.05 > sum(low) / len(low)
    # one arm only, separable labels, no rows at all
    alone = response_model.newton_models(responses.where("false").join(features, "customer_sk"), ["x"])
    assert all((b == 0).all() for b in alone.values())
    split = spark.createDataFrame([(float(i), "control", int(i > 5)) for i in range(12)], "x double, assignment string, responded int")
    assert np.isfinite(response_model.newton_models(split, ["x"], steps=25)["control"]).all()
