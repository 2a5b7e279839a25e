import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlift.operators.ranking import Tile, _cuts_below, add_ntiles, grouped_medians, ntile_global, quantiles
from pyspark.sql.types import LongType


def expected(rows, tiles, descending):
    """Tile of each key by sorting everything in one place; None is the largest score."""
    def rank(r):
        missing = r[1] is None
        value = 0 if missing else r[1]
        return ((not missing) if descending else missing, -value if descending else value, r[0])
    ordered = sorted(rows, key=rank)
    size, extra = divmod(len(rows), tiles)
    out = {}
    for i, (k, _) in enumerate(ordered):
        cut = extra * (size + 1)
        out[k] = i // (size + 1) + 1 if i < cut else extra + (i - cut) // max(size, 1) + 1
    return out


def tiles_of(df):
    return {r["k"]: r["tile"] for r in df.collect()}


@pytest.mark.parametrize("n, tiles, sizes", [(3, 5, [1, 1, 1]), (7, 3, [3, 2, 2]), (5, 5, [1] * 5)])
def test_sizes(spark, n, tiles, sizes):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("s"))
    got = tiles_of(ntile_global(df, "s", tiles, "k"))
    assert [sum(1 for v in got.values() if v == t) for t in range(1, len(sizes) + 1)] == sizes


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("shape", ["distinct", "all_ties", "third_tied", "few_values", "with_nulls"])
def test_distributed_equals_sorting(spark, shape, descending):
    rng = random.Random(7)
    n = 3001
    score = {
        "distinct": lambda i: rng.random(),
        "all_ties": lambda i: 4.0,
        "third_tied": lambda i: 0.5 if i % 3 == 0 else rng.random(),
        "few_values": lambda i: float(rng.randrange(6)),
        "with_nulls": lambda i: None if i % 4 == 0 else rng.random(),
    }[shape]
    keys = rng.sample(range(10 * n), n)
    rows = [(k, score(i)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k long, s double").repartition(6)
    got = tiles_of(add_ntiles(df, "k", [Tile("s", 5, "tile", descending)], resolution=32))
    assert got == expected(rows, 5, descending)


def test_other_types_are_refused(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, s double")
    with pytest.raises(TypeError, match="k is string"):
        ntile_global(df, "s", 5, "k")


def test_two_scores_of_different_types(spark):
    df = spark.range(500).select(
        F.col("id").alias("k"), (F.col("id") * 37 % 101).cast("decimal(12,2)").alias("a"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("b"))
    tiles = [Tile("a", 4, "ta"), Tile("b", 3, "tb", descending=True)]
    windowed = df.select(
        "k", F.ntile(4).over(Window.orderBy("a", "k")).alias("ta"), F.ntile(3).over(Window.orderBy(F.desc("b"), "k")).alias("tb"))
    got = add_ntiles(df, "k", tiles, resolution=16).select("k", "ta", "tb")
    assert got.exceptAll(windowed).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "decimal(30,4)"])
def test_scores_beyond_doubles(spark, kind):
    """Neighbours that are one double; every third value is common."""
    rows = [(k, 2**60 + (5 if k % 3 == 0 else k * 7919 % 1000)) for k in range(1500)]
    df = spark.createDataFrame(rows, "k long, s long").select("k", F.col("s").cast(kind).alias("s")).repartition(5)
    got = tiles_of(add_ntiles(df, "k", [Tile("s", 5, "tile")], resolution=32))
    assert got == expected(rows, 5, False)


def test_nan_is_largest(spark):
    df = spark.createDataFrame([(k, float("nan") if k % 3 == 0 else float(k)) for k in range(300)], "k long, s double")
    got = tiles_of(add_ntiles(df, "k", [Tile("s", 3, "tile")], resolution=16))
    assert all(got[k] == 3 for k in range(0, 300, 3)) and {got[k] for k in range(300) if k % 3} == {1, 2}


def test_empty(spark):
    df = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("s"))
    assert ntile_global(df, "s", 5, "k").count() == 0


def test_cuts_below(spark):
    cuts = list(range(0, 200, 2))
    df = spark.range(-5, 210).select("id", _cuts_below(F.col("id"), cuts, LongType()).alias("n"))
    assert all(r["n"] == sum(c < r["id"] for c in cuts) for r in df.collect())


@pytest.mark.parametrize("values", [
    [random.Random(3).random() for _ in range(4001)], [2.0] * 50, [1.0, 2.0] * 40 + [9.0], [5.0],
])
def test_quantiles_equal_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.95, 1.0]
    ordered = sorted(values)
    want = []
    for p in probabilities:
        at = p * (len(ordered) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        want.append(low + (at - int(at)) * (high - low))
    assert quantiles(df, "x", probabilities, resolution=16, leaf=40) == pytest.approx(want, abs=1e-12)


def test_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


def test_grouped_medians(spark):
    rng = random.Random(5)
    values = {"wide": [rng.random() for _ in range(2000)], "ties": [1.0] * 301 + [2.0] * 300, "even": [1.0, 4.0], "one": [3.0],
              "half": [5.0] * 4 + [9.0] * 4}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("none", None)], "g string, x double").repartition(7)
    got = {r["g"]: r["median"] for r in grouped_medians(df, "g", "x").collect()}
    assert got == pytest.approx({g: statistics.median(vs) for g, vs in values.items()})


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, inf, inf, float("nan"), None]], "x double")
    assert quantiles(df, "x", [0.0, 0.25, 0.5, 0.6, 0.75, 1.0]) == [-inf, 1.0, 2.0, inf, inf, inf]
