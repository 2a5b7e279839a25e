"""Uplift scores, their Qini curve, and targeting within a budget."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.expressions import ratio
from cohortlift.operators.ranking import ntile_global
from cohortlift.operators.running import POSITION, running_totals
from cohortlift.session import materialise


def uplift_scores(features: DataFrame, responses: DataFrame, columns: list[str], key: str = "customer_sk") -> DataFrame:
    """Predicted incremental take-up: one response model per arm, scored on every customer.

    ``propensity`` is the treated model alone, the score that ignores what would happen anyway.
    """
    prepared = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
    ]).fit(features).transform(features).select(key, "features")
    scored = materialise(prepared)
    training = scored.join(responses.select(key, "assignment", F.col("responded").cast("double").alias("label")), key)
    for arm, out in (("treatment", "p_treated"), ("control", "p_control")):
        model = LogisticRegression(
            maxIter=50, regParam=0.01, predictionCol="_pred", probabilityCol="_prob", rawPredictionCol="_raw",
        ).fit(training.where(F.col("assignment") == arm))
        scored = model.transform(scored).withColumn(out, vector_to_array("_prob")[1]).drop("_pred", "_prob", "_raw")
    return scored.select(key, F.col("p_treated").alias("propensity"), (F.col("p_treated") - F.col("p_control")).alias("uplift"))


def rank_bins(scores: DataFrame, score: str, bins: int = 100, key: str = "customer_sk") -> DataFrame:
    """``scores`` with the score's bin, 1 the highest: an exact ntile over the population."""
    return ntile_global(scores, score, bins, key, descending=True, out="bin")


def qini_curve(binned: DataFrame, responses: DataFrame, key: str = "customer_sk") -> DataFrame:
    """Incremental responses gained by treating the best bins first.

    ``qini`` is treated responders less control responders scaled to the treated so far;
    ``random`` is the straight line to the end of the curve. Running sums are over bins.
    """
    t, r = F.col("assignment") == "treatment", F.col("responded") == 1
    per_bin = binned.select(key, "bin").join(responses.select(key, "assignment", "responded"), key).groupBy("bin").agg(
        F.count_if(t).alias("n_t"), F.count_if(~t).alias("n_c"), F.count_if(t & r).alias("y_t"), F.count_if(~t & r).alias("y_c"))
    upto = Window.orderBy("bin")
    run = per_bin.select("bin", *[F.sum(c).over(upto).alias(c) for c in ("n_t", "n_c", "y_t", "y_c")])
    gain = F.col("y_t") - F.coalesce(ratio(F.col("y_c") * F.col("n_t"), F.col("n_c")), F.lit(0.0))
    curve = run.withColumn("qini", gain)
    whole = Window.partitionBy()
    last = F.max_by("qini", "bin").over(whole)
    share = ratio(F.col("n_t") + F.col("n_c"), F.max(F.col("n_t") + F.col("n_c")).over(whole))
    return curve.select("bin", "n_t", "n_c", "y_t", "y_c", "qini", (last * share).alias("random"), share.alias("targeted_share"))


def qini_area(curve: DataFrame) -> DataFrame:
    """Area between the curve and the random line, by trapezoids over the share targeted."""
    order = Window.orderBy("bin")
    gap = F.col("qini") - F.col("random")
    before = F.coalesce(F.lag(gap).over(order), F.lit(0.0))
    width = F.col("targeted_share") - F.coalesce(F.lag("targeted_share").over(order), F.lit(0.0))
    return curve.select(((gap + before) / 2 * width).alias("slice")).agg(F.sum("slice").alias("qini_area"))


def targeting_plan(binned: DataFrame, score: str, value: float, cost: float) -> DataFrame:
    """Bins in order of uplift, what each is expected to earn, and whether to contact it.

    A bin is contacted while its expected value exceeds its contact cost; customers with a
    negative uplift are never contacted.
    """
    wanted = F.col(score) > 0
    per_bin = binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(wanted).alias("contactable"),
        F.coalesce(F.sum(F.when(wanted, F.col(score))), F.lit(0.0)).alias("expected_conversions"))
    gain = F.col("expected_conversions") * value - F.col("contactable") * cost
    upto = Window.orderBy("bin")
    staged = per_bin.withColumn("expected_profit", gain)
    contact = (F.col("contactable") > 0) & (F.min("expected_profit").over(upto) > 0)
    return staged.withColumn("contact", contact.cast("int")).withColumn(
        "cumulative_profit", F.sum(F.when(F.col("contact") == 1, F.col("expected_profit")).otherwise(0.0)).over(upto))


#: Money in row-grain totals: whole ten-thousandths, so that their sums are the same on every partitioning.
UNIT = 10_000


def targeting_cutoff(scores: DataFrame, score: str, value: float, cost: float, budget: float | None = None, key: str = "customer_sk") -> DataFrame:
    """Every customer in order of uplift, with the running totals of cost and expected profit, and whether to contact them.

    Contacted is the shortest run of best customers whose total profit is the highest there is, as far as the ``budget`` goes; none if no
    run earns anything. A customer without a score comes last and is expected to bring nothing.
    """
    units = lambda amount: F.round(amount * UNIT).cast("long")
    gain = units(F.coalesce(F.col(score), F.lit(0.0)) * value) - units(F.lit(float(cost)))
    rows = scores.select(key, score, gain.alias("gain"), units(F.lit(float(cost))).alias("paid"))
    ranked = materialise(running_totals(rows, [score, key], {"profit": "gain", "spent": "paid"}, descending=[score]))
    affordable = ranked if budget is None else ranked.where(F.col("spent") <= int(round(budget * UNIT)))
    best = affordable.where("profit > 0").agg(F.max(F.struct(F.col("profit"), -F.col(POSITION))).alias("b")).select(-F.col("b")["col2"]).scalar()
    gel = lambda c: (F.col(c) / UNIT).alias(f"{c}_gel")
    return ranked.select(
        key, POSITION, score, gel("gain"), gel("spent"), gel("profit"), (F.col(POSITION) <= F.coalesce(best, F.lit(0))).cast("int").alias("contact"))


def budget_table(plan: DataFrame, cost: float, budgets: list[float]) -> DataFrame:
    """What each budget buys: whole bins from the best down, as far as the money and the plan go; nothing is a row of zeros."""
    upto = Window.orderBy("bin")
    spend = plan.where("contact = 1").select(
        "bin", "contactable", "expected_conversions", "expected_profit",
        (F.sum("contactable").over(upto) * cost).alias("spent"))
    wanted = plan.sparkSession.createDataFrame([(float(b),) for b in dict.fromkeys(budgets)], "budget double")
    per_budget = wanted.join(spend, F.col("spent") <= F.col("budget"), "left")
    fits = F.col("spent").isNotNull()
    return per_budget.groupBy("budget").agg(
        F.count_if(fits).alias("bins"),
        F.coalesce(F.sum(F.when(fits, F.col("contactable"))), F.lit(0).cast("long")).alias("contacts"),
        F.coalesce(F.max(F.when(fits, F.col("spent"))), F.lit(0.0)).alias("spend_gel"),
        F.coalesce(F.sum(F.when(fits, F.col("expected_conversions"))), F.lit(0.0)).alias("expected_conversions"),
        F.coalesce(F.sum(F.when(fits, F.col("expected_profit"))), F.lit(0.0)).alias("expected_profit_gel"))


def equal_budget_comparison(scores: DataFrame, responses: DataFrame, contacts_share: float, bins: int = 100,
                            key: str = "customer_sk") -> DataFrame:
    """Realised lift among the best ``contacts_share`` of customers by uplift and by propensity; the share must be a whole number of bins."""
    wanted = round(bins * contacts_share, 9)
    if wanted != int(wanted):
        raise ValueError(f"{contacts_share} of {bins} bins is no whole number of bins")
    out = None
    stored = materialise(scores)
    for ranking in ("uplift", "propensity"):
        picked = rank_bins(stored, ranking, bins, key).where(F.col("bin") <= F.lit(int(wanted)))
        t, hit = F.col("assignment") == "treatment", F.col("responded").cast("double")
        row = picked.select(key).join(responses, key).agg(
            F.count(F.lit(1)).alias("customers"),
            (F.avg(F.when(t, hit)) - F.avg(F.when(~t, hit))).alias("lift")).withColumn("ranking", F.lit(ranking))
        out = row if out is None else out.unionByName(row)
    return out
