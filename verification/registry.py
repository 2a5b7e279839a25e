"""Every registered query: an operator applied to the star over one test-data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortlift.functions.expressions import day, hash_slot, rounded
from cohortlift.operators import (
    campaign, campaigns, evaluation, features, ledger, profiles, profiling, quality, ranking, response_model, rfm, running, segmentation, uplift,
)
from cohortlift.operators.merge import BucketedTable
from cohortlift.plans.load import PublishedStar
from cohortlift.schema import CATEGORIES, CHANNELS
from cohortlift.session import materialise, scratch_path
from cohortlift.sources import star
from verification.adapter import AS_OF, SNAPSHOT_MONTHS, SNAPSHOT_START, TestStar
from verification import damage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RESTATED = "1995-07-01"
SNAPSHOT_DATES = ("1998-03-20", "1999-07-01", "2001-01-01")
SEGMENT_COLUMNS = ["purchase_count", "avg_ticket_gel", "distinct_merchants", "digital_value_share", "cash_value_share",
                   "avg_monthly_inflow_gel", "spend_momentum", "avg_balance_gel"]
CONTACT_VALUE, CONTACT_COST = 250.0, 20.0
BUDGETS = [500.0, 2000.0, 10000.0]


def query(build: Callable[[TestStar], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Dates in the test tables carry no zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(TestStar(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# ---- star tables ------------------------------------------------------------------------------
@query
def dim_date(s):
    return s.dim_date


@query
def dim_customer(s):
    return s.dim_customer


@query
def dim_merchant(s):
    return s.dim_merchant


@query
def table_counts(s):
    return star.manifest(s.tables()).select("table_name", "rows")


@query
def manifest(s):
    """The content of every table; the transactions month by month."""
    parts = star.manifest_parts(s.tables())
    return parts.select("table_name", "part", "rows", F.concat_ws("-", F.col("sum_a").cast("string"), F.col("sum_b").cast("string")).alias("fingerprint"))


#: What the test tables are known to violate: some customers never order.
ACCEPTED = ("customers_without_transactions",)


@query
def staged_load(s):
    """All tables loaded, checked and published, then read back: rows, content, months and Unknown members."""
    store = PublishedStar(s.spark, scratch_path(s.spark))
    store.load(s.tables(stored=True), ACCEPTED, s.gt_customer_persona)
    loaded = store.current()
    months = loaded["fact_transaction"].agg(F.count_distinct("txn_month").alias("n")).scalar()
    unknown = {"dim_date": loaded["dim_date"].where("date_sk = 0"), "dim_merchant": loaded["dim_merchant"].where("merchant_sk = 0")}
    members = F.lit(0).cast("long")
    for table, rows in unknown.items():
        members = F.when(F.col("table_name") == table, rows.agg(F.count(F.lit(1))).scalar()).otherwise(members)
    return star.merged(star.manifest_parts(loaded)).select(
        "table_name", "rows", "fingerprint", F.when(F.col("table_name") == "fact_transaction", months).otherwise(F.lit(0)).alias("months"),
        members.alias("unknown_members"))


@query
def catalog_statistics(s):
    """Rows, nulls and extremes as the catalog holds them after ANALYZE."""
    lines = []
    for name in ("dim_customer", "dim_merchant", "fact_account_monthly", "fact_campaign_response", "fact_transaction"):
        table = f"{name}_{uuid.uuid4().hex}"
        star.register(s.spark, getattr(s, name), table, scratch_path(s.spark))
        try:
            lines.append(star.catalog_statistics(s.spark, table).withColumn("table_name", F.lit(name)))
        finally:
            s.spark.sql(f"DROP TABLE {table}")
    return reduce(DataFrame.unionByName, lines)


# ---- recency, frequency, monetary -------------------------------------------------------------
@query
def rfm_base(s):
    return rfm.rfm_base(s.fact_transaction, AS_OF).withColumn("monetary_gel", F.col("monetary_gel").cast("double"))


@query
def ntile_global(s):
    base = rfm.rfm_base(s.fact_transaction, AS_OF).select("customer_sk", "monetary_gel", "frequency")
    tiles = [ranking.Tile("monetary_gel", 5, "spend_tile"), ranking.Tile("frequency", 7, "frequency_tile", descending=True)]
    # No row is few enough for the plain window here, so this query runs the distributed form.
    tiled = ranking.add_ntiles(materialise(base), "customer_sk", tiles)
    return tiled.select("customer_sk", "spend_tile", "frequency_tile")


@query
def rfm_score(s):
    return rfm.rfm_score(rfm.rfm_base(s.fact_transaction, AS_OF)).select("customer_sk", "r_score", "f_score", "m_score", "rfm_cell")


@query
def rfm_segment(s):
    return rfm.customer_rfm(s.fact_transaction, AS_OF)


@query
def rfm_snapshot_refresh(s):
    """The snapshot of the campaign date restated by an early one: some customers change, the rest stay."""
    snapshot = rfm.customer_rfm(s.fact_transaction, AS_OF).withColumn("snapshot_date", F.lit(AS_OF))
    return rfm.rfm_snapshot_refresh(snapshot, rfm.customer_rfm(s.fact_transaction, RESTATED), RESTATED)


BUCKETS = 64


@query
def rfm_bucketed_refresh(s):
    """The stored snapshot after an early restatement of the customers in debt: only their buckets are written again."""
    def stamped(date):
        return rfm.customer_rfm(s.fact_transaction, date).withColumn("snapshot_date", day(date))

    table = BucketedTable(s.spark, scratch_path(s.spark), ["customer_sk"], BUCKETS)
    table.merge(stamped(AS_OF))
    in_debt = s.dim_customer.where("income_band = 'low'").select("customer_sk")
    table.merge(stamped(RESTATED).join(in_debt, "customer_sk", "left_semi"))
    return table.read()


@query
def rfm_segment_report(s):
    return rfm.rfm_segment_report(rfm.customer_rfm(s.fact_transaction, AS_OF))


# ---- features ---------------------------------------------------------------------------------
def _steady(df: DataFrame) -> DataFrame:
    """Deviations rounded: their last digits depend on the order rows are combined in."""
    digits = {"ticket_volatility_gel": 4, "inflow_volatility_gel": 4, "balance_volatility_gel": 4,
              "inflow_cv": 8, "balance_cv": 8}
    return rounded(df, {c: n for c, n in digits.items() if c in df.columns})


@query
def transaction_features(s):
    return _steady(features.transaction_features(s.stored_transactions, AS_OF))


@query
def category_shares(s):
    return features.category_shares(s.fact_transaction, AS_OF)


@query
def channel_features(s):
    return features.channel_features(s.fact_transaction, AS_OF)


@query
def income_features(s):
    return _steady(features.income_features(s.fact_transaction, AS_OF))


@query
def momentum_features(s):
    return features.momentum_features(s.fact_transaction, AS_OF)


@query
def balance_features(s):
    return _steady(features.balance_features(s.fact_account_monthly, s.dim_product, AS_OF))


@query
def holding_features(s):
    return features.holding_features(s.fact_account_monthly, s.dim_product, AS_OF)


def _matrix(s, columns=None):
    return features.feature_matrix(s.stored_transactions, s.fact_account_monthly, s.dim_customer, s.dim_product, AS_OF, columns)


def _stored_matrix(s):
    """The columns of the matrix that the iterative models take: stored, not recomputed by every pass."""
    return materialise(_matrix(s, SEGMENT_COLUMNS))


@query
def feature_matrix(s):
    return _steady(_matrix(s))


@query
def monthly_feature_snapshots(s):
    return _steady(features.monthly_feature_snapshots(
        s.stored_transactions, s.fact_account_monthly, s.dim_customer, s.dim_product, list(SNAPSHOT_DATES)))


# ---- profiles ---------------------------------------------------------------------------------
@query
def spend_profile(s):
    return profiles.spend_profile(s.fact_transaction, AS_OF)


@query
def channel_profile(s):
    return profiles.channel_profile(s.fact_transaction, AS_OF)


@query
def balance_profile(s):
    return _steady(profiles.balance_profile(s.fact_account_monthly, s.dim_product, AS_OF))


@query
def profile_separation_report(s):
    report = profiles.profile_separation_report(
        s.dim_customer, profiles.spend_profile(s.fact_transaction, AS_OF), profiles.channel_profile(s.fact_transaction, AS_OF),
        profiles.balance_profile(s.fact_account_monthly, s.dim_product, AS_OF))
    return rounded(report, {c: 6 for c in report.columns[2:]})


@query
def product_penetration(s):
    return profiles.product_penetration(s.fact_account_monthly, s.dim_customer, s.dim_product)


@query
def penetration_by_persona(s):
    labelled = s.dim_customer.join(s.gt_customer_persona, "customer_sk")
    return profiles.penetration_by_group(s.fact_account_monthly, labelled, s.dim_product, "persona")


# ---- quality ----------------------------------------------------------------------------------
@query
def not_null_report(s):
    return quality.not_null_report(s.tables())


@query
def unique_report(s):
    return quality.unique_report(s.tables())


@query
def fk_report(s):
    return quality.fk_report(s.tables())


@query
def rule_report(s):
    return quality.rule_report(s.tables())


def _contract_tables(s):
    """All tables under contract: the star and the stored segments of the campaign date."""
    segments = rfm.customer_rfm(s.fact_transaction, AS_OF).withColumn("snapshot_date", F.lit(AS_OF))
    return {**s.tables(), "customer_rfm_snapshot": segments}


@query
def not_null_report_damaged(s):
    return quality.not_null_report(damage.with_nulls(_contract_tables(s)))


@query
def unique_report_damaged(s):
    return quality.unique_report(damage.with_repeats(_contract_tables(s)))


@query
def fk_report_damaged(s):
    return quality.fk_report(damage.with_other_keys(_contract_tables(s)))


@query
def rule_report_damaged(s):
    return quality.rule_report(damage.with_bad_values(s.tables()))


@query
def length_report(s):
    return quality.length_report(_contract_tables(s))


@query
def length_report_damaged(s):
    return quality.length_report(damage.with_long_texts(_contract_tables(s)))


@query
def dq_suite(s):
    return quality.dq_suite(s.tables(stored=True))


@query
def reconcile_counts(s):
    source = {"fact_transaction": s.raw("lineitem"), "dim_customer": s.raw("customer"), "dim_merchant": s.raw("supplier")}
    loaded = {"fact_transaction": s.fact_transaction, "dim_customer": s.dim_customer, "dim_merchant": s.dim_merchant}
    return quality.reconcile_counts(source, loaded, {"dim_merchant": 1})


@query
def load_counts(s):
    """Rows of every table after a load against its source."""
    return PublishedStar(s.spark, scratch_path(s.spark)).load(s.tables(stored=True), ACCEPTED).counts


@query
def randomisation_check(s):
    return quality.randomisation_check(s.fact_campaign_response, s.dim_campaign)


@query
def eligibility_check(s):
    return quality.eligibility_check(s.fact_campaign_response, s.fact_account_monthly, s.dim_product, s.dim_campaign)


@query
def shares_check(s):
    """Category shares of every customer against the categories the merchants have."""
    wide = profiles.spend_profile(s.fact_transaction, AS_OF)
    long = wide.select("customer_sk", F.inline(F.array(*[
        F.struct(F.lit(c).alias("mcc_category"), F.col(f"sh_{c}").alias("share")) for c in CATEGORIES]))).where("share IS NOT NULL")
    known = s.dim_merchant.select("mcc_category").distinct()
    return rounded(quality.shares_check(long, "customer_sk", "mcc_category", "share", known), {"share_sum": 9})


@query
def truth_coverage(s):
    return quality.truth_coverage(s.dim_customer, s.gt_customer_persona)


# ---- ledger -----------------------------------------------------------------------------------
@query
def monthly_flows(s):
    flows = ledger.monthly_flows(s.fact_transaction)
    return flows.select("customer_sk", "month", F.col("inflow").cast("double").alias("inflow"), F.col("outflow").cast("double").alias("outflow"))


def _dense(s):
    return ledger.densify_months(s.dim_customer, ledger.monthly_flows(s.fact_transaction), SNAPSHOT_START, SNAPSHOT_MONTHS,
                                 ["inflow", "outflow"])


@query
def densify_months(s):
    return _dense(s).select("customer_sk", "month_idx", "month", F.col("inflow").cast("double").alias("inflow"),
                            F.col("outflow").cast("double").alias("outflow"))


def _ledger(s):
    base = F.abs(F.col("acctbal")).cast("double")
    savers = s.holdings.where("product_sk = 4").select("customer_sk", F.lit(1).alias("saver")).hint("merge")
    openings = s._customer.join(savers, "customer_sk", "left").select(
        "customer_sk", base.alias("opening_gel"), base.alias("buffer_gel"), F.coalesce("saver", F.lit(0)).alias("has_savings"),
        F.when(F.col("saver") == 1, base * 0.8).otherwise(0.0).alias("opening_savings_gel"))
    return ledger.ledger_rollforward(_dense(s), openings)


@query
def ledger_rollforward(s):
    return rounded(_ledger(s), {"current_account_gel": 6, "savings_gel": 6})


@query
def account_snapshot(s):
    """Month-end balances of every holding, with the two ledger accounts carried forward."""
    # Spark takes the months of a holding for as small as the holding, and would broadcast all of them.
    live = ledger.live_holdings(s.holdings, SNAPSHOT_START, SNAPSHOT_MONTHS).hint("merge").join(_ledger(s), ["customer_sk", "month"])
    base = F.abs(F.col("acctbal")).cast("double")
    product = F.col("product_sk")
    balance = (
        F.when(product == 1, F.col("current_account_gel")).when(product == 4, F.col("savings_gel"))
        .when(product == 5, base * 3).when(product == 6, ledger.loan_remaining(base * 36, F.col("balance_slot") % 36, F.col("month_idx")))
        .when(product == 3, -15.0 * F.col("balance_slot")).otherwise(F.lit(0.0)))
    return ledger.account_snapshot(live, balance).withColumn("balance_gel", F.col("balance_gel").cast("double"))


@query
def loan_remaining(s):
    loans = ledger.live_holdings(s.holdings.where("product_sk = 6"), SNAPSHOT_START, SNAPSHOT_MONTHS)
    left = ledger.loan_remaining(F.abs(F.col("acctbal")).cast("double") * 3, F.col("balance_slot") % 36, F.col("month_idx"))
    return loans.select("customer_sk", "month_end_date", F.round(left, 6).alias("balance_gel"))


@query
def standardize(s):
    z = ledger.standardize(s.dim_customer, ["age", "tenure_years", "existing_product_count"])
    columns = ["age_z", "tenure_years_z", "existing_product_count_z"]
    return rounded(z.select("customer_sk", *columns), dict.fromkeys(columns, 7))


# ---- campaign ---------------------------------------------------------------------------------
@query
def campaign_eligible(s):
    return campaign.campaign_eligible(s.dim_customer, s.holdings, 3).select("customer_sk")


@query
def assign_holdout(s):
    return campaign.assign_holdout(s.dim_customer.select("customer_sk"))


@query
def campaign_arms(s):
    return campaign.campaign_arms(s.fact_campaign_response)


@query
def campaign_lift(s):
    return campaign.campaign_lift(s.fact_campaign_response)


@query
def campaign_lift_report(s):
    return campaign.campaign_lift(s.fact_campaign_response, round_digits=True)


@query
def campaign_lift_by_segment(s):
    return campaign.campaign_lift_by_segment(s.fact_campaign_response, rfm.customer_rfm(s.fact_transaction, AS_OF), 1)


@query
def response_curve(s):
    return campaign.response_curve(s.fact_campaign_response, 1)


@query
def lift_by_group(s):
    return campaign.lift_by_group(s.fact_campaign_response, s.gt_customer_persona, "persona")


@query
def activation_rates(s):
    return campaign.activation_rates(s.fact_campaign_response)


@query
def truth_in_interval(s):
    out = campaign.truth_in_interval(s.fact_campaign_response, s.gt_customer_uplift).withColumn("inside", F.col("inside").cast("int"))
    return rounded(out, {c: 9 for c in ("mean_tau", "realisable_lift", "gap", "gap_in_se")})


@query
def campaign_summary(s):
    out = campaign.summary(s.fact_campaign_response, s.gt_customer_uplift)
    return rounded(out, {"true_mean_tau_treated": 9, "true_realisable_lift": 9})


@query
def value_index(s):
    spend = rfm.rfm_base(s.fact_transaction, AS_OF).select("customer_sk", "monetary_gel")
    return campaign.value_index(materialise(spend), "monetary_gel").select("customer_sk", "value_index")


# ---- every campaign at its own start ------------------------------------------------------------
@query
def rfm_by_campaign(s):
    return campaigns.rfm_by_campaign(s.fact_transaction, s.dim_campaigns)


@query
def lift_by_campaign_segment(s):
    return campaigns.lift_by_segment(s.campaign_responses, campaigns.rfm_by_campaign(s.fact_transaction, s.dim_campaigns))


@query
def response_curves(s):
    return campaigns.response_curves(s.campaign_responses)


@query
def features_by_campaign(s):
    return _steady(campaigns.features_by_campaign(
        s.stored_transactions, s.fact_account_monthly, s.dim_customer, s.dim_product, s.dim_campaigns))


@query
def spend_concentration(s):
    spend = rfm.rfm_base(s.fact_transaction, AS_OF).select("customer_sk", "monetary_gel")
    out = running.concentration(spend, "monetary_gel", "customer_sk")
    return out.withColumns({c: F.col(c).cast("double") for c in ("monetary_gel", "cumulative")})


# ---- distributions ----------------------------------------------------------------------------
def _purchases(s):
    return s.fact_transaction.where("txn_type = 'purchase'")


@query
def share_vs_expected(s):
    """Purchases by category against the share of merchants in it."""
    expected = profiling.event_mix(s.dim_merchant.where("merchant_sk <> 0"), "mcc_category").select(
        "mcc_category", F.col("share").alias("expected_share"))
    return profiling.share_vs_expected(_purchases(s), "mcc_category", expected)


@query
def event_mix(s):
    return profiling.event_mix(s.fact_transaction, "txn_type")


@query
def event_type_mix(s):
    return profiling.event_mix(s.raw("events"), "event_type")


@query
def monthly_volume(s):
    return profiling.monthly_volume(s.fact_transaction, "txn_date")


@query
def mix_crosstab(s):
    return profiling.mix_by_label(_purchases(s), s.gt_customer_persona, "persona", "channel", [c for c in CHANNELS if c != "atm"])


@query
def amount_distribution(s):
    return rounded(profiling.amount_distribution(materialise(_purchases(s).select("amount_gel")), "amount_gel"), {"median": 6, "p95": 6})


@query
def avg_ticket_by_category(s):
    return profiling.avg_ticket_by_category(s.fact_transaction)


@query
def balance_by_group(s):
    accounts = s.fact_account_monthly.where("product_sk = 1")
    return rounded(profiling.balance_by_group(accounts, s.gt_customer_persona, "persona"), {"sd": 4})


@query
def balance_path(s):
    return profiling.balance_path(s.fact_account_monthly, [1, 2, 3, 4, 5, 6])


@query
def range_by_group(s):
    return profiling.range_by_group(s.gt_customer_uplift, "archetype", ["true_p0", "true_tau"])


@query
def mean_by_group(s):
    labelled = s.gt_customer_uplift.join(s.gt_customer_persona, "customer_sk")
    return rounded(profiling.mean_by_group(labelled, "persona", ["true_tau"]), {"avg_true_tau": 9})


# ---- segmentation, uplift, evaluation -----------------------------------------------------------
@query
def clustering_agreement(s):
    """How far income bands agree with the hidden label."""
    both = s.dim_customer.join(s.gt_customer_persona, "customer_sk")
    return rounded(evaluation.clustering_agreement(both, "income_band", "persona"), {
        "adjusted_rand_index": 8, "normalized_mutual_information": 8, "purity": 8})


@query
def leak_scan(s):
    """The engagement flag follows from the income band, so its F must be infinite."""
    columns = ["age", "tenure_years", "existing_product_count", "digital_engagement_flag"]
    return rounded(evaluation.leak_scan(s.dim_customer, columns, "income_band"), {"f_statistic": 6})


@query
def leak_scan_matrix(s):
    """Every numeric column of the matrix against the income band."""
    matrix = _matrix(s)
    numbers = [f.name for f in matrix.schema if isinstance(f.dataType, NumericType) and f.name != "customer_sk"]
    return rounded(evaluation.leak_scan(matrix, numbers, "income_band"), {"f_statistic": 6})


def _scores(s):
    """A stand-in score, a function of the balance and the key."""
    noise = hash_slot(F.concat(F.col("c"), F.lit("score")), 1000)
    return s._customer.select("customer_sk", (F.col("acctbal").cast("double") / 50000 + noise / 10000.0 - 0.05).alias("score"))


def _bins(s):
    return uplift.rank_bins(materialise(_scores(s)), "score", 20)


@query
def qini_curve(s):
    return uplift.qini_curve(_bins(s), s.fact_campaign_response)


@query
def qini_area(s):
    return rounded(uplift.qini_area(uplift.qini_curve(_bins(s), s.fact_campaign_response)), {"qini_area": 8})


def _plan(s):
    return uplift.targeting_plan(_bins(s), "score", CONTACT_VALUE, CONTACT_COST)


@query
def targeting_plan(s):
    return rounded(_plan(s), {"expected_conversions": 7, "expected_profit": 6, "cumulative_profit": 6})


@query
def targeting_cutoff(s):
    return rounded(uplift.targeting_cutoff(_scores(s), "score", CONTACT_VALUE, CONTACT_COST), {"score": 9})


@query
def budget_table(s):
    out = uplift.budget_table(_plan(s), CONTACT_COST, BUDGETS)
    return rounded(out, {"expected_conversions": 7, "expected_profit_gel": 6})


@query
def choose_k(s):
    return segmentation.choose_k(_stored_matrix(s), SEGMENT_COLUMNS, [2, 3, 4, 5, 6, 7])


@query
def cluster_quality(s):
    """Cost and silhouette of the mean points of the income bands."""
    names = ["age_z", "tenure_years_z", "existing_product_count_z"]
    points = materialise(ledger.standardize(s.dim_customer, ["age", "tenure_years", "existing_product_count"]).select("income_band", *names))
    centers = rounded(points.groupBy("income_band").agg(*[F.avg(c).alias(c) for c in names]), dict.fromkeys(names, 6))
    return rounded(segmentation.cluster_quality(points, names, centers, "income_band"), {"cost": 5, "silhouette": 6})


@query
def newton_uplift(s):
    """Response models on the age alone, four steps."""
    features_ = s.dim_customer.select("customer_sk", ((F.col("age").cast("double") - 48) / 18).alias("age_z"))
    return rounded(response_model.newton_uplift(features_, s.fact_campaign_response, ["age_z"], steps=4), {"propensity": 9, "uplift": 9})


@query
def segment_customers(s):
    return segmentation.segment_customers(_stored_matrix(s), SEGMENT_COLUMNS, 6)


@query
def uplift_scores(s):
    return uplift.uplift_scores(_stored_matrix(s), s.fact_campaign_response, SEGMENT_COLUMNS)


@query
def equal_budget_by_score(s):
    """The comparison on given scores: the stand-in for the uplift, the balance for the propensity."""
    balances = s._customer.select("customer_sk", F.col("acctbal").cast("double").alias("propensity"))
    scores = _scores(s).withColumnRenamed("score", "uplift").join(balances, "customer_sk")
    return rounded(uplift.equal_budget_comparison(scores, s.fact_campaign_response, 0.3, bins=20), {"lift": 9})


@query
def equal_budget_comparison(s):
    scores = uplift.uplift_scores(_stored_matrix(s), s.fact_campaign_response, SEGMENT_COLUMNS)
    return uplift.equal_budget_comparison(scores, s.fact_campaign_response, 0.3)


