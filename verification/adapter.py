"""The star schema derived from the TPC-H-like test tables.

Every value is a function of the given rows: transactions are line items joined to their
orders, customers keep their keys, and choices the tables do not carry (which products a
customer holds, who is treated) come from an MD5 slot of the customer key.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.functions.expressions import date_key, day, hash_slot
from cohortlift.operators import campaign, dimensions, ledger
from cohortlift.schema import CATEGORIES, EMPLOYMENTS, NO_CATEGORY
from cohortlift.session import materialise

AS_OF = dt.date(2001, 1, 1)
SNAPSHOT_START = dt.date(2000, 2, 1)
SNAPSHOT_MONTHS = 12
#: All campaigns: key, start, and what sets the draws of their customers apart. The first is that of the single-campaign queries.
CAMPAIGNS = ((1, AS_OF, ""), (2, dt.date(1998, 3, 20), "k2"), (3, dt.date(1996, 11, 1), "k3"))
#: Customers of a task: each becomes up to 72 rows of the account fact, so a small customer file must not stay one task.
CUSTOMERS_PER_TASK = 20_000
HOLDING_PERCENT = {1: 100, 2: 100, 3: 20, 4: 40, 5: 20, 6: 25}
PURCHASE_CHANNEL = {
    "1-URGENT": "pos", "2-HIGH": "ecommerce", "3-MEDIUM": "mobile_app",
    "4-NOT SPECIFIED": "internet_bank", "5-LOW": "branch",
}


def _slot(key: Column, salt: str) -> Column:
    return hash_slot(F.concat(key, F.lit(salt)), 100)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


@dataclass
class TestStar:
    """The star tables over one test-data folder; each is planned once and read lazily."""

    spark: SparkSession
    sf_dir: str

    __test__ = False

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _customer(self) -> DataFrame:
        """Spread by key over tasks of bounded size; what is built from it per customer keeps that partitioning and is not shuffled again."""
        c = F.col("c_custkey").cast("string")
        raw = self.raw("customer")
        tasks = 1 + raw.count() // CUSTOMERS_PER_TASK
        return raw.select(
            F.col("c_custkey").alias("customer_sk"), c.alias("c"), F.col("c_nationkey"),
            F.col("c_acctbal").cast("decimal(14,2)").alias("acctbal")).repartition(tasks, "customer_sk")

    @cached_property
    def fact_transaction(self) -> DataFrame:
        kind = F.when(F.col("l_returnflag") != "R", "purchase").when(
            F.col("l_linestatus") == "F", "cash_withdrawal").otherwise("inflow")
        is_purchase = F.col("txn_type") == "purchase"
        by_priority = F.create_map(*[F.lit(v) for pair in PURCHASE_CHANNEL.items() for v in pair])
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_suppkey", kind.alias("txn_type"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("amount_gel"))
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_sk"),
            F.col("o_orderdate").cast("date").alias("txn_date"), "o_orderpriority")
        return lines.join(orders, "l_orderkey").select(
            "customer_sk", date_key(F.col("txn_date")).alias("date_sk"),
            F.when(is_purchase, F.col("l_suppkey") + 1).otherwise(F.lit(0)).alias("merchant_sk"),
            "txn_date", "txn_type",
            F.when(F.col("txn_type") == "inflow", "credit").otherwise("debit").alias("direction"),
            F.when(is_purchase, F.element_at(by_priority, F.col("o_orderpriority")))
            .when(F.col("txn_type") == "cash_withdrawal", "atm").otherwise("transfer").alias("channel"),
            F.when(is_purchase, _pick(CATEGORIES, F.col("l_suppkey") % 10)).otherwise(NO_CATEGORY).alias("mcc_category"),
            "amount_gel")

    @cached_property
    def stored_transactions(self) -> DataFrame:
        """The transaction fact for queries that scan it several times: joined from the test tables once, then stored."""
        return materialise(self.fact_transaction)

    @cached_property
    def holdings(self) -> DataFrame:
        """One row per customer and held product, with the month it was opened (-1: before)."""
        rates = F.array(*[F.struct(F.lit(k).cast("long").alias("product_sk"), F.lit(p).alias("pct"))
                          for k, p in HOLDING_PERCENT.items()])
        cp = F.concat_ws("-", F.col("c"), F.col("product_sk").cast("string"))
        pairs = self._customer.select("customer_sk", "c", "acctbal", F.inline(rates)).withColumn("cp", cp)
        opened = F.when((F.col("product_sk") <= 2) | (_slot(F.col("cp"), "o") < 85), F.lit(-1).cast("long")).otherwise(
            _slot(F.col("cp"), "m") % 11 + 1)
        return pairs.where(_slot(F.col("cp"), "h") < F.col("pct")).select(
            "customer_sk", "c", "cp", "acctbal", "product_sk", opened.cast("int").alias("open_month_idx"),
            _slot(F.col("cp"), "b").alias("balance_slot"))

    @cached_property
    def fact_account_monthly(self) -> DataFrame:
        product = F.col("product_sk")
        wobble = hash_slot(F.concat(F.col("c"), F.lit("b"), F.col("month_idx").cast("string")), 100)
        balance = (
            F.when(product == 1, F.col("acctbal") + 20 * (wobble - 50))
            .when(product == 2, F.lit(0))
            .when(product == 3, -15 * F.col("balance_slot"))
            .when(product == 4, 8 * F.abs("acctbal"))
            .when(product == 5, 25 * F.abs("acctbal"))
            .otherwise(-90 * F.col("balance_slot")))
        live = ledger.live_holdings(self.holdings, SNAPSHOT_START, SNAPSHOT_MONTHS)
        return ledger.account_snapshot(live, balance)

    @cached_property
    def fact_campaign_response(self) -> DataFrame:
        return self._responses(1, AS_OF, "")

    @cached_property
    def campaign_responses(self) -> DataFrame:
        """The responses to all campaigns."""
        return reduce(DataFrame.unionByName, [self._responses(*c) for c in CAMPAIGNS])

    @cached_property
    def dim_campaigns(self) -> DataFrame:
        """All campaigns, each with its own start."""
        return reduce(DataFrame.unionByName, [
            dimensions.campaign_dim(self.dim_product, start, f"Campaign {sk}", "mobile_app", campaign_sk=sk) for sk, start, _ in CAMPAIGNS])

    def _responses(self, campaign_sk: int, start: dt.date, salt: str) -> DataFrame:
        eligible = campaign.campaign_eligible(self._customer, self.holdings, target_product_sk=3)
        c = F.col("c")
        treated = _slot(c, f"arm{salt}") < 70
        responded = _slot(c, f"resp{salt}") < F.when(treated, 32).otherwise(22)
        base = eligible.select(
            "customer_sk", F.lit(campaign_sk).cast("long").alias("campaign_sk"),
            F.when(treated, "treatment").otherwise("control").alias("assignment"),
            treated.cast("int").alias("contacted"),
            F.when(treated, F.date_add(day(start), (_slot(c, "c") % 10).cast("int"))).alias("contact_date"),
            responded.cast("int").alias("responded"), "c")
        waited = F.date_add("contact_date", (_slot(c, f"d{salt}") % 60 + 1).cast("int"))
        organic = F.date_add(day(start), (_slot(c, "g") % 70).cast("int"))
        hit = F.col("responded") == 1
        dated = base.withColumn("response_date", F.when(hit, F.coalesce(waited, organic)))
        return dated.select(
            "customer_sk", "campaign_sk", "assignment", "contacted", "contact_date",
            date_key(F.col("contact_date")).alias("contact_date_sk"), "responded", "response_date",
            date_key(F.col("response_date")).alias("response_date_sk"),
            (hit | (_slot(c, "dorm") < 4)).cast("int").alias("card_opened"),
            F.col("responded").alias("activated"),
            F.when(hit, 100 + 3 * _slot(c, "v")).otherwise(0).cast("decimal(12,2)").alias("annual_value_gel"),
            F.when(F.col("contacted") == 1, F.lit(2.5)).otherwise(F.lit(0.0)).cast("decimal(8,2)").alias("contact_cost_gel"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        c, bal = F.col("c"), F.col("acctbal")
        held = self.holdings.groupBy("customer_sk").agg(F.count(F.lit(1)).cast("int").alias("existing_product_count"))
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
        tenure = (_slot(c, "ten") % 30).cast("int")
        return self._customer.join(nation, "c_nationkey").join(held, "customer_sk", "left").select(
            "customer_sk", (18 + _slot(c, "age") % 60).cast("int").alias("age"),
            F.when(_slot(c, "sex") % 2 == 0, "F").otherwise("M").alias("gender"), "city",
            F.when(bal < 0, "low").when(bal < 3000, "low_mid").when(bal < 7000, "mid").otherwise("high").alias("income_band"),
            _pick(EMPLOYMENTS, _slot(c, "emp") % 4).alias("employment"), tenure.alias("tenure_years"),
            F.add_months(day(AS_OF), -12 * tenure).alias("relationship_start_date"),
            F.coalesce("existing_product_count", F.lit(0)).alias("existing_product_count"),
            (bal >= 3000).cast("int").alias("digital_engagement_flag"))

    @cached_property
    def dim_merchant(self) -> DataFrame:
        category = _pick(CATEGORIES, F.col("s_suppkey") % 10)
        merchants = self.raw("supplier").select(
            (F.col("s_suppkey") + 1).alias("merchant_sk"),
            dimensions.merchant_label(category, F.floor(F.col("s_suppkey") / 10) + 1).alias("merchant_name"),
            dimensions.mcc_code(category).alias("mcc_code"), category.alias("mcc_category"))
        return merchants.unionByName(dimensions.no_merchant(self.spark))

    @cached_property
    def dim_date(self) -> DataFrame:
        """Whole years around the order dates, plus a month of tail, and the Unknown member."""
        span = self.raw("orders").agg(
            F.trunc(F.min(F.col("o_orderdate").cast("date")), "year").alias("first"),
            F.date_sub(F.add_months(F.trunc(F.max(F.col("o_orderdate").cast("date")), "year"), 12), 1).alias("last"))
        return dimensions.with_unknown_date(dimensions.calendar(span, "first", "last"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.product_dim(self.spark)

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return dimensions.campaign_dim(self.dim_product, AS_OF, "Credit Card Cross-Sell", "mobile_app")

    @cached_property
    def gt_customer_persona(self) -> DataFrame:
        """Evaluation only: the market segment plays the hidden label."""
        return self.raw("customer").select(F.col("c_custkey").alias("customer_sk"), F.lower("c_mktsegment").alias("persona"))

    @cached_property
    def gt_customer_uplift(self) -> DataFrame:
        """Evaluation only: baseline and effect; some effects push the probability past 0 or 1."""
        kind = _slot(F.col("c"), "type") % 4
        p0 = _pick_double((0.10, 0.97, 0.04, 0.08), kind)
        tau = _pick_double((0.24, 0.06, 0.02, -0.12), kind)
        return self._customer.select(
            "customer_sk", _pick(("persuadable", "sure_thing", "lost_cause", "sleeping_dog"), kind).alias("archetype"),
            p0.alias("true_p0"), tau.alias("true_tau"),
            F.least(F.greatest(p0 + tau, F.lit(0.0)), F.lit(1.0)).alias("true_p1"))

    def tables(self, stored: bool = False) -> dict[str, DataFrame]:
        """All star tables by name; ``stored`` takes the transaction fact from its stored form."""
        names = ("dim_date", "dim_customer", "dim_product", "dim_merchant", "dim_campaign",
                 "fact_transaction", "fact_account_monthly", "fact_campaign_response")
        found = {name: getattr(self, name) for name in names}
        return {**found, "fact_transaction": self.stored_transactions} if stored else found


def _pick_double(values: tuple[float, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))
