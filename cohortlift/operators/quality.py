"""Contract checks and the data-quality report.

Every check is counted over whole tables. Before any join the fact is reduced to distinct keys
with row counts, so a key that owns a large share of the rows crosses the join once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.schema import KEYS, LABEL_DERIVED_COLUMNS, LENGTHS, REFERENCES, RULES, SEALED_COLUMNS, TABLES, Key, Reference, Rule

BALANCE_FLOOR = -500
SHARE_TOLERANCE = 0.02
SUM_TOLERANCE = 1e-6


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _status(violations: Column) -> Column:
    return F.when(violations == 0, "PASS").otherwise("FAIL")


def _one_pass(df: DataFrame, table: str, kind: str, failed: dict[str, Column]) -> DataFrame:
    """One row per named condition with the number of rows that meet it, from one scan."""
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(failed.values())])
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("rule"),
                 F.col(f"c{i}").alias("violations")) for i, name in enumerate(failed)])
    return counts.select(F.inline(rows))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Missing values per column, in one pass."""
    return _one_pass(df, table, "not_null", {c: F.col(c).isNull() for c in columns})


def check_unique(df: DataFrame, key: Key) -> DataFrame:
    """Key values that occur more than once; rows with a missing key part are not compared."""
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key.columns]))
    groups = present.groupBy(*key.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(key.table).alias("table_name"), F.lit(key.kind).alias("kind"),
        F.lit(", ".join(key.columns)).alias("rule"), "violations")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values of ``child`` unknown to ``parent``, with their row counts."""
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(parent_column)).agg(F.count(F.lit(1)).alias("n"))
    return used.join(parent.select(parent_column), parent_column, "left_anti")


def check_fk(child: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """Rows whose key the parent does not have."""
    orphans = orphan_rows(child, ref.column, parent, ref.parent_column)
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("violations")).select(
        F.lit(ref.table).alias("table_name"), F.lit("foreign").alias("kind"),
        F.lit(f"{ref.column} -> {ref.parent}").alias("rule"), "violations")


def check_expr(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Rows that break each rule, in one pass. A rule that is unknown (NULL) is not broken."""
    return _one_pass(df, table, "check", {r.name: ~F.expr(r.predicate) for r in rules})


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        check_not_null(df, t, [f.name for f in TABLES[t] if not f.nullable]) for t, df in tables.items()])


def unique_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([check_unique(tables[k.table], k) for k in KEYS if k.table in tables])


def fk_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphaned rows of every declared reference.

    Each child is scanned once: all its key columns are counted together, as (reference, key)
    pairs that combine on the map side, and the counts meet the parents' keys in one anti join.
    """
    refs = [r for r in REFERENCES if r.table in tables and r.parent in tables]

    def keys(table: str, pick: dict[int, str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(i).alias("ref"), F.col(c).cast("long").alias("key")) for i, c in pick.items()])
        return tables[table].select(F.inline(pairs))

    def by(side: str, column: str) -> DataFrame:
        picks: dict[str, dict[int, str]] = {}
        for i, r in enumerate(refs):
            picks.setdefault(getattr(r, side), {})[i] = getattr(r, column)
        return _union([keys(t, pick) for t, pick in picks.items()])

    used = by("table", "column").where("key IS NOT NULL").groupBy("ref", "key").agg(F.count(F.lit(1)).alias("n"))
    # Spark takes the keys of all parents for as small as their files, and would broadcast them through the driver.
    orphans = used.join(by("parent", "parent_column").hint("merge"), ["ref", "key"], "left_anti").groupBy("ref").agg(F.sum("n").alias("violations"))
    named = F.array(*[
        F.struct(F.lit(i).alias("ref"), F.lit(r.table).alias("table_name"), F.lit(f"{r.column} -> {r.parent}").alias("rule"))
        for i, r in enumerate(refs)])
    listed = used.sparkSession.range(1).select(F.inline(named))
    return listed.join(orphans, "ref", "left").select(
        "table_name", F.lit("foreign").alias("kind"), "rule", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def rule_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([check_expr(df, t, [r for r in RULES if r.table == t])
                   for t, df in tables.items() if any(r.table == t for r in RULES)])


def length_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Texts longer than the contract allows, in characters, not bytes; a missing text is not too long."""
    return _union([_one_pass(df, t, "length", {c: F.char_length(c) > n for c, n in LENGTHS[t].items()})
                   for t, df in tables.items() if t in LENGTHS])


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint with its violations: one scan per table for row rules, one reduction per key."""
    rows = _union([not_null_report(tables), unique_report(tables), fk_report(tables), rule_report(tables)])
    return rows.withColumn("status", _status(F.col("violations")))


def reconcile_counts(source: dict[str, DataFrame], loaded: dict[str, DataFrame],
                     seeded: dict[str, int] | None = None) -> DataFrame:
    """Rows of each loaded table against its source plus the members seeded on load."""
    seeded = seeded or {}

    def counts(tables: dict[str, DataFrame], out: str, extra: dict[str, int]) -> DataFrame:
        return _union([df.agg((F.count(F.lit(1)) + extra.get(t, 0)).alias(out)).withColumn("table_name", F.lit(t))
                       for t, df in tables.items()])

    both = counts(source, "expected_rows", seeded).join(counts(loaded, "loaded_rows", {}), "table_name", "full")
    return both.select(
        "table_name", F.coalesce("expected_rows", F.lit(0).cast("long")).alias("expected_rows"),
        F.coalesce("loaded_rows", F.lit(0).cast("long")).alias("loaded_rows"),
    ).withColumn("status", F.when(F.col("expected_rows") == F.col("loaded_rows"), "ok").otherwise("MISMATCH"))


def randomisation_check(responses: DataFrame, campaigns: DataFrame, tolerance: float = SHARE_TOLERANCE) -> DataFrame:
    """Realised against configured treatment share, per campaign."""
    arms = responses.groupBy("campaign_sk").agg(
        (F.count_if(F.col("assignment") == "treatment").cast("double") / F.count(F.lit(1))).alias("treated_share"))
    out = arms.join(campaigns.select("campaign_sk", F.col("treatment_share").cast("double").alias("target_share")), "campaign_sk")
    return out.withColumn("off_target", (F.abs(F.col("treated_share") - F.col("target_share")) > tolerance).cast("int"))


def first_held(snapshot: DataFrame, products: DataFrame, product_name: str) -> DataFrame:
    """First month end at which each customer held the product: one row per holder."""
    wanted = products.where(F.col("product_name") == product_name).select("product_sk").scalar()
    return snapshot.where(F.col("product_sk") == wanted).groupBy("customer_sk").agg(F.min("month_end_date").alias("first_held"))


def eligibility_check(responses: DataFrame, snapshot: DataFrame, products: DataFrame, campaigns: DataFrame,
                      product_name: str = "Credit Card") -> DataFrame:
    """Non-responders who already held the target product: before the start, and at any time.

    Holding months are reduced to the first per customer, so the existence test is an equality
    join and a date comparison.
    """
    silent = responses.where(F.col("responded") == 0).join(campaigns.select("campaign_sk", "start_date"), "campaign_sk")
    held = silent.join(first_held(snapshot, products, product_name).hint("merge"), "customer_sk")
    return held.agg(
        F.count_if(F.col("first_held") < F.col("start_date")).alias("held_before_start"),
        F.count(F.lit(1)).alias("held_at_any_time"))


def leak_gate(tables: dict[str, DataFrame], forbidden=SEALED_COLUMNS) -> list[str]:
    """Sealed label columns found in observable tables; reads schemas only."""
    return [f"{t}.{c}" for t, df in tables.items() for c in df.columns if c.lower() in forbidden]


def model_columns(df: DataFrame) -> DataFrame:
    """``df`` without sealed columns and columns derived from them."""
    return df.drop(*SEALED_COLUMNS, *LABEL_DERIVED_COLUMNS)


def shares_check(shares: DataFrame, group: str, member: str, share: str, known: DataFrame | None = None,
                 tolerance: float = SUM_TOLERANCE) -> DataFrame:
    """Per group: whether the shares sum to 1, and how many members ``known`` does not list."""
    sums = shares.groupBy(group).agg(F.sum(share).alias("share_sum"))
    if known is not None:
        unknown = shares.join(known.select(member), member, "left_anti").groupBy(group).agg(F.count(F.lit(1)).alias("unknown_members"))
        sums = sums.join(unknown, group, "left").na.fill({"unknown_members": 0})
    else:
        sums = sums.withColumn("unknown_members", F.lit(0).cast("long"))
    ok = (F.abs(F.col("share_sum") - 1) <= tolerance) & (F.col("unknown_members") == 0)
    return sums.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def truth_coverage(customers: DataFrame, sealed: DataFrame) -> DataFrame:
    """Whether a sealed table has exactly one row per customer."""
    per = sealed.groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"))
    return customers.select("customer_sk").withColumn("known", F.lit(1)).join(per, "customer_sk", "full").agg(
        F.count_if(F.col("n").isNull()).alias("without_label"),
        F.count_if(F.col("n") > 1).alias("repeated_label"),
        F.count_if(F.col("known").isNull()).alias("unknown_customer"))


def dq_suite(tables: dict[str, DataFrame], current_account: str = "Current Account",
             target_product: str = "Credit Card") -> DataFrame:
    """The ten cross-table checks as one report, errors first."""
    txn, balances = tables["fact_transaction"], tables["fact_account_monthly"]
    responses, campaigns, products = tables["fact_campaign_response"], tables["dim_campaign"], tables["dim_product"]

    def count_of(df: DataFrame, measure: Column | None = None) -> DataFrame:
        return df.agg((F.count(F.lit(1)) if measure is None else measure).cast("long").alias("violations"))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("long"))

    def row_checks(df: DataFrame, named: dict[str, Column]) -> DataFrame:
        return _one_pass(df, "", "", named).select(F.col("rule").alias("check_name"), F.lit("ERROR").alias("severity"), "violations")

    holds_any = txn.select("customer_sk").distinct()
    by_merchant = txn.groupBy("merchant_sk", "mcc_category").agg(F.count(F.lit(1)).alias("n"))
    merchants = tables["dim_merchant"].select("merchant_sk", F.col("mcc_category").alias("dim_category"))
    account = products.where(F.col("product_name") == current_account).select("product_sk").scalar()
    off_target = randomisation_check(responses, campaigns)

    reports = [
        row_checks(txn, {
            "negative_transaction_amounts": F.col("amount_gel") < 0,
            "non_purchase_with_merchant": (F.col("txn_type") != "purchase") & (F.col("merchant_sk") != 0)}),
        row_checks(responses, {
            "control_customers_contacted": (F.col("assignment") == "control") & ((F.col("contacted") == 1) | F.col("contact_date").isNotNull()),
            "revenue_without_response": (F.col("responded") == 0) & (F.col("annual_value_gel") != 0)}),
    ]
    singles = [
        ("customers_without_transactions", "ERROR",
         count_of(tables["dim_customer"].join(holds_any, "customer_sk", "left_anti"))),
        ("category_disagrees_with_merchant", "ERROR",
         count_of(by_merchant.join(merchants.hint("merge"), "merchant_sk").where("mcc_category <> dim_category"), total(F.col("n")))),
        ("campaign_targeted_existing_cardholders", "ERROR",
         eligibility_check(responses, balances, products, campaigns, target_product).select(F.col("held_before_start").alias("violations"))),
        ("transactions_outside_window", "ERROR",
         count_of(orphan_rows(txn, "date_sk", tables["dim_date"], "date_sk"), total(F.col("n")))),
        ("current_accounts_below_floor", "WARNING",
         count_of(balances.where((F.col("product_sk") == account) & (F.col("balance_gel") < BALANCE_FLOOR)))),
        ("treatment_share_off_target", "WARNING", count_of(off_target, total(F.col("off_target").cast("long")))),
    ]
    reports += [df.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "violations")
                for name, severity, df in singles]
    return _union(reports).withColumn("status", _status(F.col("violations"))).orderBy(
        F.when(F.col("severity") == "ERROR", 1).otherwise(2), F.desc("violations"), "check_name")
