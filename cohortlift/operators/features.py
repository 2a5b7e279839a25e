"""Point-in-time customer features: one block of columns per aspect of behaviour.

The blocks over the transaction fact are lists of additive measures, so ``customer_totals``
computes any set of them in one scan and one shuffle on the customer. Sums combine on the map
side: a customer who owns a large part of the fact is reduced where its rows are read and never
gathered. Amounts are summed as whole minor units in longs, which is exact, independent of the
partitioning and stays in generated code. What needs a finer grain first (months, merchants) is
reduced to that grain and then counted; medians come from counts per amount.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.expressions import DateLike, before, day, exact_mean, floored_ratio, month_start, sum_if
from cohortlift.schema import CATEGORIES, CHANNELS, DIGITAL_CHANNELS, LABEL_DERIVED_COLUMNS

KEY = "customer_sk"
RECENT_MONTHS = 3
CUSTOMER_COLUMNS = ("age", "tenure_years", "existing_product_count", "income_band", "employment", "city")
WEEKEND = (1, 7)  # Spark's dayofweek: Sunday, Saturday


# Fact rows by kind, and amounts as whole minor units, as SQL expressions.
PURCHASE = "txn_type = 'purchase'"
DEBIT = "direction = 'debit'"
INFLOW = "txn_type = 'inflow'"
CASH = f"{DEBIT} AND txn_type = 'cash_withdrawal'"
CENTS = "CAST(amount_gel * 100 AS BIGINT)"


def _gel(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100D"


def _cents_if(condition: str) -> str:
    """Sum of the amounts where ``condition`` holds, in minor units; 0 if there is none."""
    return f"sum(CASE WHEN {condition} THEN {CENTS} ELSE 0L END)"


def _ratio(numerator: str, denominator: str) -> str:
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def _floored(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / greatest(CAST({denominator} AS DOUBLE), 1D)"


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(n) for n, e in expressions.items()]


@dataclass(frozen=True)
class Block:
    """Features over the fact rows of one kind, as SQL expressions.

    ``measures`` are aggregates per customer, each restricted to the rows of its kind, so blocks
    can share a scan. ``columns`` turns them into features. ``present`` names the measure that
    counts the block's rows.
    """

    rows: str
    measures: dict[str, str]
    columns: dict[str, str]
    present: str


def purchase_block(as_of: DateLike) -> Block:
    return Block(
        rows=PURCHASE,
        measures={
            "p_n": f"count_if({PURCHASE})", "p_sum": _cents_if(PURCHASE),
            "p_max": f"max(CASE WHEN {PURCHASE} THEN {CENTS} END)",
            "p_sd": f"stddev_samp(CASE WHEN {PURCHASE} THEN CAST(amount_gel AS DOUBLE) END)",
            "p_last": f"max(CASE WHEN {PURCHASE} THEN txn_date END)",
            "p_weekend": f"count_if({PURCHASE} AND dayofweek(txn_date) IN {WEEKEND})",
        },
        columns={
            "recency_days": f"datediff(DATE '{as_of}', p_last)",
            "purchase_count": "p_n",
            "total_spend_gel": _gel("p_sum"),
            "avg_ticket_gel": _ratio(_gel("p_sum"), "p_n"),
            "ticket_volatility_gel": "p_sd",
            "max_ticket_gel": _gel("p_max"),
            "weekend_txn_share": _ratio("p_weekend", "p_n"),
        },
        present="p_n")


def _share(amount: str, listed: str) -> str:
    """Share in the total of the listed values; 0 when that total is 0."""
    return f"CASE WHEN {listed} > 0 THEN {_ratio(amount, listed)} ELSE 0D END"


def category_block() -> Block:
    listed = "(" + " + ".join(f"cat_{c}" for c in CATEGORIES) + ")"
    return Block(
        rows=PURCHASE,
        measures={**{f"cat_{c}": _cents_if(f"{PURCHASE} AND mcc_category = '{c}'") for c in CATEGORIES},
                  "cat_rows": f"count_if({PURCHASE})"},
        columns={f"sh_{c}": _share(f"cat_{c}", listed) for c in CATEGORIES},
        present="cat_rows")


def channel_block() -> Block:
    listed = "(" + " + ".join(f"chan_{c}" for c in CHANNELS) + ")"
    digital = "(" + " + ".join(f"chan_{c}" for c in DIGITAL_CHANNELS) + ")"
    return Block(
        rows=DEBIT,
        measures={
            **{f"chan_{c}": _cents_if(f"{DEBIT} AND channel = '{c}'") for c in CHANNELS},
            "cash_n": f"count_if({CASH})", "cash_sum": _cents_if(CASH), "debit_rows": f"count_if({DEBIT})"},
        columns={
            **{f"ch_{c}": _share(f"chan_{c}", listed) for c in CHANNELS},
            "digital_value_share": _share(digital, listed),
            "cash_value_share": _share("chan_atm", listed),
            "withdrawal_count": "cash_n",
            "avg_withdrawal_gel": f"coalesce({_ratio(_gel('cash_sum'), 'cash_n')}, 0D)"},
        present="debit_rows")


def momentum_block(as_of: DateLike) -> Block:
    recent = f"add_months(DATE '{as_of}', {-RECENT_MONTHS})"
    prior = f"add_months(DATE '{as_of}', {-2 * RECENT_MONTHS})"
    in_recent = f"{PURCHASE} AND txn_date >= {recent}"
    in_prior = f"{PURCHASE} AND txn_date >= {prior} AND txn_date < {recent}"
    return Block(
        rows=PURCHASE,
        measures={"recent_sum": _cents_if(in_recent), "prior_sum": _cents_if(in_prior),
                  "recent_n": f"count_if({in_recent})", "mom_rows": f"count_if({PURCHASE})"},
        columns={
            "spend_last_3m": _gel("recent_sum"), "spend_prior_3m": _gel("prior_sum"), "txns_last_3m": "recent_n",
            "spend_momentum": _floored(_gel("(recent_sum - prior_sum)"), _gel("prior_sum"))},
        present="mom_rows")


def customer_totals(txn: DataFrame, as_of: DateLike, blocks: list[Block]) -> DataFrame:
    """The measures of all ``blocks`` per customer, from one scan of the fact."""
    measures = {n: c for b in blocks for n, c in b.measures.items()}
    rows = " OR ".join(f"({r})" for r in dict.fromkeys(b.rows for b in blocks))
    return before(txn, "txn_date", as_of).where(rows).groupBy(KEY).agg(*_named(measures))


def block_columns(block: Block) -> list[Column]:
    """The features of a block; NULL where the customer has no row of it."""
    return _named({n: f"CASE WHEN {block.present} > 0 THEN {c} END" for n, c in block.columns.items()})


def _one_block(txn: DataFrame, as_of: DateLike, block: Block) -> DataFrame:
    return customer_totals(txn, as_of, [block]).select(KEY, *block_columns(block))


def medians_at(txn: DataFrame, dates: list[str]) -> DataFrame:
    """(as_of, customer, median_ticket_gel): the median purchase amount before each date; the lower one of two in the middle.

    Purchases are counted per customer and amount, a column per date, before anything is shuffled; counts add up, so parts of the fact merge
    exactly. Running counts over the amounts of a customer then show where half is reached. What meets in a task for one customer is
    bounded by the different amounts, not by the purchases.
    """
    held = range(len(dates))
    counts = before(txn, "txn_date", max(dates)).where(PURCHASE).groupBy(KEY, F.expr(CENTS).alias("cents")).agg(
        *[F.count_if(F.col("txn_date") < day(d)).alias(f"n{i}") for i, d in enumerate(dates)])
    of_customer = Window.partitionBy(KEY)
    upto = of_customer.orderBy("cents").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.select(
        KEY, "cents", *[F.sum(f"n{i}").over(upto).alias(f"upto{i}") for i in held], *[F.sum(f"n{i}").over(of_customer).alias(f"all{i}") for i in held])
    half = placed.groupBy(KEY).agg(*[
        F.min(F.when((F.col(f"all{i}") > 0) & (2 * F.col(f"upto{i}") >= F.col(f"all{i}")), F.col("cents"))).alias(f"m{i}") for i in held])
    listed = F.array(*[F.struct(day(d).alias("as_of"), (F.col(f"m{i}").cast("double") / 100).alias("median_ticket_gel")) for i, d in enumerate(dates)])
    return half.select(KEY, F.inline(listed)).where("median_ticket_gel IS NOT NULL")


def median_ticket(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Median purchase amount per customer, exact at any number of purchases."""
    return medians_at(txn, [str(as_of)]).drop("as_of")


def distinct_merchants(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Merchants each customer bought from: pairs are deduplicated first, then counted."""
    pairs = before(txn, "txn_date", as_of).where(PURCHASE).select(KEY, "merchant_sk").distinct()
    return pairs.groupBy(KEY).agg(F.count("merchant_sk").alias("distinct_merchants"))


INCOME_COLUMNS = ("avg_monthly_inflow_gel", "inflow_volatility_gel", "months_with_inflow",
                  "min_monthly_inflow_gel", "inflow_cv")


# Over one row per month with p_n purchases and the inflow in minor units.
MONTHLY = {
    "active_months": "count_if(p_n > 0)",
    "avg_monthly_inflow_gel": _ratio(_gel("sum(inflow)"), "count(inflow)"),
    "inflow_volatility_gel": f"stddev_samp({_gel('inflow')})",
    "months_with_inflow": "nullif(count(inflow), 0L)",
    "min_monthly_inflow_gel": _gel("min(inflow)"),
}
INFLOW_CV = ("CASE WHEN months_with_inflow > 0 THEN "
             + _floored("coalesce(inflow_volatility_gel, 0D)", "avg_monthly_inflow_gel") + " END")


def monthly_pattern(txn: DataFrame, as_of: DateLike, rows: str) -> DataFrame:
    """Months with a purchase, and level and regularity of the monthly inflow, per customer."""
    months = before(txn, "txn_date", as_of).where(rows).groupBy(KEY, month_start(F.col("txn_date")).alias("month")).agg(*_named({
        "p_n": f"count_if({PURCHASE})",
        # NULL in a month without any inflow, so that such a month counts in no statistic.
        "inflow": f"sum(CASE WHEN {INFLOW} THEN {CENTS} END)"}))
    return months.groupBy(KEY).agg(*_named(MONTHLY)).withColumn("inflow_cv", F.expr(INFLOW_CV))


TRANSACTION_COLUMNS = (
    "recency_days", "purchase_count", "total_spend_gel", "avg_ticket_gel", "ticket_volatility_gel", "median_ticket_gel",
    "max_ticket_gel", "distinct_merchants", "active_months", "weekend_txn_share", "purchases_per_active_month")
PER_ACTIVE_MONTH = _floored("purchase_count", "active_months")


def transaction_features(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Recency, volume, ticket size, breadth and timing of the purchases."""
    return (
        _one_block(txn, as_of, purchase_block(as_of))
        .join(monthly_pattern(txn, as_of, PURCHASE).select(KEY, "active_months"), KEY)
        .join(median_ticket(txn, as_of), KEY).join(distinct_merchants(txn, as_of), KEY)
        .withColumn("purchases_per_active_month", F.expr(PER_ACTIVE_MONTH))
        .select(KEY, *TRANSACTION_COLUMNS))


def category_shares(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Share of purchase spend by listed category."""
    return _one_block(txn, as_of, category_block())


def channel_features(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Value shares of the debit channels, digital and cash intensity, withdrawals."""
    return _one_block(txn, as_of, channel_block())


def income_features(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Level and regularity of the monthly inflow."""
    return monthly_pattern(txn, as_of, INFLOW).select(KEY, *INCOME_COLUMNS)


def momentum_features(txn: DataFrame, as_of: DateLike) -> DataFrame:
    """Spend of the last three months against the three before."""
    return _one_block(txn, as_of, momentum_block(as_of))


def product_balances(snapshot: DataFrame, products: DataFrame, product_name: str, as_of: DateLike) -> DataFrame:
    """Snapshot rows of one product, by its unique name, dated before ``as_of``.

    The key is a scalar subquery: its value reaches the scan as a filter and no join is needed.
    """
    wanted = products.where(F.col("product_name") == product_name).select("product_sk").scalar()
    return before(snapshot, "month_end_date", as_of).where(F.col("product_sk") == wanted)


def balance_history(balances: DataFrame, *by: str) -> DataFrame:
    """Level, spread, extremes and drift of each customer's month-end balances, also ``by`` other columns.

    First and last month come from ``min_by`` / ``max_by``, which need no sort.
    """
    gel, end = F.col("balance_gel"), "month_end_date"
    return balances.groupBy(*by, KEY).agg(
        exact_mean(gel).alias("avg_balance_gel"),
        F.stddev_samp(gel.cast("double")).alias("balance_volatility_gel"),
        F.min(gel).cast("double").alias("min_balance_gel"), F.max(gel).cast("double").alias("max_balance_gel"),
        F.count_if(gel < 0).alias("months_negative"),
        (F.max_by(gel, end) - F.min_by(gel, end)).cast("double").alias("balance_trend_gel"))


def balance_features(snapshot: DataFrame, products: DataFrame, as_of: DateLike) -> DataFrame:
    """Current-account behaviour; the coefficient of variation has a floor of 1 under the mean."""
    history = balance_history(product_balances(snapshot, products, "Current Account", as_of))
    return history.withColumn("balance_cv", _balance_cv())


def _balance_cv() -> Column:
    return floored_ratio(F.coalesce("balance_volatility_gel", F.lit(0.0)), F.abs("avg_balance_gel"))


HOLDING_FLAGS = {
    "has_savings": "Savings Account", "has_term_deposit": "Term Deposit",
    "has_loan": "Consumer Loan", "has_credit_card": "Credit Card",
}


def holding_features(snapshot: DataFrame, products: DataFrame, as_of: DateLike) -> DataFrame:
    """Products held and what they are worth at the last snapshot before ``as_of``."""
    past = before(snapshot, "month_end_date", as_of)
    latest = past.agg(F.max("month_end_date")).scalar()
    return _holdings(past.where(F.col("month_end_date") == latest), products)


def _holdings(snapshot: DataFrame, products: DataFrame, *by: str) -> DataFrame:
    held = snapshot.join(products.select("product_sk", "product_name"), "product_sk")
    gel = F.col("balance_gel")
    return held.groupBy(*by, KEY).agg(
        *[F.max((F.col("product_name") == name).cast("int")).alias(flag) for flag, name in HOLDING_FLAGS.items()],
        F.count(F.lit(1)).alias("products_held"),
        sum_if(gel > 0, gel).cast("double").alias("total_assets_gel"),
        F.abs(sum_if(gel < 0, gel)).cast("double").alias("total_liabilities_gel"))


def feature_matrix(txn: DataFrame, snapshot: DataFrame, customers: DataFrame, products: DataFrame,
                   as_of: DateLike, columns: list[str] | None = None) -> DataFrame:
    """One numeric row per customer: every block joined to the customer, missing numbers 0.

    Three scans of the fact: one for all totals and months, rolled up to customers and months first, and one each for the median and
    the merchants, which read only the columns they need. All parts end grouped by the customer, so the joins reuse that
    partitioning. Columns derived from a sealed label are never taken. With ``columns`` the matrix has the key and these columns
    alone; a part that gives none of them is not computed.
    """
    out = customers.select(KEY, *[c for c in CUSTOMER_COLUMNS if c not in LABEL_DERIVED_COLUMNS])
    totals = _totals_at(txn, [str(as_of)]).drop("as_of").withColumn("purchases_per_active_month", F.expr(PER_ACTIVE_MONTH))
    parts = (totals, median_ticket(txn, as_of), distinct_merchants(txn, as_of),
             balance_features(snapshot, products, as_of), holding_features(snapshot, products, as_of))
    for part in parts:
        if columns is None or set(part.columns) & set(columns):
            out = out.join(part, KEY, "left")
    last = "purchases_per_active_month"
    named = [c for c in out.columns if c != last] + [last] if columns is None else [KEY, *columns]
    return out.select(*named).na.fill(0)


def _merged(measures: list[str]) -> dict[str, str]:
    """How the measures of periods combine: dates and extremes by the extreme, everything else by its sum."""
    extreme = {"p_max": "max", "p_min": "min", "p_last": "max"}
    return {m: f"{extreme.get(m, 'sum')}({m})" for m in measures}


def _later(dates: list[str], column: str) -> Column:
    """A row for each of the dates after ``column``."""
    return F.explode(F.filter(F.array(*[day(d) for d in dates]), lambda d: d > F.col(column))).alias("as_of")


def _totals_at(txn: DataFrame, dates: list[str]) -> DataFrame:
    """The features from additive measures at every date, from one scan.

    The fact is reduced to customers and periods. A period is a month, cut again at each date and at
    its three and six months before, so that it lies on one side of all of them. Only the reduced
    rows are multiplied by the dates, and all that follows stays on their partitioning by customer.
    """
    last = dates[-1]
    cuts = ["trunc(txn_date, 'MM')"] + [
        f"CASE WHEN txn_date >= {c} THEN {c} END" for d in dates if not d.endswith("-01")
        for c in (f"DATE '{d}'", f"add_months(DATE '{d}', {-RECENT_MONTHS})", f"add_months(DATE '{d}', {-2 * RECENT_MONTHS})")]
    period = f"greatest({', '.join(cuts)})" if len(cuts) > 1 else cuts[0]
    purchase, category, channel, momentum = purchase_block(last), category_block(), channel_block(), momentum_block(last)
    ticket = f"CASE WHEN {PURCHASE} THEN CAST(amount_gel AS DOUBLE) END"
    measures = {**purchase.measures, **category.measures, **channel.measures, "p_min": f"min(CASE WHEN {PURCHASE} THEN {CENTS} END)",
                "inflow": f"sum(CASE WHEN {INFLOW} THEN {CENTS} END)"}
    del measures["p_sd"]
    # squared deviations inside a period, and what the means of periods add to them
    spread = {"p_inside": f"var_pop({ticket}) * count({ticket})", "p_between": f"pow(avg({ticket}), 2) * count({ticket})"}
    rows = before(txn, "txn_date", last).where(f"{PURCHASE} OR {INFLOW} OR {DEBIT}")
    periods = rows.groupBy(KEY, F.expr(period).alias("period")).agg(*_named({**measures, **spread})).repartition(KEY)

    recent, prior = f"add_months(as_of, {-RECENT_MONTHS})", f"add_months(as_of, {-2 * RECENT_MONTHS})"
    in_recent, in_prior = f"period >= {recent}", f"period >= {prior} AND period < {recent}"
    months = periods.select("*", _later(dates, "period")).groupBy("as_of", KEY, month_start(F.col("period")).alias("month")).agg(*_named({
        **_merged([*measures, *spread]),
        "recent_sum": f"sum(CASE WHEN {in_recent} THEN p_sum ELSE 0L END)", "prior_sum": f"sum(CASE WHEN {in_prior} THEN p_sum ELSE 0L END)",
        "recent_n": f"sum(CASE WHEN {in_recent} THEN p_n ELSE 0L END)"}))
    totals = months.groupBy("as_of", KEY).agg(*_named({
        **_merged([*[m for m in measures if m != "inflow"], *spread, "recent_sum", "prior_sum", "recent_n"]), **MONTHLY}))
    gathered = f"p_inside + p_between - pow({_gel('p_sum')}, 2) / p_n"
    totals = totals.withColumns({
        "p_sd": F.expr(f"CASE WHEN p_n > 1 THEN CASE WHEN p_min = p_max THEN 0D ELSE sqrt(greatest({gathered}, 0D) / (p_n - 1)) END END"),
        "mom_rows": F.col("p_n"), "inflow_cv": F.expr(INFLOW_CV)})
    purchase.columns["recency_days"] = "datediff(as_of, p_last)"
    blocks = [c for b in (purchase, category, channel, momentum) for c in block_columns(b)]
    return totals.select("as_of", KEY, *blocks, "active_months", *INCOME_COLUMNS)


def monthly_feature_snapshots(txn: DataFrame, snapshot: DataFrame, customers: DataFrame, products: DataFrame,
                              as_of_dates: list[DateLike]) -> DataFrame:
    """The feature matrix as seen at several dates, one row per date and customer.

    Any dates do; each row equals that of ``feature_matrix`` at its date. The fact is scanned as often
    as for one date: totals are rolled up to periods, a merchant counts from the customer's first
    purchase there, and amounts are counted for all dates side by side.
    """
    dates = sorted({str(d) for d in as_of_dates})
    if not dates:
        raise ValueError("no dates")
    purchases = before(txn, "txn_date", dates[-1]).where(PURCHASE)
    first = purchases.groupBy(KEY, "merchant_sk").agg(F.min("txn_date").alias("first"))
    merchants = first.select(KEY, "merchant_sk", _later(dates, "first")).groupBy("as_of", KEY).agg(F.count("merchant_sk").alias("distinct_merchants"))
    accounts = product_balances(snapshot, products, "Current Account", dates[-1]).select("*", _later(dates, "month_end_date"))
    balances = balance_history(accounts, "as_of").withColumn("balance_cv", _balance_cv())
    ends = before(snapshot, "month_end_date", dates[-1]).select("month_end_date").distinct()
    latest = ends.select("month_end_date", _later(dates, "month_end_date")).groupBy("as_of").agg(F.max("month_end_date").alias("month_end_date"))
    # a row a date; the snapshot is made by an explode and looks as small
    holdings = _holdings(snapshot.join(F.broadcast(latest), "month_end_date"), products, "as_of")

    out = customers.select(KEY, *[c for c in CUSTOMER_COLUMNS if c not in LABEL_DERIVED_COLUMNS], F.explode(F.array(*[day(d) for d in dates])).alias("as_of"))
    for part in (_totals_at(txn, dates), medians_at(txn, dates), merchants, balances, holdings):
        out = out.join(part.hint("merge"), ["as_of", KEY], "left")
    return out.withColumn("purchases_per_active_month", F.expr(PER_ACTIVE_MONTH)).na.fill(0)
