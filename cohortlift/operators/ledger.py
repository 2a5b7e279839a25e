"""Monthly flows, dense month spines, the account ledger and the account snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.functions.expressions import DateLike, clip, date_key, day, month_start, sum_if

# ---- fixed values: ledger constants -----------------------------------------------------------
SWEEP_RATE = 0.40
SAVINGS_MONTHLY_RATE = 0.004
OVERDRAFT_FLOOR = -500.0
LOAN_TERM_MONTHS = 36


def monthly_flows(txn: DataFrame) -> DataFrame:
    """Inflow and outflow per customer and month, from the direction of each transaction."""
    return txn.groupBy("customer_sk", month_start(F.col("txn_date")).alias("month")).agg(
        sum_if(F.col("direction") == "credit", F.col("amount_gel")).alias("inflow"),
        sum_if(F.col("direction") == "debit", F.col("amount_gel")).alias("outflow"),
    )


def month_spine(entities: DataFrame, start: DateLike, n_months: int) -> DataFrame:
    """Every entity times ``n_months`` months, with ``month_idx`` from 0."""
    spine = entities.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_months - 1))).alias("month_idx"))
    return spine.withColumn("month", F.add_months(month_start(day(start)), F.col("month_idx")))


def densify_months(entities: DataFrame, flows: DataFrame, start: DateLike, n_months: int,
                   measures: list[str], key: str = "customer_sk") -> DataFrame:
    """One row per entity and month of the window; months without a flow get 0."""
    first = month_start(day(start))
    window = flows.where((F.col("month") >= first) & (F.col("month") < F.add_months(first, n_months)))
    return (
        month_spine(entities.select(key), start, n_months)
        .join(window.select(key, "month", *measures), [key, "month"], "left")
        .select(key, "month_idx", "month", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    )


def ledger_rollforward(flows: DataFrame, openings: DataFrame, key: str = "customer_sk", order: str = "month") -> DataFrame:
    """Month-end current-account and savings balances, carried forward month by month.

    ``openings`` holds one row per entity: ``opening_gel``, ``buffer_gel``, ``has_savings`` and
    ``opening_savings_gel``. Each month the flow is applied, a share of the surplus above the
    buffer moves to savings, the account is floored, and savings earn interest. The floor and
    the sweep make this non-linear, so no window sum can express it; the months of an entity
    (already one row per month) are folded in order instead.
    """
    months = flows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        F.col(order), F.col("inflow").cast("double").alias("inflow"), F.col("outflow").cast("double").alias("outflow"),
    ))).alias("months"))
    joined = months.join(
        openings.select(
            key, F.col("has_savings").cast("int").alias("has_savings"),
            *[F.col(c).cast("double").alias(c) for c in ("opening_gel", "buffer_gel", "opening_savings_gel")]),
        key)

    def step(path: Column, month: Column) -> Column:
        last = F.element_at(path, -1)
        gross = last["ca"] + month["inflow"] - month["outflow"]
        sweep = F.when(F.col("has_savings") == 1,
                       F.greatest(gross - F.col("buffer_gel"), F.lit(0.0)) * SWEEP_RATE).otherwise(F.lit(0.0))
        return F.concat(path, F.array(F.struct(
            month[order].alias(order),
            F.greatest(gross - sweep, F.lit(OVERDRAFT_FLOOR)).alias("ca"),
            (last["sav"] * (1 + SAVINGS_MONTHLY_RATE) + sweep).alias("sav"),
        )))

    order_type = flows.schema[order].dataType
    seed = F.array(F.struct(
        F.lit(None).cast(order_type).alias(order),
        F.col("opening_gel").alias("ca"),
        F.col("opening_savings_gel").alias("sav"),
    ))
    path = F.aggregate("months", seed, step)
    return (
        joined.select(key, F.explode(F.slice(path, F.lit(2), F.size("months"))).alias("m"))
        .select(key, f"m.{order}", F.col("m.ca").alias("current_account_gel"), F.col("m.sav").alias("savings_gel"))
    )


def loan_remaining(principal: Column, elapsed_months: Column, month_idx: Column, term: int = LOAN_TERM_MONTHS) -> Column:
    """Outstanding loan after linear amortisation, as a liability (negative)."""
    elapsed = (elapsed_months + month_idx).cast("double")
    return -principal * clip(F.lit(1.0) - elapsed / F.lit(float(term)), 0.0, 1.0)


def live_holdings(holdings: DataFrame, start: DateLike, n_months: int) -> DataFrame:
    """Holdings times month, from the month each was opened (negative: before the window)."""
    spine = month_spine(holdings, start, n_months)
    return spine.where(F.col("open_month_idx") <= F.col("month_idx")).withColumn("month_end_date", F.last_day("month"))


def account_snapshot(live: DataFrame, balance: Column) -> DataFrame:
    """The periodic snapshot: one row per live holding and month end with its ``balance``."""
    return live.select(
        "customer_sk", "product_sk",
        date_key(F.col("month_end_date")).alias("date_sk"),
        "month_end_date",
        F.round(balance, 2).cast("decimal(14,2)").alias("balance_gel"),
        (F.col("open_month_idx") == F.col("month_idx")).cast("int").alias("opened_this_month"),
        F.lit(1).alias("is_held"),
    )


def standardize(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Z-scores with the population standard deviation; 0 everywhere when it is 0.

    The moments of all columns come from one aggregate, read as a one-row subquery.
    """
    moments = df.agg(F.struct(*[
        F.struct(F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("sd")).alias(c)
        for c in columns
    ]).alias("m")).scalar()
    stated = df.withColumn("_m", moments)
    return stated.withColumns({
        c + suffix: F.when(F.col(f"_m.{c}.sd") == 0, F.lit(0.0)).otherwise(
            (F.col(c).cast("double") - F.col(f"_m.{c}.mean")) / F.nullif(F.col(f"_m.{c}.sd"), F.lit(0.0)))
        for c in columns
    }).drop("_m")
