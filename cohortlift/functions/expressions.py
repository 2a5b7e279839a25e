"""Small column expressions used across the operators."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = dt.date | str


def day(value: DateLike) -> Column:
    """A business day as a DATE literal, so comparisons reach the scan."""
    return F.lit(str(value)).cast("date")


def before(df: DataFrame, date_col: str, as_of: DateLike, month_col: str = "txn_month") -> DataFrame:
    """Rows dated strictly before ``as_of``: the only place the point-in-time rule lives.

    A table partitioned by month carries ``month_col`` (first day of the month). Catalyst does
    not infer a bound on it from the day column, so the implied one is added here and prunes
    whole partitions.
    """
    kept = df.where(F.col(date_col) < day(as_of))
    if month_col in df.columns and month_col != date_col:
        kept = kept.where(F.col(month_col) < day(as_of))
    return kept


def date_key(date_col: Column) -> Column:
    """yyyymmdd as an integer; 0, the Unknown member, for a missing date."""
    key = F.year(date_col) * 10000 + F.month(date_col) * 100 + F.dayofmonth(date_col)
    return F.coalesce(key, F.lit(0))


def month_start(date_col: Column) -> Column:
    return F.trunc(date_col, "month")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL, not an error, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def floored_ratio(numerator: Column, denominator: Column, floor: float = 1.0) -> Column:
    """Division by ``max(denominator, floor)``."""
    return numerator.cast("double") / F.greatest(denominator.cast("double"), F.lit(float(floor)))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def exact_mean(value: Column) -> Column:
    """Mean of a decimal column from its exact sum: the same on every partitioning of the input."""
    return ratio(F.sum(value), F.count(value))


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where ``condition`` holds; 0 if no such row."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("decimal(1,0)"))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def hash_slot(text: Column, slots: int) -> Column:
    """A slot 0..slots-1 that depends on ``text`` alone.

    The first eight hex digits of an MD5, so any SQL engine can recompute it and a retried
    task draws the same slot.
    """
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(slots)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Presentation rounding (half up) of the named columns."""
    return df.withColumns({name: F.round(F.col(name), n) for name, n in digits.items()})


def share_of_total(df: DataFrame, measure: str, out: str) -> DataFrame:
    """``measure`` over its sum across ``df``. The total is a scalar subquery: one row, no window."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, ratio(F.col(measure), total))
