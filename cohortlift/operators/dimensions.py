"""Builders of the dimension tables and their Unknown / Not Applicable members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.functions.expressions import DateLike, date_key, day
from cohortlift.schema import CATEGORIES, MCC_CODES, NO_CATEGORY, PRODUCTS, TABLES

CONTACT_WAVE_DAYS = 10
MEASUREMENT_DAYS = 60


def _rows(spark: SparkSession, table: str, values: list[tuple]) -> DataFrame:
    """A few literal rows of a table, sized for the optimiser as what they are."""
    schema = TABLES[table]
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)]) for row in values]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _calendar_columns() -> list[Column]:
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    return [
        date_key(d).alias("date_sk"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"), weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), (weekday >= 6).cast("int").alias("is_weekend"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"), F.date_format(d, "yyyy-MM").alias("year_month"),
    ]


def calendar(spans: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day of ``first``..``last``, read from the one-row frame ``spans``."""
    days = spans.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("full_date"))
    return days.select(*_calendar_columns())


def calendar_window(spark: SparkSession, start: DateLike, n_months: int = 12, tail_months: int = 4) -> DataFrame:
    """The calendar of an observation window and its measurement tail."""
    span = spark.range(1).select(
        day(start).alias("first"),
        F.date_sub(F.add_months(day(start), n_months + tail_months), 1).alias("last"))
    return calendar(span, "first", "last")


def unknown_date(spark: SparkSession) -> DataFrame:
    """The Unknown member of the calendar: key 0, no date."""
    named = {"date_sk": 0, "month_name": "Unknown", "day_name": "Unknown"}
    return _rows(spark, "dim_date", [tuple(named.get(c) for c in TABLES["dim_date"].fieldNames())])


def with_unknown_date(dates: DataFrame) -> DataFrame:
    """``dates`` with the Unknown member, added once."""
    return dates.where("date_sk <> 0").unionByName(unknown_date(dates.sparkSession))


def no_merchant(spark: SparkSession) -> DataFrame:
    """The Not Applicable merchant: key 0."""
    return _rows(spark, "dim_merchant", [(0, "Not Applicable", 0, NO_CATEGORY)])


def product_dim(spark: SparkSession) -> DataFrame:
    return _rows(spark, "dim_product", list(PRODUCTS))


def mcc_code(category: Column) -> Column:
    """Merchant category code of a category; 0 outside the list."""
    codes = F.create_map(*[F.lit(v) for pair in MCC_CODES.items() for v in pair])
    return F.coalesce(F.try_element_at(codes, category), F.lit(0))


def merchant_label(category: Column, number: Column, width: int = 2) -> Column:
    """Title-cased category, the word Merchant, and a number padded with zeros to ``width``."""
    digits = number.cast("string")
    title = F.initcap(F.replace(category, F.lit("_"), F.lit(" ")))
    return F.concat(title, F.lit(" Merchant "), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def merchant_dim(spark: SparkSession, per_category: int = 40) -> DataFrame:
    """``per_category`` merchants for every category, numbered on, plus the Not Applicable row."""
    n = F.col("id") % per_category + 1
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.floor(F.col("id") / per_category) + 1).cast("int"))
    body = spark.range(len(CATEGORIES) * per_category).select(
        (F.col("id") + 1).alias("merchant_sk"), merchant_label(category, n).alias("merchant_name"),
        mcc_code(category).alias("mcc_code"), category.alias("mcc_category"))
    return body.unionByName(no_merchant(spark))


def campaign_dim(products: DataFrame, start: DateLike, name: str, channel: str, cost: float = 2.5,
                 share: float = 0.70, campaign_sk: int = 1) -> DataFrame:
    """One campaign for the flagged target product, with derived contact and measurement ends."""
    return products.where("is_campaign_target = 1").agg(F.min("product_sk").alias("target_product_sk")).select(
        F.lit(campaign_sk).cast("long").alias("campaign_sk"), F.lit(name).alias("campaign_name"),
        "target_product_sk", day(start).alias("start_date"),
        F.date_add(day(start), CONTACT_WAVE_DAYS).alias("end_date"),
        F.date_add(day(start), CONTACT_WAVE_DAYS + MEASUREMENT_DAYS).alias("measurement_end_date"),
        F.lit(channel).alias("contact_channel"), F.lit(cost).cast("decimal(8,2)").alias("cost_per_contact_gel"),
        F.lit(share).cast("decimal(4,3)").alias("treatment_share"))


def observable_customer(master: DataFrame) -> DataFrame:
    """The customer dimension: its declared columns only, so no sealed label can follow."""
    return master.select(*TABLES["dim_customer"].fieldNames())
