"""Star tables damaged on purpose, so that every line of the contract reports has something to count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from cohortlift.schema import DIMENSIONS, TABLES

Tables = dict[str, DataFrame]


def _copies(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names, F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("_copy"))


def with_nulls(tables: Tables) -> Tables:
    """As many copies of each row as columns; copy k has lost the columns from k on, so each column misses another number of values."""
    return {t: _copies(df, TABLES[t].names).select(*[
        F.when(F.col("_copy") > i, F.col(c)).alias(c) for i, c in enumerate(TABLES[t].names)]) for t, df in tables.items()}


def with_bad_values(tables: Tables) -> Tables:
    """As many copies of each row as columns; copy k has a value in column k that no rule allows."""

    def bad(kind):
        return F.lit("bad") if kind == StringType() else F.lit("1900-01-01").cast("date") if kind == DateType() else F.lit(-1).cast(kind)

    return {t: _copies(df, TABLES[t].names).select(*[
        F.when(F.col("_copy") == i, bad(f.dataType)).otherwise(F.col(f.name)).alias(f.name) for i, f in enumerate(TABLES[t])])
        for t, df in tables.items()}


def with_other_keys(tables: Tables) -> Tables:
    """Dimensions with their key doubled: references to odd keys and to most dates lead nowhere."""
    return {t: df.withColumn(TABLES[t].names[0], F.col(TABLES[t].names[0]) * 2) if t in DIMENSIONS else df for t, df in tables.items()}


def with_repeats(tables: Tables) -> Tables:
    """Rows whose first key column is odd come twice."""
    return {t: df.unionByName(df.where(F.col(TABLES[t].names[0]) % 2 == 1)) for t, df in tables.items()}


def with_long_texts(tables: Tables) -> Tables:
    """As many copies of each row as columns; in copies from k on, the text in column k is followed by a hundred letters of two bytes."""
    return {t: _copies(df, TABLES[t].names).select(*[
        F.when(F.col("_copy") >= i, F.concat(f.name, F.lit("é" * 100))).otherwise(F.col(f.name)).alias(f.name)
        if f.dataType == StringType() else F.col(f.name) for i, f in enumerate(TABLES[t])]) for t, df in tables.items()}
