"""Reading, typing, writing and describing star tables on any Spark-readable store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, FloatType, StructType

from cohortlift.functions.expressions import month_start
from cohortlift.operators.dimensions import with_unknown_date
from cohortlift.schema import DIMENSIONS, FACTS, TABLES

PARTITIONED = {"fact_transaction": ("txn_month", "txn_date")}
CLUSTERED = {
    "fact_transaction": ("customer_sk", "txn_date"),
    "fact_account_monthly": ("customer_sk", "month_end_date", "product_sk"),
}


def _typed(column: str, source: DataType, target: DataType) -> Column:
    value = F.col(column)
    if isinstance(source, (DoubleType, FloatType)):
        value = F.when(~F.isnan(value), value)
    if isinstance(source, BooleanType):
        value = value.cast("int")
    if isinstance(target, DateType):
        value = value.cast("date")
    return value.cast(target).alias(column)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the declared columns, bound by name and repaired by type.

    Booleans become 0/1, NaN becomes NULL, timestamps become days, doubles become the declared
    decimals. A missing column is an error.
    """
    types = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in types]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[_typed(f.name, types[f.name], f.dataType) for f in schema])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A star table from ``root``/<table> or, failing that, ``root``/<table>.parquet, typed as declared.

    The month partition column is kept beside the declared ones, so it can prune.
    """
    df = spark.read.parquet(location(spark, root, table))
    typed = conform(df, TABLES[table])
    month = PARTITIONED.get(table, (None,))[0]
    if month and month in df.columns:
        typed = df.select(*[_typed(f.name, df.schema[f.name].dataType, f.dataType) for f in TABLES[table]], F.col(month).cast("date"))
    return typed


def location(spark: SparkSession, root: str, table: str) -> str:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return f"{root}/{table}" if fs.exists(folder) else f"{root}/{table}.parquet"


def write_table(df: DataFrame, root: str, table: str, rows_per_file: int = 10_000_000) -> None:
    """Replaces a star table.

    The transaction fact is partitioned by month. Rows are brought together by month with the
    rebalance hint: adaptive execution then splits a month that is too large for one task
    and merges small ones, so a hot month neither lands on one task nor leaves many small files.
    Inside a file rows are clustered by customer, which sharpens the row-group statistics.
    """
    out = df
    month = PARTITIONED.get(table)
    if month:
        out = out.withColumn(month[0], month_start(F.col(month[1]))).hint("rebalance", month[0])
    if table in CLUSTERED:
        out = out.sortWithinPartitions(*([month[0]] if month else []), *CLUSTERED[table])
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if month:
        # A full replacement, whatever the session's overwrite mode: no stale month survives.
        writer = writer.partitionBy(month[0]).option("partitionOverwriteMode", "static")
    writer.parquet(f"{root}/{table}")


def replace_months(df: DataFrame, root: str, table: str = "fact_transaction") -> None:
    """Replaces only the months present in ``df``; other months stay, new ones appear."""
    month, date = PARTITIONED[table]
    out = df.withColumn(month, month_start(F.col(date))).hint("rebalance", month).sortWithinPartitions(month, *CLUSTERED[table])
    out.write.mode("overwrite").partitionBy(month).option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{table}")


def prepare(table: str, df: DataFrame) -> DataFrame:
    """A source table as it is loaded: typed, with its Unknown member."""
    typed = conform(df, TABLES[table])
    return with_unknown_date(typed) if table == "dim_date" else typed


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 50_000) -> None:
    """Bulk load into a database table, truncated first so that a restart cannot repeat rows."""
    df.write.mode("overwrite").option("truncate", "true").option("batchsize", batch_rows).jdbc(url, table, properties=properties)


def analyze(spark: SparkSession, table: str) -> None:
    """Column statistics of a catalog table, for the cost-based optimiser."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def _row_digest(df: DataFrame) -> Column:
    """MD5 of a row: every value by its length in bytes and its text, '-' for a missing one, in the order of the columns."""
    values = [F.col(c).cast("string") for c in df.columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]))


def _sums(df: DataFrame, *by: Column) -> DataFrame:
    """Rows, and the sums of two 32-bit parts of their digests: they don't depend on the order of the rows and add up over parts."""
    digest = _row_digest(df)
    part = lambda at: F.sum(F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(20,0)"))
    grouped = df.groupBy(*by) if by else df
    zero = F.lit(0).cast("decimal(38,0)")
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(part(1), zero).cast("decimal(38,0)").alias("sum_a"), F.coalesce(part(9), zero).cast("decimal(38,0)").alias("sum_b"))


def manifest_parts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, part, rows, sum_a, sum_b): the content of every table, the partitioned ones month by month. A table without rows has no parts."""
    def lines(name: str, df: DataFrame) -> DataFrame:
        df = df.select(*TABLES[name].fieldNames()) if name in TABLES else df
        month = month_start(F.col(PARTITIONED[name][1])) if name in PARTITIONED else F.lit(None).cast("date")
        return _sums(df, month.alias("part")).select(F.lit(name).alias("table_name"), "part", "rows", "sum_a", "sum_b")

    return reduce(DataFrame.unionByName, [lines(n, df) for n, df in tables.items()])


def _fingerprint() -> Column:
    return F.concat_ws("-", F.col("sum_a").cast("string"), F.col("sum_b").cast("string")).alias("fingerprint")


def merged(parts: DataFrame) -> DataFrame:
    """Parts of a manifest -> (table_name, rows, fingerprint) per table."""
    whole = parts.groupBy("table_name").agg(F.sum("rows").alias("rows"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("sum_a", "sum_b")])
    return whole.select("table_name", "rows", _fingerprint())


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table_name, part, change) of the parts that were added, removed or changed between two manifests."""
    b, a = before.alias("b"), after.alias("a")
    both = b.join(a, (F.col("b.table_name") == F.col("a.table_name")) & F.col("b.part").eqNullSafe(F.col("a.part")), "full")
    same = F.array_compact(F.array(*[F.when(F.col(f"b.{c}") != F.col(f"a.{c}"), c) for c in ("rows", "sum_a", "sum_b")]))
    change = F.when(F.col("b.table_name").isNull(), "added").when(F.col("a.table_name").isNull(), "removed").when(F.size(same) > 0, "changed")
    return both.select(F.coalesce("b.table_name", "a.table_name").alias("table_name"), F.coalesce("b.part", "a.part").alias("part"), change.alias("change")).where(
        "change IS NOT NULL")


def manifest(tables: dict[str, DataFrame], **parameters: str) -> DataFrame:
    """Rows and an order-independent content fingerprint of every table, with run parameters."""
    def line(name: str, df: DataFrame) -> DataFrame:
        declared = [c for c in TABLES[name].fieldNames() if c in df.columns] if name in TABLES else df.columns
        return _sums(df.select(*declared)).select(
            F.lit(name).alias("table_name"), "rows", _fingerprint(), *[F.lit(v).alias(k) for k, v in parameters.items()])

    return reduce(DataFrame.unionByName, [line(n, df) for n, df in tables.items()])


def catalog_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(table_name, column_name, rows, nulls, low, high) of an analysed catalog table, as the optimiser holds them; texts have no extremes.

    The driver reads one small description a column.
    """
    analyze(spark, table)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    rows = int(described["Statistics"].split(",")[1].split()[0])
    lines = []
    for column in spark.table(table).columns:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        found = {k: None if info.get(k) in (None, "NULL") else info[k] for k in ("num_nulls", "min", "max")}
        lines.append((table, column, rows, int(found["num_nulls"]), found["min"], found["max"]))
    return spark.createDataFrame(lines, "table_name string, column_name string, rows long, nulls long, low string, high string")


def register(spark: SparkSession, df: DataFrame, table: str, path: str) -> None:
    """``df`` as an external catalog table over ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)


LOAD_ORDER = (*DIMENSIONS, *FACTS)
