"""Ranks, tiles and running totals over whole populations, or over groups of any size, by two-level prefix sums.

A window without a partition, or over one hot group, sorts all of its rows in one task. Here the rows are cut into ranges of
(group, order); each range is summed apart, the few sums of the ranges are added up, and every row adds what came before
its range to what came before it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.session import materialise

RANGES, RANGE_ROWS = 32, 1_000_000
POSITION, SIZE = "position", "group_size"


def _order(columns: list[str], descending: list[str]) -> list[Column]:
    return [F.desc_nulls_last(c) if c in descending else F.asc_nulls_first(c) for c in columns]


def running_totals(df: DataFrame, order: list[str], sums: dict[str, str], group: list[str] | None = None,
                   descending: list[str] | None = None) -> DataFrame:
    """``df`` with its place in ``order``, the size of its group, and running totals.

    ``position`` counts from 1 and ``group_size`` is the number of rows of the group; every entry ``out: measure`` of ``sums``
    gives ``out``, the sum of the measure up to and including the row, and ``out_total``, that over the group. ``order`` must end
    in columns that are unique within a group; those in ``descending`` fall, their missing values last. Measures should be whole
    numbers or decimals, whose sums don't depend on the partitioning; a missing one adds nothing.

    No range holds much more than ``RANGE_ROWS`` rows, ties included, as the unique end of ``order`` splits them. Without a group
    the sums of the ranges, one row each, pass through the driver.
    """
    group, falling = group or [], descending or []
    rows = materialise(df)
    ordered = [*[F.asc_nulls_first(g) for g in group], *_order(order, falling)]
    placed = rows.repartitionByRange(RANGES + rows.count() // RANGE_ROWS, *ordered).withColumn("_range", F.spark_partition_id())
    local = Window.partitionBy(*group, "_range").orderBy(*_order(order, falling))
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = materialise(placed.withColumns({
        "_place": F.row_number().over(local).cast("long"), **{f"_run_{out}": F.coalesce(F.sum(m).over(upto), F.lit(0)) for out, m in sums.items()}}))
    totals = placed.groupBy(*group, "_range").agg(
        F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(m), F.lit(0)).alias(f"_sum_{out}") for out, m in sums.items()])
    parts = ["_n", *[f"_sum_{out}" for out in sums]]
    if group:
        whole = Window.partitionBy(*group)
        earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            *group, "_range", *[F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"{p}_before") for p in parts],
            *[F.sum(p).over(whole).alias(f"{p}_all") for p in parts])
        both = [F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}")) for g in group]
    else:
        offsets, both = _added_up(totals, parts), []
    condition = F.col("r._range") == F.col("o._range")
    for b in both:
        condition = condition & b
    joined = placed.alias("r").join(offsets.alias("o"), condition)
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("_place") + F.col("_n_before")).alias(POSITION), F.col("_n_all").alias(SIZE),
        *[c for out in sums for c in (
            (F.col(f"_run_{out}") + F.col(f"_sum_{out}_before")).alias(out), F.col(f"_sum_{out}_all").alias(f"{out}_total"))])


def _added_up(totals: DataFrame, parts: list[str]) -> DataFrame:
    """What came before each range, and the whole: a row per range, added up in their order."""
    types = {f.name: f.dataType.simpleString() for f in totals.schema}
    found = sorted(totals.collect(), key=lambda r: r["_range"])
    whole = [sum(r[p] for r in found) for p in parts]
    before, rows = [0 * w for w in whole], []
    for r in found:
        rows.append((r["_range"], *before, *whole))
        before = [b + r[p] for b, p in zip(before, parts, strict=True)]
    schema = ", ".join(["_range int", *[f"{p}_before {types[p]}" for p in parts], *[f"{p}_all {types[p]}" for p in parts]])
    return totals.sparkSession.createDataFrame(rows, schema)


def tile_of(tiles: int) -> Column:
    """The NTILE of a row from its position and the size of its group: the first ``size % tiles`` tiles hold one row more."""
    p, n = F.col(POSITION) - 1, F.col(SIZE)
    small, longer = F.floor(n / tiles), n % tiles
    edge = longer * (small + 1)
    return F.when(p < edge, F.floor(p / (small + 1))).otherwise(longer + F.floor((p - edge) / F.greatest(small, F.lit(1)))).cast("int") + 1


def grouped_ntile(df: DataFrame, group: list[str], score: str, key: str, tiles: int, out: str, descending: bool = False) -> DataFrame:
    """``df`` with the exact NTILE of ``score`` within each group; ties by the key, ascending."""
    ranked = running_totals(df, [score, key], {}, group, [score] if descending else [])
    return ranked.withColumn(out, tile_of(tiles)).drop(POSITION, SIZE)


def concentration(df: DataFrame, measure: str, key: str) -> DataFrame:
    """Every row from the largest measure down, with the running total and its share of all: a Lorenz curve at row grain."""
    out = running_totals(df.select(key, measure), [measure, key], {"cumulative": measure}, descending=[measure])
    share = F.try_divide(F.col("cumulative").cast("double"), F.col("cumulative_total").cast("double"))
    rows = F.try_divide(F.col(POSITION).cast("double"), F.col(SIZE).cast("double"))
    return out.select(key, POSITION, measure, "cumulative", rows.alias("cumulative_rows"), share.alias("cumulative_share"))
