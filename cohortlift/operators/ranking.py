"""Exact NTILE over a whole population without sorting it in one task."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DecimalType, DoubleType, LongType, NumericType

from cohortlift.functions.expressions import any_of
from cohortlift.operators.running import running_totals


@dataclass(frozen=True)
class Tile:
    """Rank ``score`` into ``tiles`` groups written to ``out``; ties are broken by the key, ascending.

    A missing score counts as the largest value.
    """

    score: str
    tiles: int
    out: str
    descending: bool = False


def _last_ranks(rows: int, tiles: int) -> list[int]:
    """The last rank of every tile but the final one; earlier tiles take the remainder."""
    size, extra = divmod(rows, tiles)
    return [i * size + min(i, extra) for i in range(1, tiles)]


def _literals(values, data_type) -> Column:
    """An array constant, sent as one string and folded once by the optimiser."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(ArrayType(data_type))


def _shares(resolution: int) -> Column:
    return _literals([i / resolution for i in range(1, resolution)], DoubleType())


def _cuts_below(x: Column, cuts: list, data_type, stride: int = 16) -> Column:
    """How many of the sorted ``cuts`` are less than ``x``: every 16th first, then the 16 that remain."""
    if not cuts:
        return F.lit(0)
    coarse = cuts[stride - 1::stride]
    passed = F.size(F.filter(_literals(coarse, data_type), lambda c: c < x)) * stride if coarse else F.lit(0)
    rest = F.slice(_literals(cuts, data_type), passed + 1, F.lit(stride))
    return passed + F.size(F.filter(rest, lambda c: c < x))


EXACT_LONG = 2 ** 53  # integers up to here are doubles


def _magnitude(column: str, data_type) -> Column:
    """The largest size of a column's values in units of their last digit; NULL where doubles hold every value."""
    if isinstance(data_type, LongType):
        return F.max(F.abs(F.col(column).cast("decimal(20,0)")))
    if isinstance(data_type, DecimalType):
        return F.max(F.abs(F.col(column).cast("double"))) * float(10 ** data_type.scale)
    return F.lit(None).cast("double")


def _number(value) -> float:
    return float((value - dt.date(1970, 1, 1)).days) if isinstance(value, dt.date) else float(value)


class _Cuts:
    """The position of a column among sorted cut values.

    ``below`` counts the cuts less than the value, ``on_heavy`` tells whether it equals a cut
    that was met more than once. Where doubles hold every value, Bucketizer finds the place by
    binary search; larger longs and decimals are compared in their own type.
    """

    def __init__(self, column: str, data_type, cuts: list, as_doubles: bool):
        self.column, self.values = column, sorted(v for v in set(cuts) if v == v)
        met = Counter(cuts)
        heavy = [met[v] > 1 for v in self.values]
        self.bucket = f"_at_{column}" if as_doubles and self.values else None
        self.data_type = data_type
        x = F.col(column)
        if self.bucket:
            self.edges = [-math.inf, *map(_number, self.values), math.inf]
            # Bucket j starts at edge j, which belongs to it; missing and NaN get none or the last.
            at = F.least(F.col(self.bucket).cast("int"), F.lit(len(self.values)))
            equal = F.element_at(_literals(self.edges, DoubleType()), at + 1) == self._as_double()
            self.below = at - equal.cast("int")
            self.on_heavy = equal & F.element_at(_literals([False, *heavy], BooleanType()), at + 1)
        else:
            self.below = _cuts_below(x, self.values, data_type)
            several = [v for v, h in zip(self.values, heavy) if h]
            self.on_heavy = F.array_contains(_literals(several, data_type), x) if several else F.lit(False)

    def _as_double(self) -> Column:
        x = F.col(self.column)
        return (F.unix_date(x) if isinstance(self.data_type, DateType) else x).cast("double")

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` with what the expressions of this object refer to."""
        if not self.bucket:
            return df
        source = self.bucket + "_x"
        found = Bucketizer(splits=self.edges, inputCol=source, outputCol=self.bucket, handleInvalid="keep")
        return found.transform(df.withColumn(source, self._as_double())).drop(source)


class _Cells:
    """Order-preserving cells of one score: the open gaps between cut values, and heavy values alone.

    A value met at two or more quantiles is heavy. It gets a cell of its own, split further by
    cuts of the key, so that no tie, however common, ends up in one cell.
    """

    def __init__(self, score: _Cuts, key: _Cuts):
        missing = F.col(score.column).isNull()
        self.cell = F.when(missing, 2 * len(score.values) + 1).otherwise(2 * score.below + score.on_heavy.cast("int"))
        self.part = F.when(missing | score.on_heavy, key.below).otherwise(0)


def _beyond(tile: Tile, key: str, score_bound, key_bound) -> Column:
    """Rows ranked after the bound row."""
    score = F.col(tile.score)
    if score_bound is None:
        further = score.isNotNull() if tile.descending else F.lit(False)
        same = score.isNull()
    else:
        bound = F.lit(score_bound)
        further = F.coalesce(score < bound if tile.descending else score > bound, F.lit(not tile.descending))
        same = score.eqNullSafe(bound)
    return further | (same & (F.col(key) > F.lit(key_bound)))


def _order(tile: Tile, score: str) -> Column:
    return F.col(score).desc_nulls_first() if tile.descending else F.col(score).asc_nulls_last()


def add_ntiles(df: DataFrame, key: str, tiles: list[Tile], resolution: int = 256) -> DataFrame:
    """``df`` with one exact NTILE column per entry of ``tiles``.

    Only the rows at the ends of the tiles decide the result, so at no size is the population
    sorted or shuffled whole: (1) a sketch of every
    score and of the key gives cut values; (2) rows are counted per cell between the cuts, and
    cells of ties per part of the key; (3) the cells that hold the last row of a tile, and only
    they, are ranked to find that row. Each row is then compared with those few rows. What
    reaches the driver is bounded by ``resolution`` and the number of tiles. ``df`` is read by
    every pass: pass a stored table. ``key`` must be a unique number or date, scores numbers or
    dates; other types are refused before anything runs.
    """
    types = {f.name: f.dataType for f in df.schema}
    for column in (key, *(t.score for t in tiles)):
        if not isinstance(types[column], (NumericType, DateType)):
            raise TypeError(f"{column} is {types[column].simpleString()}; keys and scores must be numbers or dates")
    columns = list(dict.fromkeys([key, *(t.score for t in tiles)]))
    share = _shares(resolution)
    sketch = df.agg(F.count(F.lit(1)).alias("rows"), *[
        e for i, c in enumerate(columns) for e in (
            F.percentile_approx(c, share, 10 * resolution).alias(f"cuts_{i}"), _magnitude(c, types[c]).alias(f"size_{i}"))]).first()
    rows = sketch["rows"]
    cuts = {c: _Cuts(c, types[c], sketch[f"cuts_{i}"] or [], (sketch[f"size_{i}"] or 0) <= EXACT_LONG) for i, c in enumerate(columns)}
    cells = [_Cells(cuts[t.score], cuts[key]) for t in tiles]
    placed = df
    for c in cuts.values():
        placed = c.place(placed)
    ends = _ends(placed, tiles, cells, rows)
    bounds: dict[int, list] = {i: [] for i in range(len(tiles))}
    found = _rows_at(placed, key, tiles, cells, ends)
    if found is not None:
        for r in found.collect():
            bounds[r["spec"]].append((r["key"], r[f"score_{r['spec']}"]))
    return df.withColumns({
        t.out: sum((_beyond(t, key, s, k).cast("int") for k, s in bounds[i]), F.lit(1)) for i, t in enumerate(tiles)})


def _counts(df: DataFrame, columns: list[list[Column]], wanted: Column | None = None) -> list[tuple]:
    """Rows per (spec, position): one pass over ``df`` for all specs."""
    spread = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("spec"), *[c.alias(f"p{j}") for j, c in enumerate(position)])
        for i, position in enumerate(columns)])))
    if wanted is not None:
        spread = spread.where(wanted)
    keys = spread.columns
    return [tuple(r) for r in spread.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()]


def _split(groups: list[tuple], ranks: list[int]) -> list[tuple]:
    """Ordered (position, rows) groups against wanted ranks: (position, ranks inside it)."""
    out, passed = [], 0
    for position, n in groups:
        inside = sorted({r - passed for r in ranks if passed < r <= passed + n})
        if inside:
            out.append((position, inside))
        passed += n
    return out


def _ends(df: DataFrame, tiles: list[Tile], cells: list[_Cells], rows: int) -> list[tuple]:
    """(spec, cell, part, positions) of the last row of every tile."""
    per_cell = _counts(df, [[c.cell] for c in cells])
    found = []
    for i, spec in enumerate(tiles):
        ordered = sorted(((c, n) for s, c, n in per_cell if s == i), reverse=spec.descending)
        ranks = [b for b in _last_ranks(rows, spec.tiles) if 0 < b < rows]
        found += [(i, cell, inside) for cell, inside in _split(ordered, ranks)]
    tied = [(i, cell) for i, cell, _ in found if cell % 2]
    if not tied:
        return [(i, cell, 0, inside) for i, cell, inside in found]
    here = any_of([(F.col("spec") == i) & (F.col("p0") == cell) for i, cell in tied])
    per_part = _counts(df, [[c.cell, c.part] for c in cells], here)
    ends = []
    for i, cell, inside in found:
        parts = sorted((p, n) for s, c, p, n in per_part if (s, c) == (i, cell)) if cell % 2 else [(0, rows)]
        ends += [(i, cell, part, at) for part, at in _split(parts, inside)]
    return ends


def _rows_at(df: DataFrame, key: str, tiles: list[Tile], cells: list[_Cells], ends: list) -> DataFrame | None:
    """The rows at the wanted positions inside their cells."""
    found = None
    for i, spec in enumerate(tiles):
        mine = [e for e in ends if e[0] == i]
        if not mine:
            continue
        # Generated columns: computed once per row, where a filter on plain ones would repeat them.
        position = F.inline(F.array(F.struct(cells[i].cell.alias("cell"), cells[i].part.alias("part"))))
        here = df.select(
            F.lit(i).alias("spec"), F.col(key).alias("key"), *[F.col(t.score).alias(f"score_{j}") for j, t in enumerate(tiles)],
            F.col(spec.score).alias("_score"), position)
        here = here.where(any_of([(F.col("cell") == c) & (F.col("part") == p) for _, c, p, _ in mine]))
        inside = Window.partitionBy("cell", "part").orderBy(_order(spec, "_score"), F.col("key"))
        ranked = here.withColumn("rn", F.row_number().over(inside))
        hits = ranked.where(any_of([
            (F.col("cell") == c) & (F.col("part") == p) & F.col("rn").isin(at) for _, c, p, at in mine]))
        hits = hits.drop("_score", "cell", "part", "rn")
        found = hits if found is None else found.unionByName(hits)
    return found


def ntile_global(df: DataFrame, score: str, tiles: int, key: str, descending: bool = False, out: str = "tile",
                 resolution: int = 256) -> DataFrame:
    """``df`` with the exact NTILE of one score."""
    return add_ntiles(df, key, [Tile(score, tiles, out, descending)], resolution)


def _sketched(df: DataFrame, resolution: int) -> tuple[int, list[float]]:
    """Number of values ``x`` and cut values that split them into about ``resolution`` parts."""
    cuts = F.percentile_approx("x", _shares(resolution), 10 * resolution)
    row = df.agg(F.count("x").alias("n"), cuts.alias("cuts")).first()
    return row["n"], row["cuts"] or []


def _values_at(df: DataFrame, ranks: list[int], cuts: list[float], resolution: int, leaf: int) -> dict[int, float]:
    """The finite values ``x`` at 0-based ``ranks``, by narrowing to one cell after another.

    Cell 2i holds the rows equal to cut i, cell 2i + 1 those between it and the next. A cell of
    ``leaf`` rows or fewer is put in order; a larger one is narrowed again.
    """
    x = F.col("x")
    edges = [-math.inf, *sorted(set(cuts)), math.inf]
    bucketed = Bucketizer(splits=edges, inputCol="x", outputCol="at").transform(df)
    at_cut = F.element_at(_literals(edges[:-1], DoubleType()), F.col("at").cast("int") + 1) == x
    cells = bucketed.select((2 * F.col("at").cast("int") + F.when(at_cut, 0).otherwise(1)).alias("cell"))
    counted = sorted((r["cell"], r["n"]) for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())
    found: dict[int, float] = {}
    passed = 0
    for cell, n in counted:
        inside = [r for r in ranks if passed <= r < passed + n]
        low, high = edges[cell // 2], edges[cell // 2 + 1]
        if inside and cell % 2 == 0:
            found |= dict.fromkeys(inside, low)
        elif inside:
            part = df.where((x > F.lit(low)) & (x < F.lit(high)))
            within = [r - passed for r in inside]
            deeper = _ordered(part, within) if n <= leaf else _values_at(part, within, _sketched(part, resolution)[1], resolution, leaf)
            found |= {r + passed: v for r, v in deeper.items()}
        passed += n
    return found


def _ordered(df: DataFrame, ranks: list[int]) -> dict[int, float]:
    """The values ``x`` at 0-based ``ranks`` of a cell of bounded size."""
    upto = df.groupBy("x").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy("x")))
    hits = upto.where(any_of([(F.col("upto") > r) & (F.col("upto") - F.col("n") <= r) for r in ranks])).collect()
    return {r: h["x"] for r in ranks for h in hits if h["upto"] > r >= h["upto"] - h["n"]}


def quantiles(df: DataFrame, measure: str, probabilities: list[float], resolution: int = 256,
              leaf: int = 50_000) -> list[float | None]:
    """Exact quantiles of a measure (as doubles), interpolated between neighbours, at any number of rows.

    Cells between sketched cut values are counted and only the cell that holds a wanted rank is
    looked into, again and again until it has at most ``leaf`` rows. Values met at a cut are
    their own cell, so ties end the search instead of prolonging it. Infinite values are counted
    and take the first and last ranks; nulls and NaN have none. Each pass reads ``df``.
    """
    present = df.select(F.col(measure).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    finite = present.where((F.col("x") > F.lit(-math.inf)) & (F.col("x") < F.lit(math.inf)))
    below, rows = present.agg(F.count_if(F.col("x") == F.lit(-math.inf)), F.count(F.lit(1))).first()
    if rows == 0:
        return [None] * len(probabilities)
    n, cuts = _sketched(finite, resolution)
    spots = [(p * (rows - 1)) for p in probabilities]
    ranks = sorted({r for s in spots for r in (int(s), min(int(s) + 1, rows - 1))})
    at = {r: -math.inf if r < below else math.inf for r in ranks}
    inside = [r - below for r in ranks if below <= r < below + n]
    if inside:
        at |= {r + below: v for r, v in _values_at(finite, inside, cuts, resolution, leaf).items()}

    def between(spot: float) -> float:
        low, high, part = at[int(spot)], at[min(int(spot) + 1, rows - 1)], spot - int(spot)
        return low if part == 0 or low == high else low + part * (high - low)

    return [between(s) for s in spots]


def grouped_medians(df: DataFrame, group: str, measure: str, out: str = "median") -> DataFrame:
    """Exact median of every group (mean of the two middle values of an even number).

    Equal values are counted first; running counts over ranges of (group, value) then show where the middle lies, so a group
    with most of the rows is spread over tasks like any other.
    """
    x = F.col(measure)
    counted = df.where(x.isNotNull() & F.col(group).isNotNull()).groupBy(group, measure).agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counted, [measure], {"upto": "n"}, [group])
    rows, first = F.col("upto_total"), F.col("upto") - F.col("n") + 1
    low, high = F.floor((rows + 1) / 2), F.floor(rows / 2) + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (F.col("upto") >= rank), x.cast("double")))

    return placed.groupBy(group).agg(((at(low) + at(high)) / 2).alias(out))
