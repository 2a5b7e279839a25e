"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.common import columns, n_words_of, stored

WEIGHTS = (1, 2, 3)
#: Weight of a source over training time, as (time, weight) knots from 0 to 1 with straight lines between: one schedule for each of WEIGHTS.
#: Sources of the first kind fade, those of the second stay, those of the third grow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
MOST = 3
#: Parts of the hash order of one source; each part is summed apart, so that no source gathers in one task.
PARTS = 4096


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> and kind, weight, target. Sources by code point, null last, weigh `weights` in turn and share all sizes.

    No target exceeds `most` times its source's size: with all shares at level x per unit of weight, sources reach that limit in the order of
    size / weight; the level is the first one that the next source can take whole. One row a source is all that meets in one task.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    ranked = sources.withColumn("kind", order % len(weights)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1))
    limit = (most * F.col("source_size")).cast("double")
    before = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = left.cast("double") / weight_left
    levels = ranked.withColumn("level", level).withColumn("limit", limit)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    levels = levels.withColumn("x", F.min_by(fits, F.when(fits.isNotNull(), limit / F.col("weight"))).over(Window.partitionBy()))
    return levels.withColumn("target", F.least("limit", F.coalesce(F.col("x") * F.col("weight"), F.col("limit")))).select(
        "source", "source_size", "kind", "weight", "target")


def _position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the schedule reaches `share` of its whole: per line a quadratic equation."""
    pieces, whole = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        pieces.append((t0, t1, w0, w1, whole))
        whole += (w0 + w1) / 2 * (t1 - t0)
    out = None
    for t0, t1, w0, w1, done in pieces:
        slope, need = (w1 - w0) / (t1 - t0), share * whole - done
        at = F.lit(t0) + 2 * need / (w0 + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * need)))
        out = at if out is None else F.when(need > 0, at).otherwise(out)
    return F.least(F.lit(float(knots[-1][0])), F.greatest(F.lit(float(knots[0][0])), out))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """documents -> (doc_id, source, tie, size, source_size, target, taken, copies, positions), a row per row.

    A source whose target is q times its size gives each document floor(q) times, and some once more: in the order of the hash of doc_id, as
    long as half of the document still fits in the rest of the target. taken = copies * size; positions has a training time (0 to 1) for
    each copy: the words of a source before that copy, as a share of all it gives, meet the integral of its weight schedule there.
    Sums run over parts of the hash order, then within a part, so a hot source spreads over the tasks. Null texts have size 0, a null source
    is a source, repeated ids are documents with a place in the order, null ids are drawn by their texts; rows equal in id and text hash are alike. No rows: no rows.
    """
    nameless = F.concat(F.lit("null "), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = columns(docs, doc_id="doc_id", text="text", source="source").select(
        "doc_id", "source", n_words_of(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), nameless).cast("binary")).alias("draw"))
    rows = stored(rows.withColumn("part", F.conv(F.substring("draw", 1, 3), 16, 10).cast("int") % PARTS))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    sizes = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, most)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("part_size").over(earlier), F.lit(0))).drop("part_size").alias("p").join(
        sizes.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))).select("p.source", "part", "start", "source_size", "kind", "target")
    r, s = rows.alias("r"), starts.alias("s")
    out = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.part") == F.col("s.part"))).select(
        "r.*", "start", "source_size", "kind", "target")
    before = Window.partitionBy("source", "part").orderBy("draw", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = out.withColumn("offset", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("whole", whole)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    once_more = (F.col("size") > 0) & (F.col("offset") + F.col("size") / 2 <= rest)
    out = out.withColumn("copies", F.col("whole") + F.when(once_more, 1).otherwise(0))
    at = lambda n: F.when(F.col("target") > 0, (F.col("offset") + n * F.col("source_size")) / F.col("target")).otherwise(0.0)

    def placed(n: Column) -> Column:
        share = F.least(F.lit(1.0), at(n))
        position = _position(share, schedules[0])
        for kind in range(1, len(weights)):
            position = F.when(F.col("kind") == kind, _position(share, schedules[kind])).otherwise(position)
        return F.round(position, 6)

    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies").cast("int") - 1), placed)).otherwise(F.array().cast("array<double>"))
    return out.select(
        "doc_id", "source", "tie", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        positions.alias("positions"))


def training_order(docs: DataFrame, **config) -> DataFrame:
    """The documents as the mix takes them: a row for each copy, with copy (from 1), position and taken (its words), range-sorted by position.
    Documents of which it takes no copy go. A column of the input with one of these three names gives way to them."""
    plan = mixed(docs, **config).select("doc_id", "tie", "source", F.posexplode("positions").alias("copy", "position"), "size")
    # equal rows are alike: each has its own rows in the plan, so the plan is reduced to one of them first
    nth = F.row_number().over(Window.partitionBy("doc_id", "tie", "source", "copy").orderBy("position"))
    plan = plan.withColumn("nth", nth)
    names = [c for c in docs.columns if c not in ("copy", "position", "taken")]
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    id_, text, source = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text", "source"))
    inner = inner.withColumn("tie_", F.xxhash64(text))
    same = Window.partitionBy(id_, "tie_", source).orderBy("tie_")
    inner = inner.withColumn("nth_", F.row_number().over(same))
    out = inner.join(plan, id_.eqNullSafe(F.col("doc_id")) & (F.col("tie_") == F.col("tie")) & source.eqNullSafe(F.col("source")) & (F.col("nth_") == F.col("nth")))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), (F.col("copy") + 1).alias("copy"), "position", F.col("size").alias("taken")).orderBy("position", "doc_id", "copy")
