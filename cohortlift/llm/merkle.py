"""A Merkle manifest of a dataset: trees per source, one tree over their roots, and a proof for every document.

Leaves are reduced in superblocks of FAN ** LEVELS neighbours. Going up, each superblock becomes one node of the next tier, until a source has one
node and all sources one root. Going down, the nodes of a tier are cogrouped by superblock with the outer nodes that their proofs still need (the
siblings on the way from the superblock to the root), so one task finishes the local reduction, joins the proofs and folds them.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.common import ascii_lower, columns, stored

FAN, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ranges that number their rows apart: so many at least, and one more for each million rows.
RANGES, RANGE_ROWS = 32, 1_000_000


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    """'-' for null, else the number of UTF-8 bytes, ':' and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    return F.sha2(F.concat(*(_field(changed.get(f, F.col(f))) for f in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, other): other is the leaf of a document that was tampered with. tree is '' for a null source, else '=' and the source,
    so trees sort as sources do, null first. A document is tampered with where 5 divides the crc32 of its decimal id (never a null one): the
    letters A-Z of its text are lower-cased, nothing else."""
    rows = columns(docs, **{f: f for f in FIELDS})
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return rows.withColumn("leaf", leaf_of()).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), "doc_id", "leaf",
        F.when(hit, leaf_of(text=ascii_lower(F.col("text")))).otherwise(F.col("leaf")).alias("other"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows -> and at (from 0) and size: the place of each row in its tree by `order`, and the rows of the tree.

    Ranges of (tree, order) are numbered apart and moved by the counts of the ranges before, so a tree of any size is spread over tasks. Equal
    rows are told apart by a number of their own, which also splits them over ranges.
    """
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    placed = rows.repartitionByRange(RANGES + rows.count() // RANGE_ROWS, "tree", *order, "row").withColumn("range", F.spark_partition_id())
    within = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order, "row"))
    placed = stored(placed.withColumn("within", within.cast("long")))
    counts = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("tree", "range", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(tree).alias("size"))
    return placed.join(counts, ["tree", "range"]).withColumn("at", F.col("before") + F.col("within") - 1).drop("row", "range", "within", "before")


def _local(nodes: list[str], size: int, depth: int) -> list[list[str]]:
    """The levels of one superblock from its nodes up. In a tree of one superblock the way up ends at a single node, else after `depth` levels."""
    whole = size <= FAN**depth
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= depth:
        last = levels[-1]
        levels.append([digest(last[i : i + FAN]) for i in range(0, len(last), FAN)])
    return levels


def _blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / FAN**depth))


def _up(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, at, size, node) of a tier -> the same of the next one: a node per superblock."""

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        size = int(rows["size"].iloc[0])
        node = _local(rows["node"].tolist(), size, depth)[-1][0]
        return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "at": [rows["block"].iloc[0]], "size": [-(-size // FAN**depth)], "node": [node]})

    return _blocks(nodes, depth).groupBy("tree", "block").applyInPandas(top, "tree string, at long, size long, node string")


#: An outer node: the siblings of level `level` above its superblock (tree, block); the superblock's own node stands at `place` among them.
OUTER = "tree string, block long, level int, place int, others array<string>"


def _paths(nodes: list[str], size: int, outer: pd.DataFrame, depth: int) -> list[list[tuple[int, list[str]]]]:
    """For each node of a superblock, its (place, others) level by level, through the outer nodes to the root."""
    levels = _local(nodes, size, depth)
    above = [(int(p), list(o)) for p, o in outer.sort_values("level")[["place", "others"]].itertuples(index=False)]
    paths = []
    for i in range(len(nodes)):
        path = []
        for height, level in enumerate(levels[:-1]):
            k = i // FAN**height
            run = level[k // FAN * FAN : k // FAN * FAN + FAN]
            path.append((k % FAN, run[: k % FAN] + run[k % FAN + 1 :]))
        paths.append(path + above)
    return paths


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf leads to with the siblings of its path."""
    for place, others in path:
        leaf = digest([*others[:place], leaf, *others[place:]])
    return leaf


def _down(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The outer nodes of the tier below: for each node (a superblock there) the siblings from it to the root."""

    def exchange(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        paths = _paths(rows["node"].tolist(), int(rows["size"].iloc[0]), above, depth) if len(rows) else []
        out = [(t, a, n, p, o) for t, a, path in zip(rows["below"], rows["at_below"], paths, strict=True) for n, (p, o) in enumerate(path)]
        return pd.DataFrame(out, columns=["tree", "block", "level", "place", "others"])

    by = ["tree", "block"]
    return _blocks(nodes, depth).groupBy(*by).cogroup(outer.groupBy(*by)).applyInPandas(exchange, OUTER)


def manifest(docs: DataFrame, depth: int = LEVELS) -> DataFrame:
    """documents -> (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row per row.

    Per source (null first, then by bytes) leaves ascend by doc_id, null ids first, equal ids by leaf; rows that repeat are leaves each. Nulls
    and empty texts are hashed as such; other columns are not looked at; no rows: no rows. Superblocks hold FAN ** depth (4,096) nodes at most, and an outer
    node 15 digests, so no group grows with the data; ranges of a tree are numbered apart, so neither a hot source nor repeated rows gather.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = stored(numbered(leaves(docs), ["doc_id", "leaf"]))
    tiers = [base.select("tree", "at", "size", F.col("leaf").alias("node"))]
    most = base.agg(F.max("size")).first()[0]
    if most is None:
        return base.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    while True:
        tiers.append(stored(_up(tiers[-1], depth)))
        most = -(-most // FAN**depth)
        if most == 1:
            break
    # the last tier holds the root of each source; these are the nodes of one tree more
    subroots = tiers.pop().select("tree", F.col("node").alias("subroot"))
    over = stored(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("subroot").alias("node")), ["source_tree"]))
    upper = [over.select("tree", "at", "size", "node")]
    most = over.agg(F.max("size")).first()[0]
    while most > 1:
        upper.append(stored(_up(upper[-1], depth)))
        most = -(-most // FAN**depth)
    root = upper[-1].first()["node"]
    outer = base.sparkSession.createDataFrame([], OUTER)
    for tier in reversed(upper[1:-1] if len(upper) > 1 else []):
        outer = stored(_down(tier.withColumns({"below": F.col("tree"), "at_below": F.col("at")}), outer, depth))
    outer = stored(_down(over.withColumns({"below": F.col("source_tree"), "at_below": F.lit(0).cast("long")}), outer, depth))
    for tier in reversed(tiers[1:]):
        outer = stored(_down(tier.withColumns({"below": F.col("tree"), "at_below": F.col("at")}), outer, depth))

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        paths = _paths(rows["leaf"].tolist(), int(rows["size"].iloc[0]), above, depth) if len(rows) else []
        folded = [fold(leaf, path) for leaf, path in zip(rows["other"], paths, strict=True)]
        proofs = [digest(o for _, others in path for o in others) for path in paths]
        return pd.DataFrame({
            "tree": rows["tree"], "doc_id": rows["doc_id"], "leaf": rows["leaf"], "proof_sha256": proofs, "folded_root": folded, "root": root,
            "verified": [f == root for f in folded]})

    by = ["tree", "block"]
    done = _blocks(base, depth).groupBy(*by).cogroup(outer.groupBy(*by)).applyInPandas(
        finish, f"tree string, doc_id {kind}, leaf string, proof_sha256 string, folded_root string, root string, verified boolean")
    return done.join(subroots, "tree").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
