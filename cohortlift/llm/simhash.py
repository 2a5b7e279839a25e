"""SimHash near-duplicates found at the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.anchors import first_anchors, links_at
from cohortlift.llm.common import columns, stored
from cohortlift.llm.components import components

#: Fixed value: the seed of the shingle hash. Shingles voted on, and members compared, at a time.
SEED, VOTES, MEMBERS = 42, 1 << 15, 200_000


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle of `size` words, repeats included; fewer words: of the whole sequence; no words: nothing."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[i:j], SEED) for i, j in cuts), np.uint64, len(words) - size + 1)


def mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Another hash of the same shingle for each word of a wider fingerprint; word 0 is the hash itself."""
    if word:
        h = h ^ np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for times in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ h >> np.uint64(33)) * np.uint64(times)
        h = h ^ h >> np.uint64(33)
    return h


def fingerprint(text: str | None, size: int = 4, words: int = 1) -> bytes:
    """64 bits a word, big-endian; a bit is 1 if it is set in over half the shingle hashes."""
    h, out = shingle_hashes(text, size), []
    for word in range(words):
        votes = np.zeros(64, np.int64)
        for i in range(0, len(h), VOTES):
            part = mixed(h[i : i + VOTES], word).astype(">u8")
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out.append(np.packbits(2 * votes > len(h)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, size: int = 4, words: int = 1) -> DataFrame:
    """documents -> (doc_id, tie, print binary), one row per row; tie tells texts of rows that repeat an id apart."""

    @F.pandas_udf("binary")
    def printed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, size, words))

    return columns(docs, doc_id="doc_id", text="text").select("doc_id", F.xxhash64("text").alias("tie"), printed("text").alias("print"))


def _as_words(column: pa.ChunkedArray | pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, words)


def links(prints: DataFrame, words: int = 1, threshold: int = 4, total: int | None = None) -> DataFrame:
    """Distinct fingerprints (print) -> (a, b): links that join all prints linked directly or in steps, without the circles at an anchor.

    Each print goes to its first anchors (block A and B, see anchors.py); the second block is spread out where they meet, so one row travels
    for many anchor pairs. Only rows of one key are in memory at a time (several small ones together); there is no limit on their number.
    """
    limit = 64 * words if total is None else total

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.column("print").slice(i, 2000)
                row, key = first_anchors(_as_words(part, words), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), part.take(pa.array(row))], ["key", "print"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            pairs = links_at(keys, values, threshold, limit)
            sides = [[x.tobytes() for x in values[pairs[:, k]].astype(">u8")] for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in sides], ["a", "b"])

        held_keys, held, n = [], [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            values = _as_words(batch.column("print"), words)
            held_keys.append(keys)
            held.append(values)
            n += len(keys)
            if n >= MEMBERS and keys[-1] != held_keys[0][0]:
                keys, values = np.concatenate(held_keys), np.concatenate(held)
                cut = int(np.searchsorted(keys, keys[-1]))
                yield emit(keys[:cut], values[:cut])
                held_keys, held, n = [keys[cut:]], [values[cut:]], len(keys) - cut
        if n:
            yield emit(np.concatenate(held_keys), np.concatenate(held))

    met = prints.select("print").mapInArrow(spread, "key long, print binary")
    met = met.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(compare, "a binary, b binary")


def _labelled(rows: DataFrame, words: int, threshold: int, total: int | None) -> DataFrame:
    """(doc_id, tie, print) -> (print, label) of each distinct print; equal labels are reachable over links."""
    nodes = rows.select("print").distinct()
    labels = components(links(nodes, words, threshold, total))
    return nodes.join(labels, nodes["print"] == labels["node"], "left").select("print", F.coalesce("label", "print").alias("label"))


def near_duplicates(docs: DataFrame, size: int = 4, words: int = 1, threshold: int = 4, total: int | None = None) -> DataFrame:
    """documents -> (doc_id, print, component_id): one row per row; component_id is the smallest doc_id of those reachable over links.

    Equal fingerprints are one node, so copies never meet in pairs. Nulls and empty texts have fingerprint zero and link like any other;
    a null doc_id is a document too, but names a component only if all of it have none (null). Rows that repeat an id stay apart, each
    judged by its own text. An empty table gives no rows. Columns other than doc_id and text are not looked at.
    """
    rows = stored(fingerprints(docs, size, words))
    firsts = rows.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    labelled = stored(firsts.join(_labelled(rows, words, threshold, total), "print"))
    heads = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return rows.join(labelled.join(heads, "label").select("print", "component_id"), "print").select("doc_id", "print", "component_id")


def one_of_each(docs: DataFrame, size: int = 5, words: int = 3, threshold: int = 7, total: int | None = 39) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id stays (null last), of rows with equal id the
    one with the smallest text hash, of equal rows one. All columns of the input stay as they are."""
    rows = stored(fingerprints(docs, size, words))
    labelled = _labelled(rows, words, threshold, total)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    firsts = rows.groupBy("print").agg(F.min(rank).alias("first")).join(labelled, "print")
    heads = firsts.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("head"), F.col("first.tie").alias("head_tie"))
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    kept = inner.withColumn("tie", F.xxhash64(text)).join(heads, id_.eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie")), "left_semi")
    equal_rows = Window.partitionBy(id_, "tie").orderBy("tie")
    return kept.withColumn("nth", F.row_number().over(equal_rows)).where("nth = 1").select(*inner.columns).toDF(*docs.columns)
