"""Benchmark decontamination: an FM-index per training shard, searched for the windows of the benchmark items."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.common import columns
from cohortlift.llm.fmindex import FMIndex

#: Words are runs of these bytes of UTF-8 (digits, letters, all beyond ASCII); BYTES makes others spaces and A-Z small.
WORDS = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
BYTES = bytes(b if WORDS.match(bytes([b])) else 32 for b in range(256)).lower()
WINDOW = 10
#: Words of a shard that are indexed at once (a longer document is one shard), and characters of items that are searched for at once.
SHARD, BLOCK = 1 << 18, 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(BYTES).split() if text else []


class Phrases:
    """The windows of a block of benchmark items, by length, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        by_words: dict[tuple[bytes, ...], set[str | None]] = {}
        for name, text in items:
            w = words_of(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                by_words.setdefault(tuple(w[i : i + window]), set()).add(name)
        self.vocabulary: dict[bytes, int] = {}
        self.lengths = []
        for n in sorted({len(k) for k in by_words}):
            rows = sorted(k for k in by_words if len(k) == n)
            ids = np.array([[self.vocabulary.setdefault(x, len(self.vocabulary)) for x in k] for k in rows])
            self.lengths.append((n, ids, [by_words[k] for k in rows]))


def _shard_hits(docs: list[list[bytes]], phrases: Phrases) -> tuple[list[np.ndarray], list[set[str | None]]]:
    """Per document of a shard: which of its words are hit, and the items found."""
    # 1 ends a document; words count from 2
    symbols: defaultdict[bytes, int] = defaultdict()
    symbols.default_factory = lambda: len(symbols) + 2
    sizes = np.array([len(w) for w in docs])
    text = np.ones(int(sizes.sum()) + len(docs), np.int64)
    starts = np.r_[0, np.cumsum(sizes + 1)]
    for w, s in zip(docs, starts, strict=False):
        text[s : s + len(w)] = [symbols[x] for x in w]
    index = FMIndex(text, len(symbols) + 2)
    known = np.array([symbols.get(w, -1) for w in phrases.vocabulary], np.int64)
    edges, items = np.zeros(len(text) + 1, np.int64), [set() for _ in docs]
    for length, ids, names in phrases.lengths:
        low, high = index.search(known[ids])
        phrase = np.repeat(np.arange(len(ids)), high - low)
        if not len(phrase):
            continue
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[phrase]
        at = index.locate(rows)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        pairs = np.unique((np.searchsorted(starts, at, "right") - 1) * len(ids) + phrase)
        for d, p in zip((pairs // len(ids)).tolist(), (pairs % len(ids)).tolist(), strict=True):
            items[d] |= names[p]
    covered = np.cumsum(edges[:-1]) > 0
    return [covered[s : s + n] for s, n in zip(starts, sizes, strict=False)], items


def _spans(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs, in turn."""
    return np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))).tolist()


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items one by one from the cluster, in blocks of bounded size."""
    rows, held = [], 0
    for name, text in columns(benchmark, item_id="item_id", text="text").select(F.col("item_id").cast("string"), "text").distinct().toLocalIterator():
        rows.append((name, text))
        held += len(text or "") + 20
        if held > block:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """documents, benchmark -> (doc_id, tie, n_words, spans, items): a row per row of documents.

    spans has starts and ends (exclusive) of the runs of hit words, in turn; items the ids found, sorted as strings. A task indexes its
    documents shard by shard and searches for all windows of a block of items at once; the block travels to the tasks, `block` characters at
    most (or one longer item). Several blocks take a scan each, and their spans and items are merged. Null and empty texts have no words and
    no hits, items without words find nothing, an item without id hits words but has no name; rows that repeat an id are judged by their
    own text; an empty benchmark leaves all documents clean.
    """
    spark = docs.sparkSession
    rows = columns(docs, doc_id="doc_id", text="text").select("doc_id", F.xxhash64("text").alias("tie"), "text")
    schema = "doc_id long, tie long, n_words long, spans array<int>, items array<string>"
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))

    def scan(items: list[tuple[str | None, str | None]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = Phrases(sent.value, window)

            def emit(held: list[tuple]) -> pa.RecordBatch:
                covered, found = _shard_hits([w for _, _, w in held], phrases)
                return pa.RecordBatch.from_arrays([
                    pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), pa.array([len(h[2]) for h in held], pa.int64()),
                    pa.array([_spans(c) for c in covered], pa.list_(pa.int32())), pa.array([sorted(x for x in f if x is not None) for f in found], pa.list_(pa.string()))],
                    ["doc_id", "tie", "n_words", "spans", "items"])

            held, n = [], 0
            for batch in batches:
                for id_, tie, text in zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), batch.column("text"), strict=True):
                    held.append((id_, tie, words_of(text.as_py())))
                    n += len(held[-1][2]) + 1
                    if n >= SHARD:
                        yield emit(held)
                        held, n = [], 0
            if held:
                yield emit(held)

        return rows.mapInArrow(search, schema)

    scans = [scan(items) for items in _blocks(benchmark, block)] or [scan([])]
    if len(scans) == 1:
        return scans[0]
    # rows equal in id and text have equal hits, so they are told apart by number only
    nth = F.row_number().over(Window.partitionBy("doc_id", "tie").orderBy("tie"))
    parts = None
    for s in scans:
        s = s.withColumn("nth", nth)
        parts = s if parts is None else parts.unionByName(s)
    merged = parts.groupBy("doc_id", "tie", "nth").agg(F.first("n_words").alias("n_words"), F.collect_list("spans").alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.withColumn("spans", F.pandas_udf(_union, "array<int>")(F.col("s"))).select("doc_id", "tie", "n_words", "spans", "items")


def _union(lists: pd.Series) -> pd.Series:
    """Spans of several blocks -> the runs of words that any of them covers."""

    def one(spans) -> list[int]:
        edges = np.zeros(max((int(s[-1]) for s in spans if len(s)), default=0) + 1, np.int64)
        for s in spans:
            np.add.at(edges, np.asarray(s, int)[::2], 1)
            np.add.at(edges, np.asarray(s, int)[1::2], -1)
        return _spans(np.cumsum(edges[:-1]) > 0)

    return lists.map(one)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """hits() in digest: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans)."""
    found = hits(docs, benchmark, window, block)
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with the hit passages cut out: each run of hit words goes with what stands between its words. Documents without hits stay
    byte for byte; one of which no word is left goes. n_chars, where there, follows the text."""
    sent_blocks = [docs.sparkSession.sparkContext.broadcast(items) for items in _blocks(benchmark, BLOCK)]
    schema = docs.schema
    text_at, id_names = docs.columns.index("text"), docs.columns
    chars_at = id_names.index("n_chars") if "n_chars" in id_names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Phrases(s.value, window) for s in sent_blocks]

        def emit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table.column(text_at).to_pylist()
            words = [words_of(t) for t in texts]
            hit = [np.zeros(len(w), bool) for w in words]
            for phrases in known:
                hit = [a | b for a, b in zip(hit, _shard_hits(words, phrases)[0], strict=True)]
            stays = np.ones(len(texts), bool)
            for i in [i for i, h in enumerate(hit) if h.any()]:
                raw = texts[i].encode("utf-8", "replace")
                where = [m.span() for m in WORDS.finditer(raw)]
                runs = _spans(hit[i])
                keep, last = [], 0
                for a, b in zip(runs[::2], runs[1::2], strict=True):
                    keep.append(raw[last : where[a][0]])
                    last = where[b - 1][1]
                texts[i] = b"".join([*keep, raw[last:]]).decode()
                stays[i] = not hit[i].all()
            table = table.set_column(text_at, table.schema.field(text_at), pa.array(texts, table.schema.field(text_at).type))
            if chars_at is not None:
                old = table.column(chars_at).to_pylist()
                new = [len(t) if h.any() else n for t, h, n in zip(texts, hit, old, strict=True)]
                table = table.set_column(chars_at, table.schema.field(chars_at), pa.array(new, table.schema.field(chars_at).type))
            yield from table.filter(pa.array(stays)).to_batches()

        held, n = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(batch.slice(i, 1))
                n += len(batch.column(text_at)[i].as_py() or "") // 6 + 1
                if n >= SHARD:
                    yield from emit(held)
                    held, n = [], 0
        if held:
            yield from emit(held)

    return docs.mapInArrow(cut, schema)
