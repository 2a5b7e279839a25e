"""Ranked lexical search: the exact best documents of each item, over posting lists blocked by the similarity of their documents.

Documents are searched in shards, one after another in each task. In a shard the posting list of a term is split into blocks of similar documents
(recursive halving in a space of random projections); a block keeps the coordinatewise maximum of its documents' vectors. No document of a block
scores more than the block's summary does, so a block is skipped once that bound lies below the k-th best score found, and only then.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortlift.llm.common import ascii_lower, columns, stored

#: Terms in Spark, and the same over the UTF-8 bytes of a lower-cased text.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rows (item, term) of a block of items, which each task holds; postings of a shard; documents of a block of a posting list.
ITEM_ROWS, SHARD_POSTINGS, BLOCK = 200_000, 1_000_000, 32
PROJECTIONS = 8


@dataclass
class Items:
    """A block of items: the terms of each, numbered from 1 in order, and what the documents say about these."""

    ids: list
    terms: list[np.ndarray]
    number: dict[bytes, int]
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_documents: int = 0
    n_terms: int = 0

    def weigh(self, n_documents: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_documents, self.n_terms = n_documents, n_terms
        self.weight = np.zeros(len(self.number) + 1, np.int64)
        for term, n in df.items():
            self.weight[term] = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * n + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """items -> (item_id, term), each once; rows with the same item_id are one item."""
    rows = columns(items, item_id="item_id", text="text").where("text IS NOT NULL")
    return rows.select("item_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("term")).distinct()


def blocks_of_items(items: DataFrame, rows: int = ITEM_ROWS) -> Iterator[Items]:
    """Items in blocks of about `rows` rows, by the hash of their id; one block at a time passes through the driver."""
    wanted = stored(item_terms(items))
    n = 1 + wanted.count() // rows
    for block in range(n):
        table = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block).orderBy("item_id", "term").toArrow()
        if not table.num_rows:
            continue
        number: dict[bytes, int] = {}
        of_item: dict = {}
        for item_id, term in zip(table["item_id"].to_pylist(), table["term"].to_pylist(), strict=True):
            of_item.setdefault(item_id, []).append(number.setdefault(term.encode(), len(number) + 1))
        yield Items(list(of_item), [np.array(sorted(t)) for t in of_item.values()], number)


def forward(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of terms of each document, and which of the items' terms it holds how often."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(items.number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                words = TERM_BYTES.findall((text.as_py() or b"").lower())
                held = sorted(Counter(filter(None, map(number, words))).items())
                n.append(len(words))
                terms.extend(t for t, _ in held)
                tfs.extend(c for _, c in held)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = columns(docs, doc_id="doc_id", text="text").withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of several ranges, one after another."""
    return np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())


def cells(x: np.ndarray, docs: np.ndarray, size: int) -> list[np.ndarray]:
    """docs in cells of `size` at most: halved at the median of the coordinate with the widest range, again and again."""
    out, left = [], [docs]
    while left:
        part = left.pop()
        if len(part) <= size:
            out.append(part)
            continue
        v = x[part]
        half = len(part) // 2
        order = np.argpartition(v[:, np.argmax(v.max(0) - v.min(0))], half)
        left += [part[order[half:]], part[order[:half]]]
    return out


class Shard:
    """The index of some documents, each with one posting at least."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, items: Items, block: int = BLOCK):
        self.items, self.block, self.scored = items, block, 0
        # whole numbers of any length: n * N may pass 64 bits
        m = np.array([10 + 90 * int(x) * items.n_documents // items.n_terms for x in n], np.int64)
        doc_of = np.repeat(np.arange(len(n)), sizes)
        tf = tfs.astype(np.int64)
        self.starts, self.sizes, self.terms = np.r_[0, np.cumsum(sizes)[:-1]], sizes, terms
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc_of])
        order = np.argsort(terms, kind="stable")
        self.posted, self.first = doc_of[order], np.searchsorted(terms[order], np.arange(len(items.weight) + 1))
        self.top = np.zeros(len(items.weight), np.int64)
        np.maximum.at(self.top, terms, self.impact)
        value = (items.weight[terms] * self.impact).astype(np.float64)
        axes = np.random.default_rng(1).normal(size=(PROJECTIONS, len(items.weight)))
        length = np.sqrt(np.add.reduceat(value * value, self.starts)) + 1
        self.x = np.stack([np.add.reduceat(value * axis[terms], self.starts) / length for axis in axes], axis=1)
        self.lists: dict[int, tuple] = {}

    def postings(self, term: int) -> tuple:
        """The blocks of a posting list and their summaries, made when the list is first asked for: (blocks, keys, maxima), where key
        block * terms + coordinate has the largest impact of that coordinate in the block."""
        if term not in self.lists:
            blocks = cells(self.x, self.posted[self.first[term] : self.first[term + 1]], self.block)
            docs = np.concatenate(blocks)
            at = _spread(self.starts[docs], self.sizes[docs])
            block_of = np.repeat(np.repeat(np.arange(len(blocks)), [len(b) for b in blocks]), self.sizes[docs])
            keys = block_of * len(self.items.weight) + self.terms[at]
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.lists[term] = (blocks, keys[new], np.maximum.reduceat(self.impact[at][order], new))
        return self.lists[term]

    def bounds(self, term: int, wanted: np.ndarray) -> np.ndarray:
        """What a document of each block scores at most for the wanted terms."""
        blocks, keys, maxima = self.postings(term)
        asked = np.arange(len(blocks))[:, None] * len(self.items.weight) + wanted[None, :]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return (np.where(keys[at] == asked, maxima[at], 0) * self.items.weight[wanted]).sum(1)

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        at = _spread(self.starts[docs], self.sizes[docs])
        self.scored += len(docs)
        return np.add.reduceat(weight[self.terms[at]] * self.impact[at], np.r_[0, np.cumsum(self.sizes[docs])[:-1]])

    def search(self, item: int, best: Best) -> None:
        """Adds the documents of this shard to the best of an item.

        Terms go from the one that can add most to the least; what documents without the terms done can score at most is the sum of the rest,
        and when that is below the k-th best score, all that can enter has been seen. Equal scores count, so ties are decided by id alone.
        """
        wanted = self.items.terms[item]
        wanted = wanted[(self.top[wanted] > 0) & (self.items.weight[wanted] > 0)]
        most = self.items.weight[wanted] * self.top[wanted]
        order = np.argsort(-most, kind="stable")
        rest = np.cumsum(most[order][::-1])[::-1]
        weight = np.zeros(len(self.items.weight), np.int64)
        weight[wanted] = self.items.weight[wanted]
        seen = np.zeros(len(self.sizes), bool)
        for term, left in zip(wanted[order], rest, strict=True):
            if left < best.least:
                return
            blocks, bounds = self.postings(int(term))[0], self.bounds(int(term), wanted)
            ranked = np.argsort(-bounds, kind="stable")
            at, step = 0, 1
            while at < len(ranked) and bounds[ranked[at]] >= best.least:
                chosen = [blocks[b] for b in ranked[at : at + step] if bounds[b] >= best.least]
                docs = np.concatenate(chosen)
                docs = docs[~seen[docs]]
                seen[docs] = True
                if len(docs):
                    best.add(docs, self.scores(docs, weight))
                at, step = at + step, step * 2


class Best:
    """The k best of one item so far: highest scores first, equal ones by id, a null id before others."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.ids = k, [], 1, []

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.least
        docs, scores = docs[keep], scores[keep]
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, -self.k)[-self.k]
            docs, scores = docs[keep], scores[keep]
        new = [(-int(s), (i is not None, 0 if i is None else i)) for s, i in zip(scores, map(self.ids.__getitem__, docs), strict=True)]
        self.rows = sorted(self.rows + new)[: self.k]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _search(vectors: DataFrame, items: Items, k: int, item_type, shard_postings: int) -> DataFrame:
    """The best documents of every task for every item: (item_id, doc_id, score)."""
    sent = vectors.sparkSession.sparkContext.broadcast(items)
    doc_type = vectors.schema["doc_id"].dataType
    types = [to_arrow_type(t) for t in (item_type, doc_type)]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        best = [Best(k) for _ in items.ids]
        held, n = [], 0

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            parts = [table[c].chunk(0) for c in ("terms", "tfs")]
            shard = Shard(table["n"].to_numpy(), np.diff(parts[0].offsets.to_numpy()).astype(np.int64), *(p.values.to_numpy() for p in parts), items)
            ids = table["doc_id"].to_pylist()
            for item, b in enumerate(best):
                b.ids = ids
                shard.search(item, b)

        for batch in batches:
            held.append(batch)
            n += len(batch.column("terms").flatten())
            if n >= shard_postings:
                flush()
                held, n = [], 0
        if n:
            flush()
        out = [(i, doc, -s) for i, b in zip(items.ids, best, strict=True) for s, (known, doc) in [(s, (d[0], d[1] if d[0] else None)) for s, d in b.rows]]
        if out:
            item_ids, docs, scores = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item_ids, types[0]), pa.array(docs, types[1]), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    return vectors.mapInArrow(find, f"item_id {item_type.simpleString()}, doc_id {doc_type.simpleString()}, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, item_rows: int = ITEM_ROWS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its k best documents with a score above 0, equal scores by ascending doc_id.

    All counts are of all documents. Each task searches its documents in shards of bounded size and hands over k rows an item, so no text, list
    or term is shuffled and no key can be hot. Null texts have no terms; items without any, or whose terms no document holds, have no rows; rows
    with the same item_id are one item; repeated documents are documents each, a null doc_id comes before others; other columns are not looked
    at; empty tables give no rows. Items beyond `item_rows` terms are searched in several rounds over the documents.
    """
    doc_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    found = docs.sparkSession.createDataFrame([], f"item_id {item_type.simpleString()}, doc_id {doc_type.simpleString()}, score long")
    for block in blocks_of_items(items, item_rows):
        vectors = stored(forward(docs, block))
        n_documents, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_documents:
            break
        df = vectors.select(F.explode("terms").alias("t")).groupBy("t").count()
        block.weigh(n_documents, n_terms, {r.t: r["count"] for r in df.collect()})
        found = found.unionByName(_search(vectors.where(F.size("terms") > 0), block, k, item_type, shard_postings))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
