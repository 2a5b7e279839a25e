"""Token ids of documents in ORC: run-length encoded stripes, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlift.llm.common import columns

#: Settings of the ORC files: stripes of 8 MB, an index entry every 1,000 rows, a Bloom filter on the ids of documents.
ORC = {
    "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(8 << 20), "compression": "zstd"}
#: Bytes of text a file is made for; a text counts some bytes more than it has, so that empty ones count too.
FILE_BYTES, ROW_BYTES = 32 << 20, 64
#: Bytes of text that are encoded at once.
BATCH_BYTES = 1 << 20


class Encoder:
    """Ids of whole texts, as the tokenizer gives them, with each distinct piece of text encoded once.

    A byte-level tokenizer with its own regular expression always breaks at a space between two characters that are no white space: the space
    begins the next piece. In plain texts it also breaks between words and marks, and around line feeds. So a text is cut there and each piece is
    looked up. Pieces not known yet go through the tokenizer in one text, and its ids are dealt to them by the bytes they stand for; where
    these don't meet the ends of the pieces, each goes through alone. Tokenizers of another make, or with added tokens that reach over a
    space, get each text as a whole.
    """

    #: Pieces of a generation. The one before it is kept too: what is met again moves on, the rest goes with it.
    KEPT = 300_000
    CUT = re.compile(r"(?<=\S)(?= \S)")
    #: In a plain text: a word of letters and digits or a run of marks, with the space before it; line feeds, the last of several apart.
    FINE = re.compile(r" ?(?:[^\x00-/:-@\[-`{-\x7f]+|[!-/:-@\[-`{-~]+)|\n+\Z|\n+(?=\n)|\n")

    def __init__(self, path: str):
        self.tokenizer, self.known, self.before = Tokenizer.from_file(path), {}, {}
        made = json.loads(self.tokenizer.to_str())
        split = made["pre_tokenizer"] or {}
        added = made["added_tokens"]
        reaching = [a for a in added if " " in a["content"] or a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] and made["normalizer"]]
        self.in_pieces = made["normalizer"] is None and split.get("type") == "ByteLevel" and bool(split.get("use_regex")) and not split.get("add_prefix_space") and not reaching
        # an added token of letters and marks may begin with any of its characters, so none of these texts is plain
        self.added = [a["content"] for a in added]
        self.plain = {c: True for c in map(chr, (10, *range(32, 127))) if c != "'"}
        if self.in_pieces:
            # a character of a byte-level token stands for a byte
            lengths = {i: len(t) for t, i in self.tokenizer.get_vocab().items()} | {a["id"]: len(a["content"].encode()) for a in added}
            self.bytes_of = np.array([lengths.get(i, 0) for i in range(max(lengths) + 1)])

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        together = [p for p in new if p[0] == " " and not p[-1].isspace()]
        apart = [p for p in new if p[0] != " " or p[-1].isspace()]
        if together:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(together)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(np.fromiter((len(p.encode()) for p in together), np.int64, len(together)))
            reached = np.cumsum(self.bytes_of[ids])
            cuts = np.searchsorted(reached, ends)
            if cuts[-1] < len(ids) and (reached[cuts] == ends).all():
                data, cuts = ids.tobytes(), [0, *((cuts + 1) * 4).tolist()]
                self.known.update((p, data[a:b]) for p, a, b in zip(together, cuts, cuts[1:], strict=False))
            else:
                apart = new
        if apart:
            self.known.update(zip(apart, self._alone(apart), strict=True))

    def _is_plain(self, character: str) -> bool:
        """Letters, digits, marks, space and line feed are plain; whether another character is a letter, the tokenizer itself tells."""
        if character not in self.plain:
            self.plain[character] = character > "\x7f" and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{character}a")) == 1
        return self.plain[character]

    def _cut(self, text: str) -> list[str]:
        if (text[0] != " " != text[-1] and "  " not in text and " \n" not in text and "\n " not in text and all(map(self._is_plain, set(text)))
                and not any(a in text for a in self.added)):
            return self.FINE.findall(text)
        return self.CUT.split(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, without special tokens; null texts have none."""
        texts = [t or "" for t in texts]
        if not self.in_pieces:
            return self._alone(texts)
        if len(self.known) > self.KEPT:
            self.known, self.before = {}, self.known
        ends = [0]
        pieces: list[str] = []
        for text in texts:
            if text:
                pieces += self._cut(text)
            ends.append(len(pieces))
        found = list(map(self.known.get, pieces))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            new = {pieces[i] for i in missing}
            self.known.update((p, ids) for p in new if (ids := self.before.get(p)) is not None)
            self._learn([p for p in new if p not in self.known])
            for i in missing:
                found[i] = self.known[pieces[i]]
        return [b"".join(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    # a task has one core; threads of the library's own would only contend for those of other tasks
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def _slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows with at most `most` bytes each, a larger row alone."""
    start = end = held = 0
    for size in sizes:
        if held and held + size > most:
            yield start, end
            start, held = end, 0
        end, held = end + 1, held + size
    if end > start:
        yield start, end


def tokenized(rows: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, text) -> (doc_id, part, first, n_tokens, ids) in the order of the rows: `part` is the task, `first` the ids before it there."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).to_pylist()
            for a, b in _slices(sizes, BATCH_BYTES):
                data = [ids + end for ids in encoder.encode(batch.column("text").slice(a, b - a).to_pylist())]
                n = np.fromiter((len(d) // 4 for d in data), np.int64, b - a)
                ends = np.r_[0, np.cumsum(n)]
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<u4").astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(first + ends[:-1]), pa.array(n), ids],
                    ["doc_id", "part", "first", "n_tokens", "ids"])
                first += int(ends[-1])

    return rows.mapInArrow(encode, f"doc_id {kind}, part int, first long, n_tokens long, ids array<int>")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """Writes the token ids of all documents under `folder`, a range of ids to each file, ascending, null ids first.

    Texts are range-partitioned by doc_id, text hash and a row number, so that ids or whole rows that repeat spread over files; within a file
    documents ascend by doc_id and text. A task encodes and writes as it reads, whatever its size. The number of files follows the bytes of
    text, of which one pass takes the sum. Null and empty texts are documents of the end id alone; other columns are not looked at; an empty
    table leaves a table without rows.
    """
    rows = columns(docs, doc_id="doc_id", text="text")
    weight = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)
    files = 1 + int(rows.agg(weight).first()[0] or 0) // file_bytes
    spread = rows.withColumn("row", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(files, "doc_id", F.xxhash64("text"), "row").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    tokenized(ordered.select("doc_id", "text"), tokenizer, end_id).write.mode("overwrite").options(**ORC).orc(folder)


def read(spark: SparkSession, folder: str, kind: str = "bigint") -> DataFrame:
    """The table as written; a filter on doc_id reaches the stripe statistics, row indexes and Bloom filters."""
    return spark.read.schema(f"doc_id {kind}, part int, first long, n_tokens long, ids array<int>").orc(folder)


def starts(table: DataFrame) -> DataFrame:
    """(part, before): the ids in all files before one. Only the totals of the files, one row each, meet in a task."""
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("before"))


def digests(table: DataFrame) -> DataFrame:
    """The table -> (doc_id, start, n_tokens, ids_crc32), a row per document, from the ids that the files hold: stripes are read side by side."""
    kind = table.schema["doc_id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("first"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    found = table.mapInArrow(check, f"doc_id {kind}, part int, first long, n_tokens long, ids_crc32 long")
    return found.join(starts(table), "part").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def documents(table: DataFrame, ids: list) -> DataFrame:
    """The rows of some documents; files, stripes and row groups that cannot hold them are skipped by their metadata."""
    return table.where(F.col("doc_id").isin(ids))


def span(table: DataFrame, start: int, end: int) -> DataFrame:
    """The ids start to end (exclusive) of the whole sequence, as (start, ids) per document, for readers that take the corpus in equal parts."""
    placed = table.join(starts(table), "part").withColumn("start", F.col("before") + F.col("first"))
    inside = placed.where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start))
    low, high = F.greatest(F.lit(0), start - F.col("start")), F.least(F.col("n_tokens"), end - F.col("start"))
    return inside.select((F.col("start") + low).alias("start"), F.slice("ids", (low + 1).cast("int"), (high - low).cast("int")).alias("ids"))
