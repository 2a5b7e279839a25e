"""Toxicity: subword-bag embeddings, averaged over a passage, under a linear softmax; trained jointly in numpy."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import columns, stored

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """sample: labelled rows of each class that training sees, in expectation. Everything is scored."""

    sample: int = 3000
    buckets: int = 1 << 17
    dimensions: int = 8
    shortest: int = 3
    longest: int = 5
    passage: int = 8
    mean_rounds: int = 60
    rounds: int = 200
    rate: float = 1.0
    memory: float = 0.98
    clean: float = 0.6
    least_documents: int = 3
    seed: int = 7


def subwords(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of each word itself and of each of its character n-grams, with < and > at its ends."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in marked), np.uint64, len(marked))
    words_of, grams = [np.arange(len(marked))], [whole]
    for n in range(s.shortest, s.longest + 1):
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + points[at + k]
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        words_of.append(owner[at])
        grams.append(h ^ h >> np.uint64(32))
    return np.concatenate(words_of), (np.concatenate(grams) % np.uint64(s.buckets)).astype(np.int64)


def words_in(text: str | None) -> list[str]:
    """The lower-case words of a whole text, in order."""
    return WORD.findall(text.lower()) if text else []


def train(texts: list[str | None], toxic: np.ndarray, s: Settings) -> np.ndarray:
    """-> one weight a bucket and last the bias: log-odds of toxic per unit of a passage's averaged bag.

    A passage is `passage` words in a row; its vector is the mean over words of the mean of their subword embeddings, its class the softmax of
    a linear layer. Words of fewer than `least_documents` documents of the sample take no part in training. A document is read through its most toxic passage (in the first rounds through the mean of all, until there is something
    to choose by). Embeddings and layer are learnt together by Adam over all documents of the sample; classes count alike.
    """
    rng = np.random.default_rng(s.seed)
    in_documents = Counter(w for text in texts for w in set(words_in(text)))
    number: dict[str, int] = {}
    tokens, owner, sizes = [], [], []
    for d, text in enumerate(texts):
        words = [w for w in words_in(text) if in_documents[w] >= s.least_documents]
        for i in range(0, len(words), s.passage):
            part = words[i : i + s.passage]
            tokens.extend(number.setdefault(w, len(number)) for w in part)
            owner.append(d)
            sizes.append(len(part))
    word_of, ids = subwords(list(number), s)
    bag_sizes = np.bincount(word_of, minlength=len(number))
    tokens, owner, sizes = np.array(tokens, np.int64), np.array(owner, np.int64), np.array(sizes, np.int64)
    passage_of = np.repeat(np.arange(len(sizes)), sizes)
    y = toxic.astype(bool)
    weight = np.where(y, (1 - s.clean) / max(1, y.sum()), s.clean / max(1, (~y).sum()))
    embedding = rng.normal(0, 0.1, (s.buckets, s.dimensions))
    layer, bias = rng.normal(0, 0.3, (s.dimensions, 2)), np.zeros(2)
    state = [[np.zeros_like(p), np.zeros(1)] for p in (embedding, layer, bias)]
    first_of = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    n_passages = np.bincount(owner, minlength=len(texts))
    for step in range(1, s.rounds + 1):
        scalar = embedding @ (layer[:, 1] - layer[:, 0])
        word = np.bincount(word_of, scalar[ids], len(number)) / np.maximum(bag_sizes, 1)
        odds = np.bincount(passage_of, word[tokens], len(sizes)) / np.maximum(sizes, 1) + bias[1] - bias[0]
        if step <= s.mean_rounds:
            share = 1.0 / n_passages[owner]
        else:
            top = np.maximum.reduceat(odds, first_of) if len(odds) else odds
            best = odds >= np.repeat(top, n_passages[n_passages > 0])
            share = best / np.bincount(owner, best, len(texts))[owner]
        pooled = np.bincount(owner, odds * share, len(texts))
        error = (1 / (1 + np.exp(-np.clip(pooled, -50, 50))) - y) * weight
        error[n_passages == 0] = 0
        each = error[owner] * share / np.maximum(sizes, 1)
        on_word = np.bincount(tokens, each[passage_of], len(number)) / np.maximum(bag_sizes, 1)
        on_bucket = np.bincount(ids, on_word[word_of], s.buckets)
        # the two classes of a softmax pull in opposite directions
        pull = np.array([-1.0, 1.0])
        grads = (np.outer(on_bucket, layer @ pull), np.outer(embedding.T @ on_bucket, pull), error.sum() * pull)
        for p, g, (m, v) in zip((embedding, layer, bias), grads, state, strict=True):
            m += 0.1 * (g - m)
            v[...] = max(s.memory * v.flat[0], np.abs(g).max())
            p -= s.rate * m / (1 - 0.9**step) / (v + 1e-12)
    return np.r_[embedding @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]]


class Scorer:
    """Probability of toxic of the most toxic passage. The means of words met are kept, a bounded number of them."""

    KEPT = 300_000

    def __init__(self, weights: np.ndarray, s: Settings):
        self.weights, self.bias, self.s, self.known = weights[:-1], float(weights[-1]), s, {}

    def learn(self, words: list[str]) -> None:
        if new := list({w for w in words if w not in self.known}):
            if len(self.known) > self.KEPT:
                self.known.clear()
                new = list(set(words))
            word_of, ids = subwords(new, self.s)
            means = np.bincount(word_of, self.weights[ids]) / np.bincount(word_of)
            self.known.update(zip(new, means.tolist(), strict=True))

    def score(self, text: str | None) -> float:
        words = words_in(text)
        if not words:
            return float(1 / (1 + np.exp(-np.clip(min(self.bias, 0.0), -50, 0))))
        self.learn(words)
        values = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        at = np.arange(0, len(values), self.s.passage)
        means = np.add.reduceat(values, at) / np.diff(np.r_[at, len(values)])
        return float(1 / (1 + np.exp(-np.clip(means.max() + self.bias, -50, 50))))


def is_held_out():
    """crc32 of the id as text, modulo 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """Weights from labelled rows that are not held out. Of each class about `sample` rows take part, chosen by hash of the id; they meet in one
    task, which returns `buckets` + 1 numbers. Rows without a label, or with a null one, take no part; without any row all weights are 0."""
    labelled = columns(labels, doc_id="doc_id", toxic="toxic").where("doc_id is not null and toxic is not null").where(~is_held_out())
    labelled = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = dict(labelled.groupBy("toxic").count().collect())
    draw = F.xxhash64("doc_id", F.lit(s.seed)).cast("double") / float(1 << 64) + 0.5
    share = F.lit(0.0)
    for label, rows in n.items():
        share = F.when(F.col("toxic") == label, min(1.0, s.sample / rows)).otherwise(share)
    chosen = stored(labelled.where(draw <= share))
    # about `sample` ids a class: with that many the texts stay where they are, else (never yet seen) the join shuffles
    few = chosen.count() <= 2 * s.sample * max(1, len(n))
    sample = columns(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen) if few else chosen, "doc_id")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"], na_position="first")
        weights = train(rows["text"].tolist(), rows["toxic"].to_numpy(), s)
        at = np.flatnonzero(weights)
        return pd.DataFrame({"at": at, "weight": weights[at]})

    weights = np.zeros(s.buckets + 1)
    found = sample.select("doc_id", "text", "toxic").groupBy(F.lit(0).alias("all")).applyInPandas(learn, "at long, weight double").toPandas()
    weights[found["at"].to_numpy(int)] = found["weight"]
    return weights


def scored(docs: DataFrame, weights: np.ndarray, s: Settings = Settings()) -> DataFrame:
    """documents -> (doc_id, held_out, score, predicted), a row per row; the weights, of fixed size, travel to every task."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value, s)
        for batch in batches:
            values = [scorer.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"])

    out = columns(docs, doc_id="doc_id", text="text").mapInArrow(score, f"doc_id {kind}, score double")
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """fit() on the labelled rows, scored() on all. Null and empty texts (and texts without letters) score the model's prior, 0.5 at most;
    repeated rows score alike; a null id is held out; empty tables give no rows; other columns are not looked at."""
    return scored(docs, fit(docs, labels, s), s)
