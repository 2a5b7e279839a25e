"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import columns, stored

#: Symbols, length of the repeated windows, least words, greatest share of repeated words in a hundred.
SYMBOLS, WINDOW, LEAST_WORDS, MOST_REPEATED = "#*$%&|<>", 8, 20, 30
WHITE = " \t\n\r\x0b\x0c"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_digits", "n_marks")


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in a window that is found twice or more. Equal windows get equal numbers by doubling, exactly."""
    n, length, x = len(ids), 1, ids
    if n <= window:
        return 0
    while length < window:
        step = min(length, window - length)
        x = x[: len(x) - step] * (n + 1) + x[step:]
        _, x = np.unique(x, return_inverse=True)
        length += step
    again = np.bincount(x)[x] > 1
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    edges[at] += 1
    np.subtract.at(edges, at + window, 1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(of[65:91].sum()), int(of[97:123].sum())
    return (
        len(words), len(text) - sum(int(of[ord(c)]) for c in WHITE), sum(int(of[ord(c)]) for c in SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(ids), len(lines), len(number), upper, upper + lower, int(of[48:58].sum()), int(of[33]))


def features(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, COUNTS...), a row per row; null texts count as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([counts(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(rows[:, i]) for i in range(len(COUNTS)))], ["doc_id", *COUNTS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return columns(docs, doc_id="doc_id", text="text").mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _vote(good, bad):
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains."""
    c = F.col
    share = lambda a, b: c(a) / F.greatest(c(b), F.lit(1))
    length, symbols, upper, repeats = share("word_chars", "n_words"), share("n_symbols", "n_words"), share("n_upper", "n_letters"), share("n_repeat_words", "n_words")
    lines, kinds, digits, marks = share("n_dup_lines", "n_lines"), share("n_distinct", "n_words"), share("n_digits", "word_chars"), share("n_marks", "n_words")
    some, many = c("n_words") >= 10, c("n_words") >= 50
    return {
        "size": _vote(many, c("n_words") < LEAST_WORDS),
        "word_length": _vote(some & length.between(2.5, 10), some & ~length.between(2, 15)),
        "symbols": _vote(symbols < 0.03, symbols > 0.1),
        "capitals": _vote(some & (upper < 0.25), some & (upper > 0.5)),
        "marks": _vote(some & (marks < 0.05), some & (marks > 0.2)),
        "lines": _vote((c("n_lines") >= 3) & (lines < 0.1), (c("n_lines") >= 3) & (lines > 0.3)),
        "repeats": _vote(many & (repeats < 0.1), many & (repeats > 0.25)),
        "variety": _vote(many & (kinds > 0.3), many & (kinds < 0.12)),
        "digits": _vote(some & (digits < 0.1), some & (digits > 0.3)),
    }


@dataclass(frozen=True)
class VoteModel:
    """Kinds of documents: the good first, then for each rule a kind of bad ones that it stands for. shares: of each kind; bad_votes: for each kind
    and rule the probability of a vote of bad, given that the rule votes. A rule's accuracy on good documents is 1 less its first entry."""

    names: tuple[str, ...]
    shares: tuple[float, ...]
    bad_votes: tuple[tuple[float, ...], ...]

    def posterior(self) -> Column:
        """Probability of a good document, over columns vote_<rule>; a rule that abstains says nothing."""
        odds = []
        for share, rates in zip(self.shares[1:], self.bad_votes[1:], strict=True):
            against = F.lit(math.log(share / self.shares[0]))
            for name, good, bad in zip(self.names, self.bad_votes[0], rates, strict=True):
                vote = F.col(f"vote_{name}")
                against = against + F.when(vote < 0, math.log(bad / good)).when(vote > 0, math.log((1 - bad) / (1 - good))).otherwise(0.0)
            odds.append(F.exp(F.least(against, F.lit(500.0))))
        return 1 / (1 + sum(odds[1:], odds[0]))


def expectation_maximisation(patterns: np.ndarray, n: np.ndarray, names: list[str], error: float = 0.001, rounds: int = 500, tolerance: float = 1e-8) -> VoteModel:
    """patterns (m, rules) of votes with their numbers of documents.

    Bad documents are bad in different ways, and one kind of fault says nothing about the others, so each rule has a kind of its own beside the good
    documents; how surely it votes on its kind, on good ones and on the other kinds is what is estimated. Abstentions are missing votes, so what
    a rule can't judge (short texts, say) makes no kind. It starts from the bad votes. A rule that is wrong on some good documents and one that is
    right on a kind of its own look alike if it goes with no other rule; the prior decides: as many documents as there are say that a rule is
    wrong on `error` of the good ones. A weak prior stands for a few documents of each other kind, so an empty or one-sided corpus has a
    defined model. It ends when no parameter moves.
    """
    rules = len(names)
    said_bad, said = (patterns == -1).astype(float), (patterns != 0).astype(float)
    bad_votes = said_bad.sum(1, keepdims=True)
    none = bad_votes == 0
    p = np.concatenate((np.where(none, 0.98, 0.1), np.where(none, 0.02 / rules, 0.9 * said_bad / np.maximum(bad_votes, 1))), 1)
    own = np.concatenate((np.zeros((1, rules)), np.eye(rules)))
    prior_bad, prior = np.where(own > 0, 8.0, 0.5), np.where(own > 0, 9.0, 10.0)
    prior_bad[0], prior[0] = error * (n.sum() + 50), n.sum() + 50
    last = np.zeros(1)
    for _ in range(rounds):
        mass = n[:, None] * p
        shares = mass.sum(0) + np.r_[8.0, np.full(rules, 0.2)]
        shares /= shares.sum()
        rate = (mass.T @ said_bad + prior_bad) / (mass.T @ said + prior)
        logs = np.log(shares) + said_bad @ np.log(rate).T + (said - said_bad) @ np.log(1 - rate).T
        p = np.exp(logs - logs.max(1, keepdims=True)) if len(n) else logs
        p /= p.sum(1, keepdims=True)
        now = np.r_[shares, rate.ravel()]
        if now.shape == last.shape and np.abs(now - last).max() < tolerance:
            break
        last = now
    return VoteModel(tuple(names), tuple(shares.tolist()), tuple(tuple(r) for r in rate.tolist()))


def fitted(voted: DataFrame) -> VoteModel:
    """The model of a corpus of votes. All documents count; the driver sees a row for each pattern of votes, 3 to the number of rules at most."""
    names = list(votes())
    rows = voted.groupBy(*(f"vote_{x}" for x in names)).count().collect()
    rows.sort()
    patterns = np.array([r[:-1] for r in rows], np.int64).reshape(-1, len(names))
    return expectation_maximisation(patterns, np.array([r[-1] for r in rows], float), names)


def judged(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_good, vote_<rule>...), a row per row.

    Kept: the base rules don't fail and the posterior of the rules' votes is 0.5 or more. Null and empty texts have no words and fail. Null or
    repeated ids are rows like others, copies count as often as they occur; an empty table gives no rows.
    """
    c = F.col
    failed = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))
    voted = stored(features(docs)).withColumn("base_failed", failed).withColumns({f"vote_{k}": v for k, v in votes().items()})
    model = fitted(voted)
    out = voted.withColumn("p_good", model.posterior())
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~c("base_failed") & (c("p_good") >= 0.5)).alias("kept"),
        "p_good", *(f"vote_{k}" for k in votes()))


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that judged() keeps, whole. Votes of all documents are counted first; the second scan computes the counts anew beside each
    text, so no text is shuffled."""
    c = F.col
    failed = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))
    model = fitted(features(docs).withColumns({f"vote_{k}": v for k, v in votes().items()}))
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text = f"c{names.index('text')}"

    @F.pandas_udf(", ".join(f"{x} long" for x in COUNTS))
    def counted(texts):
        import pandas as pd

        return pd.DataFrame(np.array([counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS)), columns=list(COUNTS))

    rows = inner.withColumn("q", counted(c(text))).select(*inner.columns, "q.*").withColumns({f"vote_{k}": v for k, v in votes().items()})
    return rows.where(~failed & (model.posterior() >= 0.5)).select(*inner.columns).toDF(*names)
