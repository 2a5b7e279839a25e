import math
import re
from collections import Counter

import numpy as np
import pytest
from plain import ascii_lower

from cohortlift.llm import search
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(ascii_lower(text) or "")


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_documents, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in wanted.items():
        found = []
        for doc, c in counts:
            score = 0
            for t in words & c.keys():
                w = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * c.total() * n_documents // total)))
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def check(docs, items, **config):
    got = sorted(map(tuple, search.ranked(docs, items, **config).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], config.get("k", 10))
    return got


def test_equals_brute_force(spark):
    docs, items = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")
    whole = check(docs, items)
    assert check(docs.repartition(5), items, item_rows=300, shard_postings=700) == whole


def test_odd_cases(spark, odd, nothing):
    items = spark.createDataFrame(
        [(1, "The quick brown FOX"), (1, "lazy dog"), (2, None), (3, ""), (4, "unheard ofword"), (None, "w1x1 tail"), (5, "one one ONE word é")], "item_id long, text string")
    got = check(odd, items, k=3)
    assert {r[0] for r in got} == {1, None, 5}
    assert search.ranked(nothing, items).count() == 0 and search.ranked(odd, items.where("false")).count() == 0
    assert search.ranked(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_and_ids_of_text(spark):
    docs = spark.createDataFrame([(f"d{i:04}", "same words here") for i in range(3000)] + [("a", "Same words"), ("z", "other é")] + [(f"x{i}", "something else") for i in range(3000)], "doc_id string, text string")
    items = spark.createDataFrame([("q", "words é"), ("p", "here")], "item_id string, text string")
    got = check(docs.repartition(6), items)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == "p"] == [f"d{i:04}" for i in range(10)]


@pytest.mark.parametrize("seed", range(4))
def test_blocks_are_skipped_and_nothing_is_lost(seed):
    """Random topics in one shard: the best by all scores, from a part of the documents."""
    rng = np.random.default_rng(seed)
    n_docs, n_terms = 3000, 400
    topic = rng.integers(0, 20, n_docs)
    vectors = []
    for d in range(n_docs):
        words = np.r_[rng.integers(1, 40, 15), 41 + topic[d] * 17 + rng.integers(0, 17, 12)]
        vectors.append(Counter(words.tolist()))
    n = np.array([sum(v.values()) for v in vectors])
    sizes = np.array([len(v) for v in vectors])
    items = search.Items(
        list(range(30)), [np.unique(np.r_[rng.integers(1, 40, 6), 41 + (q % 20) * 17 + rng.integers(0, 17, 5)]) for q in range(30)],
        {str(t).encode(): t for t in range(1, n_terms)})
    items.weigh(n_docs, int(n.sum()), Counter(t for v in vectors for t in v))
    shard = search.Shard(n, sizes, np.array([t for v in vectors for t in sorted(v)]), np.array([v[t] for v in vectors for t in sorted(v)]), items)
    for item in range(30):
        best = search.Best(10)
        best.ids = list(range(n_docs))
        shard.search(item, best)
        weight = np.zeros(len(items.weight), np.int64)
        weight[items.terms[item]] = items.weight[items.terms[item]]
        before, scores = shard.scored, shard.scores(np.arange(n_docs), weight)
        shard.scored = before
        assert [(-s, d[1]) for s, d in best.rows] == [(int(scores[d]), d) for d in sorted(range(n_docs), key=lambda d: (-scores[d], d))[:10]]
        for term in items.terms[item][:3]:
            if shard.top[term]:
                blocks, bounds = shard.postings(int(term))[0], shard.bounds(int(term), items.terms[item])
                assert all(scores[b].max() <= bound for b, bound in zip(blocks, bounds, strict=True)) and max(map(len, blocks)) <= search.BLOCK
    assert shard.scored < 30 * n_docs * 0.5
