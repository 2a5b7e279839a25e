import numpy as np
import pytest
import xxhash

from cohortlift.llm import anchors, simhash
from cohortlift.llm.common import read
from cohortlift.llm.components import components

SMALL = "/root/testdata/sf0.001"
WHITE = set("\t\n\v\f\r ")


def plain_print(text: str | None, size: int = 4) -> int:
    words, word = [], ""
    for c in (text or "") + " ":
        if c in WHITE:
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints: list[int], ids: list, threshold: int) -> list:
    out, seen = [None] * len(prints), set()
    for i in range(len(prints)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            p = todo.pop()
            for j in range(len(prints)):
                if j not in group and (prints[p] ^ prints[j]).bit_count() <= threshold:
                    group.add(j)
                    todo.append(j)
        seen |= group
        named = [ids[j] for j in group if ids[j] is not None]
        for j in group:
            out[j] = min(named, default=None)
    return out


@pytest.mark.parametrize("source", ["small", "odd"])
def test_near_duplicates_equal_brute_force(spark, odd, source):
    docs = read(spark, SMALL, "documents") if source == "small" else odd
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    expected = sorted(zip(map(str, ids), prints, map(str, plain_components(prints, ids, 4)), strict=True))
    got = sorted((str(r.doc_id), int.from_bytes(r.print, "big"), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == expected


@pytest.mark.parametrize(("threshold", "words"), [(4, 1), (5, 1), (7, 1), (7, 3)])
def test_anchors_lose_no_link(spark, threshold, words):
    rng = np.random.default_rng(threshold)
    base = rng.integers(0, 2**64, (150, words), dtype=np.uint64)
    rows = [base]
    for flips in (threshold, threshold, threshold + 1):
        x = base.copy()
        for _ in range(flips):
            x[:, 0] ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        rows.append(x)
    dense = np.repeat(base[:1], 300, 0)
    for _ in range(3):
        dense[:, 0] ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    prints = np.unique(np.concatenate([*rows, dense]), axis=0)
    df = spark.createDataFrame([(bytearray(p.astype(">u8").tobytes()),) for p in prints], "print binary")
    found = components(simhash.links(df, words, threshold, 64 * words))
    label = {bytes(r.node): bytes(r.label) for r in found.collect()}
    keys = [p.astype(">u8").tobytes() for p in prints]
    got = [label.get(k, k) for k in keys]
    limit = [[min(int(np.bitwise_count(p[w] ^ q[w])) for w in range(words)) <= threshold for q in prints] for p in prints]
    for i in range(len(keys)):
        group, todo = {i}, [i]
        while todo:
            p = todo.pop()
            new = [j for j in range(len(keys)) if limit[p][j] and j not in group]
            group.update(new)
            todo += new
        assert got[i] == min(keys[j] for j in group)


def test_every_point_has_an_anchor_in_reach():
    golay, hamming = anchors.codes(1)
    rng = np.random.default_rng(1)
    for code, bits, radius in ((golay, 23, 3), (hamming, 15, 1)):
        x = rng.integers(0, 1 << bits, 500)
        at, anchor = code.reach(x, np.zeros(500, int))
        assert sorted(at.tolist()) == list(range(500))
        assert (np.bitwise_count(x[at] ^ anchor) <= radius).all() and not code.syndrome(anchor).any()


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    label = {r.node: r.label for r in components(links).collect()}
    assert label == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_survivors(spark, odd, nothing):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.schema["text"].dataType == odd.schema["text"].dataType
    # 1, 2, 3 and null share fingerprint zero; 4, 5, 5, null and 8 the body
    assert sorted((r.doc_id, (r.text or "")[:4]) for r in kept.collect()) == [(1, ""), (4, "the "), (6, "one "), (6, "w0x0"), (7, "x")]
    assert simhash.one_of_each(nothing).count() == 0 and simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(odd.where("doc_id is null")).count() == 2
    assert simhash.one_of_each(odd.where("doc_id = 5")).count() == 1
