import hashlib
import re

import pytest

from cohortlift.llm import decontamination
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    found = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            found.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths, out = sorted({len(k) for k in found}), []
    for id_, text in docs:
        w, hit, ids = words(text), set(), set()
        for i in range(len(w)):
            for n in lengths:
                if (names := found.get(tuple(w[i : i + n]))) and i + n <= len(w):
                    hit.update(range(i, i + n))
                    ids |= names
        named = sorted(str(x) for x in ids if x is not None)
        out.append((str(id_), len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("block", [decontamination.BLOCK, 1500])
def test_report_equals_brute_force(spark, block):
    docs, items = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")
    expected = plain(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert sum(x[-1] for x in expected) > 0
    assert got(decontamination.report(docs, items, block=block)) == expected


def test_odd_cases(spark, odd, nothing):
    items = [(1, "jumps over the lazy dog"), (1, "Fox Jumps"), (2, None), (3, ""), (None, "ONE word"), (9, "far away from all that it has ever known in its long life life long"), (10, "...")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for block in (decontamination.BLOCK, 1):
        assert got(decontamination.report(odd, benchmark, block=block)) == plain(docs, items)
    assert decontamination.report(nothing, benchmark).count() == 0
    assert not any(r.contaminated for r in decontamination.report(odd, benchmark.where("false")).collect())
    clean = decontamination.clean(odd, benchmark)
    assert clean.schema == odd.schema
    rows = clean.collect()
    # "one word" is nothing but a hit, so it goes; texts without hits stay as they are
    assert len(rows) == odd.count() - 1 and {(r.doc_id, r.text) for r in rows if r.doc_id in (1, 2, 3, 7)} == {(i, t) for i, t in docs if i in (1, 2, 3, 7)}
    assert all("lazy" not in (r.text or "").split("away")[0] for r in rows if r.doc_id == 4)
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    again = decontamination.report(clean, benchmark)
    assert not any(r.n_hit > 0 and r.doc_id == 4 for r in again.where("n_items > 0").collect())
