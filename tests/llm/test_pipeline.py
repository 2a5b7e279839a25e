import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortlift.llm import decontamination, quality, secret_scan, simhash
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SMALL, "documents"), []
    for name, f in corpus_pipeline.STAGES:
        out.append((name, docs, docs := f(spark, docs, SMALL).cache()))
    return out


def test_stages_keep_the_columns_and_do_their_work(spark, stages):
    columns = read(spark, SMALL, "documents").columns
    by_name = {name: (before, after) for name, before, after in stages}
    assert all(after.columns == columns for _, _, after in stages[:-1])
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = by_name["quality"]
    assert ids(after) == ids(quality.judged(before).where("kept")) and after.count() < before.count()
    before, after = by_name["simhash_dedup"]
    groups = simhash.near_duplicates(before, 5, 3, 7, 39)
    assert ids(after) == {r.component_id for r in groups.collect()}
    before, after = by_name["decontamination"]
    hit = ids(decontamination.report(before, read(spark, SMALL, "benchmark")).where("contaminated"))
    old, new = ({r.doc_id: r.text for r in df.collect()} for df in (before, after))
    assert hit and all(new.get(i) != t if i in hit else new[i] == t for i, t in old.items())
    before, after = by_name["secrets"]
    found = ids(secret_scan.secrets(before).where("spans <> ''"))
    old, new = ({r.doc_id: r.text for r in df.collect()} for df in (before, after))
    assert found and all((new[i] != t) == (i in found) for i, t in old.items())
    assert not secret_scan.secrets(after).where("n_assign + n_access + n_hex > 0").count()


def test_run_equals_its_stages(spark, stages):
    rows = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SMALL)) == rows(stages[-1][2])


def test_stages_bear_odd_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= 3 * docs.count()
