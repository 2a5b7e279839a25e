from collections import defaultdict

import duckdb
import pytest

from cohortlift.llm import mixing, oracle, queries
from cohortlift.llm.common import read

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    expected = duck.sql(oracle.SQL[name])
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(expected.columns)
    got = got.select(*expected.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected.fetchall()))


def plain_targets(sizes: dict, most: int = 3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in order}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1, None: 5}, {"a": 0, "b": 0}, {"x": 7}, {f"s{i:02}": 3**i for i in range(12)}])
def test_targets_equal_filling_by_hand(spark, sizes):
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = plain_targets(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert r.target == pytest.approx(expected[r.source])


def test_taken_words_come_near_their_target(spark):
    rows = mixing.mixed(read(spark, SMALL, "documents")).collect()
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.mixed(read(spark, SMALL, "documents").repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.training_order(docs).collect()
    position = [r.position for r in rows]
    assert position == sorted(position)
    early = defaultdict(float)
    for r in rows:
        early[r.source] += r.position < 0.5
    share = {s: early[s] / sum(r.source == s for r in rows) for s in "abc"}
    # integrals of the schedules up to the middle: 0.625, 0.5 and 0.3125 of 1.0
    assert share["a"] == pytest.approx(0.625, abs=0.01) and share["b"] == pytest.approx(0.5, abs=0.01)
    assert share["c"] == pytest.approx(0.3125 / 1.0, abs=0.01)


def test_odd_cases(odd, nothing):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == odd.count() and all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert mixing.mixed(nothing).count() == 0 and mixing.training_order(nothing).count() == 0
    out = mixing.training_order(odd)
    assert out.columns == [*odd.columns, "copy", "position", "taken"]
    assert out.count() == sum(r.copies for r in rows)
    zero = mixing.mixed(odd.where("doc_id in (1, 2)")).collect()
    assert [r.taken for r in zero] == [0, 0]


def test_query_gives_the_positions_in_their_order(spark):
    rows = queries.op3_mixing(spark, SMALL).collect()
    expected = {(r.doc_id, r.size): list(r.positions) for r in mixing.mixed(read(spark, SMALL, "documents")).collect()}
    assert len(rows) == read(spark, SMALL, "documents").count() and any("," in r.positions for r in rows)
    for r in rows:
        positions = [float(p) for p in r.positions.split(",") if p]
        assert positions == expected[r.doc_id, r.size] and len(positions) == r.copies
        assert r.first_position == (positions[0] if r.copies else None)
    first = [2.0 if r.first_position is None else r.first_position for r in rows]
    assert first == sorted(first)
    copies = mixing.training_order(read(spark, SMALL, "documents")).collect()
    assert sorted((r.doc_id, r.position) for r in copies) == sorted((r.doc_id, p) for r in rows for p in map(float, filter(None, r.positions.split(","))))


def test_null_ids_spread_over_the_order(spark):
    docs = spark.createDataFrame([(None, "w " * (i + 1), "a") for i in range(300)], "doc_id long, text string, source string")
    rows = mixing.mixed(docs)
    assert len({p for r in rows.collect() for p in r.positions}) > 250
    plan = mixing.mixed(docs.repartition(5))
    assert sorted(map(str, plan.collect())) == sorted(map(str, rows.collect()))
