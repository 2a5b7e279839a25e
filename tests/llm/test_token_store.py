import re
import struct
import zlib

import pyarrow.compute  # noqa: F401
import pyarrow.orc as orc
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortlift.llm import queries, token_store
from cohortlift.llm.common import own_folder, read

SMALL = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(BPE)
ENCODER = token_store.Encoder(BPE)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def brute(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*ids_of(text), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r'\x1c\x85\xa0 　.,!-_09azAZéßжدا漢字<|>endoftext"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_give_the_ids_of_the_whole(text):
    assert ENCODER.in_pieces
    assert list(struct.unpack(f"<{len(ids_of(text))}I", ENCODER.encode([text])[0])) == ids_of(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n.,!aZ09éßжد漢|<>&"), max_size=40), st.sampled_from(["", " ", "\n", "\n\n", "a"]))
def test_plain_texts_are_cut_finely(text, end):
    text = text + end
    assert list(struct.unpack(f"<{len(ids_of(text))}I", ENCODER.encode([text])[0])) == ids_of(text)


@pytest.mark.parametrize("text", [
    "it's", "a…b", "x ²y", "½.", "a\n\n\nb", "a\n\n", "\n\na", "tail \n", "a\tb", "no\u00adbreak", "e\u0301.", "\u200d,", "<|endoftext|>", "a<|endoftext|>.b", "Ⅷ.a", "a" * 3000])
def test_texts_at_the_edge_of_plain(text):
    for _ in range(2):
        assert list(struct.unpack(f"<{len(ids_of(text))}I", ENCODER.encode([text])[0])) == ids_of(text)


def test_forgetting_changes_nothing():
    encoder = token_store.Encoder(BPE)
    encoder.KEPT = 5
    texts = ["one two, three. four", "five\nsix seven", "one two eight nine ten", "two, four five"] * 3
    for text in texts:
        assert encoder.encode([text, "", None, text]) == [ENCODER.encode([text])[0], b"", b"", ENCODER.encode([text])[0]]


def test_query_equals_brute_force(spark):
    docs = read(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert as_rows(queries.op11_tokens(spark, SMALL)) == brute(map(tuple, docs))


def test_odd_cases_over_many_files(spark, odd, nothing):
    folder = own_folder(spark, "tokens")
    token_store.write(odd.repartition(3), folder, BPE, 2, file_bytes=4000)
    table = token_store.read(spark, folder)
    assert table.select("part").distinct().count() > 3
    got, expected = as_rows(token_store.digests(table)), brute([(r.doc_id, r.text) for r in odd.collect()])
    assert [(r[0], r[1] == 0) for r in got] == [(r[0], r[1] == 0) for r in expected]
    assert sorted((r[0] is None, r[0] or 0, *r[2:]) for r in got) == sorted((r[0] is None, r[0] or 0, *r[2:]) for r in expected)
    ends = 0
    for _, start, n, _ in got:
        assert start == ends
        ends = start + n
    whole = [i for _, ids in sorted((r.start, r.ids) for r in token_store.span(table, 0, ends).collect()) for i in ids]
    assert [i for _, ids in sorted((r.start, r.ids) for r in token_store.span(table, 40, 40_000).collect()) for i in ids] == whole[40:40_000]
    empty = own_folder(spark, "tokens")
    token_store.write(nothing, empty, BPE, 2)
    assert token_store.digests(token_store.read(spark, empty)).count() == 0


def test_ids_of_text_and_hot_rows(spark):
    rows = [("b", "x y"), ("a", "one two")] + [("hot", "the same text")] * 500 + [(None, "nothing")] * 300
    folder = own_folder(spark, "tokens")
    token_store.write(spark.createDataFrame(rows, "doc_id string, text string"), folder, BPE, 2, file_bytes=4000)
    table = token_store.read(spark, folder, "string")
    assert max(r["count"] for r in table.groupBy("part").count().collect()) < 200
    got = as_rows(token_store.digests(table))
    assert [r[0] for r in got] == [None] * 300 + ["a", "b"] + ["hot"] * 500


def test_metadata_prunes(spark):
    docs = spark.range(40_000).selectExpr("id * 2 AS doc_id", "concat('document number ', id, ' of many ', md5(string(id))) AS text")
    folder = own_folder(spark, "tokens")
    token_store.write(docs.repartition(4), folder, BPE, 2, file_bytes=4 << 20)
    table = token_store.read(spark, folder)

    def scanned(df):
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return rows, plan, leaves.head().metrics().get("numOutputRows").get().value()

    rows, plan, n = scanned(token_store.documents(table, [2_000]))
    assert len(rows) == 1 and re.search(r"PushedFilters: \[.*EqualTo\(doc_id,2000\)", plan)
    assert n <= 2_000
    # an id within the range of a row group that no document has: only the Bloom filter can tell
    rows, _, n = scanned(token_store.documents(table, [2_001]))
    assert rows == [] and n == 0
    for f in [f for f in spark.read.orc(folder).inputFiles()][:1]:
        file = orc.ORCFile(f.replace("file://", ""))
        assert file.row_index_stride == 1000 and file.nstripes >= 1


def test_other_tokenizers_get_whole_texts():
    other = token_store.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("Some words, and 12 numbers", "  spaces  here ", ""):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids)}I", other.encode([text])[0])) == ids
