import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nivalis.llm import bpe, simple8b, token_files
from nivalis.llm.common import scratch

pytest.importorskip("tokenizers")

TEXTS = ["a \n b", "x <|endoftext|>  foo\n\n bar  \n", None, " ", "", "don't  we'll \r\n\t12!!  　 z q", "ab" * 3000 + " émoji 😀 x", "word " * 5000, "  a"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, 2**64 - 1)), max_size=500))
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, first = simple8b.pack(values)
    assert (simple8b.unpack(words, first, len(values)) == values).all()
    for block in range(len(first)):
        part = simple8b.unpack(words, first, len(values), slice(block, block + 1))
        assert (part == values[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]).all()


@pytest.mark.parametrize("value", [0, 1, 2**60 - 1, 2**60, 2**64 - 1])
@pytest.mark.parametrize("n", [1, 59, 60, 61, 127, 128, 129, 1000])
def test_simple8b_runs(value, n):
    values = np.full(n, value, np.uint64)
    words, first = simple8b.pack(values)
    assert (simple8b.unpack(words, first, n) == values).all()
    assert len(first) == -(-n // simple8b.BLOCK)


def test_simple8b_is_as_small_as_its_selectors_allow():
    assert len(simple8b.pack(np.arange(128) % 2)[0]) == 3  # 60, 60 and 8 values of one bit
    assert len(simple8b.pack(np.full(128, 1000))[0]) == 22  # 6 values of 10 bits each
    assert len(simple8b.pack(np.full(3, 2**61))[0]) == 6  # an escape and the value


def test_documents_over_sections(monkeypatch):
    monkeypatch.setattr(token_files, "SECTION", 10)
    out = io.BytesIO()
    writer = token_files.Writer(out)
    docs = [(3, np.arange(35)), (None, np.arange(5)), (4, np.empty(0)), (4, np.arange(10)), (5, np.arange(20))]
    for doc_id, ids in docs:
        writer.add(doc_id, ids.astype("<u4"))
    writer.flush()
    out.seek(0)
    found, held = [], []
    for table, words, first, n in token_files.sections(out):
        assert n <= 10
        ids, at = simple8b.unpack(words, first, n), 0
        for doc_id, size, ends, null in table.tolist():
            held.extend(ids[at : at + size].tolist())
            at += size
            if ends:
                found.append((None if null else doc_id, held))
                held = []
    assert found == [(i, ids.tolist()) for i, ids in docs]
    assert writer.n_bytes == len(out.getvalue())


def brute(rows):
    known, start, out = bpe.tokenizer(bpe.default_path()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*known.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_report_equals_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 9000)
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(None, "none at all")]
    path = scratch(spark)
    manifest = token_files.write(spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, ids string, part int"), path)
    assert manifest.count() > 2
    got = sorted(map(tuple, token_files.report(manifest, path).collect()), key=lambda r: r[1])
    assert got == brute(rows)
    read = token_files.read(manifest, path).collect()
    assert sorted((r.doc_id or 0, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4"))) for r in read) == sorted((r[0] or 0, *r[1:]) for r in got)


def test_repeated_rows_are_one_after_another(spark):
    rows = [(None, "x y")] * 40 + [(5, f"t {i}") for i in range(40)] + [(1, "a")]
    path = scratch(spark)
    got = sorted(map(tuple, token_files.report(token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path), path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 40 + [1] + [5] * 40
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    assert sorted(r[3] for r in got) == sorted(r[3] for r in brute(rows))


def test_files_of_a_lost_attempt_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    path = f"file://{tmp_path}"
    manifest = token_files.write(df, path)
    (tmp_path / "lost.ids").write_bytes(token_files.MAGIC + b"half")
    assert sorted(r.doc_id for r in token_files.report(manifest, path).collect()) == [1, 2]


def test_starts_over_many_files(spark):
    manifest = spark.range(3000).selectExpr("int(id) as part", "string(id) as file", "1L as n_docs", "id % 7 as n_ids", "1L as n_bytes")
    got = [r.start for r in token_files.with_starts(manifest).orderBy("part").collect()]
    assert got == np.cumsum([0, *[i % 7 for i in range(2999)]]).tolist()


def test_empty(spark):
    path = scratch(spark)
    manifest = token_files.write(spark.createDataFrame([], "doc_id long, text string"), path)
    assert token_files.report(manifest, path).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t\r\x0b\x85\xa0　'sé1!<|>\x1c"), max_size=30), max_size=5))
def test_ids_equal_the_tokenizer(texts):
    plain = bpe.tokenizer(bpe.default_path())
    known = token_files.Known(bpe.default_path())
    for _ in range(2):  # words that are new, and that are known
        got = known.encode([x.encode() for x in texts])
        assert [x.tolist() for x in got] == [[*plain.encode(x, add_special_tokens=False).ids, 2] for x in texts]


def test_the_query_equals_the_tokenizer_on_whole_texts(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = token_files.op11_token_files(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == brute(rows)
