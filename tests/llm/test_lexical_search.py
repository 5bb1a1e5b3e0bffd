import math
import re
from collections import Counter

import numpy as np
import pytest

from nivalis.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, depth=10):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    found = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for x in found if x[2]), sum(x[2] for x in found)
    df = Counter(t for x in found for t in x[1])
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, counts, n in found:
            m = 100 - 75 + ((75 * n * n_docs) // n_terms if n_terms else 0)
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m)) for t, times in wanted.items() if t in counts)
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        out += [(item, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:depth])]
    return out


def key(row):
    return tuple(map(str, row))


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" if i % 3 else f"é{i}ñ" for i in range(60)]
    return [(i, " ".join(words[min(int(x), 59)] for x in rng.zipf(1.3, int(rng.integers(0, 60))))) for i in range(n)]


@pytest.mark.parametrize("slice_bytes", [8 << 20, 300])
def test_search_equals_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(ls, "SLICE_BYTES", slice_bytes)
    docs = [*corpus(150, 1), (None, None), (900, ""), (901, "..!"), (None, "W1 w1 W2"), (7, "w4 W4"), (7, "w4 W4"), (-5, "w50 " * 3000)]
    items = [*corpus(12, 2), (50, None), (51, "w50 w50 W1"), (51, "w2"), (None, "w7 é3ñ"), (52, "nowhere at all"), (53, "W4")]
    got = ls.search(spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(5), spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int"))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, brute(docs, items)))


def test_rows_alike_fill_the_ranks(spark):
    docs = [(i % 4, "same text here") for i in range(40)] + [(99, "other")]
    got = ls.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "text")], "item_id long, text string")).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [0] * 10 and [r["rank"] for r in got] == list(range(1, 11))


@pytest.mark.parametrize("lookups", [1, 64, 1 << 20])
def test_documents_that_cannot_enter_are_not_scored(monkeypatch, lookups):
    monkeypatch.setattr(ls, "LOOKUPS", lookups)
    docs, items = corpus(3000, 3), corpus(5, 4)
    index = ls.Index([(i, ls.terms(t.encode())) for i, t in items])
    rows = [(i, Counter(index.number[t] for t in ls.terms(x.encode()) if t in index.number), len(ls.terms(x.encode()))) for i, x in docs]
    df = Counter(t for _, c, _ in rows for t in c)
    n_docs, n_terms = sum(1 for r in rows if r[2]), sum(r[2] for r in rows)
    index.weigh(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in range(len(index.number))]))
    heaps, scored = ls.Heaps(len(items), 10), []
    for at in range(0, len(rows), 300):
        page = [r for r in rows[at : at + 300] if r[1]]
        flat = [(t, n) for _, c, _ in page for t, n in sorted(c.items())]
        scored.append(ls.search_page(index, heaps, np.array([r[0] for r in page]), np.array([r[2] for r in page]), np.array([len(r[1]) for r in page]), *np.array(flat).T, n_docs, n_terms))
    assert scored[-1] < scored[0] / 2
    got = [(items[i][0], d, s) for i, d, s in zip(heaps.item.tolist(), heaps.doc.tolist(), heaps.score.tolist(), strict=True)]
    assert sorted(got) == sorted((i, d, s) for i, _, d, s in brute(docs, items))


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for d, i in ((docs, items), (some, items), (docs, some.select("doc_id", "text").withColumnRenamed("doc_id", "item_id"))):
        assert ls.search(d, i).collect() == []


def test_the_query_equals_its_sql_and_brute_force(spark):
    import duckdb
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, ls.op12_lexical_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect()))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    assert got == sorted(con.sql(f"select item_id, rank, doc_id, score from ({ls.OP12_SQL})").fetchall())
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    assert got == sorted(brute(docs, items))


def test_a_page_is_a_row_group(spark, monkeypatch):
    """Readers hold whole row groups, so with all pages of a task in one its memory grew with its input."""
    import pyarrow.parquet as pq

    written = []
    keep = ls.materialise
    monkeypatch.setattr(ls, "materialise", lambda df, **how: written.append(keep(df, **how)) or written[-1])
    docs = spark.createDataFrame([(i, f"word{i} alike") for i in range(20)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "alike")], "item_id long, text string")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert len(ls.search(docs, items).collect()) == 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    parts = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in written[0].inputFiles()]
    assert [part.row_group(i).num_rows for part in parts for i in range(part.num_row_groups)] == [1] * 4
