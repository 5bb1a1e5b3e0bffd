import duckdb
import numpy as np
import pytest

from nivalis.llm import mixing, topk


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_threshold_search_matches_all_scores():
    rng = np.random.default_rng(3)
    data = rng.integers(-9, 10, (500, 8)).astype(float)
    data[100:200] = data[7]
    order, ids = np.argsort(data, axis=0, kind="stable"), rng.permutation(500) * 3
    for q in [*data[:20], np.zeros(8), np.array([5.0, 0, 0, 0, 0, 0, 0, 0])]:
        rows, scores = topk.threshold_search(q, data, order, ids, int(ids[7]), 12)
        all_scores = data @ q
        want = sorted((-all_scores[i], ids[i]) for i in range(500) if ids[i] != ids[7])[:12]
        assert [(-s, ids[i]) for i, s in zip(rows, scores)] == want


def brute_rows(rows, k):
    """As the contract says, with each row a candidate and the largest vector of an id asking."""
    out, queries = [], {}
    for i, v in rows:
        if i % 20 == 0:
            queries[i] = max(queries.get(i, v), v)
    for q, v in queries.items():
        fit = lambda s: max(min(s, 2**63 - 1), -(2**63))
        scores = sorted((-fit(sum(a * b for a, b in zip(v, w))), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [0.2, 2.0**25, 2.0**40])
def test_topk_query(spark, size):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(0, size, 6).tolist() for i in range(120)}
    good[40] = good[20]
    again = [(3, good[3]), (3, good[3]), (3, good[4]), (20, good[7]), (60, [size * 9] * 5)]
    rows = [(i, v, "x", 1) for i, v in [*good.items(), *again]] + [(None, good[1], "x", 1), (500, None, "x", 1), (501, [1.0, None], "x", 1), (502, [float("nan")] * 6, "x", 1), (503, [float("inf")] * 6, "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, dims int")
    got = rows_of(topk.top_k(topk.quantised(df), topk.F.col("id") % 20 == 0, 7), "query_id", "rank", "vec_id", "score")
    assert got == brute_rows([(i, [int(np.floor(64 * x)) for x in v]) for i, v in [*good.items(), *again]], 7)


def test_topk_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.quantised(df), topk.F.col("id") % 20 == 0, 3).collect() == []


def documents(spark):
    rows = [(i, "w " * (1 + i * i % 97), f"s{i % 5}", "c", 7) for i in range(400)]
    rows += [(None, "a b", None, "c", 7), (3, None, "s1", "c", 7), (3, "x", "s1", None, None), (3, "x", "s1", None, None), (900, "", "none", "c", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, cell string, size int")


def test_mixing_matches_sql_and_targets(spark):
    df = documents(spark)
    got = mixing.report(df)
    names = ("doc_id", "size", "source_size", "target", "taken")
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(mixing.OP8_SQL).fetchall()
    key = lambda r: tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r)
    assert sorted(map(key, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(key(r[:5]) for r in want)
    by_source = got.join(df.select("doc_id", "source").distinct(), "doc_id").where("doc_id != 3").groupBy("source", "target").agg(mixing.F.sum("taken").alias("t")).collect()
    for r in by_source:
        assert abs(r["t"] - r["target"]) <= max(300, 0.05 * r["target"])
    assert all(r["taken"] <= 2 * r["size"] for r in got.collect())


def test_targets_fill_up_to_the_limit(spark):
    cells = spark.createDataFrame([("sa", 1, 1, 10), ("sb", 1, 1, 1000), ("sc", 1, 1, 100), ("n", 1, 1, 90)], "src string, cell int, n long, words long")
    got = {r.src: r.target for r in mixing.targets(cells).collect()}
    assert got["sa"] == 20 and got["sc"] == 200 and got["n"] == 180
    assert sum(got.values()) == pytest.approx(1800)


def test_mix_repeats_rows_and_keeps_columns(spark):
    df = documents(spark)
    out = mixing.mix(df)
    assert out.schema == df.schema
    assert out.count() == sum(r.copies for r in mixing.report(df).collect())


def test_mix_empty(spark):
    df = documents(spark).where("false")
    assert mixing.report(df).collect() == [] and mixing.mix(df).collect() == []
