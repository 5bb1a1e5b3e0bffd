import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import models as M
from nivalis.operators import random_trees as X

NAMES = ["a", "b", "c"]


def data(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.random(n), rng.integers(0, 5, n), rng.normal(size=n)])
    y = 10 * (x[:, 0] > 0.4) + 3 * x[:, 1] + rng.normal(size=n) / 5
    return x, y, rng.integers(1, 4, n).astype(float)


def frame(spark, x, y, w):
    return spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w, strict=True)], "a double, b double, c double, y double, w double")


def brute(x, y, w, seed, tree, depth, tried, min_rows):
    """The same tree by looking at the rows of one node at a time, in numpy alone; nodes in the order they are made."""
    nodes, queue = [(np.arange(len(x)), 0)], [0]
    out = {}
    while queue:
        grown = []
        for n in queue:
            own, d = nodes[n]
            mean = np.average(y[own], weights=w[own])
            out[n] = (None, None, mean)
            spread = lambda rows: float(np.sum(w[rows] * (y[rows] - np.average(y[rows], weights=w[rows])) ** 2))
            if d == depth or w[own].sum() < min_rows or spread(own) < 1e-9:
                continue
            features, thresholds = X.drawn(seed, tree, n, x[own].min(axis=0), x[own].max(axis=0), tried)
            if not len(features):
                continue
            gains = [spread(own) - spread(own[x[own, f] <= t]) - spread(own[x[own, f] > t]) for f, t in zip(features, thresholds, strict=True)]
            best = int(np.argmax(gains))
            f, t = features[best], thresholds[best]
            out[n] = (f, t, mean)
            for rows in (own[x[own, f] <= t], own[x[own, f] > t]):
                nodes.append((rows, d + 1))
                if d + 1 < depth and w[rows].sum() >= min_rows:
                    grown.append(len(nodes) - 1)
                else:
                    out[len(nodes) - 1] = (None, None, np.average(y[rows], weights=w[rows]))
        queue = grown
    return out


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("slice_nodes", [20_000, 3])
def test_a_tree_equals_numpy(spark, monkeypatch, weighted, slice_nodes):
    monkeypatch.setattr(X, "SLICE_NODES", slice_nodes)
    x, y, w = data(300)
    got = X.fit(frame(spark, x, y, w).repartition(5), NAMES, "y", trees=2, depth=4, tried=2, min_rows=10, weight="w" if weighted else None, seed=7)
    for t, tree in enumerate(got.trees):
        want = brute(x, y, w if weighted else np.ones(len(y)), 7, t, 4, 2, 10)
        assert len(want) == len(tree.feature) and len(want) > 9
        for n, (f, threshold, mean) in want.items():
            assert tree.feature[n] == (-1 if f is None else f)
            assert tree.value[n] == pytest.approx(mean)
            if f is not None:
                assert tree.threshold[n] == pytest.approx(threshold)
    assert got.trees[0].threshold[0] != got.trees[1].threshold[0]


def test_thresholds_are_uniform():
    low, high = np.array([2.0]), np.array([10.0])
    found = np.array([X.drawn(3, tree, 0, low, high, 1)[1][0] for tree in range(4000)])
    assert found.min() >= 2 and found.max() < 10
    assert np.abs(np.histogram(found, 8, (2, 10))[0] - 500).max() < 110


def test_constant_features_are_not_drawn():
    features, _ = X.drawn(3, 0, 0, np.array([1.0, 2.0, 0.0]), np.array([1.0, 3.0, 0.0]), 3)
    assert features.tolist() == [1]


def test_fit_does_not_depend_on_partitions(spark):
    x, y, w = data(500)
    trees = [X.fit(frame(spark, x, y, w).repartition(n), NAMES, "y", 3, 5, seed=1) for n in (1, 6)]
    for a, b in zip(trees[0].trees, trees[1].trees, strict=True):
        assert a.feature == b.feature and a.threshold == b.threshold
        assert a.value == pytest.approx(b.value)


def test_leaf_values_are_means_and_predictions_average_trees(spark):
    x, y, w = data(400)
    df = frame(spark, x, y, w)
    forest = X.fit(df, NAMES, "y", 1, 6, tried=3)
    means = forest.predict(df).groupBy("prediction").agg(F.avg("y").alias("m")).collect()
    assert all(r.prediction == pytest.approx(r.m) for r in means)
    forest = X.fit(df, NAMES, "y", 5, 6, tried=3)
    rows = forest.predict(df).select("a", "b", "c", "prediction").collect()
    for r in rows[:50]:
        assert r.prediction == pytest.approx(np.mean([t.packed()[4][X.node_of(t.packed(), np.array([[r.a, r.b, r.c]]))[0]] for t in forest.trees]))


def test_held_back_rows_are_explained_as_well_as_by_a_forest(spark):
    x, y, w = data(3000)
    df = frame(spark, x, y, w).withColumn("i", F.monotonically_increasing_id())
    train, test = df.where("i % 3 > 0"), df.where("i % 3 = 0")
    trees = M.extra_trees(train, NAMES, "y", 40, 8, tried=3)
    own = M.metrics(trees.predict(test), "y").first()
    forest = M.metrics(M.fit(train, NAMES, M.forest("y", 20, 8)).transform(test), "y").first()
    assert own.r2 > 0.95 and own.r2 > forest.r2 - 0.02
    shares = trees.importances()
    assert shares.sum() == pytest.approx(1) and shares.argmin() == 2


def test_nulls_and_no_rows(spark):
    rows = [(1.0, 1.0, 1.0, 5.0), (2.0, 1.0, 1.0, 7.0), (None, 1.0, 1.0, 500.0), (1.0, 1.0, 1.0, None), (float("nan"), 1.0, 1.0, 900.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    forest = X.fit(df, NAMES, "y", 3, 4)
    assert [r.prediction for r in forest.predict(df).collect()][:2] == [5.0, 7.0]
    assert [r.prediction for r in forest.predict(df).collect()][2] is None
    none = X.fit(df.where("false"), NAMES, "y", 2, 4)
    assert [len(t.feature) for t in none.trees] == [1, 1]
    assert forest.nodes(spark).where("left is null").count() > 0


def test_rows_that_are_alike_are_one_row_of_every_pass(spark, monkeypatch):
    held, cut = [], X.checkpointed
    monkeypatch.setattr(X, "checkpointed", lambda df: held.append(cut(df)) or held[-1])
    x, y, w = data(300)
    x = np.round(x)
    df = frame(spark, x, y, w)
    copies = df.crossJoin(spark.range(20).select(F.col("id").alias("copy"))).withColumn("y", F.col("y") + F.col("copy") - 9.5)
    got = X.fit(copies.repartition(5), NAMES, "y", 3, 5, min_rows=20, weight="w", seed=1)
    assert held[0].count() == len(np.unique(x, axis=0)) < 300
    for t, tree in enumerate(got.trees):
        want = brute(np.repeat(x, 20, axis=0), (y[:, None] + np.arange(20) - 9.5).ravel(), np.repeat(w, 20), 1, t, 5, 1, 20)
        assert len(want) == len(tree.feature) > 5
        for n, (f, threshold, mean) in want.items():
            # a node of rows that are alike varies in its labels and still can't be split
            assert tree.feature[n] == (-1 if f is None else f) and tree.value[n] == pytest.approx(mean)
            assert f is None or tree.threshold[n] == pytest.approx(threshold)


@pytest.mark.parametrize("remembered", [0, 5, 100_000])
def test_predictions_of_rows_seen_before(spark, monkeypatch, remembered):
    monkeypatch.setattr(X, "REMEMBERED", remembered)
    x, y, w = data(400)
    x = np.round(x, 1)
    df = frame(spark, x, y, w)
    forest = X.fit(df, NAMES, "y", 5, 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        found = forest.predict(df.coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for r in found:
        at = np.array([[r.a, r.b, r.c]])
        assert r.prediction == pytest.approx(np.mean([t.packed()[4][X.node_of(t.packed(), at)[0]] for t in forest.trees]))
