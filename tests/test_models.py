"""What seeded models and samples give, where SQL can't say it: bounds on their errors, and their limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import bagged
from nivalis.operators import models as M
from nivalis.operators import sampling as S
from nivalis.plans import all_queries

SF = "/root/testdata/sf0.001"
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = 20 * (x[:, 0] > 0.5) + 8 * x[:, 1] + rng.normal(size=2000) / 4
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))], "i int, a double, b double, c double, y double")
    return df.where("i % 4 > 0").cache(), df.where("i % 4 = 0").cache()


def test_forest_explains_rows_it_has_not_seen(rows):
    train, test = rows
    found = M.fit(train, NAMES, M.forest("y", 10, 8)).transform(test)
    assert M.metrics(found, "y").first().r2 > 0.95
    low, high = train.agg(F.min("y"), F.max("y")).first()
    assert found.where((F.col("prediction") < low) | (F.col("prediction") > high)).count() == 0


def test_importances_are_shares_in_order(rows, spark):
    train, _ = rows
    found = M.importances(M.fit(train, NAMES, M.forest("y", 10, 8)), NAMES, spark).orderBy("rank").collect()
    assert [r.feature for r in found] == ["a", "b", "c"] and [r["rank"] for r in found] == [1, 2, 3]
    assert sum(r.importance for r in found) == pytest.approx(1) and found[0].importance > 0.7 and found[2].importance < 0.05


def test_search_takes_the_better_setting(rows):
    train, test = rows
    best = M.search(train, NAMES, "y", [5], [1, 8])
    assert best.bestModel.stages[-1].getMaxDepth() == 8
    assert M.metrics(best.transform(test), "y").first().r2 > 0.95


def test_second_pass_weighs_rare_errors(rows):
    train, test = rows
    found = M.metrics(M.fit_twice(train, NAMES, "y", lambda label, **more: M.forest(label, 10, 8, **more)).transform(test), "y").first()
    assert found.r2 > 0.9


@pytest.mark.parametrize("name", ["m04_forest", "m05_extra_trees", "m06_fit_twice", "m19_saved_model"])
def test_registered_models_stay_near_the_mean_of_labels_that_follow_nothing(spark, name):
    """The test tables' prices do not depend on the features: no model can beat their mean by much, and none may do much worse."""
    assert -0.15 < M.metrics(all_queries()[0][name](spark, SF)).first().r2 < 0.15


@pytest.mark.parametrize("name", ["m13_cover_model", "m15_search", "m11_compare"])
def test_registered_metrics_agree_with_each_other(spark, name):
    for r in all_queries()[0][name](spark, SF).collect():
        assert 0 < r.mae <= r.rmse and r.rmse == pytest.approx(r.mse**0.5) and r.r2 < 1


@pytest.mark.parametrize("name", ["m09_importances", "m13_cover_importances", "o04_ranked_importances"])
def test_registered_importances(spark, name):
    found = all_queries()[0][name](spark, SF).orderBy("rank").collect()
    assert sum(r.importance for r in found) == pytest.approx(1)
    assert [r.importance for r in found] == sorted((r.importance for r in found), reverse=True)


def test_land_points_are_uniform_and_on_land(spark):
    """Points fall only on land cells, and about as often on each."""
    grid = spark.range(100).selectExpr("id as cell_id", "int(id div 10) as y", "int(id % 10) as x", "case when id % 10 < 5 then 0 else 50 end as code")
    found = S.random_land_points(grid, 400, 30.0, -110.0, 0.5, 10, 10).collect()
    assert len(found) > 0
    names = found[0].asDict().keys()
    cells = {(int((r.lat - 30.0) / 0.5), int((r.lon + 110.0) / 0.5)) for r in found}
    assert {"lat", "lon"} <= set(names)
    assert all(30.0 <= r.lat < 35.0 and -110.0 <= r.lon < -105.0 for r in found)
    assert len(cells) > 35


def test_run_ids(spark):
    for r in all_queries()[0]["f18_run_id"](spark, SF).collect():
        assert len(r.run_id) == 5 and r.run_id.isalnum()


@pytest.fixture
def alike(spark, monkeypatch):
    """Rows of 60 kinds, 50 of each, as a table that is large enough to be summed first."""
    monkeypatch.setattr(bagged, "LEAST_ROWS", 1000)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, n, 3000) for n in (5, 4, 3)]).astype(float)
    y = 10 * (x[:, 0] > 2) + 3 * x[:, 1] + rng.normal(size=3000)
    w = rng.integers(1, 4, 3000).astype(float)
    return spark.createDataFrame([(*map(float, r), float(v), float(k)) for r, v, k in zip(x, y, w, strict=True)], "a double, b double, c double, y double, w double").repartition(3).cache()


@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("held", [20_000, 140])
def test_samples_are_bootstraps_summed_by_kind(alike, monkeypatch, weight, held):
    monkeypatch.setattr(bagged, "HELD", held)
    found = bagged.samples(alike.union(alike.limit(1).selectExpr("null", "b", "c", "y", "w")), NAMES, "y", 40, weight).collect()
    own = {(r[0], r[1], r[2]): r for r in alike.groupBy("a", "b", "c").agg(*[F.sum(F.expr(f"{weight or 1} * {v}")).alias(n) for n, v in (("n", "1"), ("ny", "y"))]).collect()}
    assert len(found) == len(own) and {tuple(r)[:3] for r in found} == set(own)
    for *kind, w, wy in map(tuple, found):
        want = own[tuple(kind)]
        # the sizes of samples spread around that of the rows themselves
        assert len(w) == 40 and len(set(w)) > 5
        assert np.mean(w) == pytest.approx(want.n, rel=0.25) and np.mean(wy) == pytest.approx(want.ny, rel=0.3, abs=25)


def test_a_forest_of_rows_that_are_alike(alike, monkeypatch, spark, tmp_path):
    """As good as the forest on the rows themselves, near the kinds' means, and it can be saved."""
    make = lambda: M.forest("y", 10, 8, featureSubsetStrategy="all")
    assert bagged.suits(alike, NAMES, M.forest("y", 10, 8)) and not bagged.suits(alike, ["y"], M.forest("y", 10, 8))
    model = M.fit(alike, NAMES, make())
    assert len(model.stages) == 12
    found = model.transform(alike)
    assert found.columns == [*alike.columns, "features", "prediction"]
    monkeypatch.setattr(bagged, "LEAST_ROWS", 10**9)
    plain = M.fit(alike, NAMES, make())
    assert len(plain.stages) == 2
    own, rows = (M.metrics(m.transform(alike), "y").first() for m in (model, plain))
    assert own.r2 > 0.95 and own.r2 == pytest.approx(rows.r2, abs=0.002)
    means = found.groupBy(*NAMES).agg(F.avg("y").alias("m"), F.count_distinct("prediction").alias("n"), F.avg("prediction").alias("p")).collect()
    assert all(r.n == 1 and abs(r.p - r.m) < 0.8 for r in means)
    shares = [{r.feature: r.importance for r in M.importances(m, NAMES, spark).collect()} for m in (model, plain)]
    assert all(shares[0][c] == pytest.approx(shares[1][c], abs=0.02) for c in NAMES) and sum(shares[0].values()) == pytest.approx(1)
    model.save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model")).transform(alike)
    assert again.select(F.sum("prediction")).first()[0] == pytest.approx(found.select(F.sum("prediction")).first()[0])


def test_a_second_pass_of_rows_that_are_alike(alike):
    found = M.fit_twice(alike, NAMES, "y", lambda label, **more: M.forest(label, 5, 8, featureSubsetStrategy="all", **more)).transform(alike)
    assert M.metrics(found, "y").first().r2 > 0.9


def test_rows_that_stand_for_several(alike):
    """Samples of counted rows spread around the same sizes as those of the rows."""
    counted = alike.groupBy(*NAMES, "w").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"))
    found = bagged.samples(counted, NAMES, "y", 40, "w", count="n").collect()
    own = {(r[0], r[1], r[2]): r for r in alike.groupBy(*NAMES).agg(F.sum("w").alias("n"), F.sum(F.expr("w * w")).alias("v")).collect()}
    assert len(found) == len(own)
    for *kind, w, _ in map(tuple, found):
        want = own[tuple(kind)]
        assert np.mean(w) == pytest.approx(want.n, rel=0.25) and np.var(w) == pytest.approx(want.v, rel=0.8)


def test_a_second_pass_reads_the_rows_once_more(alike, monkeypatch, spark):
    """A look at how alike the rows are, a pass for each fit; and the second fit's weights are those by counts of errors."""
    read, weighted = spark.sparkContext.accumulator(0), []

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    fit = bagged.fit
    monkeypatch.setattr(bagged, "fit", lambda train, *more: weighted.append(train) or fit(train, *more))
    again = alike.select(*NAMES, F.round("y").alias("y")).cache()
    model = M.fit_twice(again.mapInArrow(counted, again.schema), NAMES, "y", lambda label, **more: M.forest(label, 3, 4, **more))
    assert read.value == 3 * 3000 and len(model.stages) == 5

    model = fit(again, NAMES, M.forest("y", 3, 4))
    monkeypatch.setattr(bagged, "fit", lambda train, *more: weighted.append(train) or model)
    M.fit_twice(again, NAMES, "y", lambda label, **more: M.forest(label, 3, 4, **more))
    error = F.round(F.abs(F.col("y") - F.col("prediction")), 6)
    want = M.balanced_weights(model.transform(again), error).groupBy(*NAMES, "y").agg(F.count(F.lit(1)).alias("n"), F.avg("weight").alias("want"))
    own = weighted[-1].join(want, [*NAMES, "y"]).select("n", "__rows", (F.col("weight") / F.col("want")).alias("r")).collect()
    assert len(own) == want.count() == weighted[-1].count() and all(r.n == r["__rows"] for r in own)
    assert max(r.r for r in own) == pytest.approx(min(r.r for r in own))


def test_a_second_pass_weighs_other_rows_once(rows, spark):
    """The second fit of Spark ML goes over its rows several times, but they are weighted once."""
    read = []
    for twice in (False, True):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches, seen=seen):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        train = rows[0].mapInArrow(counted, rows[0].schema)
        make = lambda label, **more: M.forest(label, 3, 4, **more)
        M.fit_twice(train, NAMES, "y", make) if twice else M.fit(train, NAMES, make("y"))
        read.append(seen.value)
    # rows are weighted by a join of three readings: themselves, the counts of their errors, and the sizes of these
    assert read[1] - read[0] <= 3 * rows[0].count()
