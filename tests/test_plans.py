"""What the plans of joins, weights and expectations do, and what they give on hard cases."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import aggregates as A
from nivalis.operators import joins as J
from nivalis.operators import nearest as N
from nivalis.operators import quadtree
from nivalis.operators import quality as Q
from nivalis.operators import raster as R
from nivalis.operators import timeseries as W
from nivalis.sources.bucketed import bucketed
from nivalis.sources.published import Versions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- nearest cells


def fine_grid(spark, n):
    """n x n cells within one degree."""
    return spark.range(n * n).select(F.col("id").alias("cell_id"), (40 + F.floor(F.col("id") / n) / n).alias("lat"), (-105 + (F.col("id") % n) / n).alias("lon"))


def random_points(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, float(40 + a), float(-105 + b)) for i, (a, b) in enumerate(rng.random((n, 2)))], "point_id long, lat double, lon double")


@pytest.mark.parametrize("metric", ["l2", "haversine"])
def test_pairs_do_not_grow_with_the_grid(spark, metric):
    """Ten times as fine a grid on each axis, as many pairs for a point, and no more than nine leaves' cells."""
    points, most = random_points(spark, 100), []
    for n in (70, 700):
        tree = quadtree.build(fine_grid(spark, n))
        counts = [r["count"] for r in quadtree.candidates(points, tree, metric).groupBy("point_id").count().collect()]
        assert len(counts) == 100
        most.append((max(counts), np.mean(counts)))
        got = {r.point_id: r.distance for r in quadtree.nearest(points, tree, metric).collect()}
        if metric == "l2":
            for r in points.collect():
                axis = lambda v, low: min(abs(v - low - k / n) for k in (int((v - low) * n), min(int((v - low) * n) + 1, n - 1)))  # noqa: B023, E731
                assert got[r.point_id] == pytest.approx(axis(r.lat, 40) ** 2 + axis(r.lon, -105) ** 2, abs=1e-12)
    assert most[1][0] <= 9 * quadtree.LEAF and most[1][1] <= 3 * max(most[0][1], quadtree.LEAF)


def test_uneven_cells_ties_and_copies(spark):
    """A dense cluster, cells far from it, many cells in one place: as brute force says, ties to the smallest id."""
    rng = np.random.default_rng(3)
    where = [*np.round(rng.normal(0, 0.001, (400, 2)), 4), *np.round(rng.uniform(-50, 50, (60, 2)), 0), *[(7.0, 7.0)] * 200, *[(7.0, 9.0)] * 3]
    cells = [(i * 7 % 997, float(a), float(b)) for i, (a, b) in enumerate(where)]
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate([*np.round(rng.normal(0, 0.002, (80, 2)), 4), *np.round(rng.uniform(-60, 60, (80, 2)), 0), (7.0, 8.0), (7.0, 7.0)])]
    cells += [(5000, None, 1.0)]
    df = lambda rows, key: spark.createDataFrame(rows, f"{key} long, lat double, lon double")
    for metric, d in (("l1", lambda a, b: abs(a[1] - b[1]) + abs(a[2] - b[2])), ("l2", lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2)):
        got = {r.point_id: (r.distance, r.cell_id) for r in N.nearest(df([*points, (999, None, 1.0)], "point_id"), df(cells, "cell_id"), metric).collect()}
        assert got == {p[0]: min((d(p, c), c[0]) for c in cells if c[1] is not None) for p in points}


def test_a_long_thin_grid_and_points_of_one_place(spark):
    """24,000 rows of 50 columns, all points at one end: still a few leaves' cells for each, and points of one place walk once."""
    thin = spark.range(1_200_000).select(F.col("id").alias("cell_id"), (250 + 6 * F.floor(F.col("id") / 50)).alias("lat"), (-1250 + 5 * (F.col("id") % 50)).alias("lon"))
    points = spark.range(400).select(F.col("id").alias("point_id"), (250 + (F.col("id") % 100) * 37 % 241).alias("lat"), (-1250 + (F.col("id") % 100) * 53 % 251).alias("lon"))
    tree = quadtree.build(thin)
    assert quadtree._reached(points, tree, "l1").select("lat", "lon").distinct().count() == 100
    met = quadtree.candidates(points, tree, "l1").groupBy("point_id").count().agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).first()
    assert met.n == 400 and met.most <= 9 * quadtree.LEAF
    near = lambda v, low, step: min(abs(v - low - step * k) for k in ((v - low) // step, (v - low) // step + 1))
    columns = lambda v: min(abs(v + 1250 - 5 * k) for k in range(50))
    got = {r.point_id: r.distance for r in quadtree.nearest(points, tree, "l1").collect()}
    assert got == {r.point_id: near(r.lat, 250, 6) + columns(r.lon) for r in points.collect()}


def test_one_tree_for_several_joins(spark):
    tree = N.build(fine_grid(spark, 20))
    a = N.nearest(random_points(spark, 30, 1), tree, "l2").collect()
    b = N.nearest(random_points(spark, 30, 1), fine_grid(spark, 20), "l2").collect()
    assert sorted(a) == sorted(b)
    assert N.build(fine_grid(spark, 20).where("false")) is None


def test_terrain_means_between_two_roundings(spark):
    """Means that end in 5 are rounded away from zero, whatever the order of a sum leaves in their last digits."""
    from nivalis.plans.fixtures import view
    from nivalis.plans.grid_queries import a11

    got = {r.cell: r.curvature for r in a11(view(spark, "/root/testdata/sf0.1", "grid")).collect()}
    assert [got[c] for c in (18, 20, 24, 46)] == [0.9688, -0.7688, -1.6313, 3.8938]


# ---- chains of joins


def sources(spark):
    rows = lambda n, name, *more: spark.createDataFrame([*[(i % n, i % 3, float(i % 5)) for i in range(40)], *more], f"p int, d int, {name} double")
    return [rows(5, "a", (None, 1, 2.0), (None, 1, 2.0)), rows(7, "b", (None, 1, 2.0), (90, 1, None)), rows(11, "c", (4, None, None), (90, 1, 3.0))]


def full_chain(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, ["p", "d"], "full_outer").dropDuplicates()
    return out.dropDuplicates()


def test_outer_chain_equals_full_joins(spark):
    frames = sources(spark)
    key = lambda df: sorted(map(str, df.select("p", "d", "a", "b", "c").collect()))
    assert key(J.outer_chain(frames, ["p", "d"])) == key(full_chain(frames))


def test_bucketed_sources_do_not_move(spark, tmp_path):
    frames = [f.where("p is not null and d is not null") for f in sources(spark)]
    stored = [bucketed(f, f"file://{tmp_path}/{i}", ["p", "d"], 4) for i, f in enumerate(frames)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored[0].join(stored[1], ["p", "d"], "left").join(stored[2], ["p", "d"], "left")
        assert "Exchange" not in plan(joined)
        chain = plan(J.outer_chain(stored, ["p", "d"]))
        # what is left to move are the distinct keys, and the rows without a whole key
        scans = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", chain)
        assert all(re.fullmatch(r"p#\d+, d#\d+, \d+", x) or x.count("#") > 3 for x in scans) and len(scans) <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = lambda df: sorted(map(str, df.select("p", "d", "a", "b", "c").collect()))
    assert rows(J.outer_chain(stored, ["p", "d"])) == rows(full_chain(frames))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


# ---- weights


def test_weights_of_a_whole_table_need_no_single_task(spark):
    df = spark.range(100).selectExpr("id % 4 as k", "double(id) as v")
    found = A.scaled_weight(df, "v")
    assert "Window" not in plan(found)
    assert {r.weight for r in found.where("v in (0, 99)").collect()} == {0.0, 10.0}
    own = {(r.k, r.v): r.weight for r in A.scaled_weight(df.unionByName(spark.sql("select cast(null as bigint) as k, 5D as v")), "v", keys=["k"]).collect()}
    assert own[0, 0.0] == 0.0 and own[0, 96.0] == 10.0 and own[None, 5.0] is None and len(own) == 101


# ---- expectations


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_report_costs_no_second_scan(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "case when id % 10 > 0 then id end as v")
    rules = {"v": F.col("v").isNotNull(), "id": F.col("id") < 50}
    _, plain = jobs_of(spark, "plain", lambda: df.write.parquet(f"file://{tmp_path}/a"))
    watch = Q.Watch(df, rules)
    _, watched = jobs_of(spark, "watched", lambda: watch.df.write.parquet(f"file://{tmp_path}/b"))
    assert watched == plain
    report, more = jobs_of(spark, "report", lambda: watch.report())
    assert more == 0
    assert {(r.expectation, r.checked, r.failed, r.ok) for r in report.collect()} == {("v", 100, 10, False), ("id", 100, 50, False)}
    assert sorted(report.collect()) == sorted(Q.expect(df, rules).collect())


def test_a_step_is_counted_in_its_own_run(spark, tmp_path):
    df = spark.range(50).selectExpr("id % 5 as p", "date_add(date'2024-01-01', int(id div 5)) as d", "double(id) as v")
    step = lambda x: W.running_sum(x, ["p"], "d", "v", "s")
    row, n = jobs_of(spark, "step", lambda: Q.watched_step(df, step, lambda x: x.write.format("noop").mode("overwrite").save()))
    assert tuple(row.first()) == (50, 50, True)
    _, alone = jobs_of(spark, "alone", lambda: step(df).write.format("noop").mode("overwrite").save())
    assert n == alone
    assert tuple(Q.watched_step(df, lambda x: x.where("p > 0"), lambda x: x.count()).first()) == (50, 40, False)


def test_a_result_that_breaks_a_rule_is_not_published(spark, tmp_path):
    root, good = f"file://{tmp_path}/r", {"v": F.col("v") < 5}
    number, report = Q.publish_checked(spark, root, "a", spark.range(5).selectExpr("id as v"), good)
    assert number == 1 and report.first().ok
    for df, least in ((spark.range(6).selectExpr("id as v"), 0), (spark.range(2).selectExpr("id as v"), 3), (spark.sql("select cast(null as int) as v"), 0)):
        with pytest.raises(Q.ExpectationFailed) as e:
            Q.publish_checked(spark, root, "b", df, good, least)
        assert e.value.failed
    assert Versions(spark, root).latest() == 1
    assert len(list((tmp_path / "r/runs").iterdir())) == 1


# ---- series


def test_polynomial_on_whole_numbers_and_short_series(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [("a", day(i), i * i if i not in (3, 7) else None) for i in range(10)] + [("b", day(i), 5 if i < 2 else None) for i in range(4)] + [(None, day(0), 1)]
    df = spark.createDataFrame(rows, "p string, d date, v int")
    got = {(r.p, r.d): r.v for r in W.fill_polynomial(df, ["p"], "d", "v", 2).collect()}
    assert len(got) == 14
    assert got["a", day(3)] == pytest.approx(9) and got["a", day(7)] == pytest.approx(49) and got["a", day(2)] == 4.0
    assert {v for (p, _), v in got.items() if p == "b"} == {0.0}
    rng = np.random.default_rng(2)
    y = rng.normal(size=60)
    rows = [("a", day(i), None if i % 7 == 3 else float(y[i])) for i in range(60)]
    got = {r.d: r.v for r in W.fill_polynomial(spark.createDataFrame(rows, "p string, d date, v double"), ["p"], "d", "v", 3).collect()}
    known = [i for i in range(60) if i % 7 != 3]
    line = np.polyval(np.polyfit(known, y[known], 3), np.arange(60))
    assert all(got[day(i)] == pytest.approx(line[i], abs=1e-8) for i in range(60) if i % 7 == 3)


def test_a_line_does_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(5)
    rows = [("a", i, None if i % 4 == 1 else round(float(rng.uniform(0, 240)), 2)) for i in range(200)] + [("one", 3, 2.0), ("one", 4, None), ("same", 1, 2.0), ("same", 1, 4.0), ("same", 1, None)]
    found = []
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows, "p string, x int, v double").repartition(n, F.rand(n))
        found.append(sorted((r.p, r.x, str(r.v), r.f) for r in W.fill_line(df, ["p"], F.col("x"), F.col("v"), "f").collect()))
    assert found[0] == found[1] == found[2]
    known = [(x, v) for p, x, v in rows if p == "a" and v is not None]
    slope, at = np.polyfit(*zip(*known, strict=True), 1)
    for p, x, v, f in found[0]:
        if p == "a" and v == "None":
            assert f == pytest.approx(at + slope * x)
    assert {f for p, *_, v, f in found[0] if p == "one"} == {0.0}
    assert {f for p, _, v, f in found[0] if p == "same" and v == "None"} == {3.0}


# ---- window sums


@pytest.mark.parametrize("half, side", [(1, 4), (3, 7), (5, 16)])
def test_focal_means_by_integral_images(spark, monkeypatch, half, side):
    monkeypatch.setattr(R.B, "SIDE", side)
    rng = np.random.default_rng(4)
    cells = [(y, x, None if rng.random() < 0.1 else float(rng.integers(0, 90)), float(rng.integers(0, 360))) for y in range(20) for x in range(23) if rng.random() > 0.2]
    points = [(i, int(rng.integers(-3, 24)), int(rng.integers(-3, 27))) for i in range(60)] + [(100, 5, 5), (101, 5, 5), (102, None, 1)]
    got = {r.point_id: r for r in R.focal_means(spark.createDataFrame(points, "point_id int, y int, x int"), spark.createDataFrame(cells, "y int, x int, z double, a double"), ["z", "a"], half, ["a"]).collect()}
    for i, y, x in points:
        near = [] if y is None else [c for c in cells if y - half <= c[0] < y + half and x - half <= c[1] < x + half]
        if not near:
            assert i not in got
            continue
        assert got[i].n == len(near)
        z = [c[2] for c in near if c[2] is not None]
        assert got[i].mean_z == (pytest.approx(np.mean(z)) if z else None)
        turn = np.degrees(np.arctan2(*[sum(f(np.radians(c[3])) for c in near) for f in (np.sin, np.cos)])) % 360
        assert abs((got[i].mean_a - turn + 180) % 360 - 180) < 1e-6
        own = [c for c in near if c[:2] == (y, x)]
        assert (got[i].own_z, got[i].own_a) == (own[0][2:] if own else (None, None))
