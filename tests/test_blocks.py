import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import blocks as B
from nivalis.operators import raster as R


def stack(days, height, width, seed=0, gaps=0.2):
    """(day, y, x, z) rows of random grids; some cells missing, some without a value."""
    rng = np.random.default_rng(seed)
    rows = []
    for day in range(days):
        for y in range(height):
            for x in range(width):
                if rng.random() >= gaps or (y, x) == (height - 1, width - 1):
                    rows.append((f"d{day}", y, x, None if rng.random() < gaps / 4 else float(rng.integers(0, 50))))
    return rows


def field(rows, day, height, width):
    z, there = np.full((height, width), np.nan), np.zeros((height, width), bool)
    for d, y, x, v in rows:
        if d == day:
            there[y, x] = True
            z[y, x] = np.nan if v is None else v
    return z, there


def near(z, y, x, offsets, mirror):
    """The values around a cell, one at a time."""
    out = []
    for dy, dx, w in offsets:
        i, j = y + dy, x + dx
        if mirror:
            i, j = (k if 0 <= k < n else -1 - k if k < 0 else 2 * n - 1 - k for k, n in ((i, z.shape[0]), (j, z.shape[1])))
        if 0 <= i < z.shape[0] and 0 <= j < z.shape[1] and not np.isnan(z[i, j]):
            out.append(z[i, j] * w)
    return out


def brute(z, there, how, offsets, mirror):
    out = np.full(z.shape, np.nan)
    for y, x in zip(*np.nonzero(there), strict=True):
        values = near(z, y, x, offsets, mirror)
        out[y, x] = how(values) if values or how is sum else np.nan
    return out


GAUSS = list(zip(range(-4, 5), R.gaussian_weights(), strict=True))


def brute_smooth(z, there):
    rows = brute(z, there, sum, [(d, 0, w) for d, w in GAUSS], True)
    return brute(rows, there, sum, [(0, d, w) for d, w in GAUSS], True)


def brute_closing(z, there):
    return brute(brute(z, there, max, R._CROSS, False), there, min, R._CROSS, False)


def brute_curvature(z, there):
    twice = [brute(brute(z, there, sum, R._sobel(a), False), there, sum, R._sobel(a), False) for a in "yx"]
    return brute_smooth(twice[0] + twice[1], there)


@pytest.mark.parametrize("side", [6, 7, 256])
@pytest.mark.parametrize("name", ["smooth", "median", "closing", "curvature"])
def test_stencils_on_a_stack_with_gaps(spark, name, side):
    rows = stack(3, 13, 17)
    grid = spark.createDataFrame([*rows, (None, 1, 1, 5.0), ("d0", None, 1, 5.0)], "day string, y int, x int, z double")
    run, check, out = {
        "smooth": (R.smooth, brute_smooth, "z"),
        "median": (R.median_filter, lambda z, there: brute(z, there, np.median, R._BOX, True), "z"),
        "closing": (R.closing, brute_closing, "z"),
        "curvature": (R.curvature_sobel, brute_curvature, "curvature"),
    }[name]
    got = {(r.day, r.y, r.x): r[out] for r in run(grid, keys=["day"], side=side).collect()}
    assert set(got) == {r[:3] for r in rows}
    for day in ("d0", "d1", "d2"):
        want = check(*field(rows, day, 13, 17))
        for (d, y, x), v in got.items():
            if d == day:
                assert (v is None and np.isnan(want[y, x])) or v == pytest.approx(want[y, x], abs=1e-9)


def test_edges_only_are_sent(spark):
    """One exchange of the cells, used twice, and one of what lies within the halo of a tile's edge."""
    grid = spark.range(40 * 40).selectExpr("'a' as day", "id div 40 as y", "id % 40 as x", "double(id) as z")
    tiles = B._tiled(grid, ["day"], "z", 20)
    edges = B._edges(tiles, ["day"], 20, 2).join(tiles, ["day", "ty", "tx"]).select(F.sum(F.size("edge"))).first()[0]
    # in each of the four tiles two strips of 2 x 20 and a corner of 2 x 2
    assert edges == 4 * (2 * 2 * 20 + 4)
    plan = R.smooth(grid, radius=2, keys=["day"], side=20)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Generate explode" in plan
    assert "SortMergeJoin" not in plan or plan.count("Exchange hashpartitioning(day") <= 3


def test_a_halo_no_larger_than_a_tile(spark):
    with pytest.raises(ValueError):
        R.smooth(spark.range(1).selectExpr("0 as y", "0 as x", "1.0 as z"), side=3)


def test_terrain_in_one_pass_equals_the_windows(spark):
    grid = spark.createDataFrame([r[1:] for r in stack(1, 11, 9, 4)], "y long, x long, z double")
    got = {(r.y, r.x): r for r in R.terrain_table(grid, side=6).collect()}
    want = R.northness_eastness(grid).select("y", "x", "northness", "eastness").join(R.slope_aspect(grid, from_vertical=True).select("y", "x", "slope", "aspect"), ["y", "x"]).collect()
    assert len(want) == len(got)
    for r in want:
        for c in ("northness", "eastness", "slope", "aspect"):
            assert got[r.y, r.x][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-9))


def test_gradient_stops_at_a_gap(spark):
    grid = spark.createDataFrame([(y, 0, float(y)) for y in (0, 1, 3, 4, 7)], "y int, x int, z double")
    assert {r.y: r.gy for r in R.with_gradients(grid).collect()} == {0: 1.0, 1: 1.0, 3: 1.0, 4: 1.0, 7: None}


def test_empty_grid(spark):
    grid = spark.createDataFrame([], "y int, x int, z double")
    assert R.median_filter(grid).collect() == []


def test_dense_rows(spark):
    grid = spark.createDataFrame([(0, 1, 5.0), (0, 3, 6.0), (1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, 4.0), (2, 0, 9.0)], "y int, x int, z double")
    rows = {r.y: r.row for r in R.dense_rows(grid).collect()}
    assert rows == {0: [None, 5.0, None, 6.0], 1: [1.0, None, 3.0, 4.0], 2: [9.0, None, None, None]}
    assert {len(r.row) for r in R.dense_rows(grid, width=6).collect()} == {6}
    for bad in (R.dense_rows(grid, width=3), R.dense_rows(grid.union(grid.limit(1)))):
        with pytest.raises(Exception, match="repeated or outside"):
            bad.collect()


def test_regrid_carries_nothing_beyond_the_source(spark):
    grid = spark.createDataFrame([(i, 40.0 - i // 4, -100.0 + i % 4, float(i)) for i in range(16)], "cell_id long, lat double, lon double, z double")
    assert {r.z for r in R.regrid(grid, 1.0, 84.5, -100.5, 80.5, -96.5).collect()} == {None}
    same = R.regrid(grid, 1.0, 40.5, -100.5, 36.5, -96.5).collect()
    assert {(r.oy, r.ox): r.z for r in same} == {(y, x): float(4 * y + x) for y in range(4) for x in range(4)}
    wider = {(r.oy, r.ox): r.z for r in R.regrid(grid, 1.0, 41.5, -101.5, 35.5, -95.5).collect()}
    assert wider[0, 0] is None and wider[5, 3] is None and wider[1, 1] == 0.0 and wider[4, 4] == 15.0


@pytest.mark.parametrize("at_once", [1, 3 * 8 * 8, 1 << 17])
def test_small_tiles_are_computed_many_at_a_time(spark, monkeypatch, at_once):
    """Tiles of 6 x 6 cells with one around each, of three days, with gaps and in parts of different sizes."""
    monkeypatch.setattr(B, "AT_ONCE", at_once)
    rows = stack(3, 13, 17)
    grid = spark.createDataFrame(rows, "day string, y int, x int, z double")

    def compute(f):
        return {"n": np.full(f.z.shape, float(len(f.z))), "row": (f.y0[:, None, None] + np.arange(8)[:, None] + np.zeros(8)), "z": f.z}

    got = B.by_tile(grid, compute, ["n", "row", "z"], 1, ["day"], side=6).collect()
    assert {(r.day, r.y, r.x, r.z) for r in got} == set(rows) and len(got) == len(rows)
    assert all(r.row == r.y for r in got)
    most = max(r.n for r in got)
    assert most <= max(1, at_once // 64) and (most > 1) == (at_once > 1)


def test_median_skips_what_has_no_value():
    rng = np.random.default_rng(1)
    z = np.where(rng.random((9, 500)) < 0.4, np.nan, rng.integers(0, 9, (9, 500)).astype(float))
    z[:, 0] = np.nan
    with np.testing.suppress_warnings() as quiet:
        quiet.filter(RuntimeWarning)
        np.testing.assert_array_equal(R._median(z, 0), np.nanmedian(z, axis=0))
