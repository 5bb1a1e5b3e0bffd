"""Operators against numpy and on edge cases."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import aggregates, clean, joins, models, nearest, quality, raster, sampling, timeseries
from nivalis.operators.lineage import numbered
from nivalis.sources import readers, writers
from nivalis.streaming import incremental


def series(spark, values):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(p, day + dt.timedelta(days=i), v) for p, vs in values.items() for i, v in enumerate(vs)], "p int, d date, v double")


def test_fill_linear_equals_interp(spark):
    rnd = random.Random(1)
    values = {p: [rnd.uniform(0, 9) if rnd.random() < 0.5 else None for _ in range(12)] for p in range(6)} | {6: [None] * 4, 7: [None, 2.0, None, 4.0, None]}
    got = timeseries.fill_linear(series(spark, values), ["p"], "d", F.col("v"), "f").orderBy("p", "d").collect()
    for p, vs in values.items():
        known = [i for i, v in enumerate(vs) if v is not None]
        want = np.interp(range(len(vs)), known, [vs[i] for i in known]) if known else np.zeros(len(vs))
        assert [r.f for r in got if r.p == p] == pytest.approx(list(want))
    zero = timeseries.fill_linear(series(spark, {7: values[7]}), ["p"], "d", F.col("v"), "f", leading="zero", spacing="rows")
    assert [r.f for r in zero.orderBy("d").collect()] == [0, 2, 3, 4, 4]


def test_fill_polynomial(spark):
    values = {1: [0.0, 1.0, None, 9.0, 16.0], 2: [None, 3.0, None]}
    got = timeseries.fill_polynomial(series(spark, values), ["p"], "d", "v", 2).orderBy("p", "d").collect()
    assert [r.v for r in got] == pytest.approx([0, 1, 4, 9, 16, 0, 0, 0])


def test_running_sum_skips_nulls(spark):
    got = timeseries.running_sum(series(spark, {1: [1.0, None, 3.0], None: [1.0]}), ["p"], "d", "v", "t").orderBy("d").collect()
    assert [r.t for r in got] == [1, None, 4]


@pytest.mark.parametrize("metric", ["l1", "l2", "haversine"])
def test_nearest_equals_brute_force(spark, metric):
    rnd = random.Random(3)
    points = [(i, rnd.uniform(25, 49), rnd.uniform(-125, -100)) for i in range(60)] + [(99, 80.0, 10.0), (98, None, 1.0)]
    cells = [(i, rnd.randint(250, 490) / 10, rnd.randint(-1250, -1000) / 10) for i in range(300)]
    p = spark.createDataFrame(points, "point_id long, lat double, lon double")
    c = spark.createDataFrame(cells, "cell_id long, lat double, lon double")
    got = {r.point_id: r.distance for r in nearest.nearest(p, c, metric).collect()}

    def distance(a, b):
        if metric == "l1":
            return abs(a[1] - b[1]) + abs(a[2] - b[2])
        if metric == "l2":
            return (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2
        f1, f2 = np.radians(a[1]), np.radians(b[1])
        x = np.sin((f2 - f1) / 2) ** 2 + np.cos(f1) * np.cos(f2) * np.sin(np.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(x))

    assert got == {a[0]: pytest.approx(min(distance(a, b) for b in cells)) for a in points if a[1] is not None}
    assert nearest.nearest(p.where("false"), c, metric).collect() == []


def grid(spark, z):
    return spark.createDataFrame([(y, x, float(z[y, x])) for y in range(z.shape[0]) for x in range(z.shape[1])], "y int, x int, z double")


def as_array(rows, name, shape):
    out = np.full(shape, np.nan)
    for r in rows:
        out[r["y"], r["x"]] = r[name]
    return out


def test_gradient_and_stencils_equal_numpy(spark):
    z = np.random.default_rng(0).uniform(0, 100, (7, 9))
    g = raster.with_gradients(grid(spark, z)).collect()
    gy, gx = np.gradient(z)
    assert np.allclose(as_array(g, "gy", z.shape), gy) and np.allclose(as_array(g, "gx", z.shape), gx)
    padded = np.pad(z, 1, mode="symmetric")
    windows = np.lib.stride_tricks.sliding_window_view(padded, (3, 3)).reshape(*z.shape, 9)
    assert np.allclose(as_array(raster.median_filter(grid(spark, z)).collect(), "z", z.shape), np.median(windows, axis=2))
    weights = np.array(raster.gaussian_weights())
    rows = np.apply_along_axis(lambda v: np.convolve(np.pad(v, 4, mode="symmetric"), weights, "valid"), 0, z)
    want = np.apply_along_axis(lambda v: np.convolve(np.pad(v, 4, mode="symmetric"), weights, "valid"), 1, rows)
    assert np.allclose(as_array(raster.smooth(grid(spark, z)).collect(), "z", z.shape), want)


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    b = spark.createDataFrame([(1, "c"), (None, "d")], "k int, y string")
    assert joins.inner(a, b, ["k"]).count() == 1
    assert joins.inner(a, b, ["k"], null_safe=True).count() == 2


def test_expectations(spark):
    df = spark.createDataFrame([(1.0,), (None,), (500.0,)], "v double")
    assert [(r.checked, r.failed, r.ok) for r in quality.no_nulls(df, ["v"]).collect()] == [(3, 1, False)]
    assert [r.failed for r in quality.at_most(df, {"v": 240.0}).collect()] == [1]
    with pytest.raises(Exception, match=quality.FAILED):
        quality.required(df, F.col("v") < 100).collect()


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (500.0,)], "v double")
    assert [r[0] for r in df.select(clean.clip(F.col("v"), 0.0, 240.0)).collect()] == [0.0, None, 240.0]


def haversine(a, b):
    f1, f2 = np.radians(a[1]), np.radians(b[1])
    x = np.sin((f2 - f1) / 2) ** 2 + np.cos(f1) * np.cos(f2) * np.sin(np.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371 * np.arcsin(np.sqrt(x))


def test_haversine_joins_around_the_globe(spark):
    rnd = random.Random(7)
    points = [(i, rnd.uniform(-89.9, 89.9), rnd.choice([-179.95, 179.95, 0.0, rnd.uniform(-180, 180)])) for i in range(50)] + [(90, 40.0, 179.95), (91, 75.0, 10.0), (92, 89.97, 5.0)]
    cells = [(i, a[1] + rnd.uniform(-0.1, 0.1), (a[2] + rnd.uniform(-1, 1) + 180) % 360 - 180) for i, a in enumerate(points * 4)] + [(900, 40.0, -179.95), (901, 40.0, 179.0), (902, 75.0, 10.6), (903, 89.97, -175.0)]
    cells = [(i, max(-90.0, min(90.0, y)), x) for i, y, x in cells]
    p = spark.createDataFrame(points, "point_id long, lat double, lon double")
    c = spark.createDataFrame(cells, "cell_id long, lat double, lon double")
    got = {r.point_id: (r.cell_id, r.distance) for r in nearest.nearest(p, c, "haversine").collect()}
    assert all(got[a[0]][1] == pytest.approx(min(haversine(a, b) for b in cells)) for a in points) and got[90][0] == 900
    found = {(r.point_id, r.cell_id) for r in nearest.within(p, c, 20.0, "haversine").collect()}
    assert found == {(a[0], b[0]) for a in points for b in cells if haversine(a, b) <= 20}
    assert (91, 902) in found and (92, 903) in found


def test_numbered_and_quantiles_need_no_single_task(spark):
    rnd = random.Random(1)
    values = [(rnd.choice("ab"), None if rnd.random() < 0.1 else float(rnd.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame(values, "name string, value double").repartition(7)
    rows = numbered(df, ["value", "name"]).collect()
    assert sorted(r.row for r in rows) == list(range(1, 3001))
    by_row = [(r.value is not None, r.value or 0, r.name) for r in sorted(rows, key=lambda r: r.row)]
    assert by_row == sorted(by_row)
    got = {r.name: (r.q0, r.q1, r.q2) for r in aggregates.quantiles(df, (0.25, 0.5, 0.9)).collect()}
    for name in "ab":
        own = [v for n, v in values if n == name and v is not None]
        assert got[name] == pytest.approx(tuple(np.percentile(own, [25, 50, 90])))
    plan = numbered(df, ["value"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # only the sizes of the ranges


def test_random_land_points_are_as_many_as_asked(spark):
    cells = spark.createDataFrame([(y, x, 1 if (y * 20 + x) % 20 == 0 else 239) for y in range(20) for x in range(20)], "y int, x int, code int")
    got = sampling.random_land_points(cells, 50, 25.0, -125.0, 0.5, 20, 20).collect()
    assert len(got) == 50 and {r.code for r in got} == {1}
    assert all(25 + r.y * 0.5 <= r.lat < 25.5 + r.y * 0.5 and -125 + r.x * 0.5 <= r.lon < -124.5 + r.x * 0.5 for r in got)
    assert sampling.random_land_points(cells.where("code = 239"), 5, 25.0, -125.0, 0.5, 20, 20).collect() == []


def test_regrid_fills_every_cell(spark):
    cells = spark.createDataFrame([(y * 4 + x, 40.0 - y, -100.0 + x, float(y * 4 + x)) for y in range(4) for x in range(4)], "cell_id long, lat double, lon double, z double")
    got = raster.regrid(cells, 0.4, 40.2, -100.2, 36.2, -96.2).collect()
    assert len(got) == 100
    for r in got:
        lat, lon = 40.2 - (r.oy + 0.5) * 0.4, -100.2 + (r.ox + 0.5) * 0.4
        if lat < 36.5 or lon > -96.5:  # more than half a cell beyond the source
            assert r.z is None
            continue
        assert r.z == 4 * min(range(4), key=lambda y: (round(abs(40 - y - lat), 9), -y)) + min(range(4), key=lambda x: (round(abs(x - 100 - lon), 9), x))


def test_payloads_without_binaries(spark, tmp_path):
    for name, data in (("a", b"text"), ("b", b""), ("c", b"x\x00y"), ("d", b"t" * 2000 + b"\x00")):
        (tmp_path / name).write_bytes(data)
    assert sorted(r.path[-1] for r in readers.payloads(spark, f"file://{tmp_path}").collect()) == ["a", "d"]
    df = spark.createDataFrame([(b"ab",), (b"t" * 2000 + b"\x00",), (b"",), (None,)], "c binary")
    assert [r[0] for r in df.select(readers.is_text(F.col("c"), None)).collect()] == [True, False, False, None]


def test_dense_cube(spark):
    df = spark.createDataFrame([(1, 1, "a", 1.0), (2, 2, "b", 2.0), (3, 1, "b", None)], "p int, d int, k string, v double")
    cube = {(r.p, r.d, r.k): r.v for r in writers.dense_cube(df, "p", "d", "k", "v").collect()}
    assert len(cube) == 12 and {k: v for k, v in cube.items() if v is not None} == {(1, 1, "a"): 1.0, (2, 2, "b"): 2.0}


def test_inventory_needs_no_shuffle(spark):
    df = spark.createDataFrame([(1, " a b  c\td e f g "), (2, None), (3, "a b"), (4, "1 2 3 4 5 6 7 8 9 10 11 12")], "k int, t string")
    out = readers.inventory(df, "k", "t")
    assert sorted((r.k, r.record, r.f0, r.f5) for r in out.collect()) == [(1, 0, "a", "f"), (4, 0, "1", "6"), (4, 1, "7", "12")]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_canonical_names():
    assert clean.CANONICAL["cumulative_AMSR_Flag"] == "cumulative_Flag" and clean.CANONICAL["cumulative_vs"] == "cumulative_wind_speed"
    assert "cumulative_Latitude" not in clean.CANONICAL


def test_label_codes_follow_the_sorted_texts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "t string")
    assert sorted(map(tuple, models.label_encoded(df, "t").collect())) == [("a", 0), ("a", 0), ("b", 1), ("c", 2)]


def test_stream_in_batches_drops_what_is_too_late(spark, tmp_path):
    schema = "ts timestamp, k string, value double"
    at = lambda day, hour=1: dt.datetime(2024, 1, day, hour)
    batches = [[(at(1), "a", 1.0), (at(2), "a", 2.0)], [(at(8), "a", 4.0), (at(1, 2), "a", 8.0)], [(at(1, 3), "a", 100.0), (at(9), "a", 16.0)], [(at(20), "a", 32.0)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, files_at_once=1)
        incremental.run_available(incremental.daily_totals(stream, "ts", ["k"], "value"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {r.window.start.day: (r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    # day 1 is complete once day 8 has come: the row of the second file counts, that of the third is too late
    assert got == {1: (2, 9.0), 2: (1, 2.0), 8: (1, 4.0), 9: (1, 16.0)}


def test_season_state_is_carried_over(spark, tmp_path):
    schema = "day date, p int, v double"
    for rows in ([(dt.date(2024, 1, 1), 1, 1.0)], [(dt.date(2024, 1, 2), 1, 2.0), (dt.date(2024, 10, 1), 1, 4.0)], [(dt.date(2024, 9, 30), 1, 8.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, files_at_once=1)
        incremental.run_available(incremental.season_totals(stream, "day", "p", "v"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "complete")
    assert sorted((r.water_year, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(2024, 3, 11.0), (2025, 1, 4.0)]
