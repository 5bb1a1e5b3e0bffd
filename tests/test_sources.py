"""Grids in files, sketches, area weights and records of changing shape."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import raster as R
from nivalis.operators import sketches as K
from nivalis.sources import grids as G
from nivalis.sources import readers


def written(spark, tmp_path, days=6, height=7, width=5, band=3):
    rng = np.random.default_rng(1)
    rows = [(dt.date(2024, 1, 1 + d), y, x, float(rng.integers(0, 99)) + d / 8) for d in range(days) for y in range(height) for x in range(width) if rng.random() > 0.3]
    df = spark.createDataFrame([*rows, (dt.date(2024, 1, 1), None, 1, 5.0), (dt.date(2024, 1, 1), 1, -1, 5.0), (None, 1, 1, 5.0)], "day date, y int, x int, z double")
    files = G.write_grids(df, f"file://{tmp_path}/g", "swe", 40.0, -110.0, 0.5, band=band)
    return rows, files


def cells(df):
    return sorted((r.day, r.y, r.x, r.z) for r in df.collect())


def test_grids_round_trip(spark, tmp_path):
    rows, files = written(spark, tmp_path)
    assert files.count() == 18 and files.agg(F.sum("cells")).first()[0] == len(rows)
    found = G.read_grids(spark, f"file://{tmp_path}/g")
    assert cells(found) == sorted(rows)
    r = found.where("y = 2 and x = 3").first()
    assert (r.lat, r.lon) == (39.0, -108.5)
    # a run again leaves the same files
    again, _ = written(spark, tmp_path)
    assert cells(G.read_grids(spark, f"file://{tmp_path}/g")) == sorted(again)
    assert len([p for p in (tmp_path / "g").iterdir() if p.suffix == ".grid"]) == 18


def test_files_of_other_days_are_not_opened(spark, tmp_path):
    rows, _ = written(spark, tmp_path)
    for path in (tmp_path / "g").glob("*.grid"):
        if "2024-01-03" not in path.name and "2024-01-04" not in path.name:
            path.write_bytes(b"broken")
    wanted = sorted(r for r in rows if r[0] in (dt.date(2024, 1, 3), dt.date(2024, 1, 4)))
    assert cells(G.read_grids(spark, f"file://{tmp_path}/g", "2024-01-03", "2024-01-04")) == wanted
    with pytest.raises(Exception, match="unpack|not a grid"):
        G.read_grids(spark, f"file://{tmp_path}/g").collect()
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        every = spark.read.format("dated_grids").option("path", f"file://{tmp_path}/g").option("pushdown", "true").load()
        assert cells(every.where("day >= date'2024-01-03' and day < date'2024-01-05' and z >= 0")) == wanted
        assert cells(every.where("day = date'2024-01-04'")) == [r for r in wanted if r[0].day == 4]
    finally:
        spark.conf.set(key, before)


def test_grids_as_a_stream(spark, tmp_path):
    first, _ = written(spark, tmp_path, days=2)

    def run():
        stream = G.stream_grids(spark, f"file://{tmp_path}/g")
        stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
        return cells(spark.read.parquet(f"file://{tmp_path}/out"))

    assert run() == sorted(first)
    later = spark.createDataFrame([(dt.date(2024, 2, 1), 0, 0, 7.0)], "day date, y int, x int, z double")
    G.write_grids(later, f"file://{tmp_path}/g", "swe", 40.0, -110.0, 0.5)
    assert run() == sorted([*first, (dt.date(2024, 2, 1), 0, 0, 7.0)])
    assert run() == sorted([*first, (dt.date(2024, 2, 1), 0, 0, 7.0)])


def test_sketches_merge_to_what_the_rows_give(spark):
    rng = np.random.default_rng(2)
    rows = [(dt.date(2024, 1, 1 + int(d)), None if rng.random() < 0.05 else float(v), int(p)) for d, v, p in zip(rng.integers(0, 20, 20_000), rng.gamma(2, 30, 20_000), rng.integers(0, 3000, 20_000), strict=True)]
    df = spark.createDataFrame(rows, "d date, v double, p int").repartition(5)
    days = K.daily(df, "d", "v", F.col("p"), 0.0, 200.0, 40)
    assert days.count() == 20
    days.cache()
    for a, b in ((1, 20), (3, 7), (5, 5)):
        own = [r for r in rows if a <= r[0].day <= b]
        v = np.array(sorted(x[1] for x in own if x[1] is not None))
        merged = K.over(days, "d", f"2024-01-{a:02d}", f"2024-01-{b:02d}")
        r = K.answers(merged).first()
        assert (r.n, r.n_null, r.smallest, r.largest) == (len(own), len(own) - len(v), v[0], v[-1])
        assert r["mean"] == pytest.approx(v.mean())
        assert abs(r.places - len({x[2] for x in own})) <= K.DISTINCT_ERROR * len({x[2] for x in own}) + 0.5
        for q, s in ((r.q25, 0.25), (r.q50, 0.5), (r.q75, 0.75)):
            assert abs(np.searchsorted(v, q, "right") / len(v) - s) <= K.RANK_ERROR + 1 / len(v)
        bins = np.histogram(v[v <= 200], 40, (0, 200))[0]
        assert {x.bin: x.n for x in K.histogram(merged).collect()} == {i: n for i, n in enumerate(bins) if n}
    assert K.over(days, "d", "2025-01-01", "2025-01-02").count() == 1  # one row of nothing
    assert K.answers(K.over(days, "d", "2025-01-01", "2025-01-02")).first().n is None


def test_area_weights_keep_totals(spark):
    rng = np.random.default_rng(3)
    z = rng.random((12, 10)) * 50
    grid = spark.createDataFrame([(d, y, x, float(z[y, x] + d)) for d in (0, 1) for y in range(12) for x in range(10)], "d int, y int, x int, z double")
    rows, columns = R.overlaps(7, -1.5, 2.25, 0.0, 1.0, "oy", "y", spark), R.overlaps(5, -0.25, 2.3, 0.0, 1.0, "ox", "x", spark)
    sums = R.regrid_by_area(grid, rows, columns, keys=["d"], total=True).groupBy("d").agg(F.sum("z")).collect()
    assert {r[0]: pytest.approx(r[1]) for r in sums} == {0: z.sum(), 1: (z + 1).sum()}
    got = {(r.d, r.oy, r.ox): r.z for r in R.regrid_by_area(grid, rows, columns, keys=["d"]).collect()}
    for (d, oy, ox), v in got.items():
        cover = lambda i, start, step, n: np.clip(np.minimum(np.arange(n) + 1, start + (i + 1) * step) - np.maximum(np.arange(n), start + i * step), 0, None)
        w = np.outer(cover(oy, -1.5, 2.25, 12), cover(ox, -0.25, 2.3, 10))
        assert v == pytest.approx(((z + d) * w).sum() / w.sum())
    assert len(got) == 2 * 6 * 5  # the seventh row of cells begins where the source ends


def test_area_weights_of_gaps_and_falling_axes(spark):
    grid = spark.createDataFrame([(0, 0, 4.0), (0, 1, None), (1, 0, 8.0)], "y int, x int, z double")
    rows, columns = R.overlaps(1, 0.0, 2.0, 0.0, 1.0, "oy", "y", spark), R.overlaps(1, 0.0, 2.0, 0.0, 1.0, "ox", "x", spark)
    assert [r.z for r in R.regrid_by_area(grid, rows, columns).collect()] == [6.0]
    assert [r.z for r in R.regrid_by_area(grid, rows, columns, least_share=0.6).collect()] == [None]
    falling = R.overlaps(2, 40.0, -0.75, 40.0, -0.5, "oy", "y", spark).collect()
    assert {(r.oy, r.y): round(r.share, 9) for r in falling} == {(0, 0): 1.0, (0, 1): 0.5, (1, 1): 0.5, (1, 2): 1.0}


def test_records_that_change_their_shape(spark):
    texts = ['{"k": 1}', '{"reading": {"k": 2, "unit": "m"}}', '{"k": "many"}', "{broken", None, '{"k": null, "reading": {"k": 5}}', "[1, 2]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.k, r.unit) for r in readers.drifting(df, "t", {"k": (["$.k", "$.reading.k"], "int"), "unit": (["$.reading.unit"], "string")}).collect()}
    assert got == {0: (1, None), 1: (2, "m"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (5, None), 6: (None, None)}
    assert "unit: STRING" in readers.shape(df.where("i < 2"), "t").first()[0]


def test_cube_in_blocks_is_the_join(spark, monkeypatch):
    """Points and days of no value, of no cell, twice, and more of them than a block holds."""
    monkeypatch.setattr(readers, "RUN", 4, raising=False)
    monkeypatch.setattr(readers, "REPEATED", 3, raising=False)
    points = spark.sql("select id as point_id, int(id % 3) as y, if(id % 7 = 0, null, 0) as x from range(40) union all select 5, 2, 0 union all select null, 1, 0")
    cube = spark.sql("select if(id = 9, null, id) as day_idx, y, 0 as x, if(id = 3, null, id / 10) as value from range(11), (select explode(array(0, 1, 2, 4)) as y) union all select 2, 1, 0, 7")
    want, found = points.join(cube, ["y", "x"]), readers.cube_at(cube, points)
    assert found.columns == want.columns and found.dtypes == want.dtypes
    assert want.count() > 400 and found.exceptAll(want).count() == want.exceptAll(found).count() == 0


def test_all_days_of_many_points_are_small_in_a_file(spark, tmp_path):
    """Far below the two bytes that a day's number takes alone."""
    points = spark.sql("select xxhash64(id) as point_id, 0 as y, 0 as x from range(80)")
    cube = spark.sql("select id as day_idx, 0 as y, 0 as x, rand(1) as value from range(20000)")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readers.cube_at(cube, points).write.parquet(str(tmp_path / "rows"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1_600_000
    assert sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet")) < 0.8 * 1_600_000
