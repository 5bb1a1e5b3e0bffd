"""Queries for nearest joins and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from nivalis.operators import nearest as N
from nivalis.operators import raster as R
from nivalis.plans.registry import query
from nivalis.sources import writers as K

TENTHS = lambda df, key: df.select(F.col(key).alias("point_id" if key == "point_id" else "cell_id"), F.col("lat10").alias("lat"), F.col("lon10").alias("lon"))
DEGREES = lambda grid: grid.select("cell_id", (F.col("lat10") / 10).alias("lat"), (F.col("lon10") / 10).alias("lon"))
_HAV = "2 * 6371.0e0 * asin(sqrt(least(pow(sin(radians(g.lat10 / 10e0 - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(g.lat10 / 10e0)) * pow(sin(radians(g.lon10 / 10e0 - s.lon) / 2), 2), 1e0)))"


@query("j07_nearest_l1", "select s.point_id, min_by(g.cell_id, (abs(s.lat10 - g.lat10) + abs(s.lon10 - g.lon10)) * 100000 + g.cell_id) as cell_id, cast(min(abs(s.lat10 - g.lat10) + abs(s.lon10 - g.lon10)) as int) as distance from station s cross join grid g group by 1", "station", "grid")
def j07(station, grid):
    return N.nearest(TENTHS(station, "point_id"), TENTHS(grid, "cell_id"), "l1").withColumn("distance", F.col("distance").cast("int"))


@query("j08_nearest_l2", "select s.point_id, min_by(g.cell_id, (pow(s.lat10 - g.lat10, 2) + pow(s.lon10 - g.lon10, 2)) * 100000 + g.cell_id) as cell_id from station s cross join grid g group by 1", "station", "grid")
def j08(station, grid):
    return N.nearest(TENTHS(station, "point_id"), TENTHS(grid, "cell_id"), "l2").select("point_id", "cell_id")


_AXES = "with y as (select distinct lat10 as p from grid), x as (select distinct lon10 as p from grid) "


@query("j09_nearest_per_axis", _AXES + "select s.point_id, (select p from y order by abs(p - s.lat10), p limit 1) as near_lat, (select p from x order by abs(p - s.lon10), p limit 1) as near_lon from station s", "station", "grid")
def j09(station, grid):
    points = TENTHS(station, "point_id")
    return N.nearest_per_axis(points, TENTHS(grid, "cell_id")).select("point_id", "near_lat", "near_lon")


@query("j10_nearest_haversine", f"select s.point_id, round(min({_HAV}), 4) as km from station s cross join (select * from grid where code <= 100) g group by 1", "station", "grid")
def j10(station, grid):
    """Only cells with a valid code take part."""
    found = N.nearest(station, DEGREES(grid.where("code <= 100")), "haversine")
    return found.select("point_id", F.round("distance", 4).alias("km"))


@query("j11_nearest_within", f"select s.point_id, round(min({_HAV}), 4) as km from station s cross join grid g where {_HAV} <= 20 group by 1", "station", "grid")
def j11(station, grid):
    found = N.nearest_within(station, DEGREES(grid), 20.0, "haversine")
    return found.select("point_id", F.round("distance", 4).alias("km"))


@query(
    "j12_buffer_mean",
    "select d.point_id, d.obs_date, count(*) as n, round(avg(g.z), 6) as mean from (select distinct point_id, obs_date from daily) d join station s using (point_id) "
    "join grid g on (s.lat10 - g.lat10) * (s.lat10 - g.lat10) + (s.lon10 - g.lon10) * (s.lon10 - g.lon10) <= 400 group by 1, 2",
    "station", "grid", "daily",
)
def j12(station, grid, daily):
    near = N.within(TENTHS(station, "point_id"), TENTHS(grid, "cell_id"), 20.0).join(grid.select("cell_id", "z"), "cell_id")
    days = daily.select("point_id", "obs_date").distinct()
    return days.join(near, "point_id").groupBy("point_id", "obs_date").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("z"), 6).alias("mean"))


@query(
    "j13_mapper",
    "with m as (select s.point_id, min_by(g.cell_id, (abs(s.lat10 - g.lat10) + abs(s.lon10 - g.lon10)) * 100000 + g.cell_id) as cell_id from station s cross join grid g group by 1) "
    "select d.point_id, d.obs_date, d.variable, m.cell_id, g.z from daily d join m using (point_id) join grid g using (cell_id)",
    "station", "grid", "daily",
)
def j13(station, grid, daily):
    """The mapping is made once; each day then joins it by id."""
    mapper = N.nearest(TENTHS(station, "point_id"), TENTHS(grid, "cell_id"), "l1").select("point_id", "cell_id")
    return daily.join(mapper, "point_id").join(grid.select("cell_id", "z"), "cell_id").select("point_id", "obs_date", "variable", "cell_id", "z")


@query(
    "j19_nearest_of_distinct",
    "select d.point_id, d.obs_date, d.variable, m.cell_id from daily d join (select s.point_id, min_by(g.cell_id, (pow(s.lat10 - g.lat10, 2) + pow(s.lon10 - g.lon10, 2)) * 100000 + g.cell_id) as cell_id from station s cross join grid g group by 1) m using (point_id)",
    "station", "grid", "daily",
)
def j19(station, grid, daily):
    rows = daily.join(TENTHS(station, "point_id"), "point_id")
    return N.nearest_of_distinct(rows, TENTHS(grid, "cell_id"), "l2").select("point_id", "obs_date", "variable", "cell_id")


# ---- grids

_W = "window wy as (partition by x order by y), wx as (partition by y order by x)"
_BESIDE = "case when {f}({a}) over w{a} = {a} {d} 1 then {f}({v}) over w{a} end"


def _grad(v: str, a: str) -> str:
    """The gradient in SQL: only cells that are one step away are neighbours."""
    before, after = _BESIDE.format(f="lag", a=a, d="-", v=v), _BESIDE.format(f="lead", a=a, d="+", v=v)
    return f"case when {before} is null then {after} - {v} when {after} is null then {v} - {before} else ({after} - {before}) / 2 end"


_GY, _GX = _grad("z", "y"), _grad("z", "x")
_GS = f"with gr as (select y, x, z, {_GY} as gy, {_GX} as gx from grid {_W}) "


def rounded(df, digits=6):
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


@query("r01_gradient", _GS + "select y, x, round(gy, 6) as gy, round(gx, 6) as gx from gr", "grid")
def r01(grid):
    return rounded(R.with_gradients(grid).select("y", "x", "gy", "gx"))


_TURN = "case when degrees(atan2(-gx, gy)) < 0 then degrees(atan2(-gx, gy)) + 360 else degrees(atan2(-gx, gy)) end"


@query("r02_slope_aspect", _GS + f"select y, x, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) as slope, round({_TURN}, 6) as aspect from gr", "grid")
def r02(grid):
    return rounded(R.slope_aspect(grid).select("y", "x", "slope", "aspect"))


@query("r02_slope_from_vertical", _GS + "select y, x, round(90 - degrees(atan(sqrt(gx * gx + gy * gy))), 6) as slope from gr", "grid")
def r02b(grid):
    return rounded(R.slope_aspect(grid, from_vertical=True).select("y", "x", "slope"))


@query("r03_slope_aspect_spaced", _GS + "select y, x, round(degrees(atan(sqrt(gx * gx + gy * gy) / 30)), 6) as slope, round((degrees(atan2(gy, -gx)) + 360) % 360, 6) as aspect from gr", "grid")
def r03(grid):
    return rounded(R.slope_aspect_spaced(grid, 30.0).select("y", "x", "slope", "aspect"))


@query("r04_curvature_gradient", _GS + f"select y, x, round({_grad('gy', 'y')} + {_grad('gx', 'x')}, 6) + 0e0 as curvature from gr {_W}", "grid")
def r04(grid):
    return R.curvature_gradient(grid).select("y", "x", (F.round("curvature", 6) + 0.0).alias("curvature"))


def _stencil_sql(offsets, source: str, border: str, keys: str = "") -> str:
    """A convolution in SQL: the weights as a table, indices reflected or left out at the border; ``keys`` (with commas) tell grids apart."""
    rows = ", ".join(f"({dy}, {dx}, {w!r}e0)" if "e" not in repr(w) else f"({dy}, {dx}, {w!r})" for dy, dx, w in offsets)
    k = f"(values {rows}) k(dy, dx, w)"
    own = [c.strip() for c in keys.split(",") if c.strip()]
    named, same = "".join(f"t.{c}, " for c in own), "".join(f"s.{c} = t.{c} and " for c in own)
    if border == "zero":
        return f"select {named}t.y, t.x, sum(s.z * k.w) as z from {source} t cross join {k} join {source} s on {same}s.y = t.y + k.dy and s.x = t.x + k.dx group by all"
    inside = lambda i, n: f"case when ({i} + 2 * {n}) % (2 * {n}) < {n} then ({i} + 2 * {n}) % (2 * {n}) else 2 * {n} - 1 - ({i} + 2 * {n}) % (2 * {n}) end"
    return (
        f"select {named}t.y, t.x, sum(s.z * k.w) as z from {source} t cross join (select max(y) + 1 as h, max(x) + 1 as w from {source}) e cross join {k} "
        f"join {source} s on {same}s.y = {inside('(t.y + k.dy)', 'e.h')} and s.x = {inside('(t.x + k.dx)', 'e.w')} group by all"
    )


_SY, _SX = R._sobel("y"), R._sobel("x")
_GAUSS = list(zip(range(-4, 5), R.gaussian_weights(), strict=True))


def _curv_sql(source: str, keys: str = "") -> str:
    part = lambda offsets, of, border: f"({_stencil_sql(offsets, of, border, keys)})"
    return (
        f"with y1 as {part(_SY, source, 'zero')}, y2 as {part(_SY, 'y1', 'zero')}, x1 as {part(_SX, source, 'zero')}, x2 as {part(_SX, 'x1', 'zero')}, "
        f"c as (select {keys}y, x, y2.z + x2.z as z from y2 join x2 using ({keys}y, x)), "
        f"g1 as {part([(d, 0, w) for d, w in _GAUSS], 'c', 'reflect')}, g2 as {part([(0, d, w) for d, w in _GAUSS], 'g1', 'reflect')} "
    )


_CURV = _curv_sql("grid")
#: A side that cuts the grids of the test tables into several tiles.
_TILE = 64


@query("r05_curvature_sobel", _CURV + "select y, x, round(z, 4) as curvature from g2", "grid")
def r05(grid):
    return rounded(R.curvature_sobel(grid, side=_TILE), 4)


@query("r06_northness_eastness", _GS + "select y, x, round(atan(gy / nullif(sqrt(gx * gx + gy * gy), 0)), 6) as northness, round(atan(gx / nullif(sqrt(gx * gx + gy * gy), 0)), 6) as eastness from gr", "grid")
def r06(grid):
    return rounded(R.northness_eastness(grid).select("y", "x", "northness", "eastness"))


@query("r07_from_aspect", _GS + f"select y, x, round(sin(radians({_TURN})), 6) as northness, round(cos(radians({_TURN})), 6) as eastness from gr", "grid")
def r07(grid):
    north, east = R.from_aspect(F.col("aspect"))
    return rounded(R.slope_aspect(grid).select("y", "x", north.alias("northness"), east.alias("eastness")))


@query("r08_median_filter", "select y, x, z from (" + _stencil_sql(R._BOX, "grid", "reflect").replace("sum(s.z * k.w)", "median(s.z)") + ")", "grid")
def r08(grid):
    return R.median_filter(grid, side=_TILE)


@query("r09_closing", "with m as (" + _stencil_sql(R._CROSS, "grid", "zero").replace("sum(s.z * k.w)", "max(s.z)") + ") " + _stencil_sql(R._CROSS, "m", "zero").replace("sum(s.z * k.w)", "min(s.z)"), "grid")
def r09(grid):
    return R.closing(grid, side=_TILE)


_DAY = "day_idx, "
_STACK = "stack as (select day_idx, y, x, value as z from cube) "


def stacked(cube):
    return cube.select("day_idx", "y", "x", F.col("value").alias("z"))


def of_stack(sql: str) -> str:
    """SQL on the stack of daily grids."""
    return f"with {_STACK}, {sql[5:]}" if sql.startswith("with ") else f"with {_STACK} {sql}"


@query("r05_curvature_stack", of_stack(_curv_sql("stack", _DAY) + "select day_idx, y, x, round(z, 4) + 0e0 as curvature from c"), "cube")
def r05_stack(cube):
    """Every day's grid at once; tiles of 3 x 3 cells, whose surroundings of 3 come from the tiles beside them."""
    return R.curvature_sobel(stacked(cube), sigma=None, keys=["day_idx"], side=3).select("day_idx", "y", "x", (F.round("curvature", 4) + 0.0).alias("curvature"))


@query("r08_median_stack", of_stack("select day_idx, y, x, z from (" + _stencil_sql(R._BOX, "stack", "reflect", _DAY).replace("sum(s.z * k.w)", "median(s.z)") + ")"), "cube")
def r08_stack(cube):
    return R.median_filter(stacked(cube), keys=["day_idx"], side=3)


@query(
    "r09_closing_stack",
    of_stack("with m as (" + _stencil_sql(R._CROSS, "stack", "zero", _DAY).replace("sum(s.z * k.w)", "max(s.z)") + ") " + _stencil_sql(R._CROSS, "m", "zero", _DAY).replace("sum(s.z * k.w)", "min(s.z)")),
    "cube",
)
def r09_stack(cube):
    return R.closing(stacked(cube), keys=["day_idx"], side=3)


_GAUSS3 = list(zip(range(-3, 4), R.gaussian_weights(1.0, 3), strict=True))


@query(
    "r09_smooth_stack",
    of_stack(f"with g1 as ({_stencil_sql([(d, 0, w) for d, w in _GAUSS3], 'stack', 'reflect', _DAY)}), g2 as ({_stencil_sql([(0, d, w) for d, w in _GAUSS3], 'g1', 'reflect', _DAY)}) select day_idx, y, x, round(z, 6) + 0e0 as z from g2"),
    "cube",
)
def smooth_stack(cube):
    """Daily maps smoothed, a day at a time, all days at once."""
    return R.smooth(stacked(cube), radius=3, keys=["day_idx"], side=3).select("day_idx", "y", "x", (F.round("z", 6) + 0.0).alias("z"))


@query("r10_window_scaled", "with p as (select y, x, z from grid where y between 1 and 30 and x between 5 and 40) select y, x, round((z - min(z) over ()) / nullif(max(z) over () - min(z) over (), 0), 8) as scaled from p", "grid")
def r10(grid):
    return rounded(R.window_scaled(grid, 1, 30, 5, 40), 8)


@query("r11_tiles", "select cast(floor(y / 8) as bigint) as ty, cast(floor(x / 8) as bigint) as tx, count(*) as n, round(avg(z), 6) as mean from grid group by 1, 2", "grid")
def r11(grid):
    return rounded(R.tiles(grid, 8))


@query(
    "r12_terrain_table",
    _CURV + f", gr as (select y, x, z, {_GY} as gy, {_GX} as gx from grid {_W}) "
    f"select y, x, gr.z as elevation, round(90 - degrees(atan(sqrt(gx * gx + gy * gy))), 4) as slope, round({_TURN}, 4) as aspect, round(atan(gy / nullif(sqrt(gx * gx + gy * gy), 0)), 4) as northness, "
    "round(atan(gx / nullif(sqrt(gx * gx + gy * gy), 0)), 4) as eastness, round(g2.z, 3) as curvature from gr join g2 using (y, x)",
    "grid",
)
def r12(grid):
    out = R.terrain_table(grid, side=_TILE)
    return out.withColumns({c: F.round(c, 4) for c in ("slope", "aspect", "northness", "eastness")}).withColumn("curvature", F.round("curvature", 3))


_DIRECTION = "((degrees(atan2(sum(sin(radians({a}))), sum(cos(radians({a}))))) + 360) % 360)"
_TERRAIN = _GS + f", t as (select y, x, z, degrees(atan(sqrt(gx * gx + gy * gy))) as slope, {_TURN} as aspect, {_grad('gy', 'y')} + {_grad('gx', 'x')} as curvature from gr {_W}) "


def terrain(grid):
    return R.curvature_gradient(R.slope_aspect(grid)).select("y", "x", "z", "slope", "aspect", "curvature")


@query("a11_terrain_summary", _TERRAIN + f", u as (select cast(floor(y / 8) as bigint) as cell, avg(z) as elevation, avg(slope) as slope, avg(curvature) as curvature, {_DIRECTION.format(a='aspect')} as aspect from t group by 1) select cell, round(elevation, 4) as elevation, round(slope, 4) as slope, round(curvature, 4) + 0e0 as curvature, round(aspect, 4) as aspect, round(sin(radians(aspect)), 4) + 0e0 as northness, round(cos(radians(aspect)), 4) + 0e0 as eastness from u", "grid")
def a11(grid):
    """Mean curvatures often lie just between two roundings; nine decimals first take off what the order of a sum leaves."""
    cells = terrain(grid).withColumn("cell", F.floor(F.col("y") / 8))
    out = rounded(rounded(R.terrain_summary(cells, ["cell"], "z", "slope", "curvature", "aspect"), 9), 4)
    return out.withColumns({c: F.col(c) + 0.0 for c in ("curvature", "northness", "eastness")})


@query("r13_stack_bands", "select day_idx, tile, y, " + ", ".join(f"max(value) filter (where x = {b}) as b{b}" for b in range(8)) + " from cube group by 1, 2, 3", "cube")
def r13(cube):
    return R.stack_bands(cube, ["day_idx", "tile", "y"], "x", "value", list(range(8)))


_FOCAL = "avg(g.z)", "avg(g.slope)", "avg(g.curvature)", _DIRECTION.format(a="g.aspect")
_OWN = ", ".join(f"round(max(g.{v}) filter (where g.y = s.y and g.x = s.x), 4) + 0e0 as own_{v}" for v in ("z", "slope", "curvature", "aspect"))


@query(
    "r14_focal_means",
    _TERRAIN + f"select s.point_id, count(*) as n, {_OWN}, " + ", ".join(f"round({e}, 4) + 0e0 as mean_{v}" for v, e in zip(("z", "slope", "curvature", "aspect"), _FOCAL, strict=True))
    + " from (select point_id, cast(floor((lat10 - 250) / 6) as int) as y, cast(floor((lon10 + 1250) / 5) as int) as x from station) s join t g on g.y >= s.y - 33 and g.y < s.y + 33 and g.x >= s.x - 33 and g.x < s.x + 33 group by 1",
    "station", "grid",
)
def r14(station, grid):
    points = station.select("point_id", F.floor((F.col("lat10") - 250) / 6).alias("y"), F.floor((F.col("lon10") + 1250) / 5).alias("x"))
    out = rounded(R.focal_means(points, terrain(grid), ["z", "slope", "curvature", "aspect"], angles=["aspect"]), 4)
    return out.withColumns({c: F.col(c) + 0.0 for c in out.columns if c.startswith(("own_", "mean_"))})


@query("a17_mosaic_min", "select y, x, min(value) as value from cube group by 1, 2", "cube")
def a17(cube):
    return R.mosaic(cube, "value")


@query("a22_mosaic_last", "select y, x, max_by(value, day_idx) as value from cube group by 1, 2", "cube")
def a22(cube):
    return R.mosaic(cube, "value", "day_idx")


@query(
    "a18_regrid",
    "with r as (select i as oy, 400e0 - (i + 0.5e0) * 3 as place from range(56) t(i)), c as (select i as ox, -1240e0 + (i + 0.5e0) * 3 as place from range(70) t(i)), "
    "half as (select (max(lat10) - min(lat10)) / (count(distinct lat10) - 1) / 2e0 as hy, (max(lon10) - min(lon10)) / (count(distinct lon10) - 1) / 2e0 as hx from grid), "
    "ny as (select oy, any_value(place) as py, min_by(lat10, abs(lat10 - place) * 100000 + lat10) as lat10 from r, (select distinct lat10 from grid) g group by 1), "
    "nx as (select ox, any_value(place) as px, min_by(lon10, abs(lon10 - place) * 100000 + lon10) as lon10 from c, (select distinct lon10 from grid) g group by 1) "
    "select oy, ox, z from ny cross join nx cross join half left join grid on grid.lat10 = ny.lat10 and grid.lon10 = nx.lon10 and abs(py - ny.lat10) <= hy and abs(px - nx.lon10) <= hx",
    "grid",
)
def a18(grid):
    """Cells of 0.3 degrees, finer than the source, cropped to an extent that reaches beyond it."""
    return R.regrid(grid, 3.0, 400.0, -1240.0, 232.0, -1030.0, lat="lat10", lon="lon10")


_AREA = (
    "with o as (select oy, ox from range(14) a(oy), range(18) b(ox)), "
    "m as (select o.oy, o.ox, g.z, greatest(least(g.y + 1, (o.oy + 1) * 3.5e0 - 1) - greatest(g.y, o.oy * 3.5e0 - 1), 0) * greatest(least(g.x + 1, (o.ox + 1) * 2.75e0 + 0.5e0) - greatest(g.x, o.ox * 2.75e0 + 0.5e0), 0) as w "
    "from o join grid g on g.y + 1 > o.oy * 3.5e0 - 1 and g.y < (o.oy + 1) * 3.5e0 - 1 and g.x + 1 > o.ox * 2.75e0 + 0.5e0 and g.x < (o.ox + 1) * 2.75e0 + 0.5e0) "
)


def area_weights(grid):
    spark = grid.sparkSession
    return R.overlaps(14, -1.0, 3.5, 0.0, 1.0, "oy", "y", spark), R.overlaps(18, 0.5, 2.75, 0.0, 1.0, "ox", "x", spark)


@query("a18_regrid_by_area", _AREA + "select oy, ox, case when sum(w) >= 0.25e0 * 3.5e0 * 2.75e0 then round(sum(z * w) / sum(w), 6) end as z from m where w > 0 group by 1, 2", "grid")
def a18_area(grid):
    """Cells of 3.5 by 2.75 source cells, off their borders, as means by area; null where less than a quarter is covered."""
    return rounded(R.regrid_by_area(grid, *area_weights(grid), least_share=0.25))


@query("a18_totals_by_area", _AREA + "select oy, ox, round(sum(z * w) + 1e-7, 5) as z from m where w > 0 group by 1, 2", "grid")
def a18_totals(grid):
    """The same as sums of the source cells' parts."""
    return R.regrid_by_area(grid, *area_weights(grid), total=True).withColumn("z", F.round(F.col("z") + 1e-7, 5))


@query("k04_dense_rows", "select r.y, list(g.z order by c.x) as row from (select distinct y from grid) r cross join (select unnest(range((select max(x) + 1 from grid))) as x) c left join grid g on g.y = r.y and g.x = c.x group by r.y", "grid")
def k04(grid):
    return R.dense_rows(grid)


@query("k05_dense_cube", "with p as (select distinct point_id from daily), d as (select distinct obs_date from daily), v as (select distinct variable from daily) select point_id, obs_date, variable, x.v from p cross join d cross join v left join daily x using (point_id, obs_date, variable)", "daily")
def k05(daily):
    return K.dense_cube(daily, "point_id", "obs_date", "variable", "v")


@query("s10_to_long", "select day_idx, y, x, round(40e0 - y * 0.25e0, 6) as lat, round(-110e0 + x * 0.25e0, 6) as lon, value from cube", "embeddings")
def s10(embeddings):
    bands = embeddings.select(F.col("vec_id").alias("day_idx"), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, 8)).alias("value"))
    out = R.to_long(bands, "value", -110.0, 40.0, 0.25)
    return out.select("day_idx", "y", "x", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.col("value").cast("double").alias("value"))
