"""Operators on grids in long form: y, x and a value."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.operators import blocks as B
from nivalis.operators.aggregates import circular_mean
from nivalis.operators.nearest import nearest_on_axis


def _along(axis: str, keys: Sequence[str]):
    other = "x" if axis == "y" else "y"
    return Window.partitionBy(*keys, other).orderBy(axis)


def gradient(value: Column, axis: str, spacing: float = 1.0, keys: Sequence[str] = ()) -> Column:
    """Central difference of the cells beside; one-sided at an end or a gap, null where no cell is beside."""
    w = _along(axis, keys)
    before = F.when(F.lag(axis).over(w) == F.col(axis) - 1, F.lag(value).over(w))
    after = F.when(F.lead(axis).over(w) == F.col(axis) + 1, F.lead(value).over(w))
    return F.when(before.isNull(), after - value).when(after.isNull(), value - before).otherwise((after - before) / 2) / spacing


def with_gradients(grid: DataFrame, value: str = "z", spacing: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    """gy along rows and gx along columns."""
    return grid.withColumn("gy", gradient(F.col(value), "y", spacing, keys)).withColumn("gx", gradient(F.col(value), "x", spacing, keys))


def _norm() -> Column:
    return F.sqrt(F.col("gy") * F.col("gy") + F.col("gx") * F.col("gx"))


def slope_aspect(grid: DataFrame, value: str = "z", from_vertical: bool = False) -> DataFrame:
    """slope (the angle; ``from_vertical``: 90 minus it) and aspect in 0 to 360, gradients by cell."""
    angle = F.degrees(F.atan(_norm()))
    turn = F.degrees(F.atan2(-F.col("gx"), F.col("gy")))
    return with_gradients(grid, value).withColumns({"slope": 90 - angle if from_vertical else angle, "aspect": F.when(turn < 0, turn + 360).otherwise(turn)})


def slope_aspect_spaced(grid: DataFrame, spacing: float, value: str = "z") -> DataFrame:
    """slope and aspect with the cells' spacing."""
    turn = F.degrees(F.atan2(F.col("gy"), -F.col("gx")))
    return with_gradients(grid, value, spacing).withColumns({"slope": F.degrees(F.atan(_norm())), "aspect": F.pmod(turn + 360, F.lit(360.0))})


def curvature_gradient(grid: DataFrame, value: str = "z", spacing: float = 1.0) -> DataFrame:
    """The sum over both axes of the gradient of the gradient."""
    g = with_gradients(grid, value, spacing)
    return g.withColumn("gyy", gradient(F.col("gy"), "y", spacing)).withColumn("gxx", gradient(F.col("gx"), "x", spacing)).withColumn("curvature", F.col("gyy") + F.col("gxx"))


def northness_eastness(grid: DataFrame, value: str = "z", spacing: float = 1.0) -> DataFrame:
    """Arc tangents of each gradient's share; null on flat cells."""
    share = lambda g: F.atan(F.try_divide(F.col(g), _norm()))
    return with_gradients(grid, value, spacing).withColumns({"northness": share("gy"), "eastness": share("gx")})


def from_aspect(aspect: Column) -> tuple[Column, Column]:
    """Northness and eastness as sine and cosine of the aspect."""
    return F.sin(F.radians(aspect)), F.cos(F.radians(aspect))


def _sobel(axis: str) -> list[tuple[int, int, float]]:
    smooth, diff = {-1: 1, 0: 2, 1: 1}, {-1: -1, 1: 1}
    pairs = [(a, b, da * s) for a, da in diff.items() for b, s in smooth.items()]
    return [(a, b, w) if axis == "y" else (b, a, w) for a, b, w in pairs]


def gaussian_weights(sigma: float = 1.0, radius: int = 4) -> list[float]:
    raw = [exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [w / sum(raw) for w in raw]


def _gaussian(field: B.Field, sigma: float, radius: int) -> B.Field:
    weights = list(zip(range(-radius, radius + 1), gaussian_weights(sigma, radius), strict=True))
    rows = field.like(B.weighted(field.reflected(), [(d, 0, w) for d, w in weights]))
    return field.like(B.weighted(rows.reflected(), [(0, d, w) for d, w in weights]))


def smooth(grid: DataFrame, sigma: float = 1.0, radius: int = 4, value: str = "z", keys: Sequence[str] = (), side: int = B.SIDE) -> DataFrame:
    """Gaussian smoothing, with the values mirrored at the border."""
    return B.by_tile(grid, lambda f: {"z": _gaussian(f, sigma, radius).z}, ["z"], radius, keys, value, side)


def _curvature(field: B.Field, sigma: float | None, radius: int = 4) -> np.ndarray:
    twice = [field.like(B.weighted(field.like(B.weighted(field.z, _sobel(axis))).z, _sobel(axis))).z for axis in "yx"]
    total = field.like(twice[0] + twice[1])
    return (_gaussian(total, sigma, radius) if sigma else total).z


def curvature_sobel(grid: DataFrame, value: str = "z", sigma: float | None = 1.0, keys: Sequence[str] = (), side: int = B.SIDE) -> DataFrame:
    """curvature: Sobel twice on each axis with a border of zeros, added up and smoothed."""
    return B.by_tile(grid, lambda f: {"curvature": _curvature(f, sigma)}, ["curvature"], 6 if sigma else 2, keys, value, side)


_BOX = [(dy, dx, 1.0) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
_CROSS = [(0, 0, 1.0), (-1, 0, 1.0), (1, 0, 1.0), (0, -1, 1.0), (0, 1, 1.0)]


def _of_neighbours(how: Callable, z: np.ndarray, offsets: Sequence[tuple[int, int, float]]) -> np.ndarray:
    """how(the neighbours that have a value); NaN where none has."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # cells without any
        return how(B.neighbours(z, offsets), axis=0)


def _median(z: np.ndarray, axis: int) -> np.ndarray:
    """The median of the values along an axis that are not NaN: these come first when sorted."""
    ordered, n = np.sort(z, axis=axis), np.count_nonzero(~np.isnan(z), axis=axis)
    low, high = (np.take_along_axis(ordered, np.expand_dims(i, axis), axis).squeeze(axis) for i in (np.maximum(n - 1, 0) // 2, np.minimum(n // 2, z.shape[axis] - 1)))
    return np.where(low == high, low, (low + high) / 2)


def median_filter(grid: DataFrame, value: str = "z", keys: Sequence[str] = (), side: int = B.SIDE) -> DataFrame:
    """The median of the 3 x 3 cells around each, mirrored at the border."""
    return B.by_tile(grid, lambda f: {"z": _of_neighbours(_median, f.reflected(), _BOX)}, ["z"], 1, keys, value, side)


def closing(grid: DataFrame, value: str = "z", keys: Sequence[str] = (), side: int = B.SIDE) -> DataFrame:
    """Morphological closing with the cross of five cells; cells beyond the border don't count."""

    def close(field: B.Field) -> dict[str, np.ndarray]:
        widened = field.like(_of_neighbours(np.nanmax, field.z, _CROSS))
        return {"z": _of_neighbours(np.nanmin, widened.z, _CROSS)}

    return B.by_tile(grid, close, ["z"], 2, keys, value, side)


def window_scaled(grid: DataFrame, y0: int, y1: int, x0: int, x1: int, value: str = "z") -> DataFrame:
    """Cells of a window with the value scaled to 0..1."""
    part = grid.where(F.col("y").between(y0, y1) & F.col("x").between(x0, x1))
    ends = part.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return part.join(F.broadcast(ends)).select("y", "x", F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low")).alias("scaled"))


def tiles(grid: DataFrame, side: int = 300, value: str = "z") -> DataFrame:
    """Cells and mean of each square tile."""
    return grid.groupBy(F.floor(F.col("y") / side).alias("ty"), F.floor(F.col("x") / side).alias("tx")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))


def terrain_summary(cells: DataFrame, keys: Sequence[str], elevation: str, slope: str, curvature: str, aspect: str) -> DataFrame:
    """Means of the terrain of each key, and the direction of its aspects with its components."""
    out = cells.groupBy(*keys).agg(F.avg(elevation).alias("elevation"), F.avg(slope).alias("slope"), F.avg(curvature).alias("curvature"), circular_mean(F.col(aspect)).alias("aspect"))
    north, east = from_aspect(F.col("aspect"))
    return out.withColumns({"northness": north, "eastness": east})


def terrain_table(grid: DataFrame, value: str = "z", from_vertical: bool = True, keys: Sequence[str] = (), side: int = B.SIDE) -> DataFrame:
    """Elevation, slope (from the vertical, or else the angle itself), aspect, curvature, northness and eastness of each cell, in one pass over the tiles."""

    def terrain(field: B.Field) -> dict[str, np.ndarray]:
        gy, gx = B.gradient(field.z, "y"), B.gradient(field.z, "x")
        norm = np.sqrt(gy * gy + gx * gx)
        angle, turn = np.degrees(np.arctan(norm)), np.degrees(np.arctan2(-gx, gy))
        with np.errstate(invalid="ignore", divide="ignore"):
            north, east = np.arctan(gy / norm), np.arctan(gx / norm)
        return {"elevation": field.z, "slope": 90 - angle if from_vertical else angle, "aspect": np.where(turn < 0, turn + 360, turn), "northness": north, "eastness": east, "curvature": _curvature(field, 1.0)}

    return B.by_tile(grid, terrain, ["elevation", "slope", "aspect", "northness", "eastness", "curvature"], 6, keys, value, side)


def focal_means(points: DataFrame, grid: DataFrame, values: Sequence[str], half: int = 33, angles: Sequence[str] = ()) -> DataFrame:
    """n, own_<value> at the point's cell, and mean_<value> (a direction for ``angles``) over the window of cells y-half..y+half-1 (x likewise) around each point (point_id, y, x).

    Points of one cell are looked up once. A tile sums its cells up from its corner in both
    directions; the part of a window in it is then four look-ups, whatever the window's size, and a
    window touches four tiles at most.
    """
    side = max(B.SIDE, 2 * half)
    parts = {v: [f"sin_{v}", f"cos_{v}"] if v in angles else [v] for v in values}
    number = lambda v: F.col(v).cast("double")
    summed = [F.sin(F.radians(number(v))).alias(f"sin_{v}") if i == 0 else F.cos(F.radians(number(v))).alias(f"cos_{v}") for v in angles if v in parts for i in (0, 1)]
    tile = lambda c, n: F.floor(F.col(c) / side).alias(n)
    cells = grid.na.drop(subset=["y", "x"]).select(tile("y", "ty"), tile("x", "tx"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), *[number(v).alias(v) for v in values], *summed)
    places = points.na.drop(subset=["y", "x"]).select(F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x")).distinct()
    touched = lambda c: F.explode(F.sequence(F.floor((F.col(c) - half) / side), F.floor((F.col(c) + half - 1) / side)))
    wanted = places.withColumn("ty", touched("y")).withColumn("tx", touched("x"))
    names = [c for v in values for c in parts[v]]
    schema = ", ".join(["y long", "x long", "n double", *[f"`own_{v}` double" for v in values], *[f"`sum_{c}` double, `n_{c}` double" for c in names]])

    def look_up(cells: pa.Table, wanted: pa.Table) -> pa.Table:
        number_of = lambda t, c: t[c].to_numpy().astype(np.int64)
        y, x = number_of(wanted, "y"), number_of(wanted, "x")
        out = {"y": y, "x": x}
        if not len(y) or not len(cells):
            return pa.table({c.split()[0].strip("`"): pa.array([], pa.int64() if c.endswith("long") else pa.float64()) for c in schema.split(", ")})
        cy, cx = number_of(cells, "y"), number_of(cells, "x")
        y0, x0 = cy[0] // side * side, cx[0] // side * side

        def window(image: np.ndarray) -> np.ndarray:
            total = np.zeros((side + 1, side + 1))
            total[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
            top, bottom, left, right = (np.clip(v, 0, side) for v in (y - half - y0, y + half - y0, x - half - x0, x + half - x0))
            return total[bottom, right] - total[top, right] - total[bottom, left] + total[top, left]

        def image(values: np.ndarray) -> np.ndarray:
            found = np.zeros((side, side))
            found[cy - y0, cx - x0] = values
            return found

        out["n"] = window(image(np.ones(len(cy))))
        inside = (y >= y0) & (y < y0 + side) & (x >= x0) & (x < x0 + side)
        for v in values:
            own = np.full((side, side), np.nan)
            own[cy - y0, cx - x0] = cells[v].to_numpy().astype(float)
            out[f"own_{v}"] = np.where(inside, own[np.clip(y - y0, 0, side - 1), np.clip(x - x0, 0, side - 1)], np.nan)
        for c in names:
            z = cells[c].to_numpy().astype(float)
            out[f"sum_{c}"], out[f"n_{c}"] = window(image(np.nan_to_num(z))), window(image(~np.isnan(z)))
        return pa.table({k: pa.array(v, from_pandas=True) for k, v in out.items()})

    found = cells.groupBy("ty", "tx").cogroup(wanted.groupBy("ty", "tx")).applyInArrow(look_up, schema)
    sums = found.groupBy("y", "x").agg(F.sum("n").cast("long").alias("n"), *[F.max(f"own_{v}").alias(f"own_{v}") for v in values], *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for c in names for k in ("sum", "n")]).where("n > 0")
    turn = lambda v: F.pmod(F.degrees(F.atan2(f"sum_sin_{v}", f"sum_cos_{v}")) + 360, F.lit(360.0))
    means = [(F.when(F.col(f"n_sin_{v}") > 0, turn(v)) if v in angles else F.try_divide(F.col(f"sum_{v}"), F.col(f"n_{v}"))).alias(f"mean_{v}") for v in values]
    return points.select("point_id", "y", "x").join(sums.select("y", "x", "n", *[f"own_{v}" for v in values], *means), ["y", "x"]).drop("y", "x")


def mosaic(tiles_: DataFrame, value: str, order: str | None = None) -> DataFrame:
    """One value for each cell: the smallest, or that of the last tile in ``order``."""
    pick = F.min(value) if order is None else F.max_by(value, order)
    return tiles_.groupBy("y", "x").agg(pick.alias(value))


def regrid(grid: DataFrame, step: float, north: float, west: float, south: float, east: float, value: str = "z", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """oy, ox and value of each output cell from the north-west corner to the extent's other end.

    The value is that of the source cell whose row and column are nearest to the output cell's
    centre (ties: the smaller coordinate). It is null where the source lacks that cell, and where
    the centre is farther from it than half a source cell (the axis's mean spacing) on either axis:
    nothing is carried beyond the source.
    """
    spark = grid.sparkSession
    line = lambda n, name, place: spark.range(max(0, n)).select(F.col("id").alias(name), place(F.col("id")).alias(f"{name}_at"))
    every_row = line(round((north - south) / step), "oy", lambda i: F.lit(float(north)) - (i + 0.5) * step)
    every_column = line(round((east - west) / step), "ox", lambda i: F.lit(float(west)) + (i + 0.5) * step)
    half = lambda c: F.coalesce(F.try_divide(F.max(c) - F.min(c), F.count_distinct(c) - 1) / 2, F.lit(step / 2))
    reach = F.broadcast(grid.agg(half(lat).alias("__hy"), half(lon).alias("__hx")))  # one row

    def met(places: DataFrame, name: str, axis: str, limit: str) -> DataFrame:
        near = places.join(nearest_on_axis(places, grid, f"{name}_at", axis), f"{name}_at").join(reach)
        return near.where(F.abs(F.col(f"{name}_at") - F.col(f"near_{name}_at")) <= F.col(limit)).select(name, F.col(f"near_{name}_at").alias(axis))

    rows, columns = met(every_row, "oy", lat, "__hy"), met(every_column, "ox", lon, "__hx")
    # the cells that an output row takes come by its source row, and meet the columns that take them
    cells = grid.groupBy(lat, lon).agg(F.min_by(value, "cell_id").alias(value))
    found = rows.join(cells, lat).join(columns, lon).select("oy", "ox", value)
    every = every_row.select("oy").join(F.broadcast(every_column.select(F.collect_list("ox").alias("ox")))).select("oy", F.explode("ox").alias("ox"))
    return every.join(found, ["oy", "ox"], "left")


def overlaps(n: int, start: float, step: float, source_start: float, source_step: float, out: str, source: str, spark) -> DataFrame:
    """out, source and share: for each of n intervals of an axis the source's intervals that it meets, and how much of each of these (0 to 1) lies in it.

    Both axes are regular and rise or fall alike; the table is as long as the longer of the two.
    """
    low, high = (F.col(out) * step + start), ((F.col(out) + 1) * step + start)
    place = lambda v: (v - source_start) / source_step
    begin, end = F.least(place(low), place(high)), F.greatest(place(low), place(high))
    met = spark.range(n).withColumnRenamed("id", out).withColumns({"__a": begin, "__b": end})
    met = met.withColumn(source, F.explode(F.sequence(F.floor("__a"), F.ceil("__b"))))
    share = F.least(F.col(source) + 1.0, F.col("__b")) - F.greatest(F.col(source).cast("double"), F.col("__a"))
    return met.withColumn("share", share).where("share > 1e-12").select(out, source, "share")


def regrid_by_area(grid: DataFrame, rows: DataFrame, columns: DataFrame, value: str = "z", keys: Sequence[str] = (), least_share: float = 0.0, total: bool = False) -> DataFrame:
    """keys, oy, ox and value: the mean of the source cells in each output cell, weighted by area, or (``total``) the sum of the shares of them in it.

    ``rows`` and ``columns`` are ``overlaps`` of (oy, y) and (ox, x), made once for all grids of one
    shape. Cells that are missing or null are left out of the weights; an output cell less of whose
    area than ``least_share`` has values is null, and one that meets no cell is not there. Sums keep
    the total of what lies within the extent.
    """
    met = grid.where(F.col(value).isNotNull()).select(*keys, "y", "x", F.col(value).cast("double").alias("__v"))
    met = met.join(rows.withColumnRenamed("share", "__sy"), "y").join(columns.withColumnRenamed("share", "__sx"), "x")
    area = F.col("__sy") * F.col("__sx")
    sums = met.groupBy(*keys, "oy", "ox").agg(F.sum(area * F.col("__v")).alias("__z"), F.sum(area).alias("__w"))
    # the whole area of an output cell in source cells
    full = rows.groupBy("oy").agg(F.sum("share").alias("__fy")), columns.groupBy("ox").agg(F.sum("share").alias("__fx"))
    sums = sums.join(full[0], "oy").join(full[1], "ox")
    enough = F.col("__w") >= F.lit(least_share) * F.col("__fy") * F.col("__fx") - 1e-9
    found = F.col("__z") if total else F.col("__z") / F.col("__w")
    return sums.select(*keys, "oy", "ox", F.when(enough, found).alias(value))


def dense_rows(grid: DataFrame, value: str = "z", width: int | None = None) -> DataFrame:
    """Each row of a grid as an array of ``width`` values (default: the largest x and one), null where a cell is missing.

    A cell that comes twice, or lies outside the width, is an error at run time, not a shifted row.
    """
    size = grid.agg((F.max("x") + 1).cast("int").alias("width")) if width is None else grid.sparkSession.range(1).select(F.lit(width).alias("width"))
    rows = grid.groupBy("y").agg(F.sort_array(F.collect_list(F.struct("x", F.col(value).alias("v")))).alias("cells")).join(F.broadcast(size))  # one row
    places = F.transform("cells", lambda c: c["x"])
    good = (F.size(F.array_distinct(places)) == F.size(places)) & (F.array_min(places) >= 0) & (F.array_max(places) < F.col("width"))
    # a full row is its cells in order; else each cell goes behind as many nulls as were missing before it
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(places[i - 1].cast("int"))
    nulls = lambda n: F.transform(F.filter(F.sequence(F.lit(0), n), lambda k: k > 0), lambda k: F.lit(None).cast(dict(grid.dtypes)[value]))
    padded = F.flatten(F.transform("cells", lambda c, i: F.concat(nulls(c["x"].cast("int") - before(i) - 1), F.array(c["v"]))))
    ending = nulls(F.col("width") - F.element_at(places, -1).cast("int") - 1)
    row = F.when(F.size("cells") == F.col("width"), F.transform("cells", lambda c: c["v"])).otherwise(F.concat(padded, ending))
    return rows.where(F.assert_true(F.coalesce(good, F.lit(False)), "cells are repeated or outside the raster").isNull()).select("y", row.alias("row"))


def stack_bands(df: DataFrame, keys: Sequence[str], band: str, value: str, bands: Sequence) -> DataFrame:
    """A column b<band> for each band."""
    out = df.groupBy(*keys).pivot(band, list(bands)).agg(F.first(value, ignorenulls=True))
    return out.withColumnsRenamed({str(b): f"b{b}" for b in bands})


def to_long(bands: DataFrame, value: str, west: float, north: float, step: float) -> DataFrame:
    """Cells of 2-D arrays: y, x, lat, lon and value; other columns stay."""
    rest = [c for c in bands.columns if c != value]
    rows = bands.select(*rest, F.posexplode(value).alias("y", "__row"))
    cells = rows.select(*rest, "y", F.posexplode("__row").alias("x", value))
    return cells.withColumns({"lat": F.lit(north) - F.col("y") * step, "lon": F.lit(west) + F.col("x") * step})
