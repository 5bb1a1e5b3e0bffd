"""Nearest cells by a quadtree, and cells within a distance by buckets of coordinates.

The tree's leaves follow the density of the cells, so a point meets a few leaves' cells however fine
the grid is. For a radius, points meet the cells of the buckets that it reaches, found by an
equi-join. No table is broadcast and no full product is made.
"""

from __future__ import annotations

from math import degrees, pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.functions.columns import EARTH_RADIUS_KM
from nivalis.operators import quadtree
from nivalis.operators.quadtree import METRICS, Tree, build

def _turns(metric: str, side: float) -> tuple[float, int | None]:
    """The side of buckets on the second axis, and how many go around the globe (None: the axis is a line)."""
    if metric != "haversine":
        return side, None
    n = max(1, int(360 // side))
    return 360 / n, n


def _meet(points: DataFrame, cells: DataFrame, side: float, metric: str, reach: Column | None = None) -> DataFrame:
    """Pairs of points and the cells in the buckets around them: the next ones, on the second axis those up to ``reach``.

    Buckets of longitude go around the globe, so places on both sides of the 180th meridian meet.
    """
    width, n = _turns(metric, side)
    around = (lambda b: F.pmod(b, F.lit(n))) if n else (lambda b: b)
    row, column = lambda c: F.floor(F.col(c) / F.lit(float(side))), lambda v: F.floor(v / F.lit(width))
    bucketed = cells.withColumns({"by": row("clat"), "bx": around(column(F.col("clon")))})
    first, last = (column(F.col("lon")) - 1, column(F.col("lon")) + 1) if reach is None else (column(F.col("lon") - reach), column(F.col("lon") + reach))
    if n:  # no more than once around
        last = F.least(last, first + (n - 1))
    near = points.withColumn("by", F.explode(F.sequence(row("lat") - 1, row("lat") + 1)))
    near = near.withColumn("bx", F.explode(F.transform(F.sequence(first, last), around)))
    return near.join(bucketed, ["by", "bx"]).drop("by", "bx")


def nearest(points: DataFrame, cells: DataFrame | Tree, metric: str = "l1") -> DataFrame:
    """point_id, cell_id and distance of the nearest cell; ties go to the smallest cell_id.

    points: point_id, lat, lon; cells: cell_id, lat, lon, in any one unit (degrees for haversine), or
    a tree of them that was built before.
    """
    tree = cells if isinstance(cells, Tree) else build(cells)
    if tree is None:
        return points.join(cells, F.lit(False)).select("point_id", "cell_id", F.lit(0.0).alias("distance"))
    return quadtree.nearest(points, tree, metric)


def within(points: DataFrame, cells: DataFrame, radius: float, metric: str = "l2") -> DataFrame:
    """point_id, cell_id and distance of all cells within a radius (l2: squared distance; haversine: km)."""
    points = points.select("point_id", "lat", "lon").where("lat is not null and lon is not null")
    cells = cells.select("cell_id", F.col("lat").alias("clat"), F.col("lon").alias("clon")).where("clat is not null and clon is not null")
    distance = METRICS[metric](F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon"))
    if metric == "haversine":
        # the longitudes within reach widen towards the poles, and are all of them where a pole is within the radius
        angle = radius / EARTH_RADIUS_KM * 1.001
        side, limit = degrees(angle), radius
        share = F.lit(sin(min(angle, pi / 2))) / F.cos(F.radians("lat"))
        reach = F.when((F.abs(F.radians("lat")) + angle < pi / 2) & (share < 1), F.degrees(F.asin(F.least(share, F.lit(1.0))))).otherwise(180.0)
    else:
        side, limit, reach = radius, radius * radius if metric == "l2" else radius, None
    return _meet(points, cells, side, metric, reach).withColumn("distance", distance).where(F.col("distance") <= limit).select("point_id", "cell_id", "distance")


def nearest_within(points: DataFrame, cells: DataFrame, radius: float, metric: str = "l2") -> DataFrame:
    """The nearest cell of each point that has one within the radius."""
    return within(points, cells, radius, metric).groupBy("point_id").agg(F.min(F.struct("distance", "cell_id")).alias("b")).select("point_id", "b.cell_id", "b.distance")


def nearest_on_axis(values: DataFrame, axis: DataFrame, value: str, place: str) -> DataFrame:
    """value and the nearest place on an axis (ties: the smaller), for distinct values.

    An axis is a short list (the rows or columns of a grid) and becomes one array.
    """
    line = axis.select(F.col(place).alias("p")).distinct().agg(F.sort_array(F.collect_set("p")).alias("line"))
    near = F.array_min(F.transform("line", lambda p: F.struct(F.abs(p - F.col(value)).alias("d"), p.alias("p"))))
    return values.select(value).distinct().join(F.broadcast(line)).select(value, near["p"].alias(f"near_{value}"))


def nearest_per_axis(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points with near_lat and near_lon, each the nearest on its own axis."""
    axis = lambda c: cells.select(F.col(c).alias("p"))
    out = points
    for c in ("lat", "lon"):
        out = out.join(nearest_on_axis(points, axis(c), c, "p"), c)
    return out


def nearest_of_distinct(rows: DataFrame, cells: DataFrame | Tree, metric: str = "l2") -> DataFrame:
    """rows (lat, lon, ...) with cell_id, searched once for each distinct place."""
    places = rows.select("lat", "lon").distinct().withColumn("point_id", F.struct("lat", "lon"))
    found = nearest(places, cells, metric).select("point_id.lat", "point_id.lon", "cell_id")
    return rows.join(found, ["lat", "lon"], "left")
