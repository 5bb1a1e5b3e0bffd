"""A linear quadtree over cells, and the nearest cell of many points by walking it.

The tree is tables: for every third level a row for each node with the tight boxes of its children,
and the cells in packs by the leaf that they lie in. Nodes are square. A node of up to LEAF cells is a
leaf, so dense regions go deeper than sparse ones. All places walk at once, twice, one join on node
numbers for each level. The first walk takes the nearest child each time, to one leaf, whose nearest
cell bounds the distance; the second takes all children that could hold a nearer one, at the end the
cells of the few leaves that are left. So a place is one row for each level of the first walk, and a
few of the second, however fine the grid is, and points of one place walk once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.functions.columns import EARTH_RADIUS_KM, haversine_km
from nivalis.operators.lineage import checkpointed

#: Cells in a leaf, levels from one table of nodes to the next, and the deepest level (cells that even this does not part share a leaf).
LEAF, STEP, DEEPEST = 32, 3, 27
#: Cells in an array at most, about.
PACK = 4096
#: For rounding: a node this much beyond the bound is still looked at.
SLACK = 1 + 1e-9

Metric = Callable[[Column, Column, Column, Column], Column]
METRICS: dict[str, Metric] = {
    "l1": lambda a, b, c, d: F.abs(a - c) + F.abs(b - d),
    "l2": lambda a, b, c, d: (a - c) * (a - c) + (b - d) * (b - d),
    "haversine": haversine_km,
}
_BOX = ("y0", "y1", "x0", "x1")


def least(metric: str, box: tuple[Column, ...]) -> Column:
    """No place in the box is nearer to (lat, lon) than this."""
    y0, y1, x0, x1 = box
    lat, lon, zero = F.col("lat"), F.col("lon"), F.lit(0.0)
    dy, dx = F.greatest(y0 - lat, lat - y1, zero), F.greatest(x0 - lon, lon - x1, zero)
    if metric != "haversine":
        return dy + dx if metric == "l1" else dy * dy + dx * dx
    turn = F.when((lon >= x0) & (lon <= x1), zero).otherwise(F.least(F.pmod(x0 - lon, F.lit(360.0)), F.pmod(lon - x1, F.lit(360.0))))
    # to a meridian the way is shortest at a right angle, or over the pole if it is a quarter turn away
    aside = F.when(turn < 90, F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(F.least(turn, F.lit(90.0)))))).otherwise(F.radians(90 - F.abs(lat)))
    return F.greatest(F.radians(dy), aside, zero) * EARTH_RADIUS_KM


def most(metric: str, box: tuple[Column, ...]) -> Column:
    """No place in the box is farther from (lat, lon) than this."""
    y0, y1, x0, x1 = box
    lat, lon = F.col("lat"), F.col("lon")
    if metric != "haversine":
        dy, dx = F.greatest(F.abs(lat - y0), F.abs(lat - y1)), F.greatest(F.abs(lon - x0), F.abs(lon - x1))
        return dy + dx if metric == "l1" else dy * dy + dx * dx
    to_middle = haversine_km(lat, lon, (y0 + y1) / 2, (x0 + x1) / 2)
    return to_middle + F.radians(F.sqrt((y1 - y0) * (y1 - y0) + (x1 - x0) * (x1 - x0)) / 2) * EARTH_RADIUS_KM


@dataclass
class Tree:
    """families: for each step down, a node's number and its children (number and tight box), a leaf being its own child; packs: the cells of each leaf in arrays."""

    families: list[DataFrame]
    packs: DataFrame


def _number(level: int, iy: Column, ix: Column) -> Column:
    """One number for a node; 0 is the root."""
    return F.lit(level // STEP << 2 * DEEPEST) + F.shiftleft(iy, DEEPEST) + ix


def _ends() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min("clat").alias("y0"), F.max("clat").alias("y1"), F.min("clon").alias("x0"), F.max("clon").alias("x1")]


def build(cells: DataFrame, leaf: int = LEAF) -> Tree | None:
    """The tree of cells (cell_id, lat, lon); of cells in one place only that with the smallest id counts. None without cells."""
    cells = cells.select("cell_id", F.col("lat").cast("double").alias("clat"), F.col("lon").cast("double").alias("clon")).where("clat is not null and clon is not null")
    cells = checkpointed(cells.groupBy("clat", "clon").agg(F.min("cell_id").alias("cell_id")))
    n, y0, y1, x0, x1 = cells.agg(*_ends()).first()
    if not n:
        return None
    size = max(y1 - y0, x1 - x0, 1e-9) * (1 + 1e-6)
    at = lambda c, low, level: F.floor((F.col(c) - low) / size * float(2**level)).alias("iy" if c == "clat" else "ix")
    first = level = min(DEEPEST, STEP * ceil(log(max(n / leaf, 1), 4) / STEP))
    nodes, placed, rest = {}, [], cells
    while True:
        keyed = rest.select("cell_id", "clat", "clon", at("clat", y0, level), at("clon", x0, level))
        nodes[level] = checkpointed(keyed.groupBy("iy", "ix").agg(*_ends()).withColumn("leaf", (F.col("n") <= leaf) | F.lit(level >= DEEPEST)))
        split = keyed.join(nodes[level].select("iy", "ix", "leaf", "n").hint("merge"), ["iy", "ix"])
        placed.append(split.where("leaf").select(_number(level, F.col("iy"), F.col("ix")).alias("node"), "n", "cell_id", "clat", "clon"))
        if nodes[level].where("not leaf").isEmpty():
            break
        rest = checkpointed(split.where("not leaf").select("cell_id", "clat", "clon"))
        level += STEP
    for upper in range(first - STEP, 0, -STEP):
        below = nodes[upper + STEP]
        up = [F.shiftright(c, STEP).alias(c) for c in ("iy", "ix")]
        sums = [F.sum("n").alias("n"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1")]
        nodes[upper] = below.groupBy(*up).agg(*sums).withColumn("leaf", F.lit(False))
    families, leaves = [], None
    for level, found in sorted(nodes.items()):
        child = F.struct(_number(level, F.col("iy"), F.col("ix")).alias("node"), *_BOX).alias("child")
        parent = _number(level - STEP, F.shiftright("iy", STEP), F.shiftright("ix", STEP)) if level else F.lit(0).cast("long")
        children = found.select(parent.alias("node"), child, "leaf")
        every = children.select("node", "child")
        families.append(checkpointed((every if leaves is None else every.union(leaves)).groupBy("node").agg(F.collect_list("child").alias("children"))))
        own = children.where("leaf").select(F.col("child.node").alias("node"), "child")
        leaves = own if leaves is None else leaves.union(own)
    # cells that no level parts are more than one array
    packed = reduce(DataFrame.union, placed).withColumn("pack", F.pmod(F.xxhash64("clat", "clon"), F.ceil(F.col("n") / PACK)))
    return Tree(families, checkpointed(packed.groupBy("node", "pack").agg(F.collect_list(F.struct("clat", "clon", "cell_id")).alias("cells"))))


def _met(front: DataFrame, tree: Tree, step: int) -> DataFrame:
    """front with the children of each row's node; the first two tables of nodes have at most 65 rows of 64 children."""
    family = tree.families[step]
    return front.join(F.broadcast(family) if step < 2 else family.hint("merge"), "node")


def _box(child: Column) -> tuple[Column, ...]:
    return tuple(child[c] for c in _BOX)


def _reached(points: DataFrame, tree: Tree, metric: str) -> DataFrame:
    """lat, lon and cells: the distinct places of points, with each pack of cells that may hold the nearest one."""
    distance = METRICS[metric]
    places = points.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)").distinct()
    front = places.withColumns({"node": F.lit(0).cast("long"), "bound": F.lit(float("inf"))})
    for step in range(len(tree.families)):
        nearest_child = F.array_min(F.transform("children", lambda c: F.struct(least(metric, _box(c)).alias("near"), most(metric, _box(c)).alias("far"), c["node"].alias("node"))))
        front = _met(front, tree, step).select("lat", "lon", nearest_child.alias("to")).select("lat", "lon", "to.node", F.col("to.far").alias("bound"))
    one = tree.packs.where("pack = 0").select("node", "cells").hint("merge")
    found = F.array_min(F.transform("cells", lambda c: distance(F.col("lat"), F.col("lon"), c["clat"], c["clon"])))
    front = front.join(one, "node", "left").select("lat", "lon", F.lit(0).cast("long").alias("node"), F.least("bound", found).alias("bound"))
    for step in range(len(tree.families)):
        near = F.filter("children", lambda c: least(metric, _box(c)) <= F.col("bound") * SLACK + 1e-12)
        front = _met(front, tree, step).select("lat", "lon", "bound", F.explode(F.transform(near, lambda c: c["node"])).alias("node"))
    return front.join(tree.packs.hint("merge"), "node").select("lat", "lon", "cells")


def candidates(points: DataFrame, tree: Tree, metric: str) -> DataFrame:
    """point_id, lat, lon and a cell for each cell of the leaves that may hold the point's nearest one."""
    reached = _reached(points, tree, metric).select("lat", "lon", F.inline("cells"))
    return _at(points).join(reached.hint("merge"), ["lat", "lon"]).select("point_id", "lat", "lon", "clat", "clon", "cell_id")


def _at(points: DataFrame) -> DataFrame:
    return points.select("point_id", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).where("lat is not null and lon is not null").distinct()


def nearest(points: DataFrame, tree: Tree, metric: str) -> DataFrame:
    """point_id, cell_id and distance of the nearest cell; ties go to the smallest cell_id."""
    own = lambda c: F.struct(METRICS[metric](F.col("lat"), F.col("lon"), c["clat"], c["clon"]).alias("distance"), c["cell_id"].alias("cell_id"))
    best = _reached(points, tree, metric).select("lat", "lon", F.array_min(F.transform("cells", own)).alias("best"))
    best = best.groupBy("lat", "lon").agg(F.min("best").alias("best"))
    return _at(points).join(best.hint("merge"), ["lat", "lon"]).select("point_id", "best.cell_id", "best.distance")
