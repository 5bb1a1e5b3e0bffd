"""Joins of sources on point and day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.operators.aggregates import keep_first
from nivalis.operators.lineage import numbered


def inner(a: DataFrame, b: DataFrame, on: Sequence[str], other: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Rows that agree on ``on`` (``other``: the names in b). ``null_safe`` lets null match null."""
    right = b.withColumnsRenamed(dict(zip(other, on, strict=True))) if other else b
    if not null_safe:
        return a.join(right, list(on))
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    match = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])
    return a.join(renamed, match).drop(*[f"__{c}" for c in on])


def left_chain(base: DataFrame, sources: Sequence[DataFrame], on: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """base with the columns of each source, then the first row of each key."""
    return keep_first(reduce(lambda a, b: a.join(b, list(on), "left"), sources, base), on, order)


def outer_chain(sources: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """All keys of all sources, without repeated rows; rows with a null in their key meet no others.

    A chain of full joins loses the partitioning of its keys at each step. Here the distinct keys of
    all sources come first and each source is joined to them, so every source moves once, and not
    at all if it is stored in buckets of its keys (``sources.bucketed``). Sources without repeated
    rows give none, joined to distinct keys.
    """
    sources = [s.dropDuplicates() for s in sources]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    keys = reduce(DataFrame.union, [s.where(known).select(*on) for s in sources]).distinct()
    joined = reduce(lambda a, b: a.join(b, list(on), "left"), [s.where(known) for s in sources], keys)
    alone = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.where(~known) for s in sources]).dropDuplicates()
    return joined.unionByName(alone.select(*joined.columns))


def with_dimension(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """facts with the columns of a static table; the optimizer broadcasts it if its size allows."""
    return facts.join(dimension, list(on), "left")


def zip_by_order(frames: Sequence[DataFrame], order: Sequence[Sequence[str]]) -> DataFrame:
    """Tables without a common key side by side, row by row in a declared order.

    Rows are numbered within ranges of the order, so no task holds a whole table.
    """
    return reduce(lambda a, b: a.join(b, "row", "full_outer"), [numbered(f, o) for f, o in zip(frames, order, strict=True)])


def present_every_day(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of the points that have all days of the table."""
    days = df.agg(F.count_distinct(day).alias("days"))
    own = df.groupBy(key).agg(F.count_distinct(day).alias("own"))
    full = own.join(F.broadcast(days), F.col("own") == F.col("days"), "left_semi").select(key)
    return df.join(full, key, "left_semi")


def look_up(points: DataFrame, grid: DataFrame, y: str, x: str, value: str) -> DataFrame:
    """points with the grid's value at (y, x); null outside."""
    cells = grid.select(F.col("y").alias("__y"), F.col("x").alias("__x"), F.col(value).alias("found"))
    return points.join(cells, (F.col(y) == F.col("__y")) & (F.col(x) == F.col("__x")), "left").drop("__y", "__x")


def pixel(lat: Column, lon: Column, north: float, west: float, step: float, truncate: bool = False) -> tuple[Column, Column]:
    """Row and column of a point in a grid with its north-west corner given."""
    y, x = (F.lit(north) - lat) / step, (lon - F.lit(west)) / step
    return (y.cast("int"), x.cast("int")) if truncate else (F.floor(y).cast("int"), F.floor(x).cast("int"))


def audit(a: DataFrame, b: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Rows compared, and rows whose values differ (null equals null)."""
    other = b.select(*on, F.col(value).alias("__other"))
    return a.join(other, list(on)).agg(F.count(F.lit(1)).alias("compared"), F.count_if(~F.col(value).eqNullSafe(F.col("__other"))).alias("differ"))


def not_collected(wanted: DataFrame, collected: DataFrame, on: Sequence[str]) -> DataFrame:
    return wanted.join(collected, list(on), "left_anti")


def attach(full: DataFrame, predicted: DataFrame, on: Sequence[str]) -> DataFrame:
    """full with predictions; one row for each row of full, as predictions are made unique first."""
    return full.join(predicted.dropDuplicates(list(on)), list(on), "left")


def with_last_year(facts: DataFrame, day: str, yearly: DataFrame, year: str, on: Sequence[str]) -> DataFrame:
    """facts with the yearly table's row of the year before."""
    return facts.withColumn(year, F.year(day) - 1).join(yearly, [*on, year], "left")
