"""Splits and samples that come out alike on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.operators.lineage import numbered


def split_by_key(df: DataFrame, key: Column, parts: int = 5, test: int = 0) -> DataFrame:
    """df with is_test: the rows whose key leaves ``test`` modulo ``parts``."""
    return df.withColumn("is_test", F.pmod(key, F.lit(parts)) == test)


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([share, 1 - share], seed)
    return train, test


def sampled(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction, seed)


def sampled_by_key(df: DataFrame, key: str, parts: int, part: int = 0) -> DataFrame:
    """One of ``parts`` samples of whole keys, by a hash of the key."""
    hashed = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 7), 16, 10).cast("long")
    return df.where(F.pmod(hashed, F.lit(parts)) == part)


def balanced_negatives(df: DataFrame, positive: Column, negative: Column, label: str, order: list[Column]) -> DataFrame:
    """The positive rows, and as many of the negative ones in a declared order, with label 0."""
    chosen = df.where(positive)
    rest = numbered(df.where(negative & ~F.coalesce(positive, F.lit(False))), order, "__place")
    most = chosen.agg(F.count(F.lit(1)).alias("__most"))
    rest = rest.join(F.broadcast(most), F.col("__place") <= F.col("__most")).drop("__place", "__most")
    return chosen.unionByName(rest.withColumn(label, F.lit(0.0)))


def random_land_points(grid: DataFrame, n: int, south: float, west: float, step: float, height: int, width: int, seed: int = 1, refused: tuple[int, ...] = (239, 255)) -> DataFrame:
    """n random points of a grid's extent (rows y from the south) whose cell has none of the refused codes; none if there is no such cell.

    A cell is drawn for each point, with replacement, and then a place within it.
    """
    land = grid.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1) & ~F.col("code").isin(*refused))
    land = numbered(land.select("y", "x", "code"), ["y", "x"], "__place")
    cells = land.agg(F.count(F.lit(1)).alias("__cells"))
    draws = grid.sparkSession.range(n).select(F.rand(seed).alias("__a"), F.rand(seed + 1).alias("__b"), F.rand(seed + 2).alias("__c"))
    draws = draws.join(F.broadcast(cells)).withColumn("__place", F.floor(F.col("__a") * F.col("__cells")) + 1)
    at = lambda origin, c, part: (F.lit(float(origin)) + (F.col(c) + F.col(part)) * step)
    return draws.join(land, "__place").select("y", "x", at(south, "y", "__b").alias("lat"), at(west, "x", "__c").alias("lon"), "code")


def random_above(df: DataFrame, column: str, least: float, n: int, key: str) -> DataFrame:
    """n rows above a value, those whose key has the smallest hash: as good as random, and alike on every run."""
    return df.where(F.col(column) > least).orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
