"""Summaries, histograms, class counts and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.functions import columns as C
from nivalis.operators.lineage import in_ranges


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row for each column name and value, made in one scan."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names])).alias("s")).select("s.*")


def quantiles(long: DataFrame, shares: Sequence[float]) -> DataFrame:
    """name and q0, q1, ...: the exact quantiles of (name, value) at the shares, linear between neighbours.

    Distinct values are counted, dealt into ranges, and their counts added up over the ranges before,
    so no task holds all values of a name.
    """
    counts = long.where("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    ranges = in_ranges(counts, ["name", "value"])
    sums = ranges.groupBy("__part", "name").agg(F.sum("n").alias("own"))
    by_name = Window.partitionBy("name")
    before = F.coalesce(F.sum("own").over(by_name.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("__part", "name", before.alias("before"), F.sum("own").over(by_name).alias("whole"))
    upto = F.sum("n").over(Window.partitionBy("__part", "name").orderBy("value"))
    rows = ranges.withColumn("upto", upto).join(F.broadcast(sums), ["__part", "name"]).withColumn("upto", F.col("upto") + F.col("before"))
    at = lambda p: (F.col("whole") - 1) * F.lit(float(p))
    value = lambda place: F.min(F.when(F.col("upto") > place, F.col("value")))
    found = rows.groupBy("name").agg(*[x for i, p in enumerate(shares) for x in (value(F.floor(at(p))).alias(f"low{i}"), value(F.ceil(at(p))).alias(f"high{i}"), F.max(at(p) - F.floor(at(p))).alias(f"rest{i}"))])
    return found.select("name", *[(F.col(f"low{i}") + F.col(f"rest{i}") * (F.col(f"high{i}") - F.col(f"low{i}"))).alias(f"q{i}") for i in range(len(shares))])


def describe(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of columns, one row each."""
    long = _long(df, names)
    found = long.groupBy("name").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("low"), F.max("value").alias("high"))
    found = found.join(quantiles(long, (0.25, 0.5, 0.75)), "name", "left")
    return found.select("name", "n", "mean", "std", "low", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "high")


def describe_population(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """mean, median, population deviation and variance, min, max and sum; nulls are skipped."""
    long = _long(df, names)
    found = long.groupBy("name").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.var_pop("value").alias("variance"),
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("total"),
    )
    return found.join(quantiles(long, (0.5,)).withColumnRenamed("q0", "median"), "name", "left").select("name", "mean", "median", "std", "variance", "low", "high", "total")


def null_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """name and nulls of columns, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("nulls")) for c in names])).alias("s")).select("s.*")


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(name))


def distinct_places(df: DataFrame, names: Sequence[str], least: int) -> DataFrame:
    """places, and whether there are at least ``least``."""
    return df.agg(F.count_distinct(*names).alias("places")).withColumn("enough", F.col("places") >= least)


def class_breaks(df: DataFrame, value: str, classes: int = 12) -> DataFrame:
    """Upper bounds of equal steps from max(min, 0) to max."""
    ends = df.agg(F.greatest(F.min(value), F.lit(0.0)).alias("low"), F.max(value).alias("high"))
    return ends.select(F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("step"), "low", "high").select(
        "step", (F.col("low") + F.col("step") * (F.col("high") - F.col("low")) / classes).alias("bound")
    )


def class_counts(df: DataFrame, value: str, classes: int = 12) -> DataFrame:
    """Rows of each class between the bounds of ``class_breaks``; above the last is a class of its own."""
    ends = df.agg(F.greatest(F.min(value), F.lit(0.0)).alias("low"), F.max(value).alias("high"))
    bound = lambda i: F.col("low") + F.lit(i) * (F.col("high") - F.col("low")) / classes
    index = C.class_index(F.col(value), [bound(i) for i in range(classes)])
    return df.join(F.broadcast(ends)).groupBy(index.alias("class")).agg(F.count(F.lit(1)).alias("n"))


def circular_mean(angle: Column) -> Column:
    """The mean direction of angles in degrees, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(F.sum(F.sin(F.radians(angle))), F.sum(F.cos(F.radians(angle))))), F.lit(360.0))


def scaled_weight(df: DataFrame, value: str, name: str = "weight", scale: float = 10.0, keys: Sequence[str] = ()) -> DataFrame:
    """df with the value's place between the smallest and the largest (of each key), times ``scale``; null where these are equal.

    Ends are aggregated and joined back, so neither the whole table nor a key's rows go to one task.
    """
    ends = [F.min(value).alias("__low"), F.max(value).alias("__high")]
    if keys:
        found = df.groupBy(*keys).agg(*ends).withColumnsRenamed({k: f"__{k}" for k in keys})
        both = df.join(found, [df[k].eqNullSafe(found[f"__{k}"]) for k in keys])
    else:
        both = df.join(F.broadcast(df.agg(*ends)))  # one row
    place = F.try_divide(F.col(value) - F.col("__low"), F.col("__high") - F.col("__low")) * scale
    return both.withColumn(name, place).drop("__low", "__high", *[f"__{k}" for k in keys])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a declared order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(w)).where("__place = 1").drop("__place")


def histogram(df: DataFrame, name: str, low: float, high: float, bins: int = 100) -> DataFrame:
    """Rows of each of equal bins, from 1; the top end belongs to the last."""
    width = (high - low) / bins
    place = F.least(F.floor((F.col(name) - low) / width) + 1, F.lit(bins))
    return df.where(F.col(name).between(low, high)).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def compare_histograms(a: DataFrame, b: DataFrame, names: Sequence[str], ranges: dict[str, tuple[float, float]], bins: int = 100) -> DataFrame:
    """Bins of both tables side by side, for each column; a bin that one lacks has 0."""
    parts = []
    for c in names:
        low, high = ranges[c]
        x, y = histogram(a, c, low, high, bins).withColumnRenamed("n", "n_a"), histogram(b, c, low, high, bins).withColumnRenamed("n", "n_b")
        parts.append(x.join(y, "bin", "full_outer").na.fill(0, ["n_a", "n_b"]).select(F.lit(c).alias("name"), "bin", "n_a", "n_b"))
    return reduce(DataFrame.unionByName, parts)


def density(df: DataFrame, x: str, y: str, x_step: float, y_step: float) -> DataFrame:
    """Rows of each cell of a rectangular grid over two columns."""
    return df.groupBy(F.floor(F.col(x) / x_step).alias("bx"), F.floor(F.col(y) / y_step).alias("by")).agg(F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the label, in one scan."""
    row = df.agg(*[F.corr(c, label).alias(c) for c in features])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("corr")) for c in features])).alias("s")).select("s.*")


def widen(df: DataFrame, keys: Sequence[str], variable: str, value: str, variables: Sequence[str]) -> DataFrame:
    """A column for each variable; the list is given, so no pass is spent to find it."""
    return df.groupBy(*keys).pivot(variable, list(variables)).agg(F.first(value, ignorenulls=True))


def union_all(*frames: DataFrame) -> DataFrame:
    """Tables of different columns one after the other; what one lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def column_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Names that only one of two tables has, and which."""
    spark = a.sparkSession
    rows = [(c, "left") for c in a.columns if c not in b.columns] + [(c, "right") for c in b.columns if c not in a.columns]
    return spark.createDataFrame(rows, "name string, only_in string")
