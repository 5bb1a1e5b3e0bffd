"""Sinks: one-file tables, skip or overwrite, appends by day, dense cubes, versioned results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.sources.published import latest_path, publish

def write_table(df: DataFrame, path: str, force: bool = True, one_file: bool = False) -> None:
    """Parquet; without ``force`` a table that is there stays. ``one_file`` is for results that one task can write; what makes them stays spread."""
    (df.repartition(1) if one_file else df).write.mode("overwrite" if force else "ignore").parquet(path)


def append_days(df: DataFrame, path: str, day: str = "obs_date") -> None:
    df.repartition(day).write.mode("append").partitionBy(day).parquet(path)


def dense_cube(df: DataFrame, point: str, day: str, kind: str, value: str) -> DataFrame:
    """A row for each point, day and kind that occurs in the table, with nulls where there is no value.

    Days and kinds are lists of a cube's axes: thousands, not rows. Null days and kinds have no place.
    """
    keys = lambda c: df.select(c).distinct()
    # every point gets the days, then each of its rows the kinds, from arrays that come as one row
    listed = df.agg(F.sort_array(F.collect_set(day)).alias("__days"), F.sort_array(F.collect_set(kind)).alias("__kinds"))
    spine = keys(point).join(F.broadcast(listed)).select(point, F.explode("__days").alias(day), "__kinds").select(point, day, F.explode("__kinds").alias(kind))
    return spine.join(df.select(point, day, kind, value), [point, day, kind], "left")


def published_dates(names: DataFrame, column: str) -> DataFrame:
    """The distinct dates in file names."""
    day = F.regexp_extract(column, r"\d{4}-\d{2}-\d{2}", 0)
    return names.select(day.alias("day")).where("day != ''").distinct()


def write_versioned(df: DataFrame, root: str, run_id: str, after: int | None = None) -> int:
    """The result as a run that nothing changes later, and as the latest version; the version's number."""
    return publish(df.sparkSession, root, run_id, lambda path: df.write.parquet(path), after)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The run that is the latest now; what is published meanwhile does not change what is read."""
    return spark.read.parquet(latest_path(spark, root))
