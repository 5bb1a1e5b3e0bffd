"""Cutting the lineage of tables that loops build on."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session that runs in one process gets a folder of its own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and read back from the folder that the cluster shares (spark.checkpoint.dir)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def in_ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """df dealt into ranges of an order, and __part, the range's number."""
    return checkpointed(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "row") -> DataFrame:
    """df with each row's place in an order, from 1: its place in its range, and the sizes of the ranges before."""
    ranges = in_ranges(df, order)
    sizes = ranges.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    out = ranges.withColumn("__own", own).join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part")
    return out.withColumn(name, F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")
