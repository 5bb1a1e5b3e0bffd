"""Daily increments: batches after the last day done, and streams of dropped files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.functions.columns import water_year
from nivalis.sources.published import DayTable


def days_after(df: DataFrame, done: DataFrame, day: str) -> DataFrame:
    """Rows of days later than the last one in ``done`` (all rows if that is empty)."""
    last = done.agg(F.max(day).alias("__last"))
    return df.join(F.broadcast(last), F.col("__last").isNull() | (F.col(day) > F.col("__last"))).drop("__last")


def read_stream(spark: SparkSession, path: str, schema, files_at_once: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).parquet(path)


def daily_totals(stream: DataFrame, time: str, keys: list[str], value: str, late: str = "3 days") -> DataFrame:
    """Counts and sums by day, complete once a day is older than ``late``."""
    days = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return days.groupBy(F.window(time, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def season_totals(stream: DataFrame, day: str, key: str, value: str) -> DataFrame:
    """Totals by point and water year, kept as the stream's state."""
    return stream.groupBy(key, water_year(F.col(day)).alias("water_year")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived and stop. With mode "complete" the result is written anew by each batch."""
    if mode == "append":
        query = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    else:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path))
    query.trigger(availableNow=True).start().awaitTermination()


def correct_days(stream: DataFrame, root: str, checkpoint: str, day: str, key: list[str], order: str | None = None) -> None:
    """Late rows replace those of the same key; only the days they touch are written, and all of a batch's changes are seen at once.

    The table is a ``DayTable`` under ``root``. A batch that is run again after a failure finds that
    it is done.
    """

    def correct(batch: DataFrame, number: int) -> None:
        DayTable(batch.sparkSession, root, day).correct(batch, key, order, checkpoint, number)

    stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(correct).trigger(availableNow=True).start().awaitTermination()
