"""Tables stored in buckets of a key, so that joins and groupings on it move no rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Writes df to a folder in ``buckets`` of its keys, each sorted by them, and reads it as such a table.

    Tables that are to be joined need the same number of buckets; rows move once, here. The
    catalogue needs the table's name only while it is opened.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")  # of a table with a path only the name goes
