"""Small helpers that several training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside an operator; it sorts before every other id.
NO_ID = -(2**63)
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as a long and text as a string (null: empty); all other columns go."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; -1 for a null id, which belongs to no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(mod), F.lit(-1)).cast("int")


def one_text_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """chosen (id and more) with the text (null: empty) of each id; of rows that repeat an id the one with the smallest text stands for it."""
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.join(F.broadcast(chosen), "id").groupBy(*chosen.columns).agg(F.min("text").alias("text"))  # chosen is a bounded sample


def fitting(sizes: list[int], most: int) -> list[int]:
    """The places of sizes that fit into ``most`` when each in turn is taken if it still does; the smallest one if none fits."""
    taken, total = [], 0
    for i, size in enumerate(sizes):
        if total + size <= most:
            taken.append(i)
            total += size
    return taken or ([min(range(len(sizes)), key=sizes.__getitem__)] if sizes else [])


def sample_texts(docs: DataFrame, chosen: DataFrame, most_bytes: int) -> pd.DataFrame:
    """id, label and text (null: empty) of the documents that ``chosen`` (id, label) lists, for the driver.

    ``chosen`` is a bounded sample. Whole texts are taken by the hash of their id while a label has
    less than ``most_bytes``; a text that does not fit is left out and the next one is looked at. A
    label that has only larger texts gets the smallest of them, whole.
    """
    bounded_batches(docs.sparkSession)
    rows = materialise(one_text_each(docs, chosen))
    sizes = rows.select("id", "label", F.octet_length("text").alias("size"), F.xxhash64("id").alias("turn")).toPandas().sort_values(["turn", "id"])
    taken = [part.iloc[fitting(part["size"].tolist(), most_bytes)] for _, part in sizes.groupby("label")]
    if not taken:
        return pd.DataFrame({"id": [], "label": [], "text": []})
    picked = docs.sparkSession.createDataFrame(pd.concat(taken)[["id", "label"]], chosen.select("id", "label").schema)
    return rows.join(F.broadcast(picked), ["id", "label"], "left_semi").select("id", "label", "text").toPandas().sort_values(["id", "label"])


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``).

    Only a session that runs in one process gets a folder of its own where the setting is missing.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Batches between Spark and Python of at most BATCH_BYTES (one longer text is a batch of its own).

    Spark's own limit lets a batch of texts take 64 MB, several times over in the executor and in
    the worker. The setting is the session's; a smaller one stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def materialise(df: DataFrame, *, partitions: int | None = None, large_rows: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    ``large_rows``: rows hold some MB each. Readers hold up to 4,096 rows of a row group at once, and
    writers gather those of up to 128 MB as compressed, so each row gets its own; and writers keep the
    least and the largest value of each row group, whole, to the end of the file, so there are none.
    """
    path = scratch(df.sparkSession)
    rows = {"parquet.block.row.count.limit": 1, "parquet.column.statistics.enabled": False} if large_rows else {}
    (df.coalesce(partitions) if partitions else df).write.option("compression", "zstd").options(**rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
