"""Daily grids in binary files, as a data source: one partition for each file, days pushed down to the names.

A file <name>_<YYYY-MM-DD>_<band>.grid holds a band of rows of one day's grid: a header and its values
as doubles, NaN where there is none. A filter on the day decides by the names which files are opened.
Files are written under another name and moved, so a file that is there is whole, and a task that
runs again leaves the same files.

    spark.dataSource.register(DatedGrids)
    spark.read.format("dated_grids").option("path", folder).option("first", "2024-01-05").load()
    spark.readStream.format("dated_grids").option("path", folder).load()

The range of days can be given as the options first and last, as ``read_grids`` does. With the
option pushdown=true Spark's own filters on the day reach the names too, which needs the setting
``spark.sql.python.filterPushdown.enabled``. A stream takes files in the order of their names after
those it has taken, so a day's file that arrives after later days were read is not seen.
"""

import re
import struct
import uuid
from collections.abc import Iterator
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from nivalis.operators.lineage import checkpointed

MAGIC = b"GRID0001"
#: First row, rows, columns; latitude and longitude of the centre of cell (0, 0), and the step from cell to cell.
HEADER = "<8sIIIddd"
NAME = re.compile(r"_(\d{4}-\d{2}-\d{2})_(\d{5})\.grid$")
SCHEMA = "day date, y int, x int, lat double, lon double, z double"
_TYPES = pa.schema([("day", pa.date32()), ("y", pa.int32()), ("x", pa.int32()), ("lat", pa.float64()), ("lon", pa.float64()), ("z", pa.float64())])
#: Rows of a band.
BAND = 256


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


class GridFile(InputPartition):
    def __init__(self, path: str, day: str):
        super().__init__(path)
        self.path, self.day = path, day


def _listed(path: str) -> list[GridFile]:
    """The files of a folder by name."""
    system, folder = _place(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    named = sorted((i.path for i in found if i.is_file and NAME.search(i.path)), key=lambda p: p.rsplit("/", 1)[-1])
    return [GridFile(p, NAME.search(p)[1]) for p in named]


def _cells(root: str, file: GridFile) -> Iterator[pa.RecordBatch]:
    """The cells of a file that have a value."""
    with _place(root)[0].open_input_stream(file.path) as source:
        magic, first, rows, columns, north, west, step = struct.unpack(HEADER, source.read(struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError(f"{file.path} is not a grid")
        z = np.frombuffer(source.read(8 * rows * columns), "<f8").reshape(rows, columns)
    y, x = np.nonzero(~np.isnan(z))
    day = pa.repeat(pa.scalar(date.fromisoformat(file.day), pa.date32()), len(y))
    columns = [day, pa.array(y + first, pa.int32()), pa.array(x, pa.int32()), pa.array(north - (y + first) * step), pa.array(west + x * step), pa.array(z[y, x])]
    yield pa.RecordBatch.from_arrays(columns, schema=_TYPES)


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.first, self.last = options["path"], options.get("first", "0000-00-00"), options.get("last", "9999-99-99")

    def partitions(self) -> list[GridFile]:
        return [f for f in _listed(self.path) if self.first <= f.day <= self.last]

    def read(self, partition: GridFile) -> Iterator[pa.RecordBatch]:
        yield from _cells(self.path, partition)


class PushingReader(GridReader):
    """Takes comparisons of the day with a date as the range of files."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("day",) or not isinstance(getattr(f, "value", None), date):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                self.first = max(self.first, (f.value + timedelta(days=isinstance(f, GreaterThan))).isoformat())
            if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                self.last = min(self.last, (f.value - timedelta(days=isinstance(f, LessThan))).isoformat())
            if not isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan, LessThanOrEqual, LessThan)):
                yield f


class GridStream(DataSourceStreamReader):
    """Offsets are the name of the last file taken."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        files = _listed(self.path)
        return {"after": files[-1].path.rsplit("/", 1)[-1] if files else ""}

    def partitions(self, start: dict, end: dict) -> list[GridFile]:
        return [f for f in _listed(self.path) if start["after"] < f.path.rsplit("/", 1)[-1] <= end["after"]]

    def read(self, partition: GridFile) -> Iterator[pa.RecordBatch]:
        yield from _cells(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class DatedGrids(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dated_grids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GridReader:
        return (PushingReader if self.options.get("pushdown", "false") == "true" else GridReader)(self.options)

    def streamReader(self, schema) -> GridStream:
        return GridStream(self.options)


def read_grids(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """day, y, x, lat, lon and z of the days first..last; files of other days are not opened."""
    spark.dataSource.register(DatedGrids)
    reader = spark.read.format("dated_grids").option("path", path)
    for name, value in (("first", first), ("last", last)):
        if value:
            reader = reader.option(name, value)
    return reader.load()


def stream_grids(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(DatedGrids)
    return spark.readStream.format("dated_grids").option("path", path).load()


def write_grids(df: DataFrame, path: str, name: str, north: float, west: float, step: float, width: int | None = None, band: int = BAND) -> DataFrame:
    """Writes (day, y, x, z) as files of bands of rows; a row for each file: file, day and cells.

    ``width`` is the number of columns (default: the largest x and one). Rows with a null in day, y
    or x, or an x outside, have no place; of several values of a cell the largest counts.
    """
    cells = df.select(F.col("day").cast("date").cast("string").alias("day"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("z").cast("double").alias("z")).na.drop(subset=["day", "y", "x"])
    width = width or (cells.agg(F.max("x")).first()[0] or 0) + 1
    cells = cells.where((F.col("x") >= 0) & (F.col("x") < width) & (F.col("y") >= 0)).withColumn("band", F.floor(F.col("y") / band).cast("int"))

    def save(table: pa.Table) -> pa.Table:
        y, x, z = (table[c].to_numpy() for c in ("y", "x", "z"))
        day, number = table["day"][0].as_py(), table["band"][0].as_py()
        first, grid = number * band, np.full((int(y.max()) - number * band + 1, width), np.nan)
        order = np.argsort(np.nan_to_num(z.astype(float), nan=-np.inf), kind="stable")
        grid[y[order] - first, x[order]] = z[order]
        system, folder = _place(path)
        system.create_dir(folder, recursive=True)
        file, draft = f"{name}_{day}_{number:05d}.grid", f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(struct.pack(HEADER, MAGIC, first, *grid.shape, north, west, step) + grid.astype("<f8").tobytes())
        system.move(draft, f"{folder}/{file}")
        return pa.table({"file": [file], "day": [day], "cells": pa.array([int((~np.isnan(grid)).sum())], pa.int64())})

    return checkpointed(cells.groupBy("day", "band").applyInArrow(save, "file string, day string, cells long"))
