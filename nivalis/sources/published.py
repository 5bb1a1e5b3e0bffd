"""Results published in versions: readers see a whole run or the one before it, never part of one.

A run is written to a folder of its own that nothing changes afterwards. It becomes the latest by one
rename: a small folder with the version's contents is moved to the next version's number. Of two
writers that take the same number one wins, as a folder cannot be moved over another; whoever finds
other contents than its own there has lost, and tries the next number, or gives up if it had to
follow a certain version. A write that fails removes its folder; one whose driver died leaves a
folder that no version names, which ``clean`` removes after a while.

Files go through Hadoop's file systems, so a classic session is needed, and a store where moving a
folder is one step (HDFS, local disks).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class Conflict(RuntimeError):
    """Another writer has made the version that was to follow the given one."""


class Versions:
    """Numbered versions under a root; the contents of each are a small dict."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/versions"))

    def numbers(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/versions"))]
        return sorted(int(n) for n in names if n.isdigit())

    def latest(self) -> int:
        """The newest version's number; 0 if there is none."""
        return max(self.numbers(), default=0)

    def contents(self, number: int | None = None) -> dict:
        number = number or self.latest()
        if not number:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/versions/{number:09d}/contents.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, contents: dict, after: int | None = None) -> int:
        """Makes ``contents`` the next version; with ``after``, only if that is still the latest."""
        mark = uuid.uuid4().hex
        draft = f"{self.root}/drafts/{mark}"
        stream = self._fs.create(self._path(f"{draft}/contents.json"), False)
        stream.write(bytearray(json.dumps(contents | {"mark": mark}).encode()))
        stream.close()
        number = (self.latest() if after is None else after) + 1
        while not self._moved(draft, number, mark):
            if after is not None:
                self._fs.delete(self._path(draft), True)
                raise Conflict(f"version {number} exists; read it and try again")
            number += 1
        return number

    def _moved(self, draft: str, number: int, mark: str) -> bool:
        place = f"{self.root}/versions/{number:09d}"
        if self._fs.exists(self._path(place)):
            return False
        self._fs.rename(self._path(draft), self._path(place))
        if self.contents(number)["mark"] == mark:
            return True
        # another came first, and the draft may have been moved into its folder
        inside = self._path(f"{place}/{mark}")
        if self._fs.exists(inside):
            self._fs.rename(inside, self._path(draft))
        return False

    def written(self, run_id: str, write: Callable[[str], None]) -> str:
        """Calls ``write`` with a new folder for a run, which goes if that fails; its name below the root."""
        name = f"runs/{run_id}-{uuid.uuid4().hex[:12]}"
        try:
            write(f"{self.root}/{name}")
        except BaseException:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
            raise
        return name

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def clean(self, keep: int = 3, grace_s: float = 86_400) -> None:
        """Drops versions but the newest ``keep``, and folders that none of these names and that are older than ``grace_s``."""
        numbers = self.numbers()
        kept = [self.contents(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.remove(f"versions/{n:09d}")
        used = {x.split("/")[1] for c in kept for x in (c.get("folder"), *c.get("days", {}).values()) if x}
        for kind in ("runs", "drafts"):
            folder = self._path(f"{self.root}/{kind}")
            if self._fs.exists(folder):
                for s in self._fs.listStatus(folder):
                    if s.getPath().getName() not in used and s.getModificationTime() < (time.time() - grace_s) * 1000:
                        self._fs.delete(s.getPath(), True)


def publish(spark: SparkSession, root: str, run_id: str, write: Callable[[str], None], after: int | None = None) -> int:
    """Writes a run and makes it the latest version; with ``after``, only if no other came in between."""
    versions = Versions(spark, root)
    folder = versions.written(run_id, write)
    try:
        return versions.commit({"run_id": run_id, "folder": folder}, after)
    except Conflict:
        versions.remove(folder)
        raise


def latest_path(spark: SparkSession, root: str) -> str:
    """The folder of the latest version."""
    found = Versions(spark, root).contents()
    if not found:
        raise FileNotFoundError(f"nothing is published under {root}")
    return f"{root.rstrip('/')}/{found['folder']}"


class DayTable:
    """A table of immutable folders by day; a version names the folder of each day, so a change of some days is seen at once or not at all.

    A version lists its days: some 7,000 for twenty years.
    """

    def __init__(self, spark: SparkSession, root: str, day: str = "obs_date"):
        self.spark, self.root, self.day, self.versions = spark, root.rstrip("/"), day, Versions(spark, root)

    def read(self, days: list[str] | None = None, number: int | None = None) -> DataFrame | None:
        """The rows of a version (or of some of its days); None before the first."""
        found = self.versions.contents(number)
        if not found:
            return None
        schema = self.spark.createDataFrame([], found["schema"]).schema
        folders = [f for d, f in found["days"].items() if days is None or d in days]
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, touched: list[str], after: int, source: str = "", batch: int = -1) -> int:
        """A version where the days ``touched`` hold ``rows`` (and no others), and all else is as in version ``after``."""
        before = self.versions.contents(after) if after else {}
        write = lambda path: rows.withColumn("__day", F.coalesce(F.col(self.day).cast("string"), F.lit("none"))).repartition("__day").write.partitionBy("__day").parquet(path)
        folder = self.versions.written(f"days-{batch}", write)
        there = self.versions._path(f"{self.root}/{folder}")
        made = [s.getPath().getName() for s in self.versions._fs.listStatus(there) if s.getPath().getName().startswith("__day=")]
        days = {d: f for d, f in before.get("days", {}).items() if d not in touched} | {m[6:]: f"{folder}/{m}" for m in made}
        done = before.get("batches", {}) | ({source: batch} if source else {})
        ddl = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
        try:
            return self.versions.commit({"days": dict(sorted(days.items())), "batches": done, "schema": ddl}, after)
        except Conflict:
            self.versions.remove(folder)
            raise

    def correct(self, rows: DataFrame, key: list[str], order: str | None = None, source: str = "", batch: int = -1) -> int | None:
        """Rows replace those of the same key and day (nulls are alike); of rows alike in these the one with the largest ``order`` counts.

        Without ``order``, and for ties in it, the row whose other columns come last counts. A batch
        that a source has delivered before changes nothing.
        """
        after = self.versions.latest()
        if source and self.versions.contents(after).get("batches", {}).get(source, -1) >= batch:
            return None
        keys = [*key, self.day]
        first = [F.col(order).desc_nulls_last()] if order else []
        rest: list[Column] = [F.col(c).desc_nulls_last() for c in rows.columns if c not in (*keys, order)]
        rows = rows.withColumn("__turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*first, *rest, *keys))).where("__turn = 1").drop("__turn")
        touched = [r[0] for r in rows.select(F.coalesce(F.col(self.day).cast("string"), F.lit("none"))).distinct().collect()]  # the days of one batch
        old = self.read(touched, after) if after else None
        if old is not None:
            new = rows.select(*[F.col(k).alias(f"__{k}") for k in keys])
            same = [old[k].eqNullSafe(new[f"__{k}"]) for k in keys]
            rows = old.join(new, same, "left_anti").unionByName(rows)
        return self.replace(rows, touched, after, source, batch)
