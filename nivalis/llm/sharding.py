"""Shards for training data by size-tiered compaction.

``append`` writes an arrival as small immutable files, one for each task, without a shuffle;
``append_parts`` writes several arrivals in one pass. ``compact`` merges files of like size: tier 0
holds files up to ``small`` bytes, and each further tier those up to ``fanout`` times larger, until
files near ``target`` are finished and never rewritten. A tier is merged once it has ``fanout``
files or as many bytes as the target; a merge takes files until they reach the target and is read
and written by one task of one job, without a shuffle. So a row is written once at arrival and once
for each tier it climbs.

Every change ends with a new manifest, written beside its place and moved there by one rename that
fails if the version exists: readers see the old set of files or the new one, and of two writers one
loses. That holds where rename is exclusive (HDFS, local disks), not on object stores. A manifest
has one line for each file and no rows: at 128 MB a file, 100 TB are 800,000 lines of about 100
bytes, which the driver reads and writes at each commit; with a larger ``target`` they are fewer.

An arrival is written once: a writer that loses commits its files after the winner's version; a merge
that loses is dropped. ``clean`` keeps the last versions and removes files that only retired manifests
name, once older than a grace period, and folders that no manifest names (of a writer that died) after
a longer one, within which a writer has to commit.

Defined cases: a null text counts 0 bytes of text; repeated rows are stored as often as they come;
an empty arrival adds no file but commits a version; the columns of the rows are kept whatever
their names (arrivals with other columns than the first are refused). The manifest holds the schema,
so a set without files can be read. It uses Hadoop's file system through the session's JVM, which
a Spark Connect session doesn't offer.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nivalis.llm.common import documents, scratch

#: Bytes of a file of the lowest tier at most, of a finished file, and files merged at once.
SMALL, TARGET, FANOUT = 8 << 20, 128 << 20, 4
#: A file of this share of the target is finished: merged files compress a little better than their parts.
NEAR = 0.8
#: Merges written by one job; shards that a broadcast may list.
MERGES, LISTED = 64, 50_000


class Outrun(RuntimeError):
    """Another writer has made the version that was to be made."""


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int
    rows: int


class ShardSet:
    """A versioned set of files below one folder."""

    def __init__(self, spark: SparkSession, root: str, small: int = SMALL, target: int = TARGET, fanout: int = FANOUT):
        self.spark, self.root, self.small, self.target, self.fanout = spark, root.rstrip("/"), small, target, fanout
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(hadoop.Path(f"{self.root}/manifests"))

    def tier(self, shard: Shard) -> int | None:
        """The tier that a file belongs to by its bytes; None for a finished one."""
        if shard.bytes >= NEAR * self.target:
            return None
        tier, most = 0, self.small
        while shard.bytes > most:
            tier, most = tier + 1, most * self.fanout
        return tier

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifests"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        return max(self.versions(), default=0)

    def _manifest(self, version: int | None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"schema": None, "shards": []}
        stream = self._fs.open(self._path(f"{self.root}/manifests/{version:09d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def shards(self, version: int | None = None) -> list[Shard]:
        return [Shard(**x) for x in self._manifest(version)["shards"]]

    def schema(self, version: int | None = None) -> StructType | None:
        found = self._manifest(version)["schema"]
        return StructType.fromJson(found) if found else None

    def commit(self, shards: list[Shard], after: int, schema: StructType | None = None) -> int:
        """Make ``shards`` version after + 1, unless another writer has made it already."""
        place = self._path(f"{self.root}/manifests/{after + 1:09d}.json")
        draft = self._path(f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        schema = schema or self.schema(after)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps({"schema": schema and schema.jsonValue(), "shards": [asdict(s) for s in shards]}).encode()))
        stream.close()
        if self._fs.exists(place) or not self._fs.rename(draft, place):
            self._fs.delete(draft, False)
            raise Outrun(f"version {after + 1} exists; read it and try again")
        return after + 1

    def _files(self, folder: str, schema: StructType) -> list[Shard]:
        """The files of a folder that hold rows; only their footers are read."""
        if not self._fs.exists(self._path(folder)):
            return []
        found = self.spark.read.schema(schema).parquet(folder).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
        return [Shard(f"{folder}/{r['file_path'].rsplit('/', 1)[1]}", r["file_size"], r["rows"]) for r in found.orderBy("file_path").collect()]

    def _checked(self, rows: DataFrame, version: int) -> None:
        known = self.schema(version)
        if known and set(known.fieldNames()) != set(rows.columns):
            raise ValueError("the arrival's columns differ from those stored")

    def append(self, rows: DataFrame) -> int:
        """Add an arrival as small files."""
        self._checked(rows, self.version())
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        return self._added(folder, rows)

    def _added(self, folder: str, rows: DataFrame) -> int:
        """Commits the files of an arrival after whatever version is the last; they are written once however often others come first."""
        files = self._files(folder, rows.schema)
        while True:
            version = self.version()
            try:
                self._checked(rows, version)
            except ValueError:
                self._fs.delete(self._path(folder), True)
                raise
            try:
                return self.commit(self.shards(version) + files, version, rows.schema)
            except Outrun:
                continue

    def append_parts(self, rows: DataFrame, part: Column, n: int, compact: bool = True) -> int:
        """Add n arrivals, the rows with part = 0, 1, ..., in one pass; each is committed, and compacted, on its own."""
        self._checked(rows, self.version())
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.withColumn("__part", part).write.option("compression", "zstd").partitionBy("__part").parquet(folder)
        for i in range(n):
            version = self._added(f"{folder}/__part={i}", rows)
            if compact:
                version = self.compact()
        return version

    def merges(self, shards: list[Shard], everything: bool = False) -> list[list[Shard]]:
        """The groups of files to be merged next."""
        tiers: dict[int, list[Shard]] = {}
        for shard in sorted(shards, key=lambda s: (s.bytes, s.path)):
            tier = self.tier(shard)
            if tier is not None:
                tiers.setdefault(0 if everything else tier, []).append(shard)
        out = []
        for _, own in sorted(tiers.items()):
            group: list[Shard] = []
            for shard in own:
                group.append(shard)
                if sum(s.bytes for s in group) >= self.target:
                    out.append(group)
                    group = []
            if len(group) >= (2 if everything else self.fanout):
                out.append(group)
        return [group for group in out if len(group) > 1]

    def compact(self, everything: bool = False) -> int:
        """Merge files of like size until no tier has enough of them; with ``everything``, all that are not finished.

        A merge that another writer outruns is dropped, and the next one starts from that writer's version.
        """
        version = self.version()
        shards, schema = self.shards(version), self.schema(version)
        while groups := self.merges(shards, everything):
            for at in range(0, len(groups), MERGES):
                own = groups[at : at + MERGES]
                folder = f"{self.root}/data/{uuid.uuid4().hex}"
                parts = [self.spark.read.schema(schema).parquet(*[s.path for s in group]).coalesce(1) for group in own]
                reduce(DataFrame.union, parts).write.option("compression", "zstd").parquet(folder)
                gone = {s.path for group in own for s in group}
                merged = [s for s in shards if s.path not in gone] + self._files(folder, schema)
                try:
                    version, shards = self.commit(merged, version), merged
                except Outrun:
                    self._fs.delete(self._path(folder), True)
                    version = self.version()
                    shards = self.shards(version)
                    break
            else:
                everything = False
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version."""
        shards, schema = self.shards(version), self.schema(version)
        if not shards:
            return self.spark.createDataFrame([], schema or StructType())
        return self.spark.read.schema(schema).parquet(*[s.path for s in shards])

    def placed(self) -> DataFrame:
        """doc_id, text, shard (its number in the manifest), tier (null: finished) and version of each row."""
        version = self.version()
        shards = self.shards(version)
        name = lambda path: path.rsplit("/", 1)[1]
        listed = self.spark.createDataFrame([(name(s.path), i, self.tier(s)) for i, s in enumerate(shards)], "__file string, shard int, tier int")
        if not shards:
            return self.read().select("doc_id", "text", F.lit(0).alias("shard"), F.lit(0).alias("tier"), F.lit(version).alias("version"))
        rows = self.read().select("doc_id", "text", F.col("_metadata.file_name").alias("__file"))
        return rows.join(F.broadcast(listed) if len(shards) <= LISTED else listed, "__file").select("doc_id", "text", "shard", "tier", F.lit(version).alias("version"))

    def clean(self, keep: int = 2, grace_s: float = 3600, orphan_s: float = 7 * 86_400) -> None:
        """Retire all but the last ``keep`` versions, and remove files that only they name, once older than ``grace_s`` seconds.

        A manifest goes when it is as old and its files have gone. Folders that no manifest names go
        once older than ``orphan_s``.
        """
        versions = self.versions()
        used = {s.path for v in versions[-keep:] for s in self.shards(v)}
        before = (time.time() - grace_s) * 1000
        old = lambda place: self._fs.getFileStatus(place).getModificationTime() <= before
        for version in versions[:-keep]:
            manifest = self._path(f"{self.root}/manifests/{version:09d}.json")
            gone = old(manifest)
            for path in {s.path for s in self.shards(version)} - used:
                place = self._path(path)
                if self._fs.exists(place):
                    gone &= old(place) and self._fs.delete(place, False)
            if gone:
                self._fs.delete(manifest, False)
        named = {s.path.removeprefix(f"{self.root}/data/").split("/")[0] for v in self.versions() for s in self.shards(v)}
        data = self._path(f"{self.root}/data")
        if self._fs.exists(data):
            for status in self._fs.listStatus(data):
                if status.getPath().getName() not in named and status.getModificationTime() <= (time.time() - orphan_s) * 1000:
                    self._fs.delete(status.getPath(), True)


def shard_arrivals(docs: DataFrame, root: str, arrivals: int = 4, **sizes: int) -> ShardSet:
    """Append docs as ``arrivals`` arrivals, by a hash of the id and the text, compacting after each."""
    shards = ShardSet(docs.sparkSession, root, **sizes)
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(arrivals)).cast("int")
    shards.append_parts(docs, turn, arrivals)
    return shards


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_arrivals(documents(spark, sf_dir), scratch(spark)).placed()
    return placed.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "tier", "version")
