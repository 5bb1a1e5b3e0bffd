"""Exact removal of repeated passages by distributed prefix doubling on sparse positions.

A byte goes if a string of ``length`` (100) bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same one. Strings never cross documents and are
judged on the input. The doubling works on content names (fingerprints) of growing strings;
Spark groups the (name, position) pairs at each length and names that are unique drop out:

1. 40 bytes, at sampled positions. Of the 61 places where a 40-byte string lies inside a
   100-byte string, the one with the smallest hash is its anchor. Equal strings have equal
   anchors at equal offsets, so a string whose anchor is unique is unique. Only 1 position in
   31 is an anchor, which is why this fits on disk: ranking every position would shuffle more
   than ten times the input.
2. The whole run of strings that share an anchor (about 130 bytes). A run equal to an earlier
   one is removed whole; only the first of each kind goes on, and only if its anchor has
   several kinds.
3. 100 bytes, at each position left: the name is the pair of the names of its halves, at
   offsets 0 and 50. All but the first position of each pair are repeats.

Names have 64 bits at each length and the bytes behind equal names are not compared again, so the
result is exact but for collisions: K different runs (or strings) with one anchor have about
K * K / 2^64 colliding pairs, 5e-8 at a million (the lowest bit only tells whether the length is
odd). Each round is one shuffle by the anchor's name. A common anchor is salted by document, in
round 2 by its share of a sample and in round 3 by its kinds of run: its runs (or strings) are ranked
within each salt first, and then the first of each salt over all salts, so a passage that a third
of all documents share does not land in one task; the sample only decides how rows are dealt. Round
3 moves one row for each run and not for each string (but for the first strings of each salt), and
no pairs of positions are ever made. Texts are shuffled once, compressed, for round 3 and for the cut.

Defined cases: a null text is empty; texts under 100 bytes stay whole; a null doc_id comes
before all others; rows that repeat a doc_id with another text are told apart and ordered by a
64-bit hash of their text; rows equal in both are one document and get the same result each; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm.common import NO_ID, bounded_batches, documents, materialise

LENGTH, GRAM, HALF = 100, 40, 50
PLACES = LENGTH - GRAM + 1
#: Strings start in slices of so many positions; a slice reads LENGTH - 1 bytes more.
SLICE = 1 << 19
#: One document in SAMPLE shows which anchors are common; these get a salt for each SALT_ROWS rows expected.
SAMPLE, SALT_ROWS = 64, 20_000
#: The strings of an anchor have a salt in round 3 for each SALT_KINDS of its kinds of run.
SALT_KINDS = 1024

RUNS = "name long, run long, k long, t long, pos long, more short"
PACKED = "k long, t long, size int, data binary"

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**61)) * 8 + 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base % 2**64))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, SLICE + LENGTH)
_INVERSE = _powers(pow(_BASE, -1, 2**64), SLICE + LENGTH)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x ^= x >> np.uint64(29)
    return x * _MIX


class _Names:
    """Fingerprints of any substring of a slice of bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _POWER[: len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * _INVERSE[start])

    def every(self, n: int) -> np.ndarray:
        m = len(self.sums) - n
        return _mix((self.sums[n:] - self.sums[:m]) * _INVERSE[:m])


def anchor_runs(text: bytes) -> tuple[np.ndarray, ...]:
    """Runs of string starts that share an anchor: (anchor's name, run's name, first start, starts - 1)."""
    parts = []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(data) - LENGTH + 1), SLICE):
        names = _Names(data[at : at + SLICE + LENGTH - 1])
        grams = names.every(GRAM)
        order = (_mix(grams) & ~np.uint64(0xFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= PLACES:
            order = np.minimum(order[:-size], order[size:])
            size *= 2
        if size < PLACES:
            order = np.minimum(order[: len(order) - (PLACES - size)], order[PLACES - size :])
        anchor = (order & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
        own = anchor[first]
        run = names.at(first, last + LENGTH) + _mix(((own - first) * 128 + (last - first)).astype(np.uint64))
        parts.append((grams[own], run, first + at, last - first))
    if not parts:
        return (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _emit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, size = [], 0
        for k, t, text in zip(batch["k"].to_pylist(), batch["t"].to_pylist(), batch["text"], strict=True):
            name, run, start, more = anchor_runs(text.as_buffer())
            out.append((name, run, np.full(len(name), k), np.full(len(name), t), start, more))
            size += len(name)
            if size > 100_000:
                yield _rows(out)
                out, size = [], 0
        if size:
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    name, run, k, t, pos, more = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(name.view(np.int64)), pa.array(run.view(np.int64)), pa.array(k), pa.array(t), pa.array(pos), pa.array(more.astype(np.int16))],
        names=["name", "run", "k", "t", "pos", "more"],
    )


def _spans(value: list | None) -> tuple[np.ndarray, np.ndarray]:
    if not value:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lo = np.array([x["lo"] for x in value], np.int64)
    return lo, lo + np.array([x["more"] for x in value], np.int64)


def _emit_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each listed run, the names of its strings in a row, dealt by document to the salts of its anchor."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        out: list[tuple] = []
        for k, t, size, packed, value in zip(*(batch[c].to_pylist() for c in ("k", "t", "size", "data", "runs")), strict=True):
            data = np.frombuffer(expand.decompress(packed, max_output_size=size), np.uint8)
            dealt = crc32(f"{k} {t}".encode())
            for run in value:
                names = _Names(data[run["lo"] : run["lo"] + run["more"] + LENGTH])
                start = np.arange(run["more"] + 1)
                whole = names.at(start, start + HALF) * _MIX + names.at(start + HALF, start + LENGTH)
                out.append((run["name"], dealt % run["salts"], run["salts"], k, t, run["lo"], whole.view(np.int64)))
        if out:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "salt", "salts", "k", "t", "pos", "strings"])


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """True for each of n bytes in a string that starts between lo and hi."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, lo, 1)
    np.add.at(change, hi + LENGTH, -1)
    return np.cumsum(change[:n]) > 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw = [x.as_buffer() for x in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["k"], batch["t"], pa.array([x.size for x in raw], pa.int32()), pa.array([squeeze.compress(x) for x in raw], pa.binary()), *batch.columns[3:]],
            names=["k", "t", "size", "data", *batch.schema.names[3:]],
        )


def _removed(batches: Iterator[pa.RecordBatch], cut) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("size", "data", "runs")), strict=True)
        yield cut(batch, [(expand.decompress(data, max_output_size=size), *_spans(value)) for size, data, value in rows])


def _kept(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes that stay, how many go, and in how many maximal runs."""
    if not len(lo):
        return text, 0, 0
    data = np.frombuffer(text, np.uint8)
    gone = covered(len(data), lo, hi)
    return data[~gone].tobytes(), int(gone.sum()), int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum())


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """The columns k (the id), t (which tells rows with one id apart; 0 if no id repeats), text, and ``more``."""
    bounded_batches(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    repeated = not docs.select(key).groupBy("k").count().where("count > 1").limit(1).isEmpty()
    tie = F.xxhash64(text) if repeated else F.lit(0)
    return docs.select(key, tie.cast("long").alias("t"), text.alias("text"), *more)


def _common_anchors(keyed: DataFrame) -> DataFrame:
    """Names of anchors that are a hundred-thousandth of a sample of documents or more, and salts for each.

    A hundred thousand names at most, so the table may be broadcast.
    """
    sample = keyed.where(F.pmod(F.xxhash64("k", "t", F.lit(7)), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(_emit_runs, RUNS).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.where("n > 1"))
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = counts.where(F.col("n") >= max(64, whole // 100_000))
    return common.select("name", F.ceil(F.col("n") * SAMPLE / SALT_ROWS).cast("int").alias("salts"))


def _ranked(keyed: DataFrame) -> DataFrame:
    """Runs that are not alone with their anchor: name, run, k, t, pos, more, salts, place (within the run's kind) and kinds."""
    anchors = keyed.mapInArrow(_emit_runs, RUNS).join(F.broadcast(_common_anchors(keyed)), "name", "left")
    salts = F.coalesce("salts", F.lit(1))
    anchors = anchors.withColumn("salts", salts).withColumn("salt", F.pmod(F.xxhash64("k", "t"), salts).cast("int"))
    anchors = anchors.repartition("name", "salt")
    of_kind = Window.partitionBy("name", "salt", "run").orderBy("k", "t", "pos")
    of_name = Window.partitionBy("name", "salt")
    ranked = anchors.withColumn("place", F.rank().over(of_kind))
    ranked = ranked.withColumn("kinds", F.count_if(F.col("place") == 1).over(of_name))
    ranked = ranked.where("place > 1 or salts > 1 or kinds > 1")
    return materialise(ranked.select("name", "run", "k", "t", "pos", "more", "salts", "place", "kinds"))


def repeats(keyed: DataFrame, packed: DataFrame) -> DataFrame:
    """For each document with repeats: k, t, and runs, the starts of its repeated strings as (lo, more)."""
    ranked = _ranked(keyed)
    whole = ranked.where("place > 1").select("k", "t", "pos", "more")
    first = ranked.where("place = 1 and salts = 1").select("name", "kinds", "k", "t", "pos", "more")
    # what is first in its salt goes on to be ranked over all salts
    salted = ranked.where("place = 1 and salts > 1")
    kinds = salted.groupBy("name", "run").agg(F.min(F.struct("k", "t", "pos", "more")).alias("first"))
    whole = whole.unionByName(salted.join(kinds, ["name", "run"]).where("k != first.k or t != first.t or pos != first.pos").select("k", "t", "pos", "more"))
    counts = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    first = first.unionByName(kinds.join(F.broadcast(counts), "name").select("name", "kinds", "first.*"))

    first = first.withColumn("salts", F.ceil(F.col("kinds") / SALT_KINDS).cast("int"))
    strings = packed.join(_by_document(first, "name", "salts"), ["k", "t"]).select("k", "t", "size", "data", "runs")
    strings = strings.mapInArrow(_emit_strings, "name long, salt int, salts int, k long, t long, pos long, strings array<long>").repartition("name", "salt")
    strings = strings.select("name", "salt", "salts", "k", "t", "pos", F.posexplode("strings").alias("i", "string"))
    strings = strings.withColumn("pos", F.col("pos") + F.col("i"))
    place = F.rank().over(Window.partitionBy("name", "salt", "string").orderBy("k", "t", "pos"))
    placed = strings.withColumn("place", place).where("place > 1 or salts > 1")
    # a repeat within its salt is settled; the first of each salt are ranked over all salts
    placed = materialise(placed.select("k", "t", "pos", *[F.when(F.col("place") == 1, F.col(c)).alias(c) for c in ("name", "string")]))
    over_all = F.rank().over(Window.partitionBy("name", "string").orderBy("k", "t", "pos"))
    later = placed.where("name is null").drop("name", "string")
    later = later.unionByName(placed.where("name is not null").withColumn("place", over_all).where("place > 1").select("k", "t", "pos"))
    return _by_document(whole.unionByName(later.withColumn("more", F.lit(0).cast("short"))))


def repeats_by_every_position(keyed: DataFrame) -> DataFrame:
    """The same as ``repeats`` by plain prefix doubling: every position has a name for its string of 1, 2,
    4, ..., 64 and then LENGTH bytes, each the hash of the names of two that overlap or meet; positions
    with a name of their own drop out at each length. It takes over a hundred times the input in disk.
    """
    data = keyed.dropDuplicates(["k", "t"]).select("k", "t", F.col("text").cast("binary").alias("data")).where(F.length("data") >= LENGTH)
    at = data.select("k", "t", "data", F.explode(F.sequence(F.lit(0), F.length("data") - 1)).alias("pos"))
    names = at.select("k", "t", F.col("pos").cast("long").alias("pos"), F.xxhash64(F.substring("data", F.col("pos") + 1, F.lit(1))).alias("name"))
    size = 1
    while size < LENGTH:
        step = min(size, LENGTH - size)
        ahead = names.select("k", "t", (F.col("pos") - step).alias("pos"), F.col("name").alias("next"))
        names = names.join(ahead, ["k", "t", "pos"]).select("k", "t", "pos", F.xxhash64("name", "next").alias("name"))
        names = materialise(names.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).where("n > 1").drop("n"))
        size += step
    place = F.rank().over(Window.partitionBy("name").orderBy("k", "t", "pos"))
    return _by_document(names.withColumn("place", place).where("place > 1").select("k", "t", "pos", F.lit(0).cast("short").alias("more")))


def _by_document(runs: DataFrame, *more: str) -> DataFrame:
    return runs.groupBy("k", "t").agg(F.collect_list(F.struct(F.col("pos").alias("lo"), "more", *more)).alias("runs"))


def _digest(batch: pa.RecordBatch, rows: list) -> pa.RecordBatch:
    kept = [(len(text), *_kept(text, lo, hi)) for text, lo, hi in rows]
    return pa.RecordBatch.from_arrays(
        [batch["k"], pa.array([x[0] for x in kept], pa.int64()), pa.array([x[2] for x in kept], pa.int64()), pa.array([x[3] for x in kept], pa.int64()), pa.array([hashlib.sha256(x[1]).hexdigest() for x in kept], pa.string())],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def removal_report(docs: DataFrame, every_position: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document; ``every_position`` names all positions, not only anchors."""
    keyed = _keyed(docs)
    packed = keyed.mapInArrow(_packed, PACKED)
    found = repeats_by_every_position(keyed) if every_position else repeats(keyed, packed)
    return (
        packed.join(found, ["k", "t"], "left")
        .select("k", "size", "data", "runs")
        .mapInArrow(lambda it: _removed(it, _digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut from text; all columns stay, and n_chars follows the text if it is there.

    A character of which only some bytes go is dropped whole.
    """
    names = [c for c in docs.columns if c != "text"]
    rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("rest")
    rows = _keyed(docs, rest)
    kind = rows.schema["rest"].dataType.simpleString()
    keyed = rows.select("k", "t", "text")
    found = repeats(keyed, keyed.mapInArrow(_packed, PACKED))

    def cut(batch: pa.RecordBatch, own: list) -> pa.RecordBatch:
        texts = [_kept(text, lo, hi)[0].decode("utf-8", "ignore") for text, lo, hi in own]
        return pa.RecordBatch.from_arrays([batch["rest"], pa.array(texts, pa.string())], names=["rest", "text"])

    out = rows.mapInArrow(_packed, f"{PACKED}, rest {kind}").join(found, ["k", "t"], "left").select("rest", "size", "data", "runs")
    out = out.mapInArrow(lambda it: _removed(it, cut), f"rest {kind}, text string")
    shown = {c: F.col(f"rest.c{i}") for i, c in enumerate(names)} | {"text": F.col("text")}
    if "n_chars" in shown:
        shown["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[shown[c].alias(c) for c in docs.columns])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(documents(spark, sf_dir))
