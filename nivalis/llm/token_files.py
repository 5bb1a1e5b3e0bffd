"""Token ids in binary files, packed with Simple-8b, in ascending order of doc_id.

A file is a magic number and sections. A section holds up to SECTION ids, with a table of its
documents and the place of each block of 128 ids, so a section, or a run of blocks in it, is decoded
alone and at once. A document that goes over a section's end goes on in the next section of the
same file. Documents are dealt over files by ranges of doc_id, about FILE_BYTES of text each.

Each task writes its file under a name that no other attempt uses. The manifest, a table of one row
per file that Spark commits when all tasks are done, names the files that count; what a lost task
left behind is never read. The manifest gives the ids in each file, and their sums over the files
before give the place of each document in the whole sequence.

Memory: a section and a batch of texts in each task (or one longer text), and the ids of up to
KNOWN_BYTES of distinct words, which are encoded once while they are known.

Defined cases: a null text is empty and has only the end id; a null doc_id sorts before all others
and is returned as null; rows that repeat a doc_id are documents of their own, ordered by their
texts' hash; no documents: no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm import bpe, simple8b
from nivalis.llm.common import documents, id_and_text, materialise, scratch
from nivalis.llm.joined_words import Numbers, joined_ids

#: The id after each document.
END = 2
#: Bytes of text for a file, ids in a section, and bytes of words whose ids a worker keeps.
FILE_BYTES, SECTION, KNOWN_BYTES = 64 << 20, 1 << 20, 128 << 20

MAGIC = b"S8BIDS01"
#: A section's header: documents, ids, words and blocks.
HEADER = struct.Struct("<IIII")
#: Of a document in a section: its id, its ids there, whether it ends there, whether its id is null.
ENTRY = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("ends", "u1"), ("null", "u1")])

#: White space in a row, and a byte that UTF-8 does not use.
_RUN, _BARE = re.compile(rb"[\t-\r ]{2}"), b"\xff"

MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"


def _keys(text: bytes) -> list[bytes]:
    """The words of a text: a space before a word is left out, and a word without one that does not follow a line end gets a byte that no text has."""
    if _RUN.search(text) or (not text.isascii() and bpe._WIDE.search(text)):
        return [w[1:] if w[:1] == b" " and w[1:2] != b"\n" else w if w[:1] == b"\n" else _BARE + w for w in bpe.split_words(text)]
    found = text.replace(b"\n", b" \n").split(b" ")
    if found[0]:
        found[0] = _BARE + found[0]
    else:  # a space or a line end comes first
        del found[0]
    return found


def _word(key: bytes) -> bytes:
    return key[1:] if key[:1] == _BARE else key if key[:1] == b"\n" else b" " + key


class Known:
    """The ids of the words that this worker met lately. Word 0 is the end of a document."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.number, self.size = Numbers({_BARE: 0}), 0
        self.table = bpe.Packed(np.ones(1, np.int64), np.array([END], "<u4"))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text and its end."""
        if self.size > KNOWN_BYTES:
            self.clear()
        look, before = self.number.__getitem__, len(self.number)
        words = [np.fromiter(map(look, [*(_keys(x) if x else []), _BARE]), np.int64) for x in texts]
        if new := list(itertools.islice(self.number, before, None)):
            many = lambda parts: [x.ids for x in bpe.tokenizer(self.path).encode_batch_fast([w.decode() for w in parts], add_special_tokens=False)]
            flat, cuts = joined_ids([_word(w) for w in new], many, bpe.pieces(self.path).lengths)
            self.table = bpe.Packed(np.concatenate([self.table.lengths, np.diff(cuts)]), np.concatenate([self.table.flat, flat.astype("<u4")]))
            self.size += 150 * len(new) + sum(map(len, new)) + 4 * len(flat)
        return [self.table.joined(x) for x in words]


_known: dict[str, Known] = {}


def _section(entries: list[tuple], ids: np.ndarray) -> bytes:
    words, first = simple8b.pack(ids)
    table = np.array(entries, ENTRY)
    return b"".join([HEADER.pack(len(table), len(ids), len(words), len(first)), table.tobytes(), first.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


class Writer:
    """Writes documents' ids to an open binary file, section by section."""

    def __init__(self, out):
        self.out, self.entries, self.parts, self.held, self.n_docs, self.n_ids = out, [], [], 0, 0, 0
        out.write(MAGIC)
        self.n_bytes = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while True:
            taken = ids[at : at + SECTION - self.held]
            at += len(taken)
            self.entries.append((doc_id or 0, len(taken), at == len(ids), doc_id is None))
            self.parts.append(taken)
            self.held += len(taken)
            if self.held == SECTION:
                self.flush()
            if at == len(ids):
                break
        self.n_docs += 1
        self.n_ids += len(ids)

    def flush(self) -> None:
        if self.entries:
            data = _section(self.entries, np.concatenate(self.parts))
            self.out.write(data)
            self.n_bytes += len(data)
            self.entries, self.parts, self.held = [], [], 0


def sections(source) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """The table of documents, the packed words, the places of the blocks and the number of ids of each section."""
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")
    while head := source.read(HEADER.size):
        n_docs, n_ids, n_words, n_blocks = HEADER.unpack(head)
        data = source.read(n_docs * ENTRY.itemsize + 4 * n_blocks + 8 * n_words)
        table = np.frombuffer(data, ENTRY, n_docs)
        first = np.frombuffer(data, "<u4", n_blocks, table.nbytes).astype(np.int64)
        yield table, np.frombuffer(data, "<u8", n_words, table.nbytes + 4 * n_blocks), first, n_ids


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def write(docs: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    """Encodes documents and writes them to files in the folder ``path``, which all executors share; the manifest."""
    tokenizer = tokenizer or bpe.default_path()
    texts = id_and_text(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    n = max(1, math.ceil((size or 0) / FILE_BYTES), min(texts.sparkSession.sparkContext.defaultParallelism, math.ceil((size or 0) / bpe.blocks.PAGE_BYTES)))
    # rows that repeat an id, or the null id, spread by their texts' hash, and copies by their place
    keys = ["doc_id", "tie", "turn"]
    dealt = texts.withColumns({"tie": F.xxhash64("text"), "turn": F.monotonically_increasing_id()}).repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known.setdefault(tokenizer, Known(tokenizer))
        system, folder = _place(path)
        out = writer = None
        name = f"{uuid.uuid4().hex}.ids"
        try:
            for batch in batches:
                if writer is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}")
                    writer = Writer(out)
                encoded = known.encode([x.as_buffer().to_pybytes() for x in batch["text"]])
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoded, strict=True):
                    writer.add(doc_id, ids)
            if writer:
                writer.flush()
        finally:
            if out:
                out.close()
        if writer:
            row = {"part": TaskContext.get().partitionId(), "file": name, "n_docs": writer.n_docs, "n_ids": writer.n_ids, "n_bytes": writer.n_bytes}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    return materialise(dealt.select("doc_id", "text").mapInArrow(save, MANIFEST))


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with start, the ids in all files before: sums within groups of 1,024 files, and over the groups."""
    group = F.floor(F.col("part") / 1024).alias("group")
    sums = manifest.groupBy(group).agg(F.sum("n_ids").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for 1,024 files: 800 at 100 TB of text in files of 128 MB
    base = F.broadcast(sums.select("group", before.alias("base")))
    return manifest.select("*", group).join(base, "group").withColumn("start", F.col("base") + inside).drop("group", "base")


def _read(manifest: DataFrame, path: str, rows_of, schema: str, types: pa.Schema) -> DataFrame:
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _place(path)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_stream(f"{folder}/{row['file']}") as source:
                    for rows in rows_of(sections(source), row["start"]):
                        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types.types, strict=True)], schema=types)

    files = max(1, manifest.count())
    return with_starts(manifest).repartitionByRange(files, "part").mapInArrow(load, schema)


def read(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start and ids (array<int>) of the documents in the files."""

    def rows_of(found, start: int) -> Iterator[list[tuple]]:
        held: list[np.ndarray] = []
        for table, words, first, n in found:
            ids, at, rows = simple8b.unpack(words, first, n).astype("<u4"), 0, []
            for doc_id, size, ends, null in table.tolist():
                held.append(ids[at : at + size])
                at += size
                if ends:
                    whole = np.concatenate(held)
                    rows.append((None if null else doc_id, start, whole.view("<i4")))
                    start, held = start + len(whole), []
            if rows:
                yield rows

    types = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _read(manifest, path, rows_of, "doc_id long, start long, ids array<int>", types)


def report(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents in the files; a document's ids are not held whole."""

    def rows_of(found, start: int) -> Iterator[list[tuple]]:
        count = crc = 0
        for table, words, first, n in found:
            ids, at, rows = simple8b.unpack(words, first, n).astype("<u4"), 0, []
            for doc_id, size, ends, null in table.tolist():
                crc = zlib.crc32(ids[at : at + size], crc)
                at, count = at + size, count + size
                if ends:
                    rows.append((None if null else doc_id, start, count, crc))
                    start, count, crc = start + count, 0, 0
            if rows:
                yield rows

    types = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return _read(manifest, path, rows_of, "doc_id long, start long, n_tokens long, ids_crc32 long", types)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    return report(write(documents(spark, sf_dir), path), path)
