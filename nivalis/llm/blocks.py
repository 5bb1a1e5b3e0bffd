"""Whole texts dealt into blocks, for operators that look words up in a table of all words.

Such an operator meets each word of a block once, sends the block's distinct words to the tasks
that own them (by hash), and gets one answer back for each. Texts cross the network once, packed;
words cross it once per block and not once per occurrence. How many blocks and owners there are
goes by the bytes of text, not by a setting, so a block has about BLOCK_BYTES at every size (or
one longer text).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a page (a longer text has a page of its own).
PAGE_BYTES = 1 << 20
#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20


def count(texts: DataFrame) -> int:
    """The number of blocks for the column text; of little text each core gets one, of a page or more."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = min(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PAGE_BYTES))
    return max(1, few, math.ceil(size / BLOCK_BYTES))


def owner(word: bytes, n: int) -> int:
    return crc32(word) % n


def pages(texts: DataFrame, n: int) -> DataFrame:
    """Packs the rows of (doc_id long, fold int, text string): block (of n), doc_ids, folds, sizes, and data (zstandard).

    Pages are dealt by data, ids and their turn, so that copies of a long text spread.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        rows: list[tuple] = []
        size = turn = 0

        def page() -> pa.RecordBatch:
            ids, folds, sizes, parts = (list(x) for x in zip(*rows, strict=True))
            data = squeeze.compress(b"".join(parts))
            block = crc32(repr((turn, ids)).encode(), crc32(data)) % n
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([folds], pa.list_(pa.int32())), pa.array([sizes], pa.list_(pa.int32())), pa.array([data], pa.binary())],
                names=["block", "doc_ids", "folds", "sizes", "data"],
            )

        for batch in batches:
            for doc_id, fold, text in zip(batch["doc_id"].to_pylist(), batch["fold"].to_pylist(), batch["text"], strict=True):
                raw = text.as_buffer().to_pybytes()
                if rows and size + len(raw) > PAGE_BYTES:
                    yield page()
                    rows, size, turn = [], 0, turn + 1
                rows.append((doc_id, fold, len(raw), raw))
                size += len(raw)
        if rows:
            yield page()

    schema = "block int, doc_ids array<long>, folds array<int>, sizes array<int>, data binary"
    return texts.select("doc_id", F.col("fold").cast("int"), "text").mapInArrow(pack, schema)


def read(table: pa.Table) -> Iterator[tuple[list, list, list[bytes]]]:
    """The ids, folds and texts of each page."""
    expand = zstandard.ZstdDecompressor()
    for ids, folds, sizes, data in zip(table["doc_ids"].to_pylist(), table["folds"].to_pylist(), table["sizes"].to_pylist(), table["data"], strict=True):
        raw = expand.decompress(data.as_buffer(), max_output_size=max(1, sum(sizes)))
        texts, at = [], 0
        for n in sizes:
            texts.append(raw[at : at + n])
            at += n
        yield ids, folds, texts
