"""Ranked lexical search, reversed: the items' terms are the index, and documents stream through it.

The inverted index over the terms of all items is broadcast. Documents are read once: each task
keeps of a document its length and its counts of terms that the index holds, packed in pages. When
document frequencies and lengths are known, the pages stream through the index, and each task keeps
the DEPTH best documents of every item in a bounded heap; the heaps of all tasks are merged.

An item's terms are taken from the dearest down until those that are left cannot lift a document to
the item's current last place; only documents with one of the former are scored for the item, all
of whose terms then count. So the result is exact, and the work for an item falls as its heap fills.

The index is broadcast in slices of about SLICE_BYTES of item text: items are dealt by hash, the
size of every slice is checked, and each slice has a pass of its own over the documents, so what is
broadcast does not grow with the items (one longer item is a slice of its own).

Terms are the maximal runs of letters and digits of ASCII and of all other characters beyond ASCII;
only A-Z are lower-cased. Scores are 64-bit whole numbers but for a term's weight.

Defined cases: a null or empty text has no terms; a document without terms counts nowhere; rows
that repeat a doc_id, and a null doc_id, are documents of their own, null before all others in ties;
rows that repeat an item_id (null too) are one item with the terms of all; an item whose terms no
document holds has no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.llm.common import NO_ID, documents, id_and_text, materialise

#: Documents to return for an item, and bytes of item text in a slice of the index.
DEPTH, SLICE_BYTES = 10, 8 << 20
#: Terms looked up at once, bytes of packed pages for a task, and a score's largest factor beside the weight.
LOOKUPS, TASK_BYTES, FULL = 1 << 20, 32 << 20, 1_000_000

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
PAGE = "ids binary, lengths binary, counts binary, terms binary, times binary, n_docs long, n_terms long"


def terms(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


class Index:
    """The terms of a slice of items: for each term the items that hold it and how often, and for each item its terms."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]):
        self.item_ids = [item_id for item_id, _ in items]
        self.number: dict[bytes, int] = {}
        rows = [np.array([self.number.setdefault(t, len(self.number)) for t in found], np.int64) for _, found in items]
        distinct = [np.unique(x, return_counts=True) for x in rows]
        none = [np.empty(0, np.int64)]
        self.terms = np.concatenate([*none, *[x for x, _ in distinct]])
        self.times = np.concatenate([*none, *[x for _, x in distinct]])
        sizes = np.array([len(x) for x, _ in distinct], np.int64)
        self.items = np.repeat(np.arange(len(items)), sizes)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])

    def weigh(self, weights: np.ndarray) -> None:
        """Sorts the entries of each item by the most that they can add, from the least, and sums these up."""
        self.weights = weights
        most = weights[self.terms] * self.times * FULL
        order = np.lexsort((most, self.items))
        self.terms, self.times = self.terms[order], self.times[order]
        total = np.cumsum(most[order])
        before = np.concatenate([[0], total])[self.begin[:-1]]
        self.reach = total - np.repeat(before, np.diff(self.begin))


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, n: int, depth: int):
        self.depth, self.n = depth, n
        self.item, self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.ones(n, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least[item]
        item, score, doc = (np.concatenate([a, b[good]]) for a, b in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.depth
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full = place == self.depth - 1
        self.least[item[full]] = score[full]


def _ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... (n of them) of each, one after another."""
    ends = np.cumsum(n)
    return np.repeat(first - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def search_page(index: Index, heaps: Heaps, ids: np.ndarray, lengths: np.ndarray, counts: np.ndarray, found: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int) -> int:
    """Scores the documents of a page for the items that they can still matter to; the number of pairs scored."""
    norms = np.array([25 + 75 * int(n) * n_docs // max(n_terms, 1) for n in lengths], np.int64)
    doc = np.repeat(np.arange(len(ids)), counts)
    parts = index.weights[found] * ((1_000_000_000 * times) // (1000 * times + 8 * norms[doc]))
    # the entries of items whose terms so far could already reach the item's last place, by term
    needed = np.flatnonzero(index.reach >= heaps.least[index.items])
    needed = needed[np.argsort(index.terms[needed], kind="stable")]
    by_term = index.terms[needed]
    low, high = np.searchsorted(by_term, found, "left"), np.searchsorted(by_term, found, "right")
    n_items, step, scored = len(index.item_ids), 0, 0
    keys = doc * len(index.weights) + found
    ends = np.cumsum(high - low)
    while step < len(found):
        # some documents at a time, so that few candidates are held
        stop = int(np.searchsorted(ends, (ends[step - 1] if step else 0) + LOOKUPS, "right"))
        stop = max(stop, step + 1)
        if stop < len(found):
            first = int(np.searchsorted(doc, doc[stop]))
            stop = first if first > step else int(np.searchsorted(doc, doc[step], "right"))
        which = np.arange(step, stop)
        pairs = np.unique(np.repeat(doc[which], (high - low)[which]) * n_items + index.items[needed[_ragged(low[which], (high - low)[which])]])
        sizes = np.diff(index.begin)[pairs % n_items]
        at = 0
        cuts = np.cumsum(sizes)
        while at < len(pairs):
            to = max(at + 1, int(np.searchsorted(cuts, (cuts[at - 1] if at else 0) + LOOKUPS, "right")))
            d, i, n = pairs[at:to] // n_items, pairs[at:to] % n_items, sizes[at:to]
            entry = _ragged(index.begin[i], n)
            wanted = np.repeat(d, n) * len(index.weights) + index.terms[entry]
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            added = np.where(keys[place] == wanted, parts[place] * index.times[entry], 0)
            score = np.add.reduceat(added, np.cumsum(n) - n)
            heaps.add(i, score, ids[d])
            at = to
        scored += len(pairs)
        step = stop
    return scored


def _pack(number: dict[bytes, int]):
    """Pages of documents with their counts of the index's terms."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = number.value
        for batch in batches:
            ids, lengths, counts, found, times, n_docs, n_terms = [], [], [], [], [], 0, 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                own = terms(text.as_buffer().to_pybytes())
                if not own:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(own)
                known = np.array([x for x in map(look.get, own) if x is not None], np.int32)
                if len(known):
                    term, n = np.unique(known, return_counts=True)
                    ids.append(NO_ID if doc_id is None else doc_id)
                    lengths.append(len(own))
                    counts.append(len(term))
                    found.append(term)
                    times.append(n.astype(np.int32))
            if n_docs:
                none = [np.empty(0, np.int32)]
                columns = [np.array(ids, "<i8"), np.array(lengths, "<i8"), np.array(counts, "<i4"), np.concatenate([*none, *found]), np.concatenate([*none, *times])]
                yield pa.RecordBatch.from_arrays([*[pa.array([x.tobytes()], pa.binary()) for x in columns], pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=[x.split()[0] for x in PAGE.split(", ")])

    return pack


def _frequencies(n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n, np.int64)
        for batch in batches:
            for x in batch["terms"]:
                held += np.bincount(np.frombuffer(x.as_buffer(), "<i4"), minlength=n)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], names=["term", "df"])

    return count


def _searched(index, depth: int, n_docs: int, n_terms: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        heaps = Heaps(len(own.item_ids), depth)
        for batch in batches:
            for row in batch.select(["ids", "lengths", "counts", "terms", "times"]).to_pylist():
                page = [np.frombuffer(row[c], kind).astype(np.int64) for c, kind in (("ids", "<i8"), ("lengths", "<i8"), ("counts", "<i4"), ("terms", "<i4"), ("times", "<i4"))]
                search_page(own, heaps, *page, n_docs, n_terms)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (heaps.item, heaps.doc, heaps.score)], names=["item", "doc_id", "score"])

    return search


def _slices(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items, with their terms, in slices whose size is checked before they come to the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = F.sum(F.octet_length("text") + 16).alias("size")
    n = max(1, math.ceil((rows.agg(size).first()[0] or 0) / SLICE_BYTES))
    while True:
        dealt = rows.withColumn("slice", F.pmod(F.xxhash64("item_id"), F.lit(n)))
        too_large = dealt.groupBy("slice").agg(size, F.count_distinct("item_id").alias("ids")).where((F.col("size") > 2 * SLICE_BYTES) & (F.col("ids") > 1))
        if too_large.isEmpty():
            break
        n *= 2
    for k in range(n):
        found: dict[int | None, list[bytes]] = {}
        for row in dealt.where(F.col("slice") == k).select("item_id", "text").toLocalIterator():
            found.setdefault(row.item_id, []).extend(terms(row.text.encode()))
        if held := {k: v for k, v in found.items() if v}:
            yield list(held.items())


def search(docs: DataFrame, items: DataFrame, depth: int = DEPTH) -> DataFrame:
    """item_id, rank, doc_id and score of the ``depth`` best documents of each item."""
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = id_and_text(docs)
    results = [spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")]
    for part in _slices(items):
        index = Index(part)
        pages = materialise(texts.mapInArrow(_pack(context.broadcast(index.number)), PAGE), large_rows=True)
        n_docs, n_terms, size = (x or 0 for x in pages.agg(F.sum("n_docs"), F.sum("n_terms"), F.sum(F.length("terms") + F.length("times"))).first())
        counted = pages.select("terms").mapInArrow(_frequencies(len(index.number)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = np.zeros(len(index.number), np.int64)
        for row in counted.toLocalIterator():  # no more rows than terms of the slice
            df[row.term] = row.df
        index.weigh(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64))
        index.number = {}
        tasks = max(context.defaultParallelism, math.ceil(size / TASK_BYTES))
        best = pages.coalesce(tasks).mapInArrow(_searched(context.broadcast(index), depth, n_docs, n_terms), "item long, doc_id long, score long")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        merged = best.select("*", place.cast("int").alias("rank")).where(F.col("rank") <= depth)
        names = F.broadcast(spark.createDataFrame(list(enumerate(index.item_ids)), "item long, item_id long"))  # a row for each item of the slice
        results.append(merged.join(names, "item").select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
    return functools.reduce(DataFrame.union, results)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
lengths AS (SELECT rid, doc_id, count(*) AS n FROM words GROUP BY rid, doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(n) AS BIGINT) AS L FROM lengths),
counts AS (SELECT rid, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY rid, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, N),
scored AS (
  SELECT a.item_id, c.rid, l.doc_id, CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * l.n * t.N) // t.L)))) AS BIGINT) AS score
  FROM counts c JOIN lengths l USING (rid) JOIN weights w USING (term) JOIN asked a USING (term), totals t
  GROUP BY a.item_id, c.rid, l.doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
