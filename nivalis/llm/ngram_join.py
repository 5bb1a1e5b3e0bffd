"""Join of documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

1. One pass over the texts makes 160 MinHash values of each set. Documents with equal sets are
   one class and go on as one.
2. Classes that agree in one of 32 bands of 5 values are candidates (a pair at 0.8 is missed
   with probability 3e-6). A pair belongs to the first band in which it agrees and is met there
   only. Its MinHash values are compared 16 at a time, one byte of each; it is dropped once the
   posterior probability that its similarity reaches the threshold is under TOLERANCE (Bayes,
   flat prior).
3. Each pair that is left is verified exactly, once, on its sets of 5-grams, among the members of
   its band value that have such pairs. Links are counted there, weighted by copies; of a group's
   links only spanning edges leave, never all its pairs. Their components are the classes of the
   result.

A band value of many members is cut into blocks of 256, and each pair of blocks is a task of its
own, so no group is ever in one task. A long chain of documents, each like the next, costs what
its links cost: nothing is compared across band values.

Defined cases: a text with one to four words has one gram of them all; a text without words
links to nothing; a null text is empty; a null id sorts before all others; rows that repeat an
id are separate documents; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm.common import NO_ID, documents, id_and_text, materialise
from nivalis.llm.components import components
from nivalis.llm.words import mix, window_hashes, word_hashes

GRAM, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, STEP = 32, 5, 16
BLOCK = 256
#: Pairs compared at once.
PAIRS = 1 << 16

_rng = np.random.default_rng(11)
_A = (_rng.integers(0, 2**31, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint64).astype(np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def gram_set(text: bytes | memoryview, n: int = GRAM) -> np.ndarray:
    """The sorted distinct hashes of the word n-grams of a text."""
    words = word_hashes(text)
    return np.unique(window_hashes(words, min(n, len(words)))) if len(words) else np.empty(0, np.uint64)


def minhash(grams: np.ndarray) -> np.ndarray:
    low = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, np.uint32(2**32 - 1))
    for at in range(0, len(low), 8192):
        out = np.minimum(out, (_A * low[None, at : at + 8192] + _B).min(axis=1))
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = _BAND.copy()
    for i in range(ROWS):
        keys = mix(keys + values[i::ROWS])
    return keys


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For STEP, 2 * STEP, ... values compared: with fewer matches a pair is dropped."""
    similarity = (np.arange(4000) + 0.5) / 4000
    match = similarity + (1 - similarity) / 256  # one byte of different values may agree
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match)
            weight = np.exp(log - log.max())
            if weight[similarity >= threshold].sum() >= tolerance * weight.sum():
                break
        out.append(m)
    return np.array(out)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n is connected to by the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 2000):
            rows = batch.slice(part, 2000)
            name, count, values, keys = [], [], [], []
            for text in rows["text"]:
                grams = gram_set(text.as_buffer())
                own = minhash(grams)
                name.append(int(mix(grams).sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0)
                count.append(len(grams))
                values.append(own.astype(np.uint8).tobytes())
                keys.append(band_keys(own).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["tie"], pa.array(name, pa.int64()), pa.array(count, pa.int32()), pa.array(values, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "tie", "name", "grams", "minhash", "bands"],
            )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal keys, from batches sorted by them."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for key in keys:
            values = table[key].to_numpy()
            change |= values[1:] != values[:-1]
        at = 0
        for end in (np.flatnonzero(change) + 1).tolist():
            yield table.slice(at, end - at)
            at = end
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def _survivors(group: pa.Table, fewest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a group that this band is the first to bring together and that stay likely."""
    n, band = group.num_rows, group["band"][0].as_py()
    cross, own = group["i"][0].as_py() != group["j"][0].as_py(), group["own"].to_numpy()
    values = np.frombuffer(b"".join(group["minhash"].to_pylist()), np.uint8).reshape(n, -1)
    bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    every, found = np.triu_indices(n, 1), []
    for at in range(0, len(every[0]), PAIRS):
        left, right = (x[at : at + PAIRS] for x in every)
        if cross:
            apart = own[left] != own[right]
            left, right = left[apart], right[apart]
        for earlier in range(band):
            if len(left):
                new = bands[left, earlier] != bands[right, earlier]
                left, right = left[new], right[new]
        matches = np.zeros(len(left), np.int64)
        for step, least in enumerate(fewest):
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (values[left, part] == values[right, part]).sum(axis=1)
            stay = matches >= least
            if not stay.all():
                left, right, matches = left[stay], right[stay], matches[stay]
        found.append((left, right))
    left, right = zip(*found, strict=True)
    return np.concatenate(left), np.concatenate(right)


def _likely(fewest: np.ndarray):
    """The members of each band value that have pairs to be verified."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["key", "i", "j"]):
            left, right = _survivors(group, fewest)
            if len(left):
                yield from group.select(["key", "i", "j", "own", "band", "name"]).take(np.union1d(left, right)).combine_chunks().to_batches()

    return search


def _in_blocks(rows: DataFrame, size: str, name: str) -> DataFrame:
    """rows dealt to the pairs (i, j) of blocks of their group; own is the row's block."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(name), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    return rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each pair of sorted sets reaches the threshold."""
    out = np.zeros(len(left), bool)
    order = np.argsort(left, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(left[order])) + 1) if len(left) else []:
        one = sets[left[own[0]]]
        for part in np.split(own, range(64, len(own), 64)):
            others = [sets[k] for k in right[part]]
            sizes, flat = np.array([len(x) for x in others]), np.concatenate(others)
            at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
            common = np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            out[part] = common >= THRESHOLD * (len(one) + sizes - common)
    return out


def _verified(fewest: np.ndarray):
    """For the members of a band value: (a, null, links of a by copies), and spanning edges (a, b, 0)."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for group in _groups(batches, ["key", "i", "j"]):
            left, right = _survivors(group, fewest)
            sets = [gram_set(expand.decompress(x.as_buffer(), max_output_size=n)) for x, n in zip(group["data"], group["size"].to_pylist(), strict=True)]
            linked = _linked(sets, left, right)
            left, right = left[linked], right[linked]
            if not len(left):
                continue
            names, copies = group["name"].to_numpy(), group["copies"].to_numpy()
            links = np.zeros(len(names), np.int64)
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            root, some = _roots(len(names), left, right), np.flatnonzero(links)
            moved = np.flatnonzero(root != np.arange(len(root)))
            a, links = np.concatenate([names[some], names[moved]]), np.concatenate([links[some], np.zeros(len(moved), np.int64)])
            b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(names[root[moved]], pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(links, pa.int64())], names=["a", "b", "links"])

    return verify


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw = [x.as_buffer() for x in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["tie"], pa.array([x.size for x in raw], pa.int32()), pa.array([squeeze.compress(x) for x in raw], pa.binary())],
            names=["doc_id", "tie", "size", "data"],
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, tie (a hash of the text), class_id, n_links, and first (whether the row stands for its class).

    class_id is the smallest doc_id among all documents connected by links; n_links counts the
    other documents at the threshold or above, copies included.
    """
    texts = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    signed = materialise(texts.mapInArrow(_signatures, "doc_id long, tie long, name long, grams int, minhash binary, bands array<long>"))
    classes = signed.where("grams > 0").groupBy("name").agg(
        F.min(F.struct("doc_id", "tie")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("minhash").alias("minhash"), F.any_value("bands").alias("bands")
    )
    classes = materialise(classes)

    fewest = fewest_matches()
    unit = ["key", "i", "j"]
    rows = classes.select("name", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = rows.join(shared, "key").join(classes.select("name", "minhash", "bands"), "name")
    rows = _in_blocks(rows, "members", "name").select(*unit, "own", "band", "name", "minhash", "bands")
    rows = rows.repartition(*unit).sortWithinPartitions(*unit)
    likely = materialise(rows.mapInArrow(_likely(fewest), "key long, i int, j int, own int, band int, name long"))

    asked = classes.join(likely.select("name").distinct(), "name").select("name", "copies", "minhash", "bands", F.coalesce("rep.doc_id", F.lit(NO_ID)).alias("doc_id"), "rep.tie")
    packed = texts.mapInArrow(_packed, "doc_id long, tie long, size int, data binary").withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    asked = asked.join(packed, ["doc_id", "tie"]).groupBy("name").agg(*[F.any_value(c).alias(c) for c in ("copies", "minhash", "bands", "size", "data")])
    rows = likely.join(asked, "name").repartition(*unit).sortWithinPartitions(*unit)
    found = materialise(rows.mapInArrow(_verified(fewest), "a long, b long, links long"))

    labels = components(found.where("a != b").select("a", "b")).select(F.col("node").alias("name"), "label")
    links = found.groupBy(F.col("a").alias("name")).agg(F.sum("links").alias("links"))
    named = classes.select("name", "rep", "copies").join(labels, "name", "left").join(links, "name", "left")
    named = named.withColumn("label", F.coalesce("label", "name"))
    heads = named.groupBy("label").agg(F.min("rep").alias("head"))
    named = named.join(heads, "label").select("name", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = signed.select("doc_id", "tie", F.when(F.col("grams") > 0, F.col("name")).alias("name")).join(named, "name", "left")
    alone = F.col("n_links").isNull()
    return out.select(
        "doc_id",
        "tie",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("tie") == F.col("head.tie")))).alias("first"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that stand for their class, all columns kept; of equal rows one stays."""
    kept = near_duplicates(docs).where("first").groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n"))
    kept = materialise(kept)
    names = docs.columns
    rows = docs.select(F.col("doc_id").cast("long").alias("k"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t"), F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row"))
    rows = rows.join(kept, rows["k"].eqNullSafe(kept["doc_id"]) & (rows["t"] == kept["tie"]), "left_semi")
    if not kept.where("n > 1").limit(1).isEmpty():
        rows = rows.dropDuplicates(["k", "t"])
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


OP9_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
g as (
  select distinct doc_id, unnest(case when len(ws) < 5 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as gram
  from w where len(ws) > 0),
n as (select doc_id, count(*) as n from g group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as common from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where common >= 0.8e0 * (x.n + y.n - common)),
reach as (
  select a, b from links
  union
  select reach.a, links.b from reach join links on reach.b = links.a)
select d.doc_id, least(d.doc_id, coalesce((select min(b) from reach where a = d.doc_id), d.doc_id)) as class_id,
       (select count(*) from links where a = d.doc_id) as n_links
from documents d
"""
