"""Quality rules: statistics of each text, fixed limits, and an isolation forest on the statistics.

The forest is fitted on statistics of documents labelled good: each tree splits a few hundred of
them at random values of random statistics, within the range that labelled rows of either kind
span, and a text that such splits separate after few steps is an anomaly. The score above which a
text is rejected is calibrated on labelled rows: FALSE_REJECTS of the good ones lie above it.

Fitting reads a sample of at most SAMPLE labelled rows (those with the smallest hash of the id);
statistics, limits and verdicts cover every document and its whole text.

Defined cases: a null text has no words and fails; without usable labels only the fixed limits
decide; an id that is null or repeated is no obstacle, each row gets its own result; other
columns are ignored, and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.llm.common import bounded_batches, documents, labels, one_text_each
from nivalis.llm.words import slice_hashes, window_hashes, word_bounds

SAMPLE, TREES, TREE_ROWS, FALSE_REJECTS = 20_000, 200, 512, 0.003
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8

_SYMBOL, _UPPER, _SPACE = (np.isin(np.arange(256), list(x)) for x in (b"#*$%&|<>", range(65, 91), b"\t\n\x0b\x0c\r "))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = 7


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The COUNTS of a text, and its features for the forest."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_bounds(data)
    n = len(start)
    chars = int(((data & 0xC0) != 0x80).sum()) - int(_SPACE[data].sum())
    symbols = int(_SYMBOL[data].sum())
    lines = Counter(line for line in text.split(b"\n") if line.strip(b"\t\n\x0b\x0c\r "))
    n_lines = sum(lines.values())
    words = slice_hashes(data, start, end)
    windows = window_hashes(words, WINDOW)
    repeated = 0
    if len(windows) > 1:
        _, kind, times = np.unique(windows, return_inverse=True, return_counts=True)
        change = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(times[kind] > 1)
        change[at] += 1
        change[at + WINDOW] -= 1
        repeated = int((np.cumsum(change[:n]) > 0).sum())
    counts = [n, chars, symbols, n_lines - len(lines), repeated]
    some_words, length = max(n, 1), end - start
    features = [
        chars / some_words,
        symbols / some_words,
        (n_lines - len(lines)) / max(n_lines, 1),
        repeated / some_words,
        int(_UPPER[data].sum()) / max(chars, 1),
        len(np.unique(words)) / some_words,
        float(length.std() / length.mean()) if n else 0.0,
    ]
    return counts, features


def base_failed(counts: list[int]) -> bool:
    return counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]


def _usual_depth(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random binary tree of n."""
    n = np.maximum(np.asarray(n, float), 2)
    return np.where(n > 2, 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n, 1.0)


@dataclass
class Forest:
    """Trees as arrays (tree, node): the feature split at (-1: a leaf), the value, the left child, and the depth added at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: int
    limit: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, depth in zip(self.feature, self.value, self.left, self.depth, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                split = feature[node]
                inner = split >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(split, 0)] >= value[node]
                node = np.where(inner, left[node] + right, node)
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / _usual_depth(self.rows))


def _tree(x: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator, deepest: int) -> list[tuple]:
    """Random splits of the box low..high, down to single rows of x or none."""
    nodes: list[tuple] = [()]
    todo = [(0, x, low, high, 0)]
    while todo:
        at, part, low, high, depth = todo.pop()
        wide = np.flatnonzero(high > low)
        if depth >= deepest or len(part) < 2 or not len(wide):
            nodes[at] = (-1, 0.0, 0, depth + (float(_usual_depth(len(part))) if len(part) > 1 else 0.0))
            continue
        feature = int(rng.choice(wide))
        value = float(rng.uniform(low[feature], high[feature]))
        right = part[:, feature] >= value
        nodes[at] = (feature, value, len(nodes), 0.0)
        below, above = high.copy(), low.copy()
        below[feature] = above[feature] = value
        todo += [(len(nodes), part[~right], low, below, depth + 1), (len(nodes) + 1, part[right], above, high, depth + 1)]
        nodes += [(), ()]
    return nodes


def fit(x: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS, seed: int = 1) -> Forest | None:
    """Trees that separate good rows within the range of all rows; the limit lets ``false_rejects`` of the good go."""
    own = x[good]
    if len(own) < 2 or good.all():
        return None
    rng = np.random.default_rng(seed)
    rows, low, high = min(TREE_ROWS, len(own)), x.min(axis=0), x.max(axis=0)
    trees = [_tree(own[rng.choice(len(own), rows, replace=False)], low, high, rng, int(np.ceil(np.log2(rows))) + 4) for _ in range(TREES)]
    size = max(map(len, trees))
    padded = [[*t, *[(-1, 0.0, 0, 0.0)] * (size - len(t))] for t in trees]
    columns = [np.array([[node[i] for node in t] for t in padded], kind) for i, kind in enumerate((np.int64, float, np.int64, float))]
    forest = Forest(*columns, rows, np.inf)
    forest.limit = float(np.quantile(forest.scores(own), 1 - false_rejects))
    return forest


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(x.as_buffer().to_pybytes()) for x in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["quality"], pa.array([base_failed(c) for c, _ in found], pa.bool_()), pa.array([f for _, f in found], pa.list_(pa.float64()))],
            names=["quality", "failed", "features"],
        )


def fit_on_labels(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """A forest fitted on at most ``sample`` labelled documents that pass the fixed limits.

    An id counts once, however often it is labelled or comes in docs; one with both labels does not.
    """
    bounded_batches(docs.sparkSession)
    marks = marks.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    marks = marks.agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("other")).where("quality = other")
    marks = marks.select("id", "quality").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = one_text_each(docs, marks).select("quality", "text")
    rows = rows.mapInArrow(_features, "quality int, failed boolean, features array<double>").where("not failed").toPandas()
    if rows.empty:
        return None
    return fit(np.stack(rows["features"].to_list()), rows["quality"].to_numpy() == 1)


def _judged(forest: Forest | None, texts: list[bytes]) -> tuple[list[list[int]], list[bool], np.ndarray, list[bool]]:
    found = [statistics(x) for x in texts]
    failed = [base_failed(c) for c, _ in found]
    scores = forest.scores(np.array([f for _, f in found]).reshape(-1, FEATURES)) if forest else np.zeros(len(found))
    kept = [not f and (forest is None or bool(s <= forest.limit)) for f, s in zip(failed, scores, strict=True)]
    return [c for c, _ in found], failed, scores, kept


def _texts(column: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column]


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, the COUNTS, base_failed, kept and score of each document."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, scores, kept = _judged(forest, _texts(batch["text"]))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(scores)], names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    bounded_batches(docs.sparkSession)
    schema = f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean, score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(report, schema)


def keep_good(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they are."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"))
    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _judged(forest, _texts(batch["row"].field(text).cast(pa.string())))[3]
            yield batch.filter(pa.array(kept, pa.bool_()))

    out = rows.mapInArrow(keep, f"row {rows.schema['row'].dataType.simpleString()}")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, fit_on_labels(docs, labels(spark, sf_dir)))
