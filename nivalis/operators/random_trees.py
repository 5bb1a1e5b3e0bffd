"""Extremely randomised trees, grown level by level in Spark.

Every tree sees all rows. At each node some features are drawn, and for each one a threshold,
uniformly between the smallest and the largest value that the node's rows have; the split whose two
sides vary least is taken. Nothing is sorted or binned, so a level is two aggregations: the ranges of
the features by (tree, node), and the sums on both sides of the drawn thresholds. Rows whose features
are alike go the same way in every tree, so they are first put together with their sums of weight,
label and squares; a level then costs what the distinct rows cost. These stay where they are; each
task finds the node of each of its rows, sums by node, and sends only the sums.

The driver holds the trees and, for a slice of the open nodes at a time, their sums: at most
SLICE_NODES nodes. A level with more open nodes takes several passes.

Draws come from a generator seeded with (seed, tree, node), so a fit does not depend on partitions;
sums of floating-point numbers may differ in their last digits between runs, as the order of tasks
does. Rows with a null or NaN label, feature or weight, and rows with no weight, take no part.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.operators.lineage import checkpointed

#: Open nodes, over all trees, whose sums are held at once.
SLICE_NODES = 20_000

#: Distinct rows whose predictions a task remembers.
REMEMBERED = 100_000


@dataclass
class Tree:
    """Arrays by node: the feature and threshold of its split and its children (-1: a leaf), and the mean of its rows."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, depth: int) -> int:
        for name, x in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", value), ("depth", depth), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def packed(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right), np.array(self.value)


def node_of(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The node that each row of x has come to: a value up to the threshold goes left."""
    feature, threshold, left, right, _ = tree
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return at
        node = at[inner]
        at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])


def drawn(seed: int, tree: int, node: int, low: np.ndarray, high: np.ndarray, tried: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``tried`` features that vary in a node, and a threshold for each, from low (taken) to high (not)."""
    varying = np.flatnonzero(high > low)
    rng = np.random.default_rng([seed, tree, node])
    features = rng.permutation(varying)[:tried]
    share = rng.random(len(features))
    # a sum of two parts: high - low may overflow; rounding must not reach high
    thresholds = low[features] * (1 - share) + high[features] * share
    return features, np.minimum(np.maximum(thresholds, low[features]), np.nextafter(high[features], -np.inf))


def _mean(trees: Sequence[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """The mean of the trees' values for each row; NaN where a feature is."""
    total = np.zeros(len(x))
    for tree in trees:
        total += tree[4][node_of(tree, x)]
    return np.where(np.isnan(x).any(axis=1), np.nan, total / len(trees))


@dataclass
class Forest:
    features: list[str]
    trees: list[Tree]

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """df with the mean of the trees' values; null where a feature is null."""
        broadcast = df.sparkSession.sparkContext.broadcast([t.packed() for t in self.trees])

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            known: dict[bytes, float] = {}
            for rows in batches:
                x = np.ascontiguousarray(rows.to_numpy(float))
                named = x.view(f"V{x.itemsize * x.shape[1]}").ravel().tolist()
                if len(known) > REMEMBERED:
                    known = {}
                new = list(dict.fromkeys(k for k in named if k not in known))
                if new:
                    known.update(zip(new, _mean(broadcast.value, np.frombuffer(b"".join(new)).reshape(len(new), -1)).tolist(), strict=True))
                yield pd.Series([known[k] for k in named], dtype=float)

        return df.withColumn(name, F.nanvl(score(F.struct(*[F.col(c).cast("double") for c in self.features])), F.lit(None)))

    def importances(self) -> np.ndarray:
        """The share of each feature in what the splits took from the variance, averaged over the trees."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            own = np.bincount([f for f in tree.feature if f >= 0], [g for f, g in zip(tree.feature, tree.gain, strict=True) if f >= 0], len(self.features))
            total += own / own.sum() if own.sum() > 0 else 0
        return total / total.sum() if total.sum() > 0 else total

    def nodes(self, spark) -> DataFrame:
        """tree, node, depth, feature, threshold, left, right and value: the trees as a table."""
        rows = [
            (i, n, t.depth[n], self.features[f] if f >= 0 else None, t.threshold[n] if f >= 0 else None, t.left[n] if f >= 0 else None, t.right[n] if f >= 0 else None, t.value[n])
            for i, t in enumerate(self.trees)
            for n, f in enumerate(t.feature)
        ]
        return spark.createDataFrame(rows, "tree int, node int, depth int, feature string, threshold double, left int, right int, value double")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """The features, and the sums of weight, label and squares."""
    columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
    return np.column_stack(columns[3:]), columns[:3]


def _ranges(trees, open_nodes: dict[int, np.ndarray], n_features: int):
    """The ranges of all features in the open nodes, and the sums of weight, label and squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: [np.full((len(n), n_features), np.inf), np.full((len(n), n_features), -np.inf), np.zeros((len(n), 3))] for t, n in open_nodes.items()}
        for batch in batches:
            x, own_sums = _arrays(batch)
            for t, (low, high, sums) in held.items():
                place, own = _placed(trees.value[t], open_nodes[t], x)
                if not len(own):
                    continue
                order = np.argsort(place, kind="stable")
                first = np.flatnonzero(np.diff(place[order], prepend=-1))
                nodes, values = place[order][first], x[own[order]]
                low[nodes] = np.minimum(low[nodes], np.minimum.reduceat(values, first, axis=0))
                high[nodes] = np.maximum(high[nodes], np.maximum.reduceat(values, first, axis=0))
                for k, v in enumerate(own_sums):
                    sums[:, k] += np.bincount(place, v[own], len(low))
        for t, (low, high, sums) in held.items():
            met = np.flatnonzero(sums[:, 0] > 0)
            if len(met):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(met), t), pa.int32()), pa.array(open_nodes[t][met], pa.int32()), *[pa.array(list(a[met]), pa.list_(pa.float64())) for a in (low, -high)], *[pa.array(sums[met, k]) for k in range(3)]],
                    names=["tree", "node", "low", "high", "w", "wy", "wyy"],
                )

    return run


def _placed(tree: tuple[np.ndarray, ...], nodes: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place among ``nodes`` of each row that is in one of them, and which rows these are."""
    at = node_of(tree, x)
    place = np.searchsorted(nodes, at)
    own = np.flatnonzero((place < len(nodes)) & (nodes[np.minimum(place, len(nodes) - 1)] == at))
    return place[own], own


def _sides(trees, splits: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """The sums left of each drawn threshold: by tree, (nodes, features, thresholds) with a row for each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: np.zeros((*f.shape, 3)) for t, (_, f, _) in splits.items()}
        for batch in batches:
            x, own_sums = _arrays(batch)
            for t, (nodes, features, thresholds) in splits.items():
                place, own = _placed(trees.value[t], nodes, x)
                for k in range(features.shape[1]):
                    left = x[own, features[place, k]] <= thresholds[place, k]
                    p, rows = place[left], own[left]
                    for j, v in enumerate(own_sums):
                        held[t][:, k, j] += np.bincount(p, v[rows], len(nodes))
        for t, (nodes, features, _) in splits.items():
            met = np.flatnonzero(held[t][:, :, 0].sum(axis=1) > 0)
            if len(met):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(met), t), pa.int32()), pa.array(nodes[met], pa.int32()), pa.array(list(held[t][met].reshape(len(met), -1)), pa.list_(pa.float64()))],
                    names=["tree", "node", "sums"],
                )

    return run


def _by_place(column: str, n: int, how) -> Column:
    """An aggregate of each place of arrays of n numbers."""
    return F.array(*[how(F.col(column)[i]) for i in range(n)]).alias(column)


def _spread(w: np.ndarray, wy: np.ndarray, wyy: np.ndarray) -> np.ndarray:
    """The sum of squared distances from the mean."""
    return np.maximum(wyy - np.divide(wy * wy, w, out=np.zeros_like(wy), where=w > 0), 0)


def fit(train: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 10, tried: int | None = None, min_rows: float = 2, weight: str | None = None, seed: int = 42) -> Forest:
    """Trees of at most ``depth`` splits, with ``tried`` features (default: a third, one at least) drawn at each; a node of less weight than ``min_rows`` is a leaf."""
    features, spark = list(features), train.sparkSession
    tried = tried or max(1, len(features) // 3)
    number = lambda c: F.col(c).cast("double")
    rows = train.select(number(label).alias("__y"), (number(weight) if weight else F.lit(1.0)).alias("__w"), *[number(c).alias(f"__x{i}") for i, c in enumerate(features)])
    good = [F.col(c).isNotNull() & ~F.isnan(c) for c in rows.columns]
    rows = checkpointed(_alike(rows.where(good[0]).where(good[1]).where(F.col("__w") > 0).where(_all(good[2:])), len(features)))
    forest = [Tree() for _ in range(trees)]
    for tree in forest:
        tree.add(0.0, 0)
    still = [(t, 0) for t in range(trees)]
    while still:
        following: list[tuple[int, int]] = []
        for at in range(0, len(still), SLICE_NODES):
            following += _grow(spark, rows, forest, still[at : at + SLICE_NODES], len(features), tried, depth, min_rows, seed)
        still = following
    return Forest(features, forest)


def _alike(rows: DataFrame, n_features: int) -> DataFrame:
    """One row for all with the same features: the sums of weight, label and squares, and the features (0.0 and -0.0 are alike)."""
    w, y = F.col("__w"), F.col("__y")
    sums = [F.sum(v).alias(n) for n, v in (("__sw", w), ("__swy", w * y), ("__swyy", w * y * y))]
    names = [f"__x{i}" for i in range(n_features)]
    return rows.groupBy(*names).agg(*sums).select("__sw", "__swy", "__swyy", *names)


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _grow(spark, rows: DataFrame, forest: list[Tree], nodes: list[tuple[int, int]], n_features: int, tried: int, depth: int, min_rows: float, seed: int) -> list[tuple[int, int]]:
    """Gives these nodes their values and splits; the children that are to be grown next."""
    by_tree: dict[int, np.ndarray] = {}
    for t, n in nodes:
        by_tree.setdefault(t, []).append(n)
    by_tree = {t: np.array(sorted(n), np.int64) for t, n in by_tree.items()}
    trees = spark.sparkContext.broadcast({t: forest[t].packed() for t in by_tree})
    partial = rows.mapInArrow(_ranges(trees, by_tree, n_features), "tree int, node int, low array<double>, high array<double>, w double, wy double, wyy double")
    found = partial.groupBy("tree", "node").agg(_by_place("low", n_features, F.min), _by_place("high", n_features, F.min), *[F.sum(c).alias(c) for c in ("w", "wy", "wyy")])
    known, splits = {}, {}
    for r in found.toLocalIterator():
        low, high, sums = np.array(r.low), -np.array(r.high), np.array([r.w, r.wy, r.wyy])
        tree = forest[r.tree]
        tree.value[r.node] = float(r.wy / r.w)
        spread = float(_spread(*sums[:, None])[0])
        if tree.depth[r.node] < depth and r.w >= min_rows and spread > 1e-12 * max(r.wyy, 1e-300):
            chosen, thresholds = drawn(seed, r.tree, r.node, low, high, tried)
            if len(chosen):
                known[r.tree, r.node] = sums, spread
                splits.setdefault(r.tree, []).append((r.node, chosen, thresholds))
    if not splits:
        trees.unpersist()
        return []
    # nodes where fewer features vary repeat their first draw
    padded = lambda a: np.concatenate([a, np.repeat(a[:1], tried - len(a))])
    dealt = {t: tuple(map(np.array, zip(*[(n, padded(f), padded(x)) for n, f, x in sorted(s, key=lambda v: v[0])], strict=True))) for t, s in splits.items()}
    partial = rows.mapInArrow(_sides(trees, dealt), "tree int, node int, sums array<double>")
    found = partial.groupBy("tree", "node").agg(_by_place("sums", 3 * tried, F.sum))
    following = []
    for r in sorted(found.toLocalIterator(), key=lambda r: (r.tree, r.node)):
        sums, spread = known[r.tree, r.node]
        left = np.array(r.sums).reshape(tried, 3)
        right = sums - left
        gain = spread - _spread(*left.T) - _spread(*right.T)
        gain[(left[:, 0] <= 0) | (right[:, 0] <= 0)] = -np.inf
        best = int(np.argmax(gain))
        if not np.isfinite(gain[best]):
            continue
        _, chosen, thresholds = (x[np.searchsorted(dealt[r.tree][0], r.node)] for x in dealt[r.tree])
        tree = forest[r.tree]
        tree.feature[r.node], tree.threshold[r.node], tree.gain[r.node] = int(chosen[best]), float(thresholds[best]), float(max(gain[best], 0))
        for name, side in (("left", left[best]), ("right", right[best])):
            child = tree.add(float(side[1] / side[0]), tree.depth[r.node] + 1)
            getattr(tree, name)[r.node] = child
            if tree.depth[child] < depth and side[0] >= min_rows:
                following.append((r.tree, child))
    trees.unpersist()
    return following
