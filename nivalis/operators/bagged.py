"""Random forests on tables whose rows have few distinct features.

Rows whose features are alike go the same way in every tree, and how their labels vary among
themselves takes the same part of the variance on both sides of any split. So a tree of Spark ML is the
same whether it gets a bootstrap sample of the rows, or the sample's weight and mean label for each
distinct row of features. One pass draws how often each row is in the sample of each tree (Poisson, as
Spark ML draws it) and sums by distinct features; the trees then grow on these sums, whose size
follows the distinct rows. Draws depend on the partitions of the rows, as in Spark ML. A row may also
stand for several that are alike in their label too: their draws add up to one with the sum of the means.
"""

from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.operators.lineage import checkpointed

#: Smaller tables, and those with more distinct rows of features than one in so many, are fitted row by row.
LEAST_ROWS, ALIKE = 1_000_000, 8

#: Distinct rows of features whose sums a task holds at once.
HELD = 20_000

#: Trees that grow at the same time.
PARALLEL = 4


def suits(train: DataFrame, features: Sequence[str], regressor) -> bool:
    """Whether the regressor is a bootstrapped forest, and the rows are many and mostly alike."""
    if not isinstance(regressor, RandomForestRegressor) or not regressor.getBootstrap() or regressor.getNumTrees() < 2 or regressor.getMinInstancesPerNode() > 1:
        return False
    rows, kinds = train.agg(F.count(F.lit(1)), F.approx_count_distinct(F.struct(*features), 0.02)).first()
    return rows >= LEAST_ROWS and kinds * ALIKE <= rows


def _drawn(n_features: int, trees: int, rate: float, seed: int):
    """The weight and the weighted label of each tree's sample, by distinct features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        places: dict[bytes, int] = {}
        sums = np.zeros((2, trees, HELD))

        def held() -> pa.RecordBatch:
            x = np.frombuffer(b"".join(places)).reshape(len(places), n_features)
            lists = [pa.ListArray.from_arrays(np.arange(len(places) + 1, dtype=np.int32) * trees, pa.array(s[:, : len(places)].T.ravel())) for s in sums]
            return pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], *lists], names=[*[f"__x{i}" for i in range(n_features)], "__w", "__wy"])

        for whole in batches:
            for batch in (whole.slice(i, HELD // 2) for i in range(0, whole.num_rows, HELD // 2)):
                if len(places) > HELD // 2:
                    yield held()
                    places.clear()
                    sums[:] = 0
                y, w, n, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                named = np.column_stack(x).view(f"V{8 * n_features}").ravel().tolist()
                at = np.array([places.setdefault(k, len(places)) for k in named])
                for t in range(trees):
                    weight = rng.poisson(rate * n) * w
                    sums[0, t, : len(places)] += np.bincount(at, weight, len(places))
                    sums[1, t, : len(places)] += np.bincount(at, weight * y, len(places))
        if places:
            yield held()

    return run


def samples(train: DataFrame, features: Sequence[str], label: str, trees: int, weight: str | None = None, rate: float = 1.0, seed: int = 42, count: str | None = None) -> DataFrame:
    """__x0.. (the distinct features), and __w and __wy: for each tree the weight of its sample there, and the weighted sum of its labels. Rows with a null or NaN feature take no part. ``count``: how many rows each stands for, of the same weight."""
    number = lambda c: F.col(c).cast("double")
    number_or_one = lambda c: number(c) if c else F.lit(1.0)
    good = F.lit(True)
    for c in features:
        good = good & F.col(c).isNotNull() & ~F.isnan(number(c))
    names = [f"__x{i}" for i in range(len(features))]
    # 0.0 is added so that -0.0 and 0.0 are alike
    rows = train.where(good).select(number(label).alias("__y"), number_or_one(weight).alias("__w"), number_or_one(count).alias("__n"), *[(number(c) + F.lit(0.0)).alias(n) for c, n in zip(features, names, strict=True)])
    drawn = rows.mapInArrow(_drawn(len(features), trees, rate, seed), ", ".join([*[f"{n} double" for n in names], "__w array<double>", "__wy array<double>"]))
    total = lambda c: F.array(*[F.sum(F.col(c)[t]) for t in range(trees)]).alias(c)
    return drawn.groupBy(*names).agg(total("__w"), total("__wy"))


def fit(train: DataFrame, features: Sequence[str], regressor: RandomForestRegressor, count: str | None = None) -> PipelineModel:
    """The regressor's forest, a stage for each tree and one for their mean; ``count`` as in ``samples``."""
    trees, label, prediction = regressor.getNumTrees(), regressor.getLabelCol(), regressor.getPredictionCol()
    weight = regressor.getWeightCol() if regressor.isSet("weightCol") else None
    cells = checkpointed(samples(train, features, label, trees, weight, regressor.getSubsamplingRate(), regressor.getSeed(), count))
    assembler = VectorAssembler(inputCols=list(features), outputCol=regressor.getFeaturesCol(), handleInvalid="skip")
    strategy = regressor.getFeatureSubsetStrategy()
    settings = {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "weightCol": "__weight", "featureSubsetStrategy": "onethird" if strategy == "auto" else strategy}

    def grown(t: int) -> RandomForestRegressionModel:
        w: Column = F.col("__w")[t]
        rows = cells.where(w > 0).select(*[F.col(f"__x{i}").alias(c) for i, c in enumerate(features)], (F.col("__wy")[t] / w).alias(label), w.alias("__weight"))
        own = settings | {"seed": regressor.getSeed() + t, "predictionCol": f"__tree{t}"}
        return regressor.copy({regressor.getParam(k): v for k, v in own.items()}).fit(assembler.transform(rows))

    with ThreadPool(PARALLEL) as pool:
        grown_trees = pool.map(inheritable_thread_target(train.sparkSession)(grown), range(trees))
    names = [f"__tree{t}" for t in range(trees)]
    mean = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), ({' + '.join(names)}) / {trees} AS {prediction} FROM __THIS__")
    return PipelineModel([assembler, *grown_trees, mean])
