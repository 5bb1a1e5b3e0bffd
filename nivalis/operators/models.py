"""Regression with Spark ML: preparation, fitting, evaluation, prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.functions.columns import season
from nivalis.operators import bagged, random_trees
from nivalis.operators.clean import blank_to_null, numeric_only, to_number
from nivalis.operators.lineage import checkpointed, numbered
from nivalis.sources.published import latest_path, publish


def prepare(df: DataFrame, label: str, missing: float = -999.0, day: str | None = None, features: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with '--' and nulls marked, without rows whose label is missing.

    ``day`` adds the season of a date; ``features`` are the columns to keep before the label, in this
    order, of which texts are read as numbers.
    """
    if day:
        df = df.withColumn("season", season(F.col(day)))
    if features:
        texts = {f.name for f in df.schema if f.dataType.typeName() == "string"}
        df = df.select(*[to_number(blank_to_null(F.col(c))).alias(c) if c in texts else F.col(c) for c in features], label)
    return numeric_only(df).na.fill(missing).where(F.col(label) != missing)


def population_scaled(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """name_scaled: distance from the mean in population deviations (0 where there is no spread)."""
    stats = df.agg(*[F.avg(c).alias(f"{c}_m") for c in names], *[F.stddev_pop(c).alias(f"{c}_s") for c in names])
    out = df.join(F.broadcast(stats))
    return out.withColumns({f"{c}_scaled": F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}_m"), F.col(f"{c}_s")), F.lit(0.0)) for c in names}).drop(*stats.columns)


def _pipeline(features: Sequence[str], stages: Sequence, scale: bool = False) -> Pipeline:
    first = [VectorAssembler(inputCols=list(features), outputCol="raw" if scale else "features", handleInvalid="skip")]
    if scale:
        first.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True))
    return Pipeline(stages=[*first, *stages])


def forest(label: str, trees: int = 25, depth: int = 15, **more) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=42, **more)


def fit(train: DataFrame, features: Sequence[str], regressor, scale: bool = False) -> PipelineModel:
    """A fitted pipeline; a forest on many rows that are mostly alike grows on their sums."""
    if not scale and bagged.suits(train, features, regressor):
        return bagged.fit(train, features, regressor)
    return _pipeline(features, [regressor], scale).fit(train)


def linear(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features")


def balanced_weights(df: DataFrame, value: Column) -> DataFrame:
    """weight = rows / (distinct values * rows of the value), from counts and not from a window over all rows."""
    keyed = df.withColumn("__key", value)
    counts = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__kinds"))
    weights = counts.join(F.broadcast(whole)).select("__key", (F.col("__rows") / (F.col("__kinds") * F.col("__n"))).alias("weight"))
    return keyed.join(weights, keyed["__key"].eqNullSafe(weights["__key"])).drop("__key")


def extra_trees(train: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 10, **more) -> random_trees.Forest:
    """Extremely randomised trees: all rows in each tree, thresholds drawn at random."""
    return random_trees.fit(train, features, label, trees, depth, **more)


def fit_twice(train: DataFrame, features: Sequence[str], label: str, make) -> PipelineModel:
    """A fit, and a second one weighted by how rare each row's error was in the first.

    Rows alike in features and label have the same error. Where rows are mostly alike in their features, the
    alike are put together before the errors are predicted and counted; an error then has about two labels
    for each distinct row of features, at most. Weights there lack the factor that all rows share, which
    changes no tree. Other tables are weighted once, and kept for the passes of the second fit.
    """
    once, again = make(label), make(label, weightCol="weight")
    error = F.round(F.abs(F.col(label) - F.col("prediction")), 6)
    if bagged.suits(train, features, once):
        alike = train.groupBy(*features, label).agg(F.count(F.lit(1)).alias("__rows"))
        found = bagged.fit(train, features, once).transform(alike).withColumn("__error", error)
        weight = 1 / F.sum("__rows").over(Window.partitionBy("__error"))
        return bagged.fit(found.select(*features, label, "__rows", weight.alias("weight")), features, again, "__rows")
    found = _pipeline(features, [once]).fit(train).transform(train)
    weighted = balanced_weights(found, error).select(*features, label, "weight")
    return _pipeline(features, [again]).fit(checkpointed(weighted))


def metrics(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """mae, mse, rmse and r2 in one scan."""
    e, y = F.col(label) - F.col(predicted), F.col(label)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
    )


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """feature, importance and rank."""
    found = [s.featureImportances.toArray() for s in model.stages if hasattr(s, "featureImportances")]
    total = reduce(lambda a, b: a + b, found)
    return shares(features, total / (total.sum() or 1), spark)


def shares(features: Sequence[str], values: Sequence[float], spark) -> DataFrame:
    """feature, importance and rank of importances at hand."""
    return ranked(spark.createDataFrame([(f, float(v)) for f, v in zip(features, values, strict=True)], "feature string, importance double"))


def ranked(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))


def compare(train: DataFrame, test: DataFrame, label: str, sets: Mapping[str, Sequence[str]], make=linear) -> DataFrame:
    """Metrics of one kind of model over several sets of features."""
    parts = []
    for name, features in sets.items():
        parts.append(metrics(fit(train, features, make(label)).transform(test), label).select(F.lit(name).alias("features"), "*"))
    return reduce(DataFrame.unionByName, parts)


def compare_rows(train: DataFrame, test: DataFrame, label: str, features: Sequence[str], subsets: Mapping[str, Column], make=linear) -> DataFrame:
    """Metrics of one kind of model fitted and tried on several choices of rows."""
    parts = []
    for name, chosen in subsets.items():
        found = fit(train.where(chosen), features, make(label)).transform(test.where(chosen))
        parts.append(metrics(found, label).select(F.lit(name).alias("rows_used"), "*"))
    return reduce(DataFrame.unionByName, parts)


def search(train: DataFrame, features: Sequence[str], label: str, trees: Sequence[int], depths: Sequence[int], parallelism: int = 2):
    """The forest that does best on a held-back part."""
    regressor = forest(label)
    grid = ParamGridBuilder().addGrid(regressor.numTrees, list(trees)).addGrid(regressor.maxDepth, list(depths)).build()
    tuning = TrainValidationSplit(estimator=_pipeline(features, [regressor]), estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=label), trainRatio=0.8, parallelism=parallelism, seed=42)
    return tuning.fit(train)


def label_encoded(df: DataFrame, column: str) -> DataFrame:
    """column_code: the place of each text among the sorted distinct ones, from 0."""
    codes = numbered(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], f"{column}_code")
    return df.join(codes.withColumn(f"{column}_code", (F.col(f"{column}_code") - 1).cast("int")), column)


def melted(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str = "model", value: str = "predicted") -> DataFrame:
    return df.unpivot(list(keys), list(values), name, value)


def save_versioned(model: PipelineModel, spark, root: str, run_id: str) -> int:
    """The model as a run, and as the latest version; the version's number."""
    return publish(spark, root, run_id, lambda path: model.save(path))


def load_latest(spark, root: str) -> PipelineModel:
    return PipelineModel.load(latest_path(spark, root))
