"""Daily summaries that merge: any range of days is answered from them, without the rows.

A summary has a row for each day (and key): counts, sums, smallest and largest, a histogram with
fixed bounds, a quantile sketch (KLL) and a sketch of distinct values (HLL). Counts, sums and
histograms merge exactly; a quantile's rank is off by about RANK_ERROR of the rows at most, and a
distinct count by about DISTINCT_ERROR, with a chance of 99 in 100 each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of the sketches, and the errors that go with them.
KLL_K, HLL_LG_K = 200, 14
RANK_ERROR, DISTINCT_ERROR = 0.0166, 0.021


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value from 0, the last one with its upper end; null outside."""
    at = F.floor((value - low) / (high - low) * bins)
    return F.when((value >= low) & (value <= high), F.least(at, F.lit(bins - 1))).cast("int")


def daily(df: DataFrame, day: str, value: str, distinct: Column, low: float, high: float, bins: int = 100, keys: Sequence[str] = ()) -> DataFrame:
    """A row for each day (and ``keys``): n, n_null, total, smallest, largest, histogram, quantiles and places.

    ``distinct`` is what is counted once, such as a place; rows with a null day have no summary.
    """
    at, number = bin_of(F.col(value), low, high, bins), F.col(value).cast("double")
    rows = df.where(F.col(day).isNotNull()).select(*keys, day, number.alias("__v"), distinct.cast("string").alias("__d"), at.alias("__b"))
    by_bin = rows.groupBy(*keys, day, "__b").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__v").isNull()).alias("n_null"), F.sum("__v").alias("total"), F.min("__v").alias("smallest"), F.max("__v").alias("largest"),
        F.kll_sketch_agg_double("__v", KLL_K).alias("quantiles"), F.hll_sketch_agg("__d", HLL_LG_K).alias("places"),
    )
    return _merged(by_bin.withColumn("histogram", F.when(F.col("__b").isNotNull(), F.map_from_arrays(F.array("__b"), F.array("n")))), [*keys, day])


def _merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    listed = F.flatten(F.collect_list(F.map_entries("histogram")))
    sums = F.aggregate(listed, F.create_map().cast("map<int,bigint>"), lambda held, e: F.map_concat(F.map_filter(held, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(F.coalesce(F.try_element_at(held, e["key"]), F.lit(0)) + e["value"]))))
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("total").alias("total"), F.min("smallest").alias("smallest"), F.max("largest").alias("largest"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("places").alias("places"), sums.alias("histogram"),
    )


def over(summaries: DataFrame, day: str, first: str, last: str, keys: Sequence[str] = ()) -> DataFrame:
    """The summaries of the days first..last as one (for each of ``keys``)."""
    return _merged(summaries.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))), keys)


def answers(merged: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75), keys: Sequence[str] = ()) -> DataFrame:
    """n, n_null, mean, smallest, largest, places (an estimate) and q<share in hundredths> (estimates)."""
    known = F.col("n") > F.col("n_null")  # an empty sketch has no quantiles
    found = [F.when(known, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(s)))).alias(f"q{round(100 * s)}") for s in shares]
    mean = F.try_divide(F.col("total"), F.col("n") - F.col("n_null")).alias("mean")
    return merged.select(*keys, "n", "n_null", mean, "smallest", "largest", F.hll_sketch_estimate("places").alias("places"), *found)


def histogram(merged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """bin and n of each bin that has rows."""
    return merged.select(*keys, F.explode("histogram").alias("bin", "n"))
