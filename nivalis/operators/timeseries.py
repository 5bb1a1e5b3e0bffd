"""Lags, running totals and gap filling for series keyed by point and day.

All windows are partitioned by the series key, so a chain of them costs one shuffle. Rows with a
null key belong to no series and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nivalis.functions.columns import season_start


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def lags(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], n: int = 7) -> DataFrame:
    """columns of the n rows before, as name_1 to name_n; then every null number is 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = _keyed(df, keys).withColumns({f"{c}_{k}": F.lag(c, k).over(w) for c in columns for k in range(1, n + 1)})
    return out.na.fill(0)


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """The sum so far; null on rows without a value."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return _keyed(df, keys).withColumn(name, F.when(F.col(value).isNotNull(), F.sum(value).over(w)))


def fill_linear(df: DataFrame, keys: Sequence[str], day: str, value: Column, name: str, leading: str = "hold", spacing: str = "days") -> DataFrame:
    """Gaps (nulls of ``value``) on the line between their neighbours.

    Before the first value that value is held, or 0 stands (``leading``="zero"); after the last it
    is held; a series without values is 0. ``spacing`` measures by days or by rows.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    x = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) if spacing == "days" else F.row_number().over(w)
    df = _keyed(df, keys).withColumns({"__v": value, "__x": x})
    known = F.when(F.col("__v").isNotNull(), F.struct("__x", "__v"))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumns({"__p": F.last(known, ignorenulls=True).over(back), "__n": F.first(known, ignorenulls=True).over(ahead)})
    px, pv, nx, nv = F.col("__p.__x"), F.col("__p.__v"), F.col("__n.__x"), F.col("__n.__v")
    between = pv + (nv - pv) * (F.col("__x") - px) / F.nullif(nx - px, F.lit(0))
    filled = (
        F.when(F.col("__v").isNotNull(), F.col("__v"))
        .when(F.col("__p").isNull() & F.col("__n").isNull(), 0.0)
        .when(F.col("__p").isNull(), nv if leading == "hold" else F.lit(0.0))
        .when(F.col("__n").isNull(), pv)
        .otherwise(between)
    )
    return df.withColumn(name, filled).drop("__v", "__x", "__p", "__n")


def fill_line(df: DataFrame, keys: Sequence[str], x: Column, value: Column, name: str, low: float | None = None, high: float | None = None, digits: int = 6) -> DataFrame:
    """Gaps on the least-squares line through the series' values; with one value or none all is 0.

    ``x`` is a whole number, such as a day. Values are summed as whole numbers of ``digits``
    decimals, so the line does not depend on the order of rows. A series whose values all have one
    x has its mean on the line.
    """
    w = Window.partitionBy(*keys)
    exact = lambda c: c.cast("decimal(38,0)")
    df = _keyed(df, keys).withColumns({"__at": x.cast("long"), "__v": value})
    df = df.withColumns({"__x": F.col("__at") - F.min("__at").over(w), "__y": F.round(F.col("__v") * 10**digits).cast("decimal(20,0)")})
    at = F.when(F.col("__y").isNotNull(), F.col("__x")).cast("decimal(20,0)")
    sums = {"__n": F.count("__y"), "__sx": F.sum(at), "__sxx": F.sum(at * at), "__sy": F.sum("__y"), "__sxy": F.sum(at * F.col("__y"))}
    df = df.withColumns({c: exact(s.over(w)) for c, s in sums.items()})
    n, sx, sxx, sy, sxy = map(F.col, sums)
    spread = exact(exact(n * sxx) - exact(sx * sx))
    above = exact(exact(exact(sy * sxx) - exact(sx * sxy)) + exact(exact(F.col("__x")) * exact(exact(n * sxy) - exact(sx * sy))))
    line = F.when(spread == 0, sy.cast("double") / (n.cast("double") * 10.0**digits)).otherwise(F.try_divide(above.cast("double"), spread.cast("double") * 10.0**digits))
    out = F.when(n <= 1, 0.0).otherwise(F.coalesce("__v", line))
    if low is not None:
        out = F.greatest(F.lit(low), F.least(F.lit(high), out))
    return df.withColumn(name, out).drop("__at", "__x", "__v", "__y", *sums)


def fill_polynomial(df: DataFrame, keys: Sequence[str], order: str, value: str, degree: int) -> DataFrame:
    """Gaps on the least-squares polynomial in the row's place; ``value`` becomes a double.

    With ``degree`` values or fewer all is 0. Places are scaled to -1..1; the sums of their powers
    are windows over the series, and the normal equations are solved row by row in columns.
    """
    w = Window.partitionBy(*keys)
    middle = (F.count(F.lit(1)).over(w) - 1) / 2
    place = (F.row_number().over(w.orderBy(order)) - 1 - middle) / F.greatest(middle, F.lit(1.0))
    names = df.columns
    df = _keyed(df, keys).withColumns({"__x": place, "__v": F.col(value).cast("double")})
    power = lambda k: F.when(F.col("__v").isNotNull(), F.lit(1.0) if k == 0 else F.pow("__x", F.lit(float(k))))
    size = degree + 1
    df = df.withColumns({f"__s{k}": F.sum(power(k)).over(w) for k in range(2 * degree + 1)} | {f"__t{k}": F.sum(power(k) * F.col("__v")).over(w) for k in range(size)})
    # elimination from the first row down: the matrix is positive definite, so no rows change places
    df = df.withColumns({f"__m{i}_{j}": F.col(f"__s{i + j}") for i in range(size) for j in range(size)} | {f"__m{i}_{size}": F.col(f"__t{i}") for i in range(size)})
    for p in range(size):
        share = {i: F.try_divide(F.col(f"__m{i}_{p}"), F.col(f"__m{p}_{p}")) for i in range(p + 1, size)}
        df = df.withColumns({f"__m{i}_{j}": F.col(f"__m{i}_{j}") - share[i] * F.col(f"__m{p}_{j}") for i in share for j in range(p, size + 1)})
    for i in reversed(range(size)):
        rest = F.col(f"__m{i}_{size}")
        for j in range(i + 1, size):
            rest = rest - F.col(f"__m{i}_{j}") * F.col(f"__c{j}")
        df = df.withColumn(f"__c{i}", F.try_divide(rest, F.col(f"__m{i}_{i}")))
    line = F.col("__c0")
    for k in range(1, size):
        line = line + F.col(f"__c{k}") * F.pow("__x", F.lit(float(k)))
    filled = F.when(F.count("__v").over(w) <= degree, 0.0).otherwise(F.coalesce("__v", line))
    return df.withColumn(value, filled).select(*names)


def by_series(df: DataFrame, keys: Sequence[str], order: str, apply: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """apply(each series, sorted by ``order``), for what windows cannot express; a series must fit in memory."""
    return _keyed(df, keys).groupBy(*keys).applyInPandas(lambda part: apply(part.sort_values(order)), schema)


def season_to_date(df: DataFrame, day: str, target: date | str) -> DataFrame:
    """Rows from the last 1 October up to the target day."""
    at = F.lit(str(target)).cast("date")
    return df.where(F.col(day).between(season_start(at), at))


def day_and_total(df: DataFrame, keys: Sequence[str], day: str, value: str, target: date | str) -> DataFrame:
    """The value of the target day and the season's total up to it."""
    at = F.lit(str(target)).cast("date")
    part = season_to_date(df, day, target)
    return part.groupBy(*keys).agg(F.max(F.when(F.col(day) == at, F.col(value))).alias("value"), F.sum(value).alias("total"))


def calendar(df: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last of a table."""
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias(day))


def complete_days(df: DataFrame, key: str, day: str, value: str, fill: float) -> DataFrame:
    """A row for each point and each day of the calendar; ``fill`` where there is no row."""
    points = df.select(key).distinct()
    spans = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    spine = points.join(F.broadcast(spans)).select(key, F.explode(F.expr("sequence(first, last, interval 1 day)")).alias(day))
    return spine.join(df.select(key, day, value), [key, day], "left").withColumn(value, F.coalesce(value, F.lit(fill)))
