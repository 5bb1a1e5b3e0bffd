"""Column functions: calendar, coordinates, classes and scaling. Each maps columns to a column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def season(day: Column) -> Column:
    """1 spring (March to May), 2 summer, 3 autumn, 4 winter."""
    return F.floor(F.pmod(F.month(day) + 9, F.lit(12)) / 3).cast("int") + 1


def month_mod3(day: Column) -> Column:
    """(month - 1) mod 3: a feature under the name of a season, though it is not one."""
    return F.pmod(F.month(day) - 1, F.lit(3))


def water_year(day: Column) -> Column:
    """The year in which the season that starts on 1 October ends."""
    return F.year(day) + (F.month(day) >= 10).cast("int")


def season_start(day: Column) -> Column:
    return F.make_date(water_year(day) - 1, F.lit(10), F.lit(1))


def days_since_1900(day: Column) -> Column:
    return F.datediff(day, F.lit("1900-01-01").cast("date"))


def from_days_since_1900(days: Column) -> Column:
    return F.date_add(F.lit("1900-01-01").cast("date"), days)


def year_and_day(day: Column) -> Column:
    """YYYYDDD."""
    return F.concat(F.year(day).cast("string"), F.lpad(F.dayofyear(day).cast("string"), 3, "0"))


def cube_day(day: Column) -> Column:
    """The index of a day in a yearly cube."""
    return F.dayofyear(day) - 1


def parse_us_time(text: Column) -> Column:
    """The date of month/day/year hour:minute; null if it can't be read."""
    return F.to_date(F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def degree_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow(lat2 - lat1, 2) + F.pow(lon2 - lon1, 2))


def log_cumulative(df: DataFrame, part: str = "cumulative", shift: float = 0.1) -> DataFrame:
    """log10(x + shift) of each column whose name holds ``part``; null where that is not positive."""
    return df.withColumns({c: F.log10(F.col(c) + shift) for c in df.columns if part in c})


def class_index(value: Column, bounds: Sequence[Column]) -> Column:
    """The first class whose upper bound is at or above the value, else the last."""
    last = F.lit(len(bounds))
    return reduce(lambda rest, i: F.when(value <= bounds[i], i).otherwise(rest), range(len(bounds) - 1, -1, -1), last)


def asymmetric_loss(truth: Column, predicted: Column, above: float = 10.0, factor: float = 2.0) -> Column:
    """Absolute error, doubled where the truth is large."""
    return F.abs(truth - predicted) * F.when(truth > above, factor).otherwise(1.0)


def normalised(value: Column, by: float = 200.0) -> Column:
    return value / by


def denormalised(value: Column, by: float = 200.0) -> Column:
    return value * by


def operation_day(today: Column, lag: int = 3) -> Column:
    return F.date_sub(today, lag)


def name_parts(name: Column, separator: str = "_") -> Column:
    """A file name's parts, without its extension."""
    return F.split(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), separator)


def date_in(text: Column) -> Column:
    """The first YYYY-MM-DD in a text, as text; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))


def coordinates_in(header: Column) -> list[Column]:
    """lat and lon from a header with two signed decimals in parentheses."""
    number = r"\(\s*(-?[0-9.]+)\s*,\s*(-?[0-9.]+)\s*\)"
    return [F.regexp_extract(header, number, i).cast("double").alias(c) for i, c in ((1, "lat"), (2, "lon"))]
