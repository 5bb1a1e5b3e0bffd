"""Projections, filters and value repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Codes of the cover product that mean no snow.
CLEAR_CODES = (0, 225, 237, 239)
#: Land classes without a prediction.
MASKED_CLASSES = (3, 27, 255)

#: Source names and the names used in feature tables; fixed values.
CANONICAL = {
    "etr": "potential_evapotranspiration",
    "pr": "precipitation_amount",
    "rmax": "relative_humidity_rmax",
    "rmin": "relative_humidity_rmin",
    "tmmn": "air_temperature_tmmn",
    "tmmx": "air_temperature_tmmx",
    "vpd": "mean_vapor_pressure_deficit",
    "vs": "wind_speed",
    "AMSR_SWE": "SWE",
    "AMSR_Flag": "Flag",
    "Latitude": "lat",
    "Longitude": "lon",
}
CANONICAL |= {f"cumulative_{a}": f"cumulative_{b}" for a, b in CANONICAL.items() if a not in ("Latitude", "Longitude")}


def rename(df: DataFrame, names: Mapping[str, str] = CANONICAL) -> DataFrame:
    """Columns renamed by a dictionary; names that are not there are ignored."""
    return df.withColumnsRenamed(dict(names))


def select_in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Without the columns whose names match a regular expression."""
    import re

    return df.drop(*[c for c in df.columns if re.search(pattern, c)])


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """The first of columns that share a name."""
    seen: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        seen.setdefault(c, i)
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"c{i}").alias(c) for c, i in seen.items()])


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])


def in_box(df: DataFrame, south: float, north: float, west: float, east: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def in_dates(df: DataFrame, column: str, first: date | str, last: date | str) -> DataFrame:
    """Rows of days first..last; the bounds are put on the raw column so that scans can use them."""
    c = F.col(column)
    return df.where((c >= F.lit(str(first)).cast("date")) & (c < F.date_add(F.lit(str(last)).cast("date"), 1)))


def active(df: DataFrame, end: str, after: date | str) -> DataFrame:
    return df.where(F.col(end) > F.lit(str(after)).cast("date"))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def fill_nulls(df: DataFrame, value: float, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=list(columns) if columns else None)


def blank_to_null(text: Column, blank: str = "--") -> Column:
    return F.nullif(text, F.lit(blank))


def to_number(text: Column) -> Column:
    """A double, or null where the text is no number."""
    return text.try_cast("double")


def converted(df: DataFrame, factors: Mapping[str, tuple[str, float]]) -> DataFrame:
    """New columns: name -> (source column, factor)."""
    return df.withColumns({name: F.col(source) * factor for name, (source, factor) in factors.items()})


def zero_or_missing(depth: Column, missing: float = -999.0) -> Column:
    """0 where the depth is 0, else the mark of a missing label (also where the depth is null)."""
    return F.when(depth == 0, 0.0).otherwise(missing)


def fill_label_where_clear(label: Column, code: Column, codes: Sequence[int] = CLEAR_CODES) -> Column:
    return F.when(label.isNull() & code.isin(*codes), 0.0).otherwise(label)


def clean_code(code: Column, limit: int = 100, zero: Sequence[int] = CLEAR_CODES[1:]) -> Column:
    """0 for codes in ``zero`` and negatives, null above ``limit``."""
    return F.when(code.isin(*zero) | (code < 0), 0).when(code > limit, None).otherwise(code)


def clip(value: Column, low: float, high: float) -> Column:
    """The value within low..high; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def mask_prediction(predicted: Column, code: Column, temperature: Column, land: Column) -> Column:
    """0 where the cover is clear, the temperature is missing or the land class has no prediction."""
    return F.when(code.isin(*CLEAR_CODES) | temperature.isNull() | land.isin(*MASKED_CLASSES), 0.0).otherwise(predicted)


def good_quality(df: DataFrame, flag: str, code: str, best: bool = True, limit: int = 100) -> DataFrame:
    """Rows with quality 0 (``best``) or under 3, and cover up to ``limit``."""
    return df.where((F.col(flag) == 0 if best else F.col(flag) < 3) & (F.col(code) <= limit))


def replace_by(df: DataFrame, column: str, corrected: str) -> DataFrame:
    return df.drop(column).withColumnRenamed(corrected, column)
