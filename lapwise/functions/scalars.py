"""Column expressions: typing, time parsing, flags, codes and labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tyre compound codes, the slow and problem stop limits in
# seconds, weather limits in degrees, and the finish status pattern.
COMPOUND_CODES = {"SOFT": 0, "MEDIUM": 1, "HARD": 2, "INTERMEDIATE": 3, "WET": 4}
UNKNOWN_CODE = -1
SLOW_STOP_SECONDS = 5.0
PROBLEM_STOP_SECONDS = 15.0
HOT_TRACK, COLD_TRACK = 40, 25
FINISHED_PATTERN = r"finished|\+"


def typed(schema: str, columns: Iterable[str]) -> list[Column]:
    """One select list that brings drifting columns to `schema`; bad values and absent columns become null."""
    have = set(columns)
    return [
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in T.StructType.fromDDL(schema)
    ]


def parse_clock(text: Column) -> Column:
    """`m:ss.SSS` to seconds; anything without exactly two parts, or with bad numbers, is null."""
    parts = F.split(text, ":")
    minutes = F.get(parts, F.lit(0)).try_cast("double")
    seconds = F.get(parts, F.lit(1)).try_cast("double")
    return F.when(F.size(parts) == 2, minutes * 60 + seconds)


def stop_seconds(text: Column) -> Column:
    """Pit stop duration given as plain seconds or as `m:ss.SSS`."""
    return F.coalesce(text.try_cast("double"), parse_clock(text))


def best_of(*columns: str) -> Column:
    """Row-wise minimum that skips nulls."""
    return F.least(*columns)


def positions_gained(grid: Column, finish: Column) -> Column:
    return grid - F.coalesce(finish, grid)


def is_finished(status: Column) -> Column:
    return F.coalesce(F.lower(status).rlike(FINISHED_PATTERN), F.lit(False))


def flag(condition: Column) -> Column:
    """1 or 0; null counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def exceeds(value: Column, limit: float) -> Column:
    """Boolean that is false for null."""
    return F.coalesce(value > limit, F.lit(False))


def encode(value: Column, codes: Mapping[str, int] = COMPOUND_CODES, unknown: int = UNKNOWN_CODE) -> Column:
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(unknown))


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(top, bottom)


def finite(value: Column) -> Column:
    """NaN and infinities become null."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            for c in df.columns
        ]
    )


def _interval_seconds(interval: Column) -> Column:
    interval = interval.cast("interval day to second")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), interval).cast("double")

    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def seconds_of_intervals(df: DataFrame) -> DataFrame:
    """Replace each day-time interval column by `<name>_seconds`, in one select."""
    return df.select(
        *[
            _interval_seconds(F.col(f.name)).alias(f"{f.name}_seconds")
            if isinstance(f.dataType, T.DayTimeIntervalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def seconds_of_nanos(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nanosecond counts by `<name>_seconds`."""
    return df.select(
        *[(F.col(c) / 1e9).alias(f"{c}_seconds") if c in columns else F.col(c) for c in df.columns]
    )


def underscored(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def find_column(df: DataFrame, *fragments: str) -> str | None:
    """The first column whose name contains all fragments, ignoring case."""
    for name in df.columns:
        if all(f.lower() in name.lower() for f in fragments):
            return name
    return None


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns that are not excluded."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def full_name(given: Column, family: Column) -> Column:
    return F.concat_ws(" ", given, family)


def race_label(round_: Column, race: Column, drivers: Column) -> Column:
    return F.format_string("R%d — %s (%d drivers)", round_, race, drivers)
