"""Calendar features of a DATE column (weekday 0 = Monday, ISO weeks)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# Part -> period of its sine/cosine pair.
PERIODS = {"weekday": 7, "month": 12, "week": 52, "day_of_year": 365}

# The seven stage-1 instruments, in model order.
INSTRUMENTS = [
    "sin_month",
    "cos_month",
    "sin_day",
    "cos_day",
    "sin_week",
    "cos_week",
    "is_holiday_season",
]

# Temporal columns of the lagged data set used out of sample.
LAG_TEMPORAL = [
    "sin_day_of_week",
    "cos_day_of_week",
    "sin_month",
    "cos_month",
    "sin_day_of_year",
    "cos_day_of_year",
    "is_weekend",
]

_SHORT = {"weekday": "day", "month": "month", "week": "week", "day_of_year": "day_of_year"}


def part(d: Column, name: str) -> Column:
    return {
        "weekday": F.weekday,
        "month": F.month,
        "week": F.weekofyear,
        "day_of_year": F.dayofyear,
    }[name](d)


def is_weekend(d: Column) -> Column:
    return (F.weekday(d) >= 5).cast("int")


def sin_of(d: Column, name: str) -> Column:
    return F.sin(F.lit(2 * math.pi) * part(d, name) / F.lit(PERIODS[name]))


def cos_of(d: Column, name: str) -> Column:
    return F.cos(F.lit(2 * math.pi) * part(d, name) / F.lit(PERIODS[name]))


def holiday(d: Column, variant: str = "season") -> Column:
    """``season``: December and January.  ``extended`` adds 1-7 July and late November."""
    winter = F.month(d).isin(12, 1)
    if variant == "season":
        return winter.cast("int")
    if variant != "extended":
        raise ValueError(f"unknown holiday variant {variant!r}")
    july = (F.month(d) == 7) & (F.day(d) <= 7)
    november = (F.month(d) == 11) & (F.day(d) >= 22)
    return (winter | july | november).cast("int")


def is_summer(d: Column) -> Column:
    return F.month(d).isin(6, 7, 8).cast("int")


def is_peak_season(d: Column) -> Column:
    return F.month(d).isin(6, 7, 8, 12, 1).cast("int")


def with_calendar(df: DataFrame, date: str = "obs_date") -> DataFrame:
    d = F.col(date)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "month": F.month(d),
            "is_weekend": is_weekend(d),
            "week_of_year": F.weekofyear(d),
            "day_of_year": F.dayofyear(d),
        }
    )


def with_cyclic(
    df: DataFrame, parts: tuple[str, ...] = tuple(PERIODS), date: str = "obs_date"
) -> DataFrame:
    d = F.col(date)
    cols = {}
    for name in parts:
        cols[f"sin_{_SHORT[name]}"] = sin_of(d, name)
        cols[f"cos_{_SHORT[name]}"] = cos_of(d, name)
    return df.withColumns(cols)


def with_instruments(df: DataFrame, date: str = "obs_date") -> DataFrame:
    out = with_cyclic(df, ("month", "weekday", "week"), date)
    return out.withColumn("is_holiday_season", holiday(F.col(date)).cast("double"))


def lag_temporal_array(date: str = "obs_date") -> Column:
    """The temporal block of the lagged data set as one array, in ``LAG_TEMPORAL`` order."""
    d = F.col(date)
    return F.array(
        sin_of(d, "weekday"),
        cos_of(d, "weekday"),
        sin_of(d, "month"),
        cos_of(d, "month"),
        sin_of(d, "day_of_year"),
        cos_of(d, "day_of_year"),
        is_weekend(d).cast("double"),
    )


def with_week_poly(
    df: DataFrame, keys: list[str], degree: int = 2, date: str = "obs_date"
) -> DataFrame:
    """ISO week centred on the group's own mean, and its powers up to ``degree``."""
    week = F.weekofyear(F.col(date)).cast("double")
    df = df.withColumn("week_centered", week - F.avg(week).over(Window.partitionBy(*keys)))
    names = {2: "week_squared", 3: "week_cubic", 4: "week_quartic"}
    return df.withColumns(
        {names[k]: F.pow(F.col("week_centered"), F.lit(k)) for k in range(2, degree + 1)}
    )
