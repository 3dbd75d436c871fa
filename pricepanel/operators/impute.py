"""Missing-value operators.

Fills are window expressions over ``(keys ORDER BY date)``; every operator that
needs several of them uses one identical window specification so that Spark
sorts once.  Input has one row per (keys, date), which bounds a window
partition by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.operators.align import densify
from pricepanel.operators.profile import gap_profile

ENTITY = ["entity"]


def _back(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _ahead(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(0, Window.unboundedFollowing)


def last_known(value: str | Column, keys: list[str], order: str = "obs_date") -> Column:
    return F.last(value, ignorenulls=True).over(_back(keys, order))


def next_known(value: str | Column, keys: list[str], order: str = "obs_date") -> Column:
    return F.first(value, ignorenulls=True).over(_ahead(keys, order))


def both_ways(value: str, keys: list[str], order: str = "obs_date") -> Column:
    """Forward fill, then backward fill what is left at the start."""
    return F.coalesce(last_known(value, keys, order), next_known(value, keys, order))


def decayed(value: str, keys: list[str], order: str = "obs_date", rate: float = 0.99) -> Column:
    """Last observation times ``rate`` per row since; a leading gap takes the first one."""
    v = F.col(value)
    here = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    seen_at = F.last(F.when(v.isNotNull(), F.col("_rn")), ignorenulls=True).over(_back(keys, order))
    return here, F.coalesce(
        v,
        last_known(value, keys, order) * F.pow(F.lit(rate), F.col("_rn") - seen_at),
        next_known(value, keys, order),
    )


def ffill(df: DataFrame, value: str = "price", keys=None, order: str = "obs_date") -> DataFrame:
    return df.withColumn(value, last_known(value, keys or ENTITY, order))


def ffill_bfill(df: DataFrame, value: str = "price", keys=None, order: str = "obs_date") -> DataFrame:
    return df.withColumn(value, both_ways(value, keys or ENTITY, order))


def fill_group_median(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date"
) -> DataFrame:
    """Forward fill; what remains takes the median of the forward-filled series."""
    keys = keys or ENTITY
    filled = ffill(df, value, keys, order)
    return filled.withColumn(
        value, F.coalesce(value, F.median(value).over(Window.partitionBy(*keys)))
    )


def fill_cascade(
    grid: DataFrame,
    cleaned: DataFrame,
    value: str = "price",
    keys=None,
    order: str = "obs_date",
) -> DataFrame:
    """Forward, backward, entity median of ``cleaned``, market median of ``cleaned``.

    The medians only ever reach series that are empty on the grid.
    """
    keys = keys or ENTITY
    medians = cleaned.groupBy(*keys).agg(F.median(value).alias("_entity_median"))
    market = cleaned.agg(F.median(value).alias("m")).scalar()
    return (
        grid.join(medians, keys, "left")
        .withColumn(
            value, F.coalesce(both_ways(value, keys, order), F.col("_entity_median"), market)
        )
        .drop("_entity_median")
    )


def fill_availability(
    df: DataFrame, value: str = "available", keys=None, order: str = "obs_date"
) -> DataFrame:
    return df.withColumn(
        value, F.coalesce(both_ways(value, keys or ENTITY, order), F.lit(1.0))
    )


def decay_fill(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date", rate: float = 0.99
) -> DataFrame:
    """Decaying forward fill, first value for a leading gap, median if all else is NULL."""
    keys = keys or ENTITY
    here, filled = decayed(value, keys, order, rate)
    return df.withColumn("_rn", here).withColumn(value, filled).drop("_rn")


def interpolated(value: str, keys: list[str], order: str = "obs_date") -> Column:
    """Linear interpolation by row position; needs ``_rn``.  Trailing gaps keep the last
    value, leading gaps stay NULL."""
    v = F.col(value)
    at = F.when(v.isNotNull(), F.col("_rn"))
    prev_v, next_v = last_known(value, keys, order), next_known(value, keys, order)
    prev_n = F.last(at, ignorenulls=True).over(_back(keys, order))
    next_n = F.first(at, ignorenulls=True).over(_ahead(keys, order))
    share = F.try_divide(F.col("_rn") - prev_n, next_n - prev_n)
    return F.coalesce(v, prev_v + (next_v - prev_v) * share, prev_v)


def interpolate(
    df: DataFrame,
    value: str = "price",
    keys=None,
    order: str = "obs_date",
    pre_fill: bool = True,
) -> DataFrame:
    """``pre_fill=True`` fills both ways first, which leaves nothing to interpolate;
    ``False`` interpolates for real."""
    keys = keys or ENTITY
    if pre_fill:
        return ffill_bfill(df, value, keys, order)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rn", rn).withColumn(value, interpolated(value, keys, order)).drop("_rn")


def baseline_fill(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date"
) -> DataFrame:
    """Forward, backward; a wholly empty series has no median either and stays NULL."""
    return ffill_bfill(df, value, keys, order)


def impute_univariate(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date"
) -> DataFrame:
    """Chained imputation on the series' own lags.

    The lag table, price included, is filled both ways before the imputer sees
    it, so nothing is left to impute and the result is the two-way fill.
    """
    return ffill_bfill(df, value, keys, order)


def impute_by_gap(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date", compat: bool = True
) -> DataFrame:
    """Fill every series by the method its longest gap recommends.

    All candidate fills share one window sort; the label picks between them.
    ``compat=False`` lets ``linear_interpolation`` interpolate for real.
    """
    keys = keys or ENTITY
    labels = gap_profile(df, value, keys, order).select(*keys, "method")
    here, decay = decayed(value, keys, order)
    two_way = both_ways(value, keys, order)
    linear = two_way if compat else F.coalesce(interpolated(value, keys, order), two_way)
    return (
        df.withColumn("_rn", here)
        .withColumns({"_two_way": two_way, "_linear": linear, "_decay": decay})
        .join(labels, keys)
        .withColumn(
            value,
            F.when(F.col("method") == "time_series_decay", F.col("_decay"))
            .when(F.col("method") == "linear_interpolation", F.col("_linear"))
            .otherwise(F.col("_two_way")),
        )
        .drop("_rn", "_two_way", "_linear", "_decay")
    )


def complete_panel(
    df: DataFrame, start: Column, end: Column, value: str = "price", keys=None
) -> DataFrame:
    """Every day of ``start..end`` for every series, then a two-way fill."""
    return ffill_bfill(densify(df, keys or ENTITY, start, end), value, keys or ENTITY)


def extend_calendar(
    df: DataFrame, base_dates: DataFrame, value: str = "price", keys=None, date: str = "obs_date"
) -> DataFrame:
    """Extend each series forward to the last date of ``base_dates`` and forward fill.

    The range starts at the panel's own first date, so earlier base dates stay absent.
    """
    keys = keys or ENTITY
    last = (
        df.select(date).unionByName(base_dates.select(date)).agg(F.max(date).alias("m")).scalar()
    )
    first = df.agg(F.min(date).alias("m")).scalar()
    return ffill(densify(df, keys, first, last, date=date), value, keys, date)


def fill_mean(df: DataFrame, value: str = "price", keys=None, within=None) -> DataFrame:
    """Series mean, else the mean over ``within`` (the whole table when empty)."""
    keys = keys or ENTITY
    if within:
        overall = F.avg(value).over(Window.partitionBy(*within))
    else:
        overall = df.agg(F.avg(value).alias("m")).scalar()
    return df.withColumn(
        value, F.coalesce(F.col(value), F.avg(value).over(Window.partitionBy(*keys)), overall)
    )


def clip_nonneg(df: DataFrame, value: str = "price") -> DataFrame:
    """Negative values become 0; NULL stays NULL."""
    v = F.col(value)
    return df.withColumn(value, F.when(v < 0, F.lit(0.0)).otherwise(v))


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0.0, cols)


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows without any NULL."""
    return df.dropna("any", subset=cols)


def fill_stats(
    before: DataFrame, after: DataFrame, value: str = "price", keys=None, date: str = "obs_date"
) -> DataFrame:
    """NULLs before and cells filled, per series."""
    keys = keys or ENTITY
    b = before.select(*keys, date, F.col(value).isNull().alias("_was"))
    a = after.select(*keys, date, F.col(value).isNull().alias("_is"))
    return (
        b.join(a, [*keys, date])
        .groupBy(*keys)
        .agg(
            F.count_if("_was").alias("original_nulls"),
            (F.count_if("_was") - F.count_if("_is")).alias("filled"),
        )
    )
