"""Outliers, rescaling, standardisation and detrending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.operators.quantile import exact_quantiles


def iqr_flag(
    df: DataFrame, key: str | None = None, value: str = "price", multiplier: float = 3.0
) -> DataFrame:
    """``is_outlier`` when outside quartiles -/+ multiplier x IQR; NULL is never an outlier."""
    quartiles = {"_q1": 0.25, "_q3": 0.75}
    v = F.col(value)
    if key:
        rows = df.join(exact_quantiles(df, value, quartiles, [key]), key, "left")
    else:
        q = exact_quantiles(df, value, quartiles).agg(
            F.struct(F.max("_q1").alias("_q1"), F.max("_q3").alias("_q3")).alias("q")
        ).scalar()
        rows = df.withColumns({"_q1": q.getField("_q1"), "_q3": q.getField("_q3")})
    spread = (F.col("_q3") - F.col("_q1")) * multiplier
    outside = (v < F.col("_q1") - spread) | (v > F.col("_q3") + spread)
    return rows.withColumn("is_outlier", F.coalesce(outside, F.lit(False))).drop("_q1", "_q3")


def median_mad(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Median and median absolute deviation per group (keys + ``median``, ``mad``)."""
    med = exact_quantiles(df, value, {"median": 0.5}, keys)
    dev = df.join(med, keys).withColumn("_dev", F.abs(F.col(value) - F.col("median")))
    return med.join(exact_quantiles(dev, "_dev", {"mad": 0.5}, keys), keys)


def overall_median_mad(df: DataFrame, value: str) -> tuple[float | None, float | None]:
    """Median and MAD of a whole column.

    The MAD needs the median first; fetching these two numbers one after the
    other keeps each plan flat instead of nesting one quantile plan in another.
    """

    def median(x: DataFrame, col: str) -> float | None:
        row = exact_quantiles(x, col, {"q": 0.5}).first()
        return row["q"] if row else None

    m = median(df, value)
    if m is None:
        return None, None
    return m, median(df.select(F.abs(F.col(value) - F.lit(m)).alias("_dev")), "_dev")


def mad_rescale(
    focal: DataFrame,
    comp: DataFrame,
    focal_value: str = "price",
    comp_value: str = "price",
    out: str = "normalized",
    null_poisons: bool = False,
) -> DataFrame:
    """Move the focal values to the competitors' median and MAD.

    NULLs are ignored by default.  ``null_poisons=True`` makes the whole result
    NULL when either input holds a NULL, which is what a plain median of raw
    values does.  A zero focal MAD gives NULL.
    """
    (f_mid, f_mad), (c_mid, c_mad) = (
        overall_median_mad(focal, focal_value),
        overall_median_mad(comp, comp_value),
    )
    number = lambda x: F.lit(x).cast("double")
    rescaled = (
        F.try_divide(F.col(focal_value) - number(f_mid), number(f_mad)) * number(c_mad)
        + number(c_mid)
    )
    if null_poisons:
        holes = focal.select(F.col(focal_value).alias("v")).unionByName(
            comp.select(F.col(comp_value).alias("v"))
        )
        clean = holes.agg(F.count_if(F.col("v").isNull()).alias("n")).scalar() == 0
        rescaled = F.when(clean, rescaled)
    return focal.withColumn(out, rescaled)


def standardise(
    df: DataFrame,
    value: str = "price",
    keys: list[str] | None = None,
    fit: Column | None = None,
    out: str = "z",
) -> DataFrame:
    """(x - mean) / population deviation, fitted on the rows where ``fit`` holds and applied
    to all; a zero deviation divides by one."""
    w = Window.partitionBy(*(keys or ["entity"]))
    base = F.when(fit, F.col(value)) if fit is not None else F.col(value)
    sd = F.stddev_pop(base).over(w)
    return df.withColumn(
        out, (F.col(value) - F.avg(base).over(w)) / F.when(sd == 0, 1.0).otherwise(sd)
    )


def trend(value: str | Column, keys: list[str], order: str, n: int = 30, shift: int = 0) -> Column:
    """Mean of the last ``n`` rows; ``shift=1`` leaves the current row out."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1) - shift, -shift)
    return F.avg(value).over(w)


def detrend(
    df: DataFrame,
    value: str = "price",
    keys: list[str] | None = None,
    order: str = "obs_date",
    n: int = 30,
    trend_shift: int = 0,
) -> DataFrame:
    """Adds ``trend`` and ``deviation`` = (x - trend) / trend (NULL on a zero trend)."""
    t = trend(value, keys or ["entity"], order, n, trend_shift)
    return df.withColumn("trend", t).withColumn(
        "deviation", F.try_divide(F.col(value) - F.col("trend"), F.col("trend"))
    )


def retrend(trend_col: Column, deviation: Column) -> Column:
    """Level that belongs to a relative deviation."""
    return trend_col * (1 + deviation)
