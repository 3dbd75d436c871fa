"""Feature engineering on series and on row vectors.

Lags, differences and rolling means are row based: they follow the rows that
exist, not the calendar, so they must be computed after alignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.functions import calendar as C
from pricepanel.lineage import spread
from pricepanel.operators.impute import last_known

ENTITY = ["entity"]
LAGS = (1, 2, 3, 4, 5)


def _w(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def diff(df: DataFrame, value: str = "price", keys=None, order: str = "obs_date") -> DataFrame:
    """First difference over rows; NULL when either end is missing."""
    w = _w(keys or ENTITY, order)
    return df.withColumn(f"{value}_change", F.col(value) - F.lag(value).over(w))


def pct_change(
    df: DataFrame, value: str = "price", keys=None, order: str = "obs_date", pad: bool = True
) -> DataFrame:
    """Relative change over rows, gaps padded forward first; NULL after a zero."""
    keys = keys or ENTITY
    level = last_known(value, keys, order) if pad else F.col(value)
    w = _w(keys, order)
    return (
        df.withColumn("_level", level)
        .withColumn("_prev", F.lag("_level").over(w))
        .withColumn(f"{value}_change_pct", F.try_divide(F.col("_level") - F.col("_prev"), F.col("_prev")))
        .drop("_level", "_prev")
    )


def lags(
    df: DataFrame, ks: tuple[int, ...] = LAGS, value: str = "price", keys=None, order: str = "obs_date"
) -> DataFrame:
    w = _w(keys or ENTITY, order)
    return df.withColumns({f"{value}_lag_{k}": F.lag(value, k).over(w) for k in ks})


def market_availability(
    df: DataFrame, flag: str = "available", keys=None, date: str = "obs_date"
) -> DataFrame:
    """Daily mean of the availability flag over all competitors."""
    return df.groupBy(*(keys or []), date).agg(F.avg(flag).alias("market_availability"))


def market_mean(df: DataFrame, value: str = "price", keys=None, date: str = "obs_date") -> DataFrame:
    """Daily mean over competitors that have a value."""
    return df.groupBy(*(keys or []), date).agg(F.avg(value).alias("market_mean"))


# --- row vectors: the whole matrix row of a focal in one array column -----------------


def row_vectors(target: DataFrame, comp: DataFrame) -> DataFrame:
    """(focal_id, obs_date, columns, row): base rate first, then one price per competitor.

    Only dates of the focal that occur among its competitors are kept, and
    competitors without any price on those dates are left out.  Focals have
    different competitor sets; arrays let all of them share one table, and one
    window over arrays then lags every competitor at once.
    """
    cells = (
        comp.groupBy("focal_id", "obs_date", "entity", "currency")
        .agg(F.min("price").alias("price"))
        .join(target, ["focal_id", "obs_date"])
    )
    known = F.col("price").isNotNull()
    columns = cells.groupBy("focal_id").agg(
        F.sort_array(F.collect_set(F.when(known, F.struct("entity", "currency")))).alias("columns")
    )
    by_date = cells.groupBy("focal_id", "obs_date").agg(
        F.first("base_rate").alias("base_rate"),
        F.map_from_entries(F.collect_list(F.when(known, F.struct("entity", "price")))).alias("_cells"),
    )
    return spread(by_date.join(columns, "focal_id"), ["focal_id"]).select(
        "focal_id",
        "obs_date",
        "columns",
        F.concat(
            F.array("base_rate"),
            F.transform("columns", lambda c: F.try_element_at("_cells", c["entity"])),
        ).alias("row"),
    )


def _pick(row: Column, positions: Column) -> Column:
    """Competitor entries of a row vector at 1-based competitor positions."""
    return F.transform(positions, lambda i: F.get(row, i))


def competitor_positions(columns: Column, currency: str | None) -> Column:
    """Row-vector positions (0 is the base rate) of the competitors in ``currency``."""
    every = F.sequence(F.lit(1), F.size(columns))
    if currency is None:
        return F.when(F.size(columns) > 0, every).otherwise(F.array().cast("array<int>"))
    return F.filter(
        F.when(F.size(columns) > 0, every).otherwise(F.array().cast("array<int>")),
        lambda i: F.get(columns, i - 1)["currency"] == currency,
    )


def lagged_rows(rows: DataFrame, ks: tuple[int, ...] = LAGS) -> DataFrame:
    """Adds ``lag_k`` arrays and drops the first rows of each focal, which lack a lag.

    ``rows`` is the completed matrix (no NULL cells), so a row is complete
    exactly when its deepest lag exists.
    """
    w = _w(["focal_id"], "obs_date")
    out = rows.withColumns({f"lag_{k}": F.lag("row", k).over(w) for k in ks})
    return out.where(F.col(f"lag_{max(ks)}").isNotNull())


def lag_block(lagged: DataFrame, currency: str | None, ks: tuple[int, ...] = LAGS) -> Column:
    """Lag features grouped by competitor: lags 1..k of the first, then of the second ..."""
    positions = competitor_positions(F.col("columns"), currency)
    stacked = F.array(*[F.col(f"lag_{k}") for k in ks])
    return F.flatten(
        F.transform(positions, lambda i: F.transform(stacked, lambda r: F.get(r, i)))
    )


def lag_names(columns: Column, currency: str | None, ks: tuple[int, ...] = LAGS) -> Column:
    """Feature descriptions matching ``lag_block``: name, kind, lag, currency."""
    lag_numbers = F.array(*[F.lit(k) for k in ks])
    chosen = columns if currency is None else F.filter(columns, lambda c: c["currency"] == currency)
    return F.flatten(
        F.transform(
            chosen,
            lambda c: F.transform(
                lag_numbers,
                lambda k: F.struct(
                    F.concat(c["entity"], F.lit("_lag_"), k.cast("string")).alias("feature"),
                    F.lit("lag").alias("kind"),
                    k.alias("lag"),
                    c["currency"].alias("currency"),
                ),
            ),
        )
    )


def described(names: list[str], kind: str) -> Column:
    """Constant feature descriptions without lag or currency."""
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                F.lit(kind).alias("kind"),
                F.lit(None).cast("int").alias("lag"),
                F.lit(None).cast("string").alias("currency"),
            )
            for n in names
        ]
    )


def oos_design(rows: DataFrame, ks: tuple[int, ...] = LAGS, currency: str = "USD") -> DataFrame:
    """(focal_id, obs_date, y, x, n_comp): lagged competitor prices in one currency plus
    the seven temporal features."""
    lagged = lagged_rows(rows, ks)
    x = F.concat(lag_block(lagged, currency, ks), C.lag_temporal_array())
    return lagged.select(
        "focal_id",
        "obs_date",
        F.get("row", F.lit(0)).alias("y"),
        x.alias("x"),
        F.size(competitor_positions(F.col("columns"), currency)).alias("n_comp"),
    )


# Temporal columns of the in-sample model, in model order.
INSAMPLE_TEMPORAL = [
    "day_of_year",
    "sin_day_of_week",
    "cos_day_of_week",
    "sin_month",
    "cos_month",
    "sin_day_of_year",
    "cos_day_of_year",
    "week_of_year",
    "week_centered",
    "week_squared",
    "sin_week",
    "cos_week",
    "is_holiday",
    "is_peak_season",
    "is_summer",
    "sin_dow",
    "cos_dow",
]


def insample_design(
    rows: DataFrame, ks: tuple[int, ...] = LAGS, include_contemporaneous: bool = True
) -> DataFrame:
    """(focal_id, obs_date, y, x): the in-sample feature set.

    Same-day competitor prices are part of it by default; lags of the base rate
    never are.  Several columns are exact copies or shifts of each other
    (``sin_dow``/``sin_day_of_week``, ``week_of_year``/``week_centered``); they
    are kept so that selection sees the same candidates.
    """
    lagged = C.with_week_poly(lagged_rows(rows, ks), ["focal_id"])
    d = F.col("obs_date")
    same_day = _pick(F.col("row"), competitor_positions(F.col("columns"), None))
    if not include_contemporaneous:
        same_day = F.array().cast("array<double>")
    temporal = F.array(
        F.dayofyear(d).cast("double"),
        C.sin_of(d, "weekday"),
        C.cos_of(d, "weekday"),
        C.sin_of(d, "month"),
        C.cos_of(d, "month"),
        C.sin_of(d, "day_of_year"),
        C.cos_of(d, "day_of_year"),
        F.weekofyear(d).cast("double"),
        F.col("week_centered"),
        F.col("week_squared"),
        C.sin_of(d, "week"),
        C.cos_of(d, "week"),
        C.holiday(d, "extended").cast("double"),
        C.is_peak_season(d).cast("double"),
        C.is_summer(d).cast("double"),
        C.sin_of(d, "weekday"),
        C.cos_of(d, "weekday"),
    )
    x = F.concat(
        same_day, F.array(C.is_weekend(d).cast("double")), lag_block(lagged, None, ks), temporal
    )
    return lagged.select("focal_id", "obs_date", F.get("row", F.lit(0)).alias("y"), x.alias("x"))


def feature_dictionary(
    columns: DataFrame,
    design: str,
    ks: tuple[int, ...] = LAGS,
    include_contemporaneous: bool = True,
    currency: str = "USD",
) -> DataFrame:
    """(focal_id, features): descriptions in the order of the design's ``x``."""
    if design == "oos":
        names = F.concat(
            lag_names(F.col("columns"), currency, ks), described(C.LAG_TEMPORAL, "temporal")
        )
    elif design == "insample":
        same_day = F.transform(
            "columns",
            lambda c: F.struct(
                c["entity"].alias("feature"),
                F.lit("price").alias("kind"),
                F.lit(None).cast("int").alias("lag"),
                c["currency"].alias("currency"),
            ),
        )
        parts = [same_day] if include_contemporaneous else []
        names = F.concat(
            *parts,
            described(["is_weekend"], "temporal"),
            lag_names(F.col("columns"), None, ks),
            described(INSAMPLE_TEMPORAL, "temporal"),
        )
    else:
        raise ValueError(f"unknown design {design!r}")
    return columns.select("focal_id", names.alias("features"))


def lag_profile(
    rows: DataFrame, ks: tuple[int, ...] = LAGS, status: bool = True
) -> DataFrame:
    """Per focal: rows before and after lagging, retention in percent, feature counts.

    Lag features are counted from the description, not by searching names, so a
    competitor whose name contains "lag" does not distort the count.
    """
    counts = rows.groupBy("focal_id").agg(
        F.count(F.lit(1)).alias("original_rows"), F.max(F.size("row")).alias("price_columns")
    )
    sizes = sum((F.size(f"lag_{k}") for k in ks), F.lit(0))
    lagged = lagged_rows(rows, ks).groupBy("focal_id").agg(
        F.count(F.lit(1)).alias("_kept"),
        F.max(sizes).alias("_lags"),
        F.max(F.size(C.lag_temporal_array())).alias("_calendar"),
    )
    kept = F.coalesce("_kept", F.lit(0))
    # A focal that keeps no row still has its columns.
    n_lag = F.coalesce(F.col("_lags"), F.col("price_columns") * len(ks))
    out = counts.join(lagged, "focal_id", "left").select(
        "focal_id",
        "original_rows",
        kept.alias("final_rows"),
        (F.col("original_rows") - kept).alias("rows_lost"),
        F.round(kept / F.col("original_rows") * 100, 1).alias("data_retention_pct"),
        # prices, weekday, month, weekend, lags, day of year, six sine/cosine columns
        (F.col("price_columns") + 3 + n_lag + F.coalesce("_calendar", F.lit(7))).cast("bigint").alias("total_features"),
        n_lag.cast("bigint").alias("lag_features"),
        F.col("price_columns").cast("bigint").alias("price_columns"),
        (F.col("price_columns") - 1).cast("bigint").alias("num_competitors"),
    )
    return out.withColumn("status", F.lit("Success")) if status else out


def select_features(dictionary: DataFrame, rule: str) -> DataFrame:
    """Choose features by their description.

    ``usd_lags``: lagged prices in USD plus temporal features; ``no_target_lags``:
    everything except lags of the base rate.
    """
    if rule == "usd_lags":
        cond = ((F.col("kind") == "lag") & (F.col("currency") == "USD")) | (
            F.col("kind") == "temporal"
        )
    elif rule == "no_target_lags":
        cond = ~F.col("feature").startswith("base_rate")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return dictionary.where(cond)
