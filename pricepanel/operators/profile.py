"""Profiling and data quality: every operator is one or two aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.functions.stats import null_count, safe_corr
from pricepanel.operators.quantile import exact_quantiles

# Longest gap (rows) -> recommended imputation method.
GAP_ROUTES = [
    (0, "none"),
    (1, "forward_fill"),
    (3, "linear_interpolation"),
    (7, "time_series_decay"),
]
GAP_ROUTE_BEYOND = "univariate_mice"


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the type of every column."""
    types = F.array(*[F.lit(f"{n}:{t}") for n, t in df.dtypes])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"), types.alias("types")
    )


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; ``approximate`` uses a mergeable sketch."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in cols])
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def null_census(df: DataFrame) -> DataFrame:
    """NULLs per column and their sum."""
    counts = df.agg(*[null_count(F.col(c)).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns[1:]), F.col(df.columns[0]))
    return counts.withColumn("total_nulls", total)


def missing_by(df: DataFrame, key: str, value: str = "price", denom: str = "all") -> DataFrame:
    """Missing cells per key.  ``denom='all'`` divides by every row, ``'valid'`` by the
    non-NULL rows only; both definitions are in use."""
    if denom not in ("all", "valid"):
        raise ValueError("denom is 'all' or 'valid'")
    agg = df.groupBy(key).agg(
        F.count(value).alias("valid"), null_count(F.col(value)).alias("missing")
    )
    base = F.col("valid") + F.col("missing") if denom == "all" else F.col("valid")
    return agg.withColumn("missing_rate", F.try_divide(F.col("missing"), base))


def missing_by_date(
    df: DataFrame, value: str = "price", threshold: int = 2, date: str = "obs_date"
) -> DataFrame:
    """Dates on which more than ``threshold`` entities have no value."""
    return (
        df.groupBy(date)
        .agg(null_count(F.col(value)).alias("missing"))
        .where(F.col("missing") > threshold)
    )


def invalid_prices(df: DataFrame, value: str = "price") -> DataFrame:
    return df.agg(F.count_if(F.col(value) <= 0).alias("invalid"))


def segment_stats(df: DataFrame, segment: str = "segment", value: str = "price") -> DataFrame:
    """Mean, sample deviation and count per segment, cheapest first."""
    return (
        df.groupBy(segment)
        .agg(
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.count(value).alias("n"),
        )
        .orderBy("mean", segment)
    )


def availability_rate(df: DataFrame, key: str = "entity", flag: str = "available") -> DataFrame:
    return df.groupBy(key).agg(F.avg(flag).alias("availability"))


def price_bound(a: DataFrame, b: DataFrame, value: str = "price", k: float = 1.5) -> DataFrame:
    """One row ``upper_bound``: ``k`` times the larger 99th percentile."""
    qa = exact_quantiles(a, value, {"p99": 0.99})
    qb = exact_quantiles(b, value, {"p99": 0.99})
    return qa.unionByName(qb).agg((F.max("p99") * k).alias("upper_bound"))


def flag_price_bounds(
    a: DataFrame, b: DataFrame, value: str = "price", k: float = 1.5
) -> tuple[DataFrame, DataFrame]:
    """Both inputs with ``invalid`` set where the value is not positive or above the bound.

    Rows are flagged, never removed; a NULL price is not invalid.
    """
    bound = price_bound(a, b, value, k).scalar()

    def flag(df: DataFrame) -> DataFrame:
        v = F.col(value)
        return df.withColumn("invalid", F.coalesce((v <= 0) | (v > bound), F.lit(False)))

    return flag(a), flag(b)


def histogram(
    df: DataFrame, value: str = "price", bins: int = 30, keys: list[str] | None = None
) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum falls in the last bin."""
    keys = keys or []
    v = F.col(value).cast("double")
    lo, hi = F.min(v).alias("_lo"), F.max(v).alias("_hi")
    if keys:
        rows = df.where(v.isNotNull()).join(
            df.groupBy(*keys).agg(lo, hi), keys
        )
    else:
        bounds = df.agg(F.struct(lo, hi).alias("b")).scalar()
        rows = df.where(v.isNotNull()).withColumns(
            {"_lo": bounds.getField("_lo"), "_hi": bounds.getField("_hi")}
        )
    width = (F.col("_hi") - F.col("_lo")) / bins
    index = F.least(
        F.lit(bins), F.coalesce(F.floor(F.try_divide(v - F.col("_lo"), width)), F.lit(0)) + 1
    ).cast("int")
    return (
        rows.withColumn("bin", index)
        .groupBy(*keys, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.col("_lo") + (F.col("bin") - 1) * width).alias("left_edge"),
        )
    )


def gap_islands(
    df: DataFrame, value: str = "price", keys: list[str] | None = None, order: str = "obs_date"
) -> DataFrame:
    """One row per run of consecutive missing rows: start and length."""
    keys = keys or ["entity"]
    missing = F.col(value).isNull()
    w_all = Window.partitionBy(*keys).orderBy(order)
    w_same = Window.partitionBy(*keys, "_miss").orderBy(order)
    return (
        df.withColumn("_miss", missing)
        .withColumn("_rn", F.row_number().over(w_all))
        .withColumn("_island", F.col("_rn") - F.row_number().over(w_same))
        .where("_miss")
        .groupBy(*keys, "_island")
        .agg(F.min(order).alias("gap_start"), F.count(F.lit(1)).alias("gap_size"))
        .drop("_island")
    )


def route_for_gap(max_gap: Column) -> Column:
    """Recommended method for the longest gap of a series."""
    (limit, name), *rest = GAP_ROUTES
    expr = F.when(max_gap <= limit, name)
    for limit, name in rest:
        expr = expr.when(max_gap <= limit, name)
    return expr.otherwise(GAP_ROUTE_BEYOND)


def gap_profile(
    df: DataFrame, value: str = "price", keys: list[str] | None = None, order: str = "obs_date"
) -> DataFrame:
    """Missing share, gap counts and sizes, and the recommended method per series."""
    keys = keys or ["entity"]
    base = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), null_count(F.col(value)).alias("total_missing")
    )
    gaps = (
        gap_islands(df, value, keys, order)
        .groupBy(*keys)
        .agg(
            F.max("gap_size").alias("max_gap"),
            F.count(F.lit(1)).alias("num_gaps"),
            F.avg("gap_size").alias("avg_gap"),
            F.sort_array(F.collect_list(F.struct("gap_start", "gap_size"))).alias("_gaps"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return base.join(gaps, keys, "left").select(
        *keys,
        "total_missing",
        (F.col("total_missing") / F.col("_rows") * 100).alias("pct_missing"),
        F.coalesce("max_gap", zero).alias("max_gap"),
        F.coalesce("num_gaps", zero).alias("num_gaps"),
        F.coalesce("avg_gap", F.lit(0.0)).alias("avg_gap"),
        F.coalesce(
            F.transform("_gaps", lambda g: g["gap_size"]), F.array().cast("array<bigint>")
        ).alias("gap_sizes"),
        route_for_gap(F.coalesce("max_gap", zero)).alias("method"),
    )


def missing_grid(
    dense: DataFrame, value: str = "price", keys: list[str] | None = None, date: str = "obs_date"
) -> DataFrame:
    """0/1 indicator of a missing cell on a dense grid."""
    keys = keys or ["entity"]
    return dense.select(*keys, date, F.col(value).isNull().cast("int").alias("is_missing"))


def value_counts(df: DataFrame, label: str) -> DataFrame:
    """Frequency and share of each label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n"), total))


def range_summary(df: DataFrame, value: str = "price", date: str = "obs_date") -> DataFrame:
    return df.agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.min(date).alias("date_start"),
        F.max(date).alias("date_end"),
    )


def readiness(
    focal: DataFrame,
    comp: DataFrame,
    value: str = "price",
    entity: str = "entity",
    date: str = "obs_date",
) -> DataFrame:
    """Seven named checks of a focal and a competitor table, with score and verdict.

    The deviation checks look at the common date range, all others at the
    whole tables.  The result is one row per check.
    """
    v = F.col(value)
    ranges = [df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")) for df in (focal, comp)]
    # One row with two dates; as literals they can be pushed into every scan below.
    w = ranges[0].unionByName(ranges[1]).agg(F.max("lo").alias("lo"), F.min("hi").alias("hi")).first()
    inside = F.col(date).between(F.lit(w["lo"]), F.lit(w["hi"]))

    daily_f = focal.where(inside).groupBy(date).agg(F.avg(value).alias("f"))
    daily_c = comp.where(inside).groupBy(date).agg(F.avg(value).alias("c"))
    joint = daily_f.join(daily_c, date).agg(
        F.count(F.lit(1)).alias("days"), safe_corr(F.col("f"), F.col("c")).alias("corr")
    )

    def side(df: DataFrame, tag: str) -> DataFrame:
        fields = [
            F.count(F.lit(1)).alias(f"{tag}_rows"),
            F.count_if(v <= 0).alias(f"{tag}_invalid"),
            null_count(v).alias(f"{tag}_nulls"),
            F.stddev_samp(F.when(inside, v)).alias(f"{tag}_sd"),
        ]
        if tag == "c":
            fields.append(F.count_distinct(entity).alias("entities"))
        return df.agg(*fields)

    # Three one-row results folded into one row.
    parts = (
        side(focal, "f")
        .unionByName(side(comp, "c"), allowMissingColumns=True)
        .unionByName(joint, allowMissingColumns=True)
    )
    figures = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    # Names and limits of the checks.
    checks = {
        "sufficient_overlap": F.col("days") >= 100,
        "clean_price_data": (F.col("f_invalid") + F.col("c_invalid")) == 0,
        "missing_data_manageable": F.try_divide(F.col("c_nulls"), F.col("c_rows")) < 0.05,
        "price_variation_adequate": (F.col("f_sd") > 0) & (F.col("c_sd") > 0),
        "meaningful_correlation": F.abs("corr") > 0.2,
        "multiple_competitors": F.col("entities") >= 3,
        "instruments_available": F.lit(True),
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"), F.coalesce(cond, F.lit(False)).alias("passed")
            )
            for name, cond in checks.items()
        ]
    )
    score = F.aggregate(
        "checks", F.lit(0), lambda acc, x: acc + x["passed"].cast("int")
    ) / F.lit(len(checks))
    return (
        figures.select(rows.alias("checks"))
        .withColumn("score", score)
        .withColumn(
            "verdict",
            F.when(F.col("score") >= 0.7, "ready")
            .when(F.col("score") >= 0.5, "cautious")
            .otherwise("preparation_needed"),
        )
        .select(F.inline("checks"), "score", "verdict")
    )
