"""Correlation and lead-lag analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.functions.stats import safe_corr
from pricepanel.operators.normalise import mad_rescale


def paired_daily(
    focal: DataFrame, comp: DataFrame, value: str = "price", keys=None, date: str = "obs_date"
) -> DataFrame:
    """Daily means of both sides on their common dates: columns ``f`` and ``c``."""
    keys = keys or []
    a = focal.groupBy(*keys, date).agg(F.avg(value).alias("f"))
    b = comp.groupBy(*keys, date).agg(F.avg(value).alias("c"))
    return a.join(b, [*keys, date])


def level_corr(pairs: DataFrame, keys=None, minimum: int = 10) -> DataFrame:
    """Correlation of levels; NULL with fewer than ``minimum`` dates."""
    n = F.count(F.lit(1))
    return pairs.groupBy(*(keys or [])).agg(
        n.alias("n_dates"),
        F.when(n >= minimum, safe_corr(F.col("f"), F.col("c"))).alias("correlation"),
    )


def change_corr(pairs: DataFrame, keys=None, minimum: int = 5, date: str = "obs_date") -> DataFrame:
    """Correlation of first differences between consecutive common dates."""
    keys = keys or []
    w = Window.partitionBy(*keys).orderBy(date)
    d = pairs.select(
        *keys,
        (F.col("f") - F.lag("f").over(w)).alias("f"),
        (F.col("c") - F.lag("c").over(w)).alias("c"),
    ).where(F.col("f").isNotNull() & F.col("c").isNotNull())
    return level_corr(d, keys, minimum)


def normalised_corr(
    focal: DataFrame, comp: DataFrame, value: str = "price", date: str = "obs_date"
) -> DataFrame:
    """Correlation after rescaling the focal to the competitors' median and MAD."""
    scaled = mad_rescale(
        focal.where(F.col(value).isNotNull()), comp, value, value, out="_scaled"
    ).withColumn(value, F.col("_scaled"))
    return level_corr(paired_daily(scaled, comp, value, date=date))


def lead_lag(
    pairs: DataFrame, n: int = 5, keys=None, minimum: int = 5, date: str = "obs_date"
) -> DataFrame:
    """Correlation at shifts -n..n and the strongest of them.

    A positive lag pairs the focal ``lag`` rows earlier with today's competitor.
    All shifts come from one window sort and one aggregation.
    """
    keys = keys or []
    w = Window.partitionBy(*keys).orderBy(date)
    shifted = {f"_f{k}": F.lag("f", k).over(w) for k in range(1, n + 1)}
    shifted |= {f"_c{k}": F.lag("c", k).over(w) for k in range(1, n + 1)}
    wide = pairs.withColumns(shifted)

    def at(lag: int) -> Column:
        f = F.col(f"_f{lag}") if lag > 0 else F.col("f")
        c = F.col(f"_c{-lag}") if lag < 0 else F.col("c")
        both = f.isNotNull() & c.isNotNull()
        floor = 1 if lag == 0 else minimum
        return F.struct(
            F.lit(lag).alias("lag"),
            F.when(F.count_if(both) >= floor, safe_corr(f, c)).alias("correlation"),
        )

    span = range(-n, n + 1)
    table = wide.groupBy(*keys).agg(F.array(*[at(k) for k in span]).alias("_all"))
    # First lag wins a tie: the sort key is the negated lag at equal strength.
    best = F.array_max(
        F.transform(
            F.filter("_all", lambda r: r["correlation"].isNotNull()),
            lambda r: F.struct(F.abs(r["correlation"]).alias("a"), (-r["lag"]).alias("l")),
        )
    )
    return table.withColumn("_best", -best["l"]).select(
        *keys, F.inline("_all"), F.col("_best").alias("best_lag")
    )


def line_fit(pairs: DataFrame, keys=None) -> DataFrame:
    """Least-squares line of the focal on the competitors."""
    return pairs.groupBy(*(keys or [])).agg(
        F.regr_slope("f", "c").alias("slope"), F.regr_intercept("f", "c").alias("intercept")
    )


def availability_corr(pairs: DataFrame, availability: DataFrame, date: str = "obs_date") -> DataFrame:
    """Daily availability against focal and competitor prices."""
    joined = pairs.join(availability, date)
    a = F.col("mean_available")
    return joined.agg(
        safe_corr(a, F.col("f")).alias("focal_corr"), safe_corr(a, F.col("c")).alias("comp_corr")
    )


def segment_corr(
    focal: DataFrame,
    comp_daily: DataFrame,
    segment: str = "segment",
    value: str = "price",
    min_rows: int = 30,
    min_dates: int = 10,
    date: str = "obs_date",
) -> DataFrame:
    """Correlation of each segment's daily mean with the market (``c``), strongest first."""
    return (
        focal.groupBy(segment, date)
        .agg(F.avg(value).alias("_s"), F.count(F.lit(1)).alias("_rows"))
        .join(comp_daily, date, "left")
        .groupBy(segment)
        .agg(
            F.sum("_rows").alias("_n"),
            F.count("c").alias("n_dates"),
            safe_corr(F.col("_s"), F.col("c")).alias("correlation"),
        )
        .where((F.col("_n") >= min_rows) & (F.col("n_dates") >= min_dates))
        .drop("_n")
        .orderBy(F.abs("correlation").desc(), segment)
    )


def panel_corr(
    focal: DataFrame,
    comp: DataFrame,
    value: str = "price",
    keys=None,
    on=None,
    target: str = "base_rate",
) -> DataFrame:
    """Correlation of each competitor with the focal over common dates."""
    keys = keys or ["entity"]
    return (
        comp.join(focal, on or ["obs_date"])
        .groupBy(*keys)
        .agg(safe_corr(F.col(value), F.col(target)).alias("correlation"))
    )


def method_correlations(
    focal: DataFrame, candidates: DataFrame, methods: list[str], keys=None, on=None
) -> DataFrame:
    """Per entity the correlation of every candidate fill with the focal, in one pass.

    ``candidates`` holds the original ``price`` and one column per method.
    """
    keys = keys or ["entity"]
    y = F.col("base_rate")
    return (
        candidates.join(focal, on or ["obs_date"])
        .groupBy(*keys)
        .agg(
            safe_corr(F.col("price"), y).alias("original"),
            *[safe_corr(F.col(m), y).alias(m) for m in methods],
        )
    )


def corr_distortion(correlations: DataFrame, methods: list[str]) -> DataFrame:
    """Mean and largest absolute change of correlation per method, ranked."""
    long = correlations.unpivot(
        ["original"], [F.col(m) for m in methods], "method", "_after"
    ).withColumn("_d", F.abs(F.col("_after") - F.col("original")))
    return long.groupBy("method").agg(
        F.avg("_d").alias("mean_distortion"), F.max("_d").alias("max_distortion")
    )


def best_imputation(candidates: DataFrame, distortion: DataFrame, methods: list[str]) -> DataFrame:
    """The panel of the method with the smallest mean distortion.

    The ranking has one row per method; the winner is a scalar and the panel is
    read once, without stacking the candidates.
    """
    winner = distortion.agg(
        F.min_by("method", F.struct("mean_distortion", "method")).alias("m")
    ).scalar()
    keep = [c for c in candidates.columns if c not in methods and c != "price"]
    pick = reduce(
        lambda acc, m: acc.when(F.col("method") == m, F.col(m)), methods, F.when(F.lit(False), F.lit(None))
    )
    return candidates.withColumn("method", winner).select(*keep, "method", pick.alias("price"))


def compare_imputations(
    focal: DataFrame, candidates: DataFrame, independent: str, combined: str
) -> DataFrame:
    """Original correlation on observed cells against two complete panels."""
    y = F.col("base_rate")
    observed = F.when(F.col("price").isNotNull(), F.col("price"))
    out = (
        candidates.join(focal, "obs_date")
        .groupBy("entity")
        .agg(
            safe_corr(observed, y).alias("original"),
            safe_corr(F.col(independent), y).alias("independent"),
            safe_corr(F.col(combined), y).alias("combined"),
        )
    )
    return out.withColumns(
        {
            "independent_distortion": F.abs(F.col("original") - F.col("independent")),
            "combined_distortion": F.abs(F.col("original") - F.col("combined")),
        }
    )


def post_check(
    focal: DataFrame, comp: DataFrame, value: str = "price", target: str = "base_rate"
) -> DataFrame:
    """Focal against the market mean after cleaning, with a warning below 0.2."""
    market = comp.groupBy("obs_date").agg(F.avg(value).alias("c"))
    r = focal.join(market, "obs_date").agg(
        F.count(F.lit(1)).alias("n_dates"), safe_corr(F.col(target), F.col("c")).alias("_r")
    )
    corr = F.when(F.col("n_dates") >= 10, F.col("_r"))
    return r.select(
        "n_dates",
        corr.alias("correlation"),
        F.coalesce(F.abs(corr) < 0.2, F.lit(False)).alias("warning"),
    )


def top_features(design: DataFrame, names: DataFrame, k: int, keys: list[str] = ["focal_id"]) -> DataFrame:
    """(keys, rank, feature, correlation): the ``k`` features that correlate most with the target, by amount.

    ``design`` has (keys, y, x) and ``names`` (keys, features), named in the order of ``x``.  A feature counts
    on the rows where it is known; equal correlations (to 6 digits) go by name, features that do not vary last.
    """
    cells = design.select(*keys, "y", F.posexplode("x").alias("pos", "v"))
    known = F.col("v").isNotNull() & F.col("y").isNotNull()
    by_feature = cells.where(known).groupBy(*keys, "pos").agg(F.round(F.abs(safe_corr(F.col("v"), F.col("y"))), 6).alias("correlation"))
    feature = names.select(*keys, F.posexplode("features.feature").alias("pos", "feature"))
    first = Window.partitionBy(*keys).orderBy(F.col("correlation").desc_nulls_last(), "feature")
    ranked = by_feature.join(feature, [*keys, "pos"]).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= k).select(*keys, "rank", "feature", "correlation")
