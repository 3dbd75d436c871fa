"""Quality of an imputation: missing counts, distribution shift, grade, roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.functions.stats import exact_kolmogorov_p, kolmogorov_p, null_count
from pricepanel.lineage import cut, ship
from pricepanel.operators.align import semi_align, top_k
from pricepanel.operators.quantile import exact_quantiles, ks_two_sample


def missing_delta(
    pre: DataFrame, post: DataFrame, keys: list[str], value: str = "price"
) -> DataFrame:
    """NULLs before and after; both shares divide by the rows before."""
    a = pre.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cells"), null_count(F.col(value)).alias("missing_before")
    )
    b = post.groupBy(*keys).agg(null_count(F.col(value)).alias("missing_after"))
    return a.join(b, keys).withColumns(
        {
            "pct_missing": F.col("missing_before") / F.col("total_cells") * 100,
            "pct_missing_after": F.col("missing_after") / F.col("total_cells") * 100,
            "n_imputed": F.col("missing_before") - F.col("missing_after"),
        }
    )


def stacked(pre: DataFrame, post: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """Both samples in one table; ``is_pre`` tells them apart."""
    cols = [*keys, value]
    return pre.select(*cols, F.lit(True).alias("is_pre")).unionByName(
        post.select(*cols, F.lit(False).alias("is_pre"))
    )


def dist_delta(
    pre: DataFrame, post: DataFrame, keys: list[str], value: str = "price"
) -> DataFrame:
    """Mean, sample deviation, median, minimum and maximum before, after and their change."""
    both = stacked(pre, post, keys, value)
    v = F.col(value)

    def side(flag: Column, tag: str) -> list[Column]:
        x = F.when(flag, v)
        return [
            F.avg(x).alias(f"{tag}_mean"),
            F.stddev_samp(x).alias(f"{tag}_std"),
            F.min(x).alias(f"{tag}_min"),
            F.max(x).alias(f"{tag}_max"),
        ]

    moments = both.groupBy(*keys).agg(*side(F.col("is_pre"), "pre"), *side(~F.col("is_pre"), "post"))
    medians = (
        exact_quantiles(both, value, {"m": 0.5}, [*keys, "is_pre"])
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("is_pre"), F.col("m"))).alias("pre_median"),
            F.max(F.when(~F.col("is_pre"), F.col("m"))).alias("post_median"),
        )
    )
    return moments.join(medians, keys).withColumns(
        {
            f"{s}_delta": F.col(f"post_{s}") - F.col(f"pre_{s}")
            for s in ("mean", "std", "median")
        }
    )


def ks_2samp(
    pre: DataFrame, post: DataFrame, keys: list[str], value: str = "price", exact: bool = False
) -> DataFrame:
    """KS statistic, p-value (asymptotic, or exact by counting lattice paths) and the 5 % verdict per group."""
    out = ks_two_sample(stacked(pre, post, keys, value), value, "is_pre", keys)
    if exact:
        ship(pre.sparkSession)
    by = exact_kolmogorov_p if exact else kolmogorov_p
    p = by(F.col("ks_statistic"), F.col("n_first"), F.col("n_second"))
    return out.withColumn("ks_pvalue", p).withColumn("ks_significant", F.col("ks_pvalue") <= 0.05)


def validate_imputation(
    pre: DataFrame,
    post: DataFrame,
    keys: list[str],
    value: str = "price",
    on: tuple[str, ...] | None = ("obs_date", "entity"),
    exact: bool = False,
) -> DataFrame:
    """One graded row per group: missing counts, distribution deltas, KS test, grade."""
    if on:
        pre, post = semi_align(pre, post, on)
    # Both samples are read by four aggregations, so they are written once.
    both = cut(stacked(pre, post, keys, value))
    pre, post = both.where("is_pre"), both.where("NOT is_pre")
    out = (
        missing_delta(pre, post, keys, value)
        .join(dist_delta(pre, post, keys, value), keys)
        .join(ks_2samp(pre, post, keys, value, exact), keys)
    )
    return grade(out)


def grade(report: DataFrame) -> DataFrame:
    """Issue and warning texts, quality word and score.

    No issue scores 5 whatever the warnings; one issue 4 without and 3 with a
    warning; more issues 2.
    """
    # Limits and the wording of issues and warnings.
    limit = F.col("pre_std") * 0.1
    shifted = F.abs("mean_delta") > limit
    issues = F.array_compact(
        F.array(
            F.when(
                shifted,
                F.format_string(
                    "Mean shifted by $%+.2f (%+.1f%%)",
                    F.col("mean_delta"),
                    F.try_divide(F.col("mean_delta"), F.col("pre_mean")) * 100,
                ),
            ),
            F.when(
                ~(F.col("ks_pvalue") > 0.05),
                F.format_string("Distribution changed (KS p = %.4f)", F.col("ks_pvalue")),
            ),
            F.when(
                (F.col("missing_after") > 0)
                & (F.col("missing_after") >= F.col("missing_before")),
                F.lit("Missing values not reduced"),
            ),
        )
    )
    warnings = F.array_compact(
        F.array(
            F.when(
                F.abs("std_delta") > limit,
                F.format_string(
                    "Std dev changed by %+.1f%%",
                    F.try_divide(F.col("std_delta"), F.col("pre_std")) * 100,
                ),
            )
        )
    )
    n_i, n_w = F.size("issues"), F.size("warnings")
    score = F.when(n_i == 0, 5).when((n_i == 1) & (n_w == 0), 4).when(n_i == 1, 3).otherwise(2)
    return (
        report.withColumns({"issues": issues, "warnings": warnings})
        .withColumn("quality_score", score)
        .withColumn(
            "quality",
            F.when(F.col("quality_score") == 5, "EXCELLENT")
            .when(F.col("quality_score") == 4, "GOOD")
            .when(F.col("quality_score") == 3, "FAIR")
            .otherwise("POOR"),
        )
    )


def quality_shares(report: DataFrame) -> DataFrame:
    """Count and share of every grade, absent grades included as zero."""
    # The grades.
    labels = ["EXCELLENT", "GOOD", "FAIR", "POOR"]
    return report.agg(
        F.count(F.lit(1)).alias("_t"),
        F.array(
            *[
                F.struct(F.lit(q).alias("quality"), F.count_if(F.col("quality") == q).alias("n"))
                for q in labels
            ]
        ).alias("_q"),
    ).select("_t", F.inline("_q")).select(
        "quality", "n", F.coalesce(F.try_divide(F.col("n") * 100, F.col("_t")), F.lit(0.0)).alias("pct")
    )


def quality_summary(report: DataFrame, bias: float = 10.0) -> DataFrame:
    """Portfolio figures: missing share, mean shift, groups with bias beyond +-``bias``."""
    return report.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg("pct_missing").alias("mean_pct_missing"),
        F.median("pct_missing").alias("median_pct_missing"),
        F.avg("mean_delta").alias("mean_of_mean_delta"),
        F.median("mean_delta").alias("median_of_mean_delta"),
        F.count_if(F.col("mean_delta") < -bias).alias("n_negative_bias"),
        F.count_if(F.col("mean_delta") > bias).alias("n_positive_bias"),
    )


def best_and_worst(report: DataFrame, key: str, k: int = 5) -> DataFrame:
    best = top_k(report, k, "quality_score", key).withColumn("list", F.lit("best"))
    worst = top_k(report, k, "quality_score", key, ascending=True).withColumn("list", F.lit("worst"))
    return best.unionByName(worst)


# --- correlation matrix preservation ------------------------------------------------------


def pair_correlations(rows: DataFrame) -> DataFrame:
    """(focal_id, i, j, correlation) over pairwise complete cells of row vectors.

    Cross products per (focal, missing pattern) hold everything needed: a pair's
    statistics add up over the patterns in which both cells exist.
    """
    from pricepanel.operators.matrix import pattern_gram

    at = lambda a, i: F.get(a, i)
    p = F.size("mean")
    cells = (
        pattern_gram(rows)
        .select("focal_id", "pattern", "n", "mean", "m2", p.alias("_p"), F.posexplode("m2").alias("_at", "c"))
        .select(
            "focal_id",
            "n",
            "c",
            F.floor(F.col("_at") / F.col("_p")).cast("int").alias("i"),
            (F.col("_at") % F.col("_p")).alias("j"),
            "mean",
            "pattern",
            "m2",
            "_p",
        )
        .where(
            (F.substring("pattern", F.col("i") + 1, F.lit(1)) == "0")
            & (F.substring("pattern", F.col("j") + 1, F.lit(1)) == "0")
        )
        .select(
            "focal_id",
            "i",
            "j",
            "n",
            at(F.col("mean"), F.col("i")).alias("mi"),
            at(F.col("mean"), F.col("j")).alias("mj"),
            "c",
            at(F.col("m2"), F.col("i") * (F.col("_p") + 1)).alias("ci"),
            at(F.col("m2"), F.col("j") * (F.col("_p") + 1)).alias("cj"),
        )
    )
    # Means are shifted by the pair's first pattern before squaring to keep digits.
    w = Window.partitionBy("focal_id", "i", "j")
    shifted = cells.withColumns(
        {"mi": F.col("mi") - F.min("mi").over(w), "mj": F.col("mj") - F.min("mj").over(w)}
    )
    s = lambda e: F.sum(e)
    n, mi, mj = F.col("n"), F.col("mi"), F.col("mj")
    agg = shifted.groupBy("focal_id", "i", "j").agg(
        s(n).alias("n"),
        s(n * mi).alias("si"),
        s(n * mj).alias("sj"),
        s(F.col("c") + n * mi * mj).alias("sij"),
        s(F.col("ci") + n * mi * mi).alias("sii"),
        s(F.col("cj") + n * mj * mj).alias("sjj"),
    )
    cov = F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    vi = F.col("sii") - F.col("si") * F.col("si") / F.col("n")
    vj = F.col("sjj") - F.col("sj") * F.col("sj") / F.col("n")
    return agg.select(
        "focal_id",
        "i",
        "j",
        F.when((F.col("n") > 1) & (vi > 0) & (vj > 0), F.try_divide(cov, F.sqrt(vi) * F.sqrt(vj))).alias(
            "correlation"
        ),
    )


def corr_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Percent of the correlation structure kept: 100 (1 - mean over columns of the column's
    mean absolute change), valid cells only, diagonal included."""
    b = pair_correlations(before).withColumnRenamed("correlation", "_b")
    a = pair_correlations(after).withColumnRenamed("correlation", "_a")
    per_column = (
        b.join(a, ["focal_id", "i", "j"])
        .groupBy("focal_id", "j")
        .agg(F.avg(F.abs(F.col("_b") - F.col("_a"))).alias("_d"))
    )
    return per_column.groupBy("focal_id").agg(
        ((1 - F.avg("_d")) * 100).alias("correlation_preserved_pct")
    )
