"""Regression and inference on panels.

Pattern shared by all models: aggregate cross products in Spark, solve the tiny
systems in Arrow batches, join the coefficient table back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pricepanel.functions.calendar import INSTRUMENTS, with_instruments
from pricepanel.functions.stats import dot, stars
from pricepanel.lineage import ship, spread
from pricepanel.operators import gram as G, solve as S

DOUBLES = T.ArrayType(T.DoubleType())


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


# --- stage 1 --------------------------------------------------------------------------


def stage1_gram(panel: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    return G.column_gram(with_instruments(panel), keys, [*INSTRUMENTS, value])


def stage1(panel: DataFrame, keys: list[str] | None = None, value: str = "price") -> DataFrame:
    """Each series on the seven calendar instruments, with intercept.

    One row per series: n, k, intercept, coef, se, t_stat, p_value (arrays start
    with the intercept), rss, tss, r2.  Standard errors are NULL when the
    instruments are collinear in the sample.
    """
    keys = keys or ["entity"]
    ship(panel.sparkSession)
    grams = stage1_gram(panel, keys, value)
    schema = T.StructType(
        _key_fields(grams, keys)
        + [
            T.StructField("n", T.LongType()),
            T.StructField("k", T.IntegerType()),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("coef", DOUBLES),
            T.StructField("se", DOUBLES),
            T.StructField("t_stat", DOUBLES),
            T.StructField("p_value", DOUBLES),
            T.StructField("rss", T.DoubleType()),
            T.StructField("tss", T.DoubleType()),
        ]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rec in batch.itertuples(index=False):
                n, mean, m2 = G.unpack(rec.n, rec.mean, rec.m2)
                k = len(mean) - 1
                b0, b, rss, tss, rank = S.least_squares(n, mean, m2)
                se = t = p = None
                if rank == k and n > k + 1:
                    inverse = np.linalg.inv(S.raw_second_moment(n, mean, m2, k))
                    se = np.sqrt(rss / (n - k - 1) * np.diag(inverse))
                    with np.errstate(divide="ignore", invalid="ignore"):
                        t = np.concatenate([[b0], b]) / se
                    p = S.t_two_sided(t, n - k - 1)
                rows.append(
                    [getattr(rec, c) for c in keys] + [n, k, b0, b, se, t, p, rss, tss]
                )
            yield pd.DataFrame(rows, columns=[f.name for f in schema])

    return grams.mapInPandas(solve, schema).withColumn(
        "r2", F.when(F.col("tss") > 0, 1 - F.col("rss") / F.col("tss"))
    )


def f_statistic(r2: Column, n: Column, k: Column) -> Column:
    """F of the regression; NULL without variation or with a perfect fit."""
    return F.when(r2 < 1, F.try_divide(r2, 1 - r2) * (n - k - 1) / k)


def fit_stats(models: DataFrame) -> DataFrame:
    return models.withColumn("f_statistic", f_statistic(F.col("r2"), F.col("n"), F.col("k")))


def coef_table(models: DataFrame, keys: list[str], names: list[str] = INSTRUMENTS) -> DataFrame:
    """Long coefficient table (term, coef, se, t_stat, p_value, stars)."""
    terms = F.array(F.lit("intercept"), *[F.lit(n) for n in names])
    return models.select(
        *keys,
        F.inline(
            F.arrays_zip(
                terms.alias("term"),
                F.concat(F.array("intercept"), "coef").alias("coef"),
                F.col("se"),
                F.col("t_stat"),
                F.col("p_value"),
            )
        ),
    ).withColumn("stars", stars(F.col("p_value")))


def instrument_strength(models: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Adds the F statistic and the Strong/Weak label."""
    f = F.col("f_statistic")
    return fit_stats(models).withColumn(
        "strength", F.when(f > threshold, "Strong").when(f.isNotNull(), "Weak").otherwise("N/A")
    )


def strength_counts(strengths: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Strong and weak instruments, with the list of strong ones."""
    strong = F.col("strength") == "Strong"
    return strengths.groupBy(*(keys or [])).agg(
        F.count_if(strong).alias("n_strong"),
        F.count_if(~strong).alias("n_weak"),
        F.sort_array(F.collect_list(F.when(strong, F.col("entity")))).alias("strong"),
    )


def residuals(
    panel: DataFrame, models: DataFrame, keys: list[str] | None = None, value: str = "price"
) -> DataFrame:
    """(keys, obs_date, price, residual): the part of each price the calendar does not explain."""
    keys = keys or ["entity"]
    z = F.array(*[F.col(c).cast("double") for c in INSTRUMENTS])
    return (
        with_instruments(panel)
        .join(models.select(*keys, "intercept", "coef"), keys)
        .select(
            *keys,
            "obs_date",
            F.col(value).alias("price"),
            (F.col(value) - F.col("intercept") - dot(F.col("coef"), z)).alias("residual"),
        )
    )


def residual_summary(resid: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return resid.groupBy(*(keys or ["entity"])).agg(
        F.avg("residual").alias("mean"),
        F.stddev_samp("residual").alias("std"),
        F.count("residual").alias("n"),
    )


def coef_summary(table: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean and deviation of each coefficient across entities."""
    return (
        table.where(F.col("term") != "intercept")
        .groupBy(*(keys or []), "term")
        .agg(F.avg("coef").alias("mean_coef"), F.stddev_samp("coef").alias("std_coef"))
    )


# --- stage 2 --------------------------------------------------------------------------


def stage2_design(
    focal: DataFrame, resid: DataFrame, keys: list[str] | None = None, target: str = "base_rate"
) -> DataFrame:
    """(keys, obs_date, entities, x, y) with x = [prices | residuals | instruments]."""
    keys = keys or ["focal_id"]
    side = resid.groupBy(*keys, "obs_date").agg(
        F.sort_array(F.collect_list(F.struct("entity", "price", "residual"))).alias("_c")
    )
    z = F.array(*[F.col(c).cast("double") for c in INSTRUMENTS])
    return with_instruments(focal.join(side, [*keys, "obs_date"])).select(
        *keys,
        "obs_date",
        F.col("_c.entity").alias("entities"),
        F.concat(F.col("_c.price"), F.col("_c.residual"), z).alias("x"),
        F.col(target).alias("y"),
    )


def stage2(design: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Two-stage residual inclusion per focal, one row each.

    Prices, their stage-1 residuals and the instruments are linearly dependent,
    so only beta + theta is determined.  The minimum-norm split is reported
    (``coef``), together with the rank; ``coef_ols`` is the model without
    residuals, whose fit is the same.  ``p_value`` uses n - columns - 1 degrees
    of freedom, ``p_value_rank`` n - rank - 1.
    """
    keys = keys or ["focal_id"]
    vectors = design.withColumn("_v", F.concat("x", F.array("y")))
    partials = G.vector_gram(vectors, keys, "_v")
    schema = T.StructType(
        _key_fields(partials, keys)
        + [
            T.StructField("n", T.LongType()),
            T.StructField("n_columns", T.IntegerType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("coef", DOUBLES),
            T.StructField("se", DOUBLES),
            T.StructField("t_stat", DOUBLES),
            T.StructField("p_value", DOUBLES),
            T.StructField("p_value_rank", DOUBLES),
            T.StructField("rss", T.DoubleType()),
            T.StructField("tss", T.DoubleType()),
            T.StructField("intercept_ols", T.DoubleType()),
            T.StructField("coef_ols", DOUBLES),
            T.StructField("rss_ols", T.DoubleType()),
        ]
    )
    n_z = len(INSTRUMENTS)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, m2 = G.merge(
            G.unpack(r.n, r.mean, r.m2) for r in pdf.itertuples(index=False)
        )
        k = len(mean) - 1
        c = (k - n_z) // 2
        b0, b, rss, tss, rank = S.least_squares(n, mean, m2)
        ols_cols = np.r_[np.arange(c), np.arange(2 * c, k)]
        o0, o, rss_ols, _, _ = S.least_squares(n, mean, m2, ols_cols)
        inverse, _ = S.pseudo_inverse(S.raw_second_moment(n, mean, m2, k))
        se = t = p = p_rank = None
        if n > k + 1:
            full = np.concatenate([[b0], b])
            diag = np.clip(np.diag(inverse), 0, None)
            with np.errstate(divide="ignore", invalid="ignore"):
                se = np.sqrt(rss / (n - k - 1) * diag)
                t = full / se
                t_rank = full / np.sqrt(rss / (n - rank - 1) * diag)
            p = S.t_two_sided(t, n - k - 1)
            p_rank = S.t_two_sided(t_rank, n - rank - 1)
        row = [pdf[x].iloc[0] for x in keys] + [n, k, rank, b0, b, se, t, p, p_rank, rss, tss]
        row += [o0, o, rss_ols]
        return pd.DataFrame([row], columns=[f.name for f in schema])

    return spread(partials, keys).groupBy(*keys).applyInPandas(solve, schema)


def stage2_terms(models: DataFrame, design: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per term: kind (intercept, beta, theta, gamma), name, estimate, inference.

    ``beta_plus_theta`` repeats the identified sum on the beta and theta rows and
    ``identified`` says whether the single estimate is determined by the data.
    """
    keys = keys or ["focal_id"]
    names = design.groupBy(*keys).agg(F.first("entities").alias("entities"))
    joined = models.join(names, keys)
    described = F.concat(
        F.array(F.struct(F.lit("intercept").alias("kind"), F.lit("intercept").alias("name"))),
        F.transform("entities", lambda e: F.struct(F.lit("beta").alias("kind"), e.alias("name"))),
        F.transform("entities", lambda e: F.struct(F.lit("theta").alias("kind"), e.alias("name"))),
        F.array(
            *[F.struct(F.lit("gamma").alias("kind"), F.lit(z).alias("name")) for z in INSTRUMENTS]
        ),
    )
    long = joined.select(
        *keys,
        (F.col("rank") == F.col("n_columns")).alias("_full"),
        F.inline(
            F.arrays_zip(
                described.alias("d"),
                F.concat(F.array("intercept"), "coef").alias("coef"),
                F.col("se"),
                F.col("t_stat"),
                F.col("p_value"),
            )
        ),
    ).select(*keys, "_full", "d.kind", "d.name", "coef", "se", "t_stat", "p_value")
    pair = Window.partitionBy(*keys, "name")
    return long.withColumns(
        {
            "stars": stars(F.col("p_value")),
            "identified": F.col("_full"),
            "beta_plus_theta": F.when(
                F.col("kind").isin("beta", "theta"), F.sum("coef").over(pair)
            ),
        }
    ).drop("_full")


def endogeneity(terms: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Verdict per residual term."""
    return terms.where(F.col("kind") == "theta").withColumn(
        "verdict", F.when(F.col("p_value") < alpha, "ENDOGENOUS").otherwise("exogenous")
    )


def endogeneity_counts(verdicts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return verdicts.groupBy(*(keys or ["focal_id"])).agg(
        F.count_if(F.col("verdict") == "ENDOGENOUS").alias("n_endogenous"),
        F.count(F.lit(1)).alias("n_tested"),
        (F.count_if(F.col("verdict") == "ENDOGENOUS") > 0).alias("endogeneity_detected"),
    )


def compare_fit(models: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """R2 and RMSE with and without residuals."""
    r2 = lambda rss: F.when(F.col("tss") > 0, 1 - F.col(rss) / F.col("tss"))
    return models.select(
        *(keys or ["focal_id"]),
        r2("rss").alias("r2_2sri"),
        r2("rss_ols").alias("r2_ols"),
        F.sqrt(F.col("rss") / F.col("n")).alias("rmse_2sri"),
        F.sqrt(F.col("rss_ols") / F.col("n")).alias("rmse_ols"),
        (r2("rss") - r2("rss_ols")).alias("r2_difference"),
    )


def effects(terms: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Total effect with its strategy label and the dominant competitor."""
    return (
        terms.where(F.col("kind") == "beta")
        .groupBy(*(keys or ["focal_id"]))
        .agg(
            F.sum("coef").alias("total_effect"),
            F.max_by(F.struct("name", "coef"), F.struct(F.abs("coef"), "name")).alias("_d"),
        )
        .withColumn(
            "strategy",
            # Limits and labels.
            F.when(F.col("total_effect") > 0.1, "COMPLEMENTARY")
            .when(F.col("total_effect") < -0.1, "COMPETITIVE")
            .otherwise("NEUTRAL"),
        )
        .withColumns({"dominant": F.col("_d.name"), "dominant_coef": F.col("_d.coef")})
        .drop("_d")
    )


def effect_labels(terms: DataFrame) -> DataFrame:
    """Sign and magnitude words of every competitor coefficient."""
    # Limits and words.
    size = F.abs("coef")
    return terms.where(F.col("kind") == "beta").withColumns(
        {
            "direction": F.when(F.col("coef") > 0, "Complementary").otherwise("Competitive"),
            "magnitude": F.when(size > 0.5, "Strong").when(size > 0.1, "Moderate").otherwise("Weak"),
        }
    )


def temporal_effects(terms: DataFrame) -> DataFrame:
    """Instrument terms that are large (> 0.5) or significant at 5 %."""
    return terms.where(
        (F.col("kind") == "gamma")
        & ((F.abs("coef") > 0.5) | F.coalesce(F.col("p_value") < 0.05, F.lit(False)))
    ).withColumn("direction", F.when(F.col("coef") > 0, "Positive").otherwise("Negative"))


def predictions(design: DataFrame, models: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, obs_date, actual, predicted_2sri, predicted_ols, residual)."""
    keys = keys or ["focal_id"]
    n_z = len(INSTRUMENTS)
    n_c = (F.size("x") - n_z) / 2
    x_ols = F.concat(
        F.slice("x", F.lit(1), n_c.cast("int")), F.slice("x", F.size("x") - n_z + 1, F.lit(n_z))
    )
    coefs = models.select(*keys, "intercept", "coef", "intercept_ols", "coef_ols")
    return (
        design.join(coefs, keys)
        .select(
            *keys,
            "obs_date",
            F.col("y").alias("actual"),
            (F.col("intercept") + dot(F.col("coef"), F.col("x"))).alias("predicted_2sri"),
            (F.col("intercept_ols") + dot(F.col("coef_ols"), x_ols)).alias("predicted_ols"),
        )
        .withColumn("residual", F.col("actual") - F.col("predicted_2sri"))
    )


def residual_diagnostics(
    pred: DataFrame, keys: list[str] | None = None, residual: str = "residual"
) -> DataFrame:
    """Mean, population deviation, Durbin-Watson and the two warnings."""
    keys = keys or ["focal_id"]
    e = F.col(residual)
    step = e - F.lag(residual).over(Window.partitionBy(*keys).orderBy("obs_date"))
    return (
        pred.withColumn("_step", step)
        .groupBy(*keys)
        .agg(
            F.avg(e).alias("mean"),
            F.stddev_pop(e).alias("std"),
            F.try_divide(F.sum(F.col("_step") * F.col("_step")), F.sum(e * e)).alias("durbin_watson"),
        )
        .withColumns(
            {
                "mean_warning": F.abs("mean") > 0.01,
                "serial_warning": (F.col("durbin_watson") < 1.5) | (F.col("durbin_watson") > 2.5),
            }
        )
    )


def equation(intercept: Column, terms: Column, limit: int | None = None) -> Column:
    """``1.234 +0.5000×name*** ...`` from an array of (feature, coef, p_value) structs.

    ``limit`` counts the intercept as the first term.
    """
    written = F.transform(
        terms,
        lambda t: F.concat(
            F.when(t["coef"] >= 0, "+").otherwise(""),
            F.format_string("%.4f", t["coef"]),
            F.lit("×"),
            t["feature"],
            stars(t["p_value"]),
        ),
    )
    parts = F.concat(F.array(F.format_string("%.3f", intercept)), written)
    if limit is not None:
        parts = F.slice(parts, 1, limit)
    return F.array_join(parts, " ")


def exclude(registry: DataFrame, ids: list[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """(kept registry, one summary row per excluded focal that is registered)."""
    hit = F.col("focal_id").isin(ids)
    return registry.where(~hit), registry.where(hit).withColumn(
        "status", F.lit(f"Excluded: {reason}")
    )
