"""Validation queries.

The fold layout, scoring and summary operators are checked in SQL on a naive
forecast (mean of the previous 30 rows); the lasso and OLS fits themselves are
checked against numpy in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.catalog.correlate import region_pairs
from pricepanel.catalog.features import vectors
from pricepanel.operators import features as X, matrix as M, normalise as N, validate as V
from pricepanel.plans import portfolio as P
from pricepanel.sources import adapters as A

view(
    "numbered",
    ["portfolio"],
    """SELECT *, row_number() OVER (PARTITION BY focal_id ORDER BY obs_date) - 1 AS rn,
       count(*) OVER (PARTITION BY focal_id) AS n FROM portfolio""",
)


@query(
    "i1_expanding_splits",
    sql="""SELECT focal_id, CAST(fold AS INTEGER) AS fold, 300 + 50 * (fold - 1) AS train_rows,
        min(obs_date) AS test_start, max(obs_date) AS test_end FROM (
          SELECT *, (rn - 300) // 50 + 1 AS fold FROM numbered WHERE rn >= 300)
        WHERE fold <= (n - 300) // 50 GROUP BY ALL""",
    uses=["numbered"],
)
def expanding_splits(spark, root):
    return V.expanding_splits(A.portfolio(spark, root))


view(
    "naive",
    ["numbered"],
    """SELECT focal_id, obs_date, base_rate AS y, y_hat, CAST((rn - 300) // 50 + 1 AS INTEGER) AS fold FROM (
         SELECT *, avg(base_rate) OVER (PARTITION BY focal_id ORDER BY obs_date
                   ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS y_hat FROM numbered)
       WHERE rn >= 300 AND (rn - 300) // 50 + 1 <= (n - 300) // 50""",
)
view(
    "naive_scores",
    ["naive"],
    """SELECT focal_id, fold, count(*) AS n,
         CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - y_hat) ** 2) / (var_pop(y) * count(*)) ELSE -999 END AS r2,
         sqrt(sum((y - y_hat) ** 2) / count(*)) AS rmse,
         CASE WHEN count(*) FILTER (y = 0) = 0 THEN avg(abs((y - y_hat) / y)) * 100 END AS mape,
         var_pop(y) = 0 OR count(*) FILTER (y = 0) > 0 AS degenerate FROM naive GROUP BY 1, 2""",
)


def naive_scores(spark, root):
    """The trend that leaves the current row out, used as forecast."""
    rows = V.numbered(A.portfolio(spark, root)).withColumn(
        "fold", V.test_fold(F.col("rn"), F.col("n"))
    )
    trend = N.trend("base_rate", ["focal_id"], "obs_date", 30, shift=1)
    pred = rows.withColumn("y_hat", trend).where(F.col("fold").isNotNull())
    return V.metrics(pred.withColumnRenamed("base_rate", "y"), ["focal_id", "fold"])


@query(
    "h18_metrics",
    sql="""SELECT focal_id, fold, n, round(r2, 5) AS r2, round(rmse, 3) AS rmse, round(mape, 4) AS mape, degenerate
        FROM naive_scores""",
    uses=["naive_scores"],
)
def metrics(spark, root):
    return naive_scores(spark, root).withColumns(
        {"r2": F.round("r2", 5), "rmse": F.round("rmse", 3), "mape": F.round("mape", 4)}
    )


@query(
    "h18_metrics_insample",
    sql="""SELECT focal_id, count(*) AS n, round(1 - sum((f - h) ** 2) / (var_pop(f) * count(*)), 5) AS r2,
        round(1 - (sum((f - h) ** 2) / (var_pop(f) * count(*))) * (count(*) - 1) / (count(*) - 2), 5) AS adj_r2,
        round(sqrt(avg((f - h) ** 2)), 3) AS rmse, round(avg(abs(f - h) / greatest(abs(f), 2.2e-16)) * 100, 4) AS mape
        FROM (SELECT p.focal_id, f, b + s * c AS h FROM region_pairs p JOIN (SELECT focal_id,
            regr_slope(f, c) AS s, regr_intercept(f, c) AS b FROM region_pairs GROUP BY 1) l USING (focal_id))
        GROUP BY 1""",
    uses=["region_pairs"],
)
def metrics_insample(spark, root):
    """In-sample scores of every focal's one-regressor line."""
    p = region_pairs(spark, root)
    line = p.groupBy("focal_id").agg(
        F.regr_slope("f", "c").alias("s"), F.regr_intercept("f", "c").alias("b")
    )
    pred = p.join(line, "focal_id").select(
        "focal_id", F.col("f").alias("y"), (F.col("b") + F.col("s") * F.col("c")).alias("y_hat")
    )
    out = V.metrics(pred, ["focal_id"], "insample")
    return out.select(
        "focal_id",
        "n",
        F.round("r2", 5).alias("r2"),
        F.round(V.adjusted_r2(F.col("r2"), F.col("n"), F.lit(1)), 5).alias("adj_r2"),
        F.round("rmse", 3).alias("rmse"),
        F.round("mape", 4).alias("mape"),
    )


view(
    "naive_cv",
    ["naive_scores"],
    """SELECT focal_id, count(*) AS cv_folds, avg(r2) AS mean_r2, stddev_pop(r2) AS std_r2, min(r2) AS min_r2,
       max(r2) AS max_r2, avg(mape) AS mean_mape, avg(rmse) AS mean_rmse, bool_or(degenerate) AS degenerate,
       CASE WHEN avg(r2) > 0.20 THEN 'GOOD' ELSE 'POOR' END AS quality FROM naive_scores GROUP BY 1""",
)


@query(
    "i4_cv_summary",
    sql="""SELECT focal_id, cv_folds, round(mean_r2, 5) AS mean_r2, round(std_r2, 5) AS std_r2,
        round(min_r2, 5) AS min_r2, round(max_r2, 5) AS max_r2, round(mean_mape, 4) AS mean_mape,
        round(mean_rmse, 3) AS mean_rmse, degenerate, quality FROM naive_cv""",
    uses=["naive_cv"],
)
def cv_summary(spark, root):
    out = V.cv_summary(naive_scores(spark, root))
    digits = {"mean_r2": 5, "std_r2": 5, "min_r2": 5, "max_r2": 5, "mean_mape": 4, "mean_rmse": 3}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


def naive_summary(spark, root):
    cv = V.cv_summary(naive_scores(spark, root))
    return A.registry(spark, root).join(cv, "focal_id", "left").select(
        "focal_id",
        (F.col("mean_r2") + 0.4).alias("cv_mean_r2"),
        F.col("max_r2").alias("final_training_r2"),
        F.when(F.col("mean_r2").isNotNull(), "Success").otherwise("Skipped: no fold").alias("status"),
    )


@query(
    "i6_portfolio_summary",
    sql="""SELECT count(*) AS n_total, count(mean_r2) AS n_success, round(avg(mean_r2 + 0.4), 5) AS mean_score,
        round(median(mean_r2 + 0.4), 5) AS median_score, round(avg(max_r2), 5) AS mean_training_r2
        FROM registry LEFT JOIN naive_cv USING (focal_id)""",
    uses=["registry", "naive_cv"],
)
def portfolio_summary(spark, root):
    """Scores are lifted by 0.4 so that the naive forecasts spread over all bands."""
    out = V.portfolio_summary(naive_summary(spark, root))
    return out.select(
        "n_total",
        "n_success",
        *[F.round(c, 5).alias(c) for c in ("mean_score", "median_score", "mean_training_r2")],
    )


@query(
    "i7_bands",
    sql="""SELECT CASE WHEN s > 0.40 THEN 'Excellent' WHEN s >= 0.25 THEN 'Good' WHEN s >= 0.15 THEN 'Acceptable'
        ELSE 'Poor' END AS band, count(*) AS n FROM (SELECT mean_r2 + 0.4 AS s FROM naive_cv) GROUP BY 1""",
    uses=["naive_cv"],
)
def bands(spark, root):
    return V.bands(naive_summary(spark, root))


@query(
    "i8_gates",
    sql="""SELECT focal_id, CASE WHEN n IS NULL THEN 'Skipped: no data'
          WHEN usd = 0 THEN 'Skipped: no competitor features'
          WHEN n - 5 < 350 THEN 'Skipped: not enough data for a fold' ELSE 'ready' END AS status
        FROM registry LEFT JOIN (SELECT focal_id, count(*) AS n FROM focal_dates GROUP BY 1) USING (focal_id)
        LEFT JOIN (SELECT focal_id, count(*) FILTER (currency = 'USD') AS usd FROM focal_columns GROUP BY 1)
        USING (focal_id)""",
    uses=["registry", "focal_columns"],
)
def gates(spark, root):
    return V.gates(A.registry(spark, root), X.oos_design(vectors(spark, root)))


def completed(spark, root):
    return P.completed_rows(A.portfolio(spark, root), A.region_panel(spark, root))


@query("h16_lasso_cv")
def lasso_cv(spark, root):
    """Selected features of the whole-series fit of every focal."""
    rows = M.clip_rows(M.iterative_impute(vectors(spark, root)))
    models = V.fit_folds(X.oos_design(rows).where("n_comp > 0"), outer=False)
    return models.select("focal_id", "alpha", "selected", "n_train", "training_r2", "status")


@query("h17_ols_hc1")
def ols_hc1(spark, root):
    from pricepanel.lineage import cut

    design = X.insample_design(completed(spark, root))
    models = cut(V.fit_folds(design, 50, limit=1e-10, fallback=5, outer=False))
    return V.ols_hc1(design, models)


@query("h17_insample_records")
def insample_records(spark, root):
    return P.insample(completed(spark, root))


@query("h19_insample_portfolio")
def insample_portfolio(spark, root):
    return V.insample_portfolio(P.insample(completed(spark, root)))


@query("i2_cv_direct")
def cv_direct(spark, root):
    return P.oos_direct(completed(spark, root), A.registry(spark, root))["scores"]


@query("i2_cv_direct_summary")
def cv_direct_summary(spark, root):
    return P.oos_direct(completed(spark, root), A.registry(spark, root))["summary"]


@query("i3_cv_detrended")
def cv_detrended(spark, root):
    return P.oos_detrended(completed(spark, root), A.registry(spark, root))["scores"]


@query("i3_cv_detrended_summary")
def cv_detrended_summary(spark, root):
    return P.oos_detrended(completed(spark, root), A.registry(spark, root))["summary"]


@query("i5_final_fit")
def final_fit(spark, root):
    design = X.oos_design(completed(spark, root)).where("n_comp > 0")
    return V.final_fit(V.fit_folds(design, outer=False))
