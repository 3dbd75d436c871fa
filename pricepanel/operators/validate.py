"""Feature selection, in-sample fits and expanding-window validation for many focals.

Input is a design table ``(focal_id, obs_date, y, x)`` with complete ``x``.
All training sets of a focal (outer windows, their five inner folds, the whole
series and its folds) are unions of contiguous row blocks.  Cross products per
block are aggregated once; every fit is then a sum of blocks, so the rows are
scanned once for all folds and once more to score the test rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pricepanel.functions.stats import dot, stars
from pricepanel.lineage import cut, spread
from pricepanel.operators import gram as G, solve as S
from pricepanel.operators.normalise import detrend, retrend
from pricepanel.operators.regress import equation

# Window layout and lasso grid of the published protocol.
MIN_TRAIN = 300
TEST_WINDOW = 50
INNER_FOLDS = 5
DEGENERATE_R2 = -999.0

DOUBLES = T.ArrayType(T.DoubleType())


def alpha_grid(n: int) -> np.ndarray:
    """Penalties from 10 down to 1e-4, strongest first."""
    return np.logspace(1, -4, n)


# --- layout ---------------------------------------------------------------------------


def numbered(df: DataFrame) -> DataFrame:
    """Adds ``rn`` (0-based row number by date) and ``n`` per focal."""
    w = Window.partitionBy("focal_id")
    return df.withColumns(
        {
            "rn": (F.row_number().over(w.orderBy("obs_date")) - 1).cast("int"),
            "n": F.count(F.lit(1)).over(w).cast("int"),
        }
    )


def fold_count(n: Column, min_train: int = MIN_TRAIN, window: int = TEST_WINDOW) -> Column:
    return F.greatest(F.floor((n - min_train) / window), F.lit(0)).cast("int")


def test_fold(
    rn: Column, n: Column, min_train: int = MIN_TRAIN, window: int = TEST_WINDOW
) -> Column:
    """1-based fold in which a row is tested; NULL for rows that never are."""
    fold = F.floor((rn - min_train) / window).cast("int") + 1
    return F.when((rn >= min_train) & (fold <= fold_count(n, min_train, window)), fold)


def expanding_splits(
    df: DataFrame, min_train: int = MIN_TRAIN, window: int = TEST_WINDOW
) -> DataFrame:
    """(focal_id, fold, train_rows, test_start, test_end) of every complete window."""
    fold = test_fold(F.col("rn"), F.col("n"), min_train, window)
    return (
        numbered(df.select("focal_id", "obs_date"))
        .withColumn("fold", fold)
        .where(F.col("fold").isNotNull())
        .groupBy("focal_id", "fold")
        .agg(F.min("obs_date").alias("test_start"), F.max("obs_date").alias("test_end"))
        .select(
            "focal_id",
            "fold",
            (F.col("fold") * window + (min_train - window)).cast("bigint").alias("train_rows"),
            "test_start",
            "test_end",
        )
    )


def _inner_fold(rn: Column, n: Column, k: int = INNER_FOLDS) -> Column:
    """Contiguous fold of the whole series: the first n mod k folds hold one row more."""
    small = F.floor(n / k)
    extra = n % k
    head = extra * (small + 1)
    return (
        F.when(rn < head, F.floor(rn / (small + 1)))
        .otherwise(extra + F.floor((rn - head) / F.greatest(small, F.lit(1))))
        .cast("int")
    )


def inner_bounds(n: int, k: int = INNER_FOLDS) -> list[int]:
    """Row numbers where the ``k`` contiguous folds of ``n`` rows begin and end; the first n mod k are longer."""
    small, extra = divmod(n, k)
    return [j * small + min(j, extra) for j in range(k + 1)]


def block_size(min_train: int, window: int) -> int:
    """Most rows per block so that every inner fold of every expanding window is whole blocks."""
    if min_train % INNER_FOLDS or window % INNER_FOLDS:
        return 1
    return math.gcd(min_train // INNER_FOLDS, window // INNER_FOLDS)


def block_gram(
    design: DataFrame, block: int | None = block_size(MIN_TRAIN, TEST_WINDOW)
) -> DataFrame:
    """Cross products of [x..., y] per focal and fold of the whole series, and per block of so many rows.

    Without ``block`` there are five partials per focal, however long the series.
    """
    rows = numbered(design)
    number = F.floor(F.col("rn") / block).cast("int") if block else F.lit(0)
    keyed = rows.select(
        "focal_id",
        number.alias("block"),
        _inner_fold(F.col("rn"), F.col("n")).alias("fold5"),
        F.concat("x", F.array("y")).alias("_v"),
    )
    return G.vector_gram(keyed, ["focal_id", "block", "fold5"], "_v")


# --- solving --------------------------------------------------------------------------

COEF_FIELDS = [
    T.StructField("fold", T.IntegerType()),
    T.StructField("alpha", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coef", DOUBLES),
    T.StructField("selected", T.ArrayType(T.IntegerType())),
    T.StructField("x_mean", DOUBLES),
    T.StructField("x_scale", DOUBLES),
    T.StructField("n_train", T.LongType()),
    T.StructField("training_r2", T.DoubleType()),
    T.StructField("status", T.StringType()),
]


def _combine(parts):
    return G.merge(iter(parts))


def _standardised(total):
    """Centre and population scale of x; a constant column is divided by one."""
    n, mean, m2 = total
    p = len(mean) - 1
    sd = np.sqrt(np.clip(np.diag(m2)[:p] / n, 0, None))
    tiny = sd <= 1e-12 * np.maximum(np.abs(mean[:p]), 1e-300)
    return mean[:p], np.where(tiny | (sd == 0), 1.0, sd)


def _scaled(part, mean, sd):
    """The same aggregate after (x - mean) / sd; y stays as it is."""
    n, m, m2 = part
    p = len(sd)
    f = np.append(1.0 / sd, 1.0)
    shift = np.append(mean, 0.0)
    return n, (m - shift) * f, m2 * np.outer(f, f)


def _select(train_sets, alphas, limit: float, fallback: int):
    """Lasso with inner cross-validation for several training sets at once.

    ``train_sets`` is a list of fold lists; returns (alpha, selected columns)
    per training set.
    """
    out = []
    for folds in train_sets:
        total = _combine(folds)
        mean, sd = _standardised(total)
        z_folds = [_scaled(f, mean, sd) for f in folds]

        def path(parts):
            n, m, m2 = train = _combine(parts)
            p = len(m) - 1
            return S.lasso_path(m2[:p, :p] / n, m2[:p, p] / n, alphas), train

        error = np.zeros(len(alphas))
        for k, held_out in enumerate(z_folds):
            w, train = path([f for i, f in enumerate(z_folds) if i != k])
            error += S.fold_errors(w, train, held_out) / len(z_folds)
        best = int(np.argmin(error))
        chosen = np.flatnonzero(np.abs(path(z_folds)[0][best]) > limit)
        if not len(chosen):
            chosen = _strongest(total, fallback)
        out.append((float(alphas[best]), chosen, total, mean, sd))
    return out


def _strongest(total, k: int) -> np.ndarray:
    """The ``k`` columns most correlated with y (constant columns have no correlation)."""
    n, mean, m2 = total
    p = len(mean) - 1
    d = np.sqrt(np.clip(np.diag(m2), 0, None))
    denominator = d[:p] * d[p]
    ok = denominator > 0
    r = np.where(ok, np.abs(m2[:p, p]) / np.where(ok, denominator, 1.0), -1.0)
    order = np.argsort(-r, kind="stable")[:k]
    return np.sort(order[r[order] >= 0])


def fit_folds(
    design: DataFrame,
    n_alphas: int = 100,
    limit: float = 0.0,
    fallback: int = 10,
    min_train: int = MIN_TRAIN,
    window: int = TEST_WINDOW,
    outer: bool = True,
) -> DataFrame:
    """Selected and refitted models: one row per (focal, fold), fold 0 = whole series.

    ``coef`` is on the original scale and full length (zero where a feature was
    not selected).  A focal whose fit fails keeps one row with its message.
    """
    size = block_size(min_train, window) if outer else None
    focal = design.schema["focal_id"]
    schema = T.StructType([focal, *COEF_FIELDS])
    alphas = alpha_grid(n_alphas)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        focal_id = pdf["focal_id"].iloc[0]
        try:
            cells = {}
            for (block, fold5), part in pdf.groupby(["block", "fold5"], sort=True):
                cells[(int(block), int(fold5))] = _combine(
                    G.unpack(r.n, r.mean, r.m2) for r in part.itertuples(index=False)
                )
            n = sum(c[0] for c in cells.values())
            parts: dict[int, list] = {}
            for (b, _), cell in cells.items():
                parts.setdefault(b, []).append(cell)
            by_block = [_combine(parts[b]) for b in sorted(parts)]
            whole = [
                _combine(c for (_, f), c in cells.items() if f == k)
                for k in sorted({f for _, f in cells})
            ]
            sets, labels = [whole], [0]
            for i in range(max((n - min_train) // window, 0) if outer else 0):
                bounds = [b // size for b in inner_bounds(min_train + i * window)]
                sets.append([_combine(by_block[a:b]) for a, b in zip(bounds, bounds[1:])])
                labels.append(i + 1)
            rows = []
            for label, (alpha, chosen, total, mean, sd) in zip(
                labels, _select(sets, alphas, limit, fallback)
            ):
                b0, b, rss, tss, _ = S.least_squares(*total, columns=chosen)
                full = np.zeros(len(mean))
                full[chosen] = b
                r2 = 1 - rss / tss if tss > 0 else None
                rows.append(
                    [focal_id, label, alpha, b0, full, chosen.astype(np.int32), mean, sd]
                    + [total[0], r2, "Success"]
                )
        except (ValueError, ArithmeticError) as e:  # isolate the focal, keep the run going
            rows = [[focal_id, 0] + [None] * 8 + [f"Failed: {e}"]]
        return pd.DataFrame(rows, columns=[f.name for f in schema])

    return spread(block_gram(design, size), ["focal_id"]).groupBy("focal_id").applyInPandas(solve, schema)


# --- scoring --------------------------------------------------------------------------


def predict(df: DataFrame, models: DataFrame, on: list[str]) -> DataFrame:
    """Adds ``y_hat`` = intercept + coef . x."""
    return df.join(models.select(*on, "intercept", "coef"), on).withColumn(
        "y_hat", F.col("intercept") + dot(F.col("coef"), F.col("x"))
    )


def metrics(df: DataFrame, keys: list[str], variant: str = "oos") -> DataFrame:
    """n, r2, rmse, mape of ``y`` against ``y_hat`` per group.

    ``oos``: MAPE divides by y (NULL when a y is zero) and a constant y scores
    -999; ``insample``: MAPE divides by max(|y|, eps).  ``degenerate`` marks
    groups whose score is an artefact of such a division.
    """
    y, e = F.col("y"), F.col("y") - F.col("y_hat")
    n = F.count(F.lit(1))
    tss = F.var_pop(y) * n
    rss = F.sum(e * e)
    if variant == "oos":
        mape = F.when(F.count_if(y == 0) == 0, F.avg(F.try_divide(F.abs(e), F.abs(y))) * 100)
    elif variant == "insample":
        mape = F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(np.finfo(float).eps))) * 100
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return df.groupBy(*keys).agg(
        n.alias("n"),
        F.when(tss > 0, 1 - F.try_divide(rss, tss)).otherwise(DEGENERATE_R2).alias("r2"),
        F.sqrt(rss / n).alias("rmse"),
        mape.alias("mape"),
        ((tss == 0) | (F.count_if(y == 0) > 0)).alias("degenerate"),
    )


def adjusted_r2(r2: Column, n: Column, p: Column) -> Column:
    return 1 - (1 - r2) * F.try_divide(n - 1, n - p - 1)


def _scored(rows: DataFrame, models: DataFrame, min_train: int, window: int) -> DataFrame:
    """Scores of the test rows; levels are rebuilt when the design carries a trend."""
    tested = (
        numbered(rows)
        .withColumn("fold", test_fold(F.col("rn"), F.col("n"), min_train, window))
        .where(F.col("fold").isNotNull())
    )
    pred = predict(tested, models.where("status = 'Success'"), ["focal_id", "fold"])
    if "trend" in rows.columns:
        pred = pred.withColumns(
            {
                "y": retrend(F.col("trend"), F.col("y")),
                "y_hat": retrend(F.col("trend"), F.col("y_hat")),
            }
        )
    return metrics(pred, ["focal_id", "fold"], "oos")


def cv_direct(
    design: DataFrame,
    min_train: int = MIN_TRAIN,
    window: int = TEST_WINDOW,
    n_alphas: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """(models, fold scores) of the direct approach."""
    models = cut(fit_folds(design, n_alphas, min_train=min_train, window=window))
    return models, _scored(design, models, min_train, window)


def detrended_design(design: DataFrame, n: int = 30, n_temporal: int = 7, trend_shift: int = 0):
    """Target and lagged prices as relative deviation from their 30-row mean.

    The temporal tail of ``x`` is left alone.  Adds ``trend`` (of the target).
    A zero trend makes the deviation NULL.
    """
    target = detrend(design, "y", ["focal_id"], n=n, trend_shift=trend_shift)
    w = Window.partitionBy("focal_id").orderBy("obs_date").rowsBetween(-(n - 1), 0)
    prices = F.slice("x", F.lit(1), F.size("x") - n_temporal)
    head = F.size("x") - n_temporal
    listed = target.withColumn("_prices", F.when(head > 0, prices).otherwise(F.array().cast("array<double>")))
    framed = listed.withColumn("_frame", F.collect_list("_prices").over(w))
    zeros = F.transform("_prices", lambda v: F.lit(0.0))
    sums = F.aggregate("_frame", zeros, lambda acc, r: F.zip_with(acc, r, lambda a, b: a + b))
    means = F.transform(sums, lambda s: s / F.size("_frame"))
    deviations = F.zip_with("_prices", means, lambda v, m: F.try_divide(v - m, m))
    return framed.select(
        "focal_id",
        "obs_date",
        F.col("deviation").alias("y"),
        F.concat(deviations, F.slice("x", head + 1, F.lit(n_temporal))).alias("x"),
        "n_comp",
        "trend",
    )


def complete_only(design: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of focals without any NULL in y or x, failed focals with the reason)."""
    bad_x = F.exists("x", lambda v: v.isNull() | F.isnan(v))
    checks = design.groupBy("focal_id").agg(
        F.count_if(F.col("y").isNull() | F.isnan("y")).alias("_y"), F.count_if(bad_x).alias("_x")
    )
    failed = checks.where("_y + _x > 0").select(
        "focal_id",
        F.when(F.col("_y") > 0, "Failed: target contains NaN")
        .otherwise("Failed: features contain NaN")
        .alias("status"),
    )
    return design.join(failed, "focal_id", "left_anti"), failed


def cv_detrended(
    design: DataFrame,
    min_train: int = MIN_TRAIN,
    window: int = TEST_WINDOW,
    n_alphas: int = 100,
    trend_window: int = 30,
    trend_shift: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(models, fold scores, failed focals): fit deviations, score rebuilt levels.

    The trend of a test row contains its own price; ``trend_shift=1`` gives a
    forecast that does not look ahead.
    """
    flat, failed = complete_only(
        detrended_design(design, trend_window, trend_shift=trend_shift)
    )
    models = cut(fit_folds(flat, n_alphas, min_train=min_train, window=window))
    return models, _scored(flat, models, min_train, window), failed


def cv_summary(scores: DataFrame) -> DataFrame:
    """Fold statistics per focal (population deviation) and the generalisation label."""
    return scores.groupBy("focal_id").agg(
        F.count(F.lit(1)).alias("cv_folds"),
        F.avg("r2").alias("mean_r2"),
        F.stddev_pop("r2").alias("std_r2"),
        F.min("r2").alias("min_r2"),
        F.max("r2").alias("max_r2"),
        F.avg("mape").alias("mean_mape"),
        F.avg("rmse").alias("mean_rmse"),
        F.max("degenerate").alias("degenerate"),
    ).withColumn("quality", F.when(F.col("mean_r2") > 0.20, "GOOD").otherwise("POOR"))


def final_fit(models: DataFrame) -> DataFrame:
    """Training R2 and feature count of the whole-series fit."""
    return models.where("fold = 0").select(
        "focal_id",
        F.col("training_r2").alias("final_training_r2"),
        F.size("selected").alias("n_features"),
        F.col("n_train"),
        "status",
    )


def gates(registry: DataFrame, design: DataFrame, min_train=MIN_TRAIN, window=TEST_WINDOW) -> DataFrame:
    """(focal_id, status): 'ready', or why a registered focal gets no result."""
    sizes = design.groupBy("focal_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max("n_comp").alias("n_comp")
    )
    return registry.join(sizes, "focal_id", "left").select(
        "focal_id",
        F.when(F.col("n").isNull(), "Skipped: no data")
        .when(F.col("n_comp") == 0, "Skipped: no competitor features")
        .when(fold_count(F.col("n"), min_train, window) == 0, "Skipped: not enough data for a fold")
        .otherwise("ready")
        .alias("status"),
    )


def run_summary(
    registry: DataFrame,
    design: DataFrame,
    models: DataFrame,
    scores: DataFrame,
    failed: DataFrame | None = None,
    min_train: int = MIN_TRAIN,
    window: int = TEST_WINDOW,
) -> DataFrame:
    """One row per registered focal: scores, or the reason there are none."""
    gate = gates(registry, design, min_train, window).withColumnRenamed("status", "_gate")
    fit = final_fit(models).withColumnRenamed("status", "_fit")
    out = gate.join(fit, "focal_id", "left").join(
        cv_summary(scores).select("focal_id", "mean_r2", "std_r2"), "focal_id", "left"
    )
    if failed is not None:
        out = out.join(failed.withColumnRenamed("status", "_failed"), "focal_id", "left")
    else:
        out = out.withColumn("_failed", F.lit(None).cast("string"))
    status = (
        F.when(F.col("_gate") != "ready", F.col("_gate"))
        .when(F.col("_failed").isNotNull(), F.col("_failed"))
        .otherwise(F.coalesce("_fit", F.lit("Failed: no model")))
    )
    ok = F.col("status") == "Success"
    return out.withColumn("status", status).select(
        "focal_id",
        F.when(ok, F.col("mean_r2")).alias("cv_mean_r2"),
        F.when(ok, F.col("std_r2")).alias("cv_std_r2"),
        F.when(ok, F.col("final_training_r2")).alias("final_training_r2"),
        F.when(ok, F.col("n_features")).otherwise(0).alias("n_features"),
        "status",
    )


def portfolio_summary(summary: DataFrame, score: str = "cv_mean_r2") -> DataFrame:
    """Counts, mean and median score over the successful focals."""
    ok = F.col("status") == "Success"
    value = F.when(ok, F.col(score))
    return summary.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(ok).alias("n_success"),
        F.avg(value).alias("mean_score"),
        F.median(value).alias("median_score"),
        F.avg(F.when(ok, F.col("final_training_r2"))).alias("mean_training_r2"),
    )


def band(score: Column) -> Column:
    """Excellent above 0.40, Good 0.25-0.40, Acceptable 0.15-0.25, Poor below."""
    return (
        F.when(score > 0.40, "Excellent")
        .when(score >= 0.25, "Good")
        .when(score >= 0.15, "Acceptable")
        .when(score < 0.15, "Poor")
    )


def bands(summary: DataFrame, score: str = "cv_mean_r2") -> DataFrame:
    return (
        summary.where("status = 'Success'")
        .groupBy(band(F.col(score)).alias("band"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- in-sample model --------------------------------------------------------------------


def ols_hc1(design: DataFrame, models: DataFrame) -> DataFrame:
    """HC1 standard errors of the selected, standardised features.

    One row per focal: ``coef_std`` and ``se``, ``z``, ``p_value`` arrays with the
    intercept first, in the order of ``selected``.  Plain and residual-weighted
    cross products come from one pass over the design.
    """
    base = models.where("fold = 0 AND status = 'Success'").select(
        "focal_id", "intercept", "coef", "selected", "x_mean", "x_scale"
    )
    z = F.transform(
        "selected",
        lambda i: (F.get("x", i) - F.get("x_mean", i)) / F.get("x_scale", i),
    )
    e = F.col("y") - F.col("intercept") - dot(F.col("coef"), F.col("x"))
    rows = design.join(base, "focal_id").select(
        "focal_id",
        F.concat(F.array(F.lit(1.0)), z).alias("_d"),
        e.alias("_e"),
    )
    moments = G.vector_gram(rows, ["focal_id"], "_d", weight="_e")
    scaled = base.select(
        "focal_id",
        F.concat(
            F.array(F.col("intercept") + dot(F.col("coef"), F.col("x_mean"))),
            F.transform("selected", lambda i: F.get("coef", i) * F.get("x_scale", i)),
        ).alias("coef_std"),
    )
    parts = moments.join(scaled, "focal_id")
    schema = T.StructType(
        [design.schema["focal_id"]]
        + [T.StructField(c, DOUBLES) for c in ("coef_std", "se", "z", "p_value")]
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        def moment(flag: bool):
            n, mean, m2 = _combine(
                G.unpack(r.n, r.mean, r.m2)
                for r in pdf[pdf["weighted"] == flag].itertuples(index=False)
            )
            return n, m2 + n * np.outer(mean, mean)

        n, a = moment(False)
        _, meat = moment(True)
        bread, _ = S.pseudo_inverse(a)
        b = np.asarray(pdf["coef_std"].iloc[0], dtype=float)
        p = len(b)
        se = np.sqrt(np.clip(np.diag(bread @ meat @ bread) * n / max(n - p, 1), 0, None))
        with np.errstate(divide="ignore", invalid="ignore"):
            z = b / se
        return pd.DataFrame(
            [[pdf["focal_id"].iloc[0], b, se, z, S.normal_two_sided(z)]],
            columns=[f.name for f in schema],
        )

    return spread(parts, ["focal_id"]).groupBy("focal_id").applyInPandas(solve, schema)


def insample(
    design: DataFrame, dictionary: DataFrame, n_alphas: int = 50, fallback: int = 5
) -> DataFrame:
    """In-sample model record per focal: metrics, selected terms with HC1 inference, equation.

    ``dictionary`` is (focal_id, features) in the order of ``x``.
    """
    models = cut(fit_folds(design, n_alphas, limit=1e-10, fallback=fallback, outer=False))
    fits = models.where("fold = 0")
    scored = metrics(
        predict(design, fits.where("status = 'Success'"), ["focal_id"]), ["focal_id"], "insample"
    ).withColumnRenamed("n", "n_observations")
    inference = ols_hc1(design, models)
    record = (
        fits.select("focal_id", "alpha", "selected", "status")
        .join(scored, "focal_id", "left")
        .join(inference, "focal_id", "left")
        .join(dictionary, "focal_id", "left")
    )
    terms = F.transform(
        "selected",
        lambda i, k: F.struct(
            F.get("features", i)["feature"].alias("feature"),
            F.get("coef_std", k + 1).alias("coef"),
            F.get("se", k + 1).alias("se"),
            F.get("p_value", k + 1).alias("p_value"),
            stars(F.get("p_value", k + 1)).alias("stars"),
            F.get("features", i)["kind"].alias("category"),
        ),
    )
    p = F.size("selected")
    return record.withColumn("coefficients", terms).select(
        "focal_id",
        adjusted_r2(F.col("r2"), F.col("n_observations"), p).alias("adj_r2"),
        "r2",
        "rmse",
        "mape",
        F.when(p >= 0, p).otherwise(0).alias("n_features"),
        "n_observations",
        F.col("alpha").alias("lasso_alpha"),
        "coefficients",
        equation(F.get("coef_std", F.lit(0)), F.col("coefficients"), 10).alias("equation"),
        "status",
    )


def insample_portfolio(records: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Portfolio figures over focals with adjusted R2 above ``threshold``."""
    good = F.col("adj_r2") > threshold
    pick = lambda c: F.when(good, F.col(c))
    return records.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(good).alias("n_success"),
        F.avg(pick("adj_r2")).alias("mean_adj_r2"),
        F.median(pick("adj_r2")).alias("median_adj_r2"),
        F.avg(pick("rmse")).alias("mean_rmse"),
        F.avg(pick("mape")).alias("mean_mape"),
    )
