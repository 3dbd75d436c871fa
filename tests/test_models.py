import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import day, design_rows, matrix_of, matrix_rows
from pricepanel.functions.calendar import INSTRUMENTS, with_instruments
from pricepanel.functions.stats import lattice_tail
from pricepanel.operators import forest, gram as G, matrix as M, quality as Q, regress as R, solve as S, validate as V
from pricepanel.plans import causal


def panel_365(spark, n=365, c=5, seed=0):
    rng = np.random.default_rng(seed)
    prices = 250 + 30 * rng.normal(size=(n, c)) + 20 * np.sin(2 * np.pi * np.arange(n)[:, None] / 365)
    focal = 200 + prices @ np.array([0.5, -0.8, 0.1, 0.3, -0.2]) + 10 * rng.normal(size=n)
    comp = spark.createDataFrame(
        [(f"H{j}", day(i), float(prices[i, j]), 1.0) for i in range(n) for j in range(c)],
        "entity STRING, obs_date DATE, price DOUBLE, available DOUBLE",
    )
    rates = spark.createDataFrame(
        [(day(i), float(focal[i])) for i in range(n)], "obs_date DATE, base_rate DOUBLE"
    )
    return rates, comp, prices, focal


def instrument_matrix(spark, rates):
    rows = with_instruments(rates).orderBy("obs_date").collect()
    return np.array([[float(r[c]) for c in INSTRUMENTS] for r in rows])


def test_published_f_values(spark):
    """R2 with n = 365 and k = 7 against the published F statistics."""
    # Published pairs of R2 and F.
    pairs = [(0.306, 22.49), (0.214, 13.89), (0.391, 32.74), (0.254, 17.36), (0.486, 48.22)]
    df = spark.createDataFrame(pairs, "r2 DOUBLE, f DOUBLE").withColumns({"n": F.lit(365), "k": F.lit(7)})
    for r in R.fit_stats(df).collect():
        assert abs(r["f_statistic"] - r["f"]) < 0.005


def test_stage1_against_numpy(spark):
    rates, comp, prices, _ = panel_365(spark)
    z = np.c_[np.ones(365), instrument_matrix(spark, rates)]
    models = {r["entity"]: r for r in R.stage1(comp).collect()}
    for j in range(5):
        y = prices[:, j]
        b, *_ = np.linalg.lstsq(z, y, rcond=None)
        e = y - z @ b
        se = np.sqrt(e @ e / (365 - 8) * np.diag(np.linalg.inv(z.T @ z)))
        m = models[f"H{j}"]
        assert np.allclose([m["intercept"], *m["coef"]], b, rtol=1e-8, atol=1e-8)
        assert np.allclose(m["se"], se, rtol=1e-8)
    resid = R.residuals(comp, R.stage1(comp))
    for r in R.residual_summary(resid).collect():
        assert abs(r["mean"]) < 1e-9


def test_two_stage_is_ols_in_disguise(spark):
    rates, comp, prices, y = panel_365(spark)
    out = causal.run(rates, comp)
    z = instrument_matrix(spark, rates)
    full = np.c_[np.ones(365), z]
    resid = prices - full @ np.linalg.lstsq(full, prices, rcond=None)[0]
    x = np.c_[prices, resid, z]
    xc, yc = x - x.mean(0), y - y.mean()
    b = np.linalg.pinv(xc, rcond=1e-8) @ yc
    ols, *_ = np.linalg.lstsq(np.c_[np.ones(365), prices, z], y, rcond=None)
    row = out["stage2"].first()
    assert row["rank"] == 12 and row["n_columns"] == 17
    assert np.allclose(row["coef"], b, rtol=1e-6, atol=1e-7)
    assert np.allclose(np.array(row["coef"][:5]) + np.array(row["coef"][5:10]), ols[1:6], atol=1e-8)
    fit = R.compare_fit(out["stage2"]).first()
    assert abs(fit["r2_difference"]) < 1e-12
    sums = {r["name"]: r["beta_plus_theta"] for r in out["terms"].where("kind = 'beta'").collect()}
    assert np.allclose([sums[f"H{j}"] for j in range(5)], ols[1:6], atol=1e-8)
    assert not out["terms"].where("kind = 'beta'").first()["identified"]
    pred = out["predictions"].orderBy("obs_date").collect()
    assert np.allclose([r["predicted_2sri"] for r in pred], [r["predicted_ols"] for r in pred])
    dw = R.residual_diagnostics(out["predictions"]).first()["durbin_watson"]
    e = np.array([r["residual"] for r in pred])
    assert math.isclose(dw, (np.diff(e) ** 2).sum() / (e @ e), rel_tol=1e-9)


def test_tail_probabilities():
    # Textbook quantiles of t and normal.
    assert np.allclose(S.t_two_sided([2.228, 3.169], 10), [0.05, 0.01], atol=2e-4)
    assert np.allclose(S.t_two_sided([1.962, 0.0], 1000), [0.05, 1.0], atol=2e-4)
    assert np.allclose(S.normal_two_sided([1.959964, 2.575829]), [0.05, 0.01], atol=1e-6)


def test_gram_blocks_add_up(spark):
    rng = np.random.default_rng(1)
    x, y = 1e5 + rng.normal(size=(97, 4)), rng.normal(size=97)
    parts = [G.unpack(r["n"], r["mean"], r["m2"]) for r in V.block_gram(design_rows(spark, x, y)).collect()]
    n, mean, m2 = G.merge(iter(parts))
    v = np.c_[x, y]
    c = v - v.mean(0)
    assert n == 97 and np.allclose(mean, v.mean(0)) and np.allclose(m2, c.T @ c, rtol=1e-8, atol=1e-6)


def slow_lasso(x, y, alpha, sweeps=5000):
    """Cyclic descent on the rows themselves."""
    n, p = x.shape
    w, r = np.zeros(p), y.copy()
    for _ in range(sweeps):
        old = w.copy()
        for j in range(p):
            g = x[:, j] @ r / n + w[j] * (x[:, j] @ x[:, j]) / n
            new = np.sign(g) * max(abs(g) - alpha, 0) / ((x[:, j] @ x[:, j]) / n)
            r += x[:, j] * (w[j] - new)
            w[j] = new
        if np.abs(w - old).max() < 1e-12:
            break
    return w


def test_lasso_path_optimal_with_duplicates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 6)).cumsum(0)
    x = np.c_[x, x[:, 0], np.zeros(80)]
    x = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    y = x[:, 0] * 2 - x[:, 3] + rng.normal(size=80)
    y -= y.mean()
    alphas = V.alpha_grid(40)
    path = S.lasso_path(x.T @ x / 80, x.T @ y / 80, alphas)
    assert (path[:, 6:] == 0).all()
    for k in (10, 20, 30):
        assert np.allclose(path[k, :6], slow_lasso(x[:, :6], y, alphas[k]), atol=1e-6)


def reference_fit(x, y, n_alphas=100, fallback=10):
    """Standardise, five contiguous folds, lasso, least squares - on rows, with numpy only."""
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / np.where(sd == 0, 1, sd)
    alphas, n = V.alpha_grid(n_alphas), len(y)
    sizes = np.full(5, n // 5)
    sizes[: n % 5] += 1
    edges = np.r_[0, sizes.cumsum()]
    errors = np.zeros(n_alphas)
    for f in range(5):
        test = np.zeros(n, bool)
        test[edges[f] : edges[f + 1]] = True
        zt, yt = z[~test] - z[~test].mean(0), y[~test] - y[~test].mean()
        w = S.lasso_path(zt.T @ zt / len(yt), zt.T @ yt / len(yt), alphas)
        for a in range(n_alphas):
            e = y[test] - (y[~test].mean() + (z[test] - z[~test].mean(0)) @ w[a])
            errors[a] += (e @ e) / len(e) / 5
    zc, yc = z - z.mean(0), y - y.mean()
    best = int(np.argmin(errors))
    w = S.lasso_path(zc.T @ zc / n, zc.T @ yc / n, alphas)[best]
    chosen = np.flatnonzero(w)
    b, *_ = np.linalg.lstsq(np.c_[np.ones(n), x[:, chosen]], y, rcond=None)
    return alphas[best], chosen, b


def test_expanding_cv_against_rows(spark):
    rng = np.random.default_rng(5)
    n = 417
    x = 100 + rng.normal(size=(n, 6)).cumsum(0)
    y = 50 + 0.8 * x[:, 1] - 0.5 * x[:, 4] + rng.normal(size=n)
    design = design_rows(spark, x, y)
    models, scores = V.cv_direct(design)
    got = {r["fold"]: r for r in models.collect()}
    assert sorted(got) == [0, 1, 2]
    fold_scores = {r["fold"]: r for r in scores.collect()}
    for fold, end in ((0, n), (1, 300), (2, 350)):
        alpha, chosen, b = reference_fit(x[:end], y[:end])
        assert math.isclose(got[fold]["alpha"], alpha)
        assert list(got[fold]["selected"]) == list(chosen)
        assert np.allclose(np.array(got[fold]["coef"])[chosen], b[1:], rtol=1e-6)
        if fold:
            t = slice(end, end + 50)
            e = y[t] - (b[0] + x[t][:, chosen] @ b[1:])
            r2 = 1 - (e @ e) / ((y[t] - y[t].mean()) ** 2).sum()
            assert math.isclose(fold_scores[fold]["r2"], r2, rel_tol=1e-6)
            assert math.isclose(fold_scores[fold]["mape"], np.mean(np.abs(e / y[t])) * 100, rel_tol=1e-6)


def test_detrended_scores_levels(spark):
    rng = np.random.default_rng(6)
    n = 350
    x = np.c_[100 + rng.normal(size=(n, 2)).cumsum(0), np.ones((n, 7)) * rng.normal(size=(n, 7))]
    y = 200 + 0.8 * x[:, 0] + rng.normal(size=n)
    models, scores, failed = V.cv_detrended(design_rows(spark, x, y))
    roll = lambda v: np.array([v[max(0, i - 29) : i + 1].mean() for i in range(n)])
    dev = lambda v: (v - roll(v)) / roll(v)
    xd = np.c_[dev(x[:, 0]), dev(x[:, 1]), x[:, 2:]]
    _, chosen, b = reference_fit(xd[:300], dev(y)[:300])
    level = roll(y)[300:] * (1 + b[0] + xd[300:][:, chosen] @ b[1:])
    e = y[300:] - level
    row = scores.first()
    assert failed.count() == 0
    assert math.isclose(row["rmse"], np.sqrt(np.mean(e**2)), rel_tol=1e-6)


def test_zero_trend_fails_only_its_focal(spark):
    rng = np.random.default_rng(7)
    x = np.c_[5 + rng.random((350, 1)), rng.normal(size=(350, 7))]
    good = design_rows(spark, x, 10 + rng.random(350), "GOOD")
    bad = design_rows(spark, x, np.zeros(350), "BAD")
    models, scores, failed = V.cv_detrended(good.unionByName(bad))
    assert {r["focal_id"]: r["status"] for r in failed.collect()} == {"BAD": "Failed: target contains NaN"}
    registry = spark.createDataFrame([("GOOD",), ("BAD",), ("GONE",)], "focal_id STRING")
    out = V.run_summary(registry, good.unionByName(bad), models, scores, failed)
    status = {r["focal_id"]: r["status"] for r in out.collect()}
    assert status == {"GOOD": "Success", "BAD": "Failed: target contains NaN", "GONE": "Skipped: no data"}


def test_hc1(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3))
    y = 3 + x @ [1.0, -2.0, 0.5] + rng.normal(size=200) * (1 + np.abs(x[:, 0]))
    design = design_rows(spark, x, y)
    models = V.fit_folds(design, 50, limit=1e-10, outer=False)
    row = V.ols_hc1(design, models).first()
    z = np.c_[np.ones(200), (x - x.mean(0)) / x.std(0)]
    b = np.linalg.solve(z.T @ z, z.T @ y)
    e = y - z @ b
    inv = np.linalg.inv(z.T @ z)
    se = np.sqrt(np.diag(inv @ (z.T * e**2) @ z @ inv) * 200 / 196)
    assert np.allclose(row["coef_std"], b) and np.allclose(row["se"], se)


@pytest.mark.parametrize("n, folds", [(349, 0), (350, 1), (399, 1), (400, 2), (676, 7)])
def test_fold_counts(spark, n, folds):
    df = spark.range(n).select(F.lit("F").alias("focal_id"), F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("obs_date"))
    assert V.expanding_splits(df).count() == folds


def test_constant_target_scores_minus_999(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0)], "k STRING, y DOUBLE, y_hat DOUBLE")
    row = V.metrics(df, ["k"]).first()
    assert (row["r2"], row["degenerate"]) == (-999.0, True)


def holes(seed=0, n=60, p=4, share=0.25):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 2)) @ rng.normal(size=(2, p)) * 20 + 100 + rng.normal(size=(n, p))
    m = base.copy()
    mask = rng.random((n, p)) < share
    mask[:, 0] = False
    m[mask] = np.nan
    return base, m, mask


def test_iterative_impute_against_rows(spark):
    _, m, mask = holes()
    got = matrix_of(M.iterative_impute(matrix_rows(spark, m)))
    x = np.where(mask, np.nanmean(m, 0), m)
    order = np.argsort(mask.mean(0), kind="stable")
    for _ in range(10):
        before = x.copy()
        for j in order:
            if mask[:, j].any():
                seen = x[~mask[:, j]]
                c = seen - seen.mean(0)
                others = np.array([k for k in range(4) if k != j])
                b0, b = S.bayes_ridge(len(seen), seen.mean(0), c.T @ c, others, j)
                x[mask[:, j], j] = b0 + x[mask[:, j]][:, others] @ b
        if np.abs(x - before).max() < 1e-3 * np.nanmax(np.abs(m)):
            break
    assert np.allclose(got, x, rtol=1e-8)


def test_soft_impute_against_svd(spark):
    _, m, mask = holes(1)
    got = matrix_of(M.soft_impute(matrix_rows(spark, m)))
    x, shrink = np.where(mask, 0, m), None
    for _ in range(100):
        u, s, vt = np.linalg.svd(x, full_matrices=False)
        shrink = s[0] / 50 if shrink is None else shrink
        s = np.maximum(s - shrink, 0)
        s[3:] = 0
        new = (u * s) @ vt
        moved, old = ((x - new)[mask] ** 2).sum(), (x[mask] ** 2).sum()
        x[mask] = new[mask]
        if old > 0 and math.sqrt(moved / old) < 1e-3:
            break
    assert np.allclose(got, x, rtol=1e-7)


def test_knn_in_small_tiles_against_brute_force(spark):
    _, m, mask = holes(2)
    m[5] = m[6]
    m[5, 1], m[6, 1] = np.nan, 77.0
    got = matrix_of(M.knn_impute(matrix_rows(spark, m), tile=16))
    for i, j in zip(*np.nonzero(np.isnan(m))):
        diff = m - m[i]
        shared = (~np.isnan(diff)).sum(1)
        dist = np.sqrt(np.nansum(diff**2, 1) * 4 / np.maximum(shared, 1))
        donors = np.flatnonzero(~np.isnan(m[:, j]) & (shared > 0))
        near = donors[np.argsort(dist[donors], kind="stable")[:5]]
        d = dist[near]
        want = m[near, j][d == 0].mean() if (d == 0).any() else (m[near, j] / d).sum() / (1 / d).sum()
        assert math.isclose(got[i, j], want, rel_tol=1e-9)


@pytest.mark.parametrize("method", ["iterative", "soft"])
def test_imputation_beats_column_mean(spark, method):
    # Low-rank completion needs clearly more columns than its rank.
    truth, m, mask = holes(4, n=120, p=12)
    got = matrix_of(M.complete_matrix(matrix_rows(spark, m), method))
    mean = np.where(mask, np.nanmean(m, 0), m)
    assert np.abs(got - truth)[mask].mean() < np.abs(mean - truth)[mask].mean()


def grown(x, y, w, row, depth):
    """Prediction of one tree for one row, by trying every split of every node."""
    mean = (w * y).sum() / w.sum()
    loss = (w * (y - mean) ** 2).sum()
    best = None
    for j in range(x.shape[1]):
        known = np.unique(x[w > 0, j])
        for low, high in zip(known, known[1:]):
            left = x[:, j] <= (low + high) / 2
            parts = [(w[s] * (y[s] - (w[s] * y[s]).sum() / w[s].sum()) ** 2).sum() for s in (left, ~left)]
            if best is None or sum(parts) < best[0] - 1e-9 * loss:
                best = (sum(parts), j, (low + high) / 2)
    if best is None or depth == 0 or loss < 1e-12:
        return mean
    _, j, cut = best
    side = x[:, j] <= cut if row[j] <= cut else x[:, j] > cut
    return grown(x[side], y[side], w[side], row, depth - 1)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_trees_grow_by_the_best_splits(depth):
    rng = np.random.default_rng(depth)
    x, asked = rng.normal(size=(200, 3)), rng.normal(size=(15, 3))
    x[:, 2] = np.round(x[:, 2])  # ties
    y = 2 * x[:, 0] - x[:, 1] ** 2 + rng.normal(size=200)
    bags = np.stack([np.bincount(rng.integers(0, 200, 200), minlength=200) for _ in range(4)])
    want = [np.mean([grown(x[b > 0], y[b > 0], b[b > 0], row, depth) for b in bags]) for row in asked]
    assert np.allclose(forest.bagged_prediction(x, y, bags, asked, depth), want)
    # Grown out, a tree gives back every sample of its bag.
    assert np.allclose(forest.bagged_prediction(x, y, np.ones((2, 200), int), x), y)


def test_forest_of_constant_and_single_samples():
    x, y = np.ones((5, 2)), np.arange(5.0)
    assert np.allclose(forest.bagged_prediction(x, y, np.ones((3, 5), int), x[:2]), 2.0)
    assert np.allclose(forest.bagged_prediction(x[:1], y[:1] + 7, np.ones((2, 1), int), x), 7.0)


def test_forest_fills_every_focal_and_keeps(spark):
    truth, m, mask = holes(5, n=80, p=3)
    rows = [(day(i), *[None if np.isnan(v) else float(v) for v in m[i]]) for i in range(80)]
    df = spark.createDataFrame(rows, "obs_date DATE, a DOUBLE, b DOUBLE, c DOUBLE")
    out = forest.forest_impute_wide(df, ["a", "b", "c"], "obs_date", rounds=3).orderBy("obs_date").collect()
    got = np.array([[r["a"], r["b"], r["c"]] for r in out])
    assert np.allclose(got[~mask], m[~mask])
    mean = np.where(mask, np.nanmean(m, 0), m)
    assert np.abs(got - truth)[mask].mean() < np.abs(mean - truth)[mask].mean()
    # Partitioning does not matter, and a focal does not see the others.
    both = matrix_rows(spark, m).unionByName(matrix_rows(spark, m[:50]).withColumn("focal_id", F.lit("other")))
    a, b = ({(r["focal_id"], r["obs_date"]): r["row"] for r in forest.forest_impute(both.repartition(k), rounds=2).collect()} for k in (1, 5))
    assert a == b and len(a) == 130
    alone = forest.forest_impute(matrix_rows(spark, m), rounds=2).collect()
    assert all(a[r["focal_id"], r["obs_date"]] == r["row"] for r in alone)


def test_forest_leaves_empty_columns(spark):
    m = np.array([[1.0, np.nan, np.nan], [2.0, np.nan, 5.0], [np.nan, np.nan, 6.0]])
    got = matrix_of(forest.forest_impute(matrix_rows(spark, m)))
    assert np.isnan(got[:, 1].astype(float)).all() and not np.isnan(got[:, [0, 2]].astype(float)).any()


def test_pair_correlations_match_pairwise_numpy(spark):
    _, m, _ = holes(6)
    for r in Q.pair_correlations(matrix_rows(spark, m)).collect():
        a, b = m[:, r["i"]], m[:, r["j"]]
        ok = ~np.isnan(a) & ~np.isnan(b)
        assert math.isclose(r["correlation"], np.corrcoef(a[ok], b[ok])[0, 1], rel_tol=1e-8)


def test_exact_ks_counts_lattice_paths():
    for n, m in [(1, 1), (2, 5), (4, 4), (5, 3), (6, 5), (5, 6)]:
        for h in range(n * m + 2):
            hit = 0
            for up in combinations(range(n + m), n):
                at, out = [0, 0], h <= 0
                for k in range(n + m):
                    at[k not in up] += 1
                    out |= abs(at[0] * m - at[1] * n) >= h
                hit += out
            assert math.isclose(lattice_tail(n, m, h), hit / math.comb(n + m, n), abs_tol=1e-12)
    # Equal samples of n: the classical 2 * C(2n, n - k) - ... series; far tails keep their digits.
    n, k = 300, 290
    series = 2 * sum((-1) ** (i + 1) * math.comb(2 * n, n - i * k) for i in range(1, n // k + 1)) / math.comb(2 * n, n)
    assert math.isclose(lattice_tail(n, n, k * n), series, rel_tol=1e-8)
