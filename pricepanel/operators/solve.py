"""Small dense solves on p x p cross products (numpy, called inside Spark tasks)."""

from __future__ import annotations

import math

import numpy as np


def pseudo_inverse(a: np.ndarray, cut: float = 1e-10):
    """(pinv, rank) of a symmetric positive semi-definite matrix of mixed scales.

    The rank is decided on the unit-diagonal version, where an eigenvalue below
    ``cut`` means a true dependency and not merely a small unit of measure.  The
    result is nevertheless the pseudo-inverse of ``a`` itself: a generalised
    inverse projected on the row space of ``a``.
    """
    d = np.sqrt(np.clip(np.diag(a), 0, None))
    scale = np.where(d > 0, d, 1.0)
    values, vectors = np.linalg.eigh(a / np.outer(scale, scale))
    keep = values > cut * max(values.max(initial=0.0), 1e-300)
    v = vectors[:, keep]
    g = (v / values[keep]) @ v.T / np.outer(scale, scale)
    if keep.all():
        return g, int(keep.sum())
    null, _ = np.linalg.qr(vectors[:, ~keep] / scale[:, None])
    row_space = np.eye(len(a)) - null @ null.T
    return row_space @ g @ row_space, int(keep.sum())


def least_squares(n: int, mean: np.ndarray, m2: np.ndarray, columns=None):
    """Minimum-norm least squares with intercept from [x..., y] cross products.

    Returns intercept, coefficients, residual and total sum of squares, rank.
    """
    p = len(mean) - 1
    idx = np.arange(p) if columns is None else np.asarray(columns, dtype=int)
    s, c, tss = m2[np.ix_(idx, idx)], m2[idx, p], m2[p, p]
    inverse, rank = pseudo_inverse(s) if len(idx) else (np.zeros((0, 0)), 0)
    b = inverse @ c
    rss = max(tss - 2 * b @ c + b @ s @ b, 0.0)
    return mean[p] - mean[idx] @ b, b, rss, tss, rank


def raw_second_moment(n: int, mean: np.ndarray, m2: np.ndarray, p: int) -> np.ndarray:
    """X'X of [1, x...] with uncentred columns."""
    x = mean[:p]
    out = np.empty((p + 1, p + 1))
    out[0, 0] = n
    out[0, 1:] = out[1:, 0] = n * x
    out[1:, 1:] = m2[:p, :p] + n * np.outer(x, x)
    return out


def _beta_fraction(a, b, x, rounds: int = 300):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, rounds):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


def t_two_sided(t, df: float) -> np.ndarray:
    """Two-sided tail probability of Student's t."""
    t = np.asarray(t, dtype=float)
    if df <= 0:
        return np.full(t.shape, np.nan)
    a, b = df / 2.0, 0.5
    x = df / (df + t**2)
    log_front = (
        math.lgamma(a + b)
        - math.lgamma(a)
        - math.lgamma(b)
        + a * np.log(np.clip(x, 1e-300, None))
        + b * np.log(np.clip(1 - x, 1e-300, None))
    )
    front = np.exp(log_front)
    direct = x < (a + 1) / (a + b + 2)
    xs = np.where(direct, x, 1 - x)
    aa, bb = np.where(direct, a, b), np.where(direct, b, a)
    value = front * _beta_fraction(aa, bb, xs) / aa
    return np.clip(np.where(direct, value, 1 - value), 0.0, 1.0)


def normal_two_sided(z) -> np.ndarray:
    z = np.abs(np.asarray(z, dtype=float)) / math.sqrt(2.0)
    return np.array([math.erfc(v) if not math.isnan(v) else math.nan for v in z.ravel()]).reshape(
        z.shape
    )


def _descend(c, q, alpha, w, sweeps: int = 10_000, tol: float = 1e-7):
    """Cyclic coordinate descent from ``w``; only used where the homotopy is degenerate."""
    w = w.copy()
    cw = c @ w
    d = np.diag(c)
    limit = tol * max(np.abs(q).max(), 1e-300)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(d > 1e-14):
            g = q[j] - cw[j] + d[j] * w[j]
            step = np.sign(g) * max(abs(g) - alpha, 0.0) / d[j] - w[j]
            if step:
                w[j] += step
                cw += c[:, j] * step
                moved = max(moved, abs(step) * d[j])
        if moved <= limit:
            break
    return w


def lasso_path(c: np.ndarray, q: np.ndarray, alphas: np.ndarray) -> np.ndarray:
    """Exact lasso coefficients at the given decreasing penalties.

    ``c`` (p, p) and ``q`` (p,) are centred cross products divided by the number
    of rows; the objective is 1/2 w'Cw - q'w + alpha*|w|_1.  The solution is
    piecewise linear in alpha, so the path is followed from one change of the
    active set to the next, which costs about one small solve per feature
    instead of thousands of sweeps when features are nearly collinear.  Every
    grid point is checked against the optimality conditions.
    """
    p = len(q)
    out = np.zeros((len(alphas), p))
    diag = np.diag(c).copy()
    usable = diag > 1e-14
    # Of duplicate columns only the first can be selected; any split between them is
    # equally good, and cyclic descent would also leave the later ones at zero.
    norm = np.sqrt(np.where(usable, diag, 1.0))
    for j in range(1, p):
        same = usable[:j] & (np.abs(c[j, :j]) >= (1 - 1e-10) * norm[j] * norm[:j])
        usable[j] &= not same.any()
    top = np.abs(np.where(usable, q, 0.0)).max(initial=0.0)
    if top <= alphas[-1]:
        return out
    first = int(np.flatnonzero(usable & (np.abs(q) >= top * (1 - 1e-12)))[0])
    active, sign = [first], {first: np.sign(q[first])}
    barred: set[int] = set()
    alpha, dropped, joined = top, None, first
    for _ in range(20 * p + 20):
        a = np.array(active, dtype=int)
        s = np.array([sign[j] for j in active])
        uv = np.linalg.solve(c[np.ix_(a, a)], np.column_stack([q[a], s])) if len(a) else np.zeros((0, 2))
        u, v = uv[:, 0], uv[:, 1]
        const, slope = q - c[:, a] @ u, c[:, a] @ v
        ceiling = alpha * (1 - 1e-12)
        nxt, event = 0.0, None
        open_ = usable.copy()
        open_[a] = False
        open_[list(barred)] = False
        for side in (1.0, -1.0):
            rate = side - slope
            ok = open_ & (np.abs(rate) >= 1e-9)
            if dropped is not None and dropped[1] == side:
                ok[dropped[0]] = False
            at = np.where(ok, const / np.where(ok, rate, 1.0), -1.0)
            at[at >= ceiling] = -1.0
            j = int(np.argmax(at))
            if at[j] > nxt:
                nxt, event = at[j], ("join", j, side)
        with np.errstate(divide="ignore", invalid="ignore"):
            zero = u / v
        for i, j in enumerate(active):
            # A coefficient that has just entered starts at zero and moves away from it.
            if j != joined and np.isfinite(zero[i]) and nxt < zero[i] < ceiling:
                nxt, event = zero[i], ("drop", j, sign[j])
        inside = (alphas <= alpha) & (alphas > nxt)
        if inside.any() and len(a):
            out[np.ix_(inside, a)] = u[None, :] - alphas[inside][:, None] * v[None, :]
        if event is None or nxt <= alphas[-1]:
            break
        alpha, dropped, joined = nxt, None, None
        kind, j, side = event
        if kind == "drop":
            active.remove(j)
            del sign[j]
            dropped = (j, side)
            barred.clear()
        else:
            rest = diag[j] - (
                c[j, a] @ np.linalg.solve(c[np.ix_(a, a)], c[a, j]) if len(a) else 0.0
            )
            if rest < 1e-10 * diag[j]:
                barred.add(j)  # a copy or combination of active columns
            else:
                active.append(j)
                sign[j] = side
                joined = j
    gradient = np.where(usable, q[None, :] - out @ c, 0.0)
    slack = 1e-7 * top
    for k, alpha in enumerate(alphas):
        on = out[k] != 0
        bad = np.abs(gradient[k]) > alpha + slack
        bad[on] = np.abs(gradient[k, on] - alpha * np.sign(out[k, on])) > slack
        if (bad & usable).any():
            out[k] = _descend(c, q, alpha, out[k])
    return out


def fold_errors(w: np.ndarray, train, test) -> np.ndarray:
    """Mean squared error on ``test`` of models fitted (centred) on ``train``.

    ``w`` is (A, p); both sets are (n, mean, m2) over [x..., y].
    """
    n_t, mean_t, m2_t = test
    _, mean_f, _ = train
    p = w.shape[1]
    bias = (mean_t[p] - mean_f[p]) - w @ (mean_t[:p] - mean_f[:p])
    ss = m2_t[p, p] - 2 * w @ m2_t[:p, p] + np.einsum("ai,ij,aj->a", w, m2_t[:p, :p], w)
    return ss / n_t + bias**2


def bayes_ridge(n: int, mean: np.ndarray, m2: np.ndarray, x_idx: np.ndarray, y_idx: int):
    """Ridge regression with evidence-maximised noise and weight precisions.

    Gamma priors of 1e-6 on both precisions, at most 300 updates, stop when the
    coefficients move by less than 1e-3 in total.  Returns (intercept, coef).
    """
    # Prior parameters and stopping rule of the public algorithm.
    prior, tol, rounds = 1e-6, 1e-3, 300
    s = m2[np.ix_(x_idx, x_idx)]
    c = m2[x_idx, y_idx]
    yy = m2[y_idx, y_idx]
    values, vectors = np.linalg.eigh(s)
    values = np.clip(values, 0.0, None)
    projected = vectors.T @ c
    noise = 1.0 / (yy / n + np.finfo(float).eps)
    weight = 1.0

    def coefficients():
        return vectors @ (projected / (values + weight / noise))

    old = None
    for _ in range(rounds):
        b = coefficients()
        rss = max(yy - 2 * b @ c + b @ s @ b, 0.0)
        gamma = np.sum(noise * values / (weight + noise * values))
        weight = (gamma + 2 * prior) / (b @ b + 2 * prior)
        noise = (n - gamma + 2 * prior) / (rss + 2 * prior)
        if old is not None and np.abs(old - b).sum() < tol:
            break
        old = b
    b = coefficients()
    return mean[y_idx] - mean[x_idx] @ b, b
