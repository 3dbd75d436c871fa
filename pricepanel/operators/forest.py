"""Chained imputation by bagged regression trees, all focals in one job.

Input is the row-vector form ``(focal_id, obs_date, columns, row)``.  A focal's
matrix has at most one row per calendar date, so it is the unit of work: Spark
deals focals out to tasks and rounds need no exchange.  Inside a task all trees
of a forest and all nodes of a level grow together: every column keeps the
samples in order of (node, value), and one pass of running sums over that order
gives the best split of every node.  Splits are exact (between two neighbouring
values, no bins) and trees grow until their leaves are pure.

Columns with fewest gaps come first; gaps start at the column mean; rounds end
after ``rounds`` or once no cell moves by ``tol`` times the largest observed
value.  Bags are drawn from (seed, focal, round, column), so a task that runs
again gives the same values.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricepanel.lineage import ship, spread


def bagged_prediction(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray, asked: np.ndarray, depth: int | None = None
) -> np.ndarray:
    """Mean prediction for the rows of ``asked`` by one tree per row of ``weights`` (times a sample is in a bag)."""
    trees, p = len(weights), x.shape[1]
    tree, sample = np.nonzero(weights)
    values = np.ascontiguousarray(x[sample].T)
    w, y = weights[tree, sample].astype(float), y[sample]
    node = tree.copy()
    order = np.stack([np.lexsort((v, tree)) for v in values])
    at = np.repeat(np.arange(trees)[:, None], len(asked), axis=1)  # node of every asked row in every tree
    out = np.zeros(at.shape)
    level, k = 0, trees
    while k:
        live = order[0]
        size = np.bincount(node[live], minlength=k)
        start = np.cumsum(size) - size
        segment = np.repeat(np.arange(k), size)
        weight = np.bincount(node[live], w[live], k)
        mean = np.bincount(node[live], (w * y)[live], k) / weight
        off = np.zeros(len(y))
        off[live] = y[live] - mean[node[live]]
        spread_ = np.bincount(node[live], (w * off * off)[live], k)
        value = np.take_along_axis(values, order, 1)
        left, moved = np.cumsum(w[order], axis=1), np.cumsum((w * off)[order], axis=1)
        left -= (left[:, start] - w[order[:, start]])[:, segment]
        moved -= (moved[:, start] - (w * off)[order[:, start]])[:, segment]
        right = weight[segment] - left
        # Between two different values of one node; the sums of deviations of both sides are opposite.
        fits = np.zeros(order.shape, bool)
        fits[:, :-1] = (segment[:-1] == segment[1:]) & (value[:, :-1] < value[:, 1:])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, moved * moved * (1 / left + 1 / right), -1.0)
        best = np.maximum.reduceat(gain, start, axis=1)
        column, top = best.argmax(axis=0), best.max(axis=0)
        splits = (top > 1e-12 * spread_) & (spread_ > 1e-14 * weight * (1 + mean * mean))
        if depth is not None and level >= depth:
            splits[:] = False
        here = gain[column[segment], np.arange(len(segment))] == top[segment]
        place = np.minimum.reduceat(np.where(here, np.arange(len(segment)), len(segment) - 1), start)
        below = value[column, place]
        above = value[column, np.minimum(place + 1, len(segment) - 1)]
        middle = (below + above) / 2
        middle = np.where(middle < above, middle, below)
        done = (at >= 0) & ~splits[at]
        out[done] = mean[at[done]]
        at[done] = -1
        child = np.cumsum(splits) - 1
        going, row = np.nonzero(at >= 0)
        where = at[going, row]
        at[going, row] = 2 * child[where] + (asked[row, column[where]] > middle[where])
        order = order[splits[node[order]]].reshape(p, -1)
        inside = order[0]
        side = values[column[node[inside]], inside] > middle[node[inside]]
        node[inside] = 2 * child[node[inside]] + side
        k, level = 2 * int(splits.sum()), level + 1
        if k:
            kind = np.uint16 if k < 1 << 16 else np.int64  # short keys are sorted by radix
            order = np.take_along_axis(order, np.argsort(node[order].astype(kind), axis=1, kind="stable"), 1)
    return out.mean(axis=0)


def impute_matrix(
    m: np.ndarray, key: int, rounds: int, trees: int, seed: int, tol: float, depth: int | None
) -> np.ndarray:
    """``m`` with its NaN cells filled; a column without any value stays empty."""
    gap = np.isnan(m)
    known = np.flatnonzero(~gap.all(axis=0))
    filled = m.copy()
    if not len(known):
        return filled
    x = np.where(gap[:, known], np.nanmean(m[:, known], axis=0), m[:, known])
    missing = gap[:, known]
    limit = tol * np.abs(x[~missing]).max()
    chain = sorted(np.flatnonzero(missing.any(axis=0)).tolist(), key=lambda j: (missing[:, j].sum(), j))
    for number in range(rounds if len(known) > 1 else 0):
        before = x.copy()
        for j in chain:
            others = np.delete(x, j, axis=1)
            seen = ~missing[:, j]
            n = int(seen.sum())
            draw = np.random.default_rng([seed, key, number, j]).integers(0, n, (trees, n))
            bags = np.stack([np.bincount(d, minlength=n) for d in draw])
            x[~seen, j] = bagged_prediction(others[seen], x[seen, j], bags, others[~seen], depth)
        if np.abs(x - before).max() < limit:
            break
    filled[:, known] = x
    return filled


def forest_impute(
    rows: DataFrame,
    rounds: int = 10,
    trees: int = 10,
    seed: int = 42,
    tol: float = 1e-3,
    depth: int | None = None,
) -> DataFrame:
    """``rows`` with the missing cells of every focal filled; columns (focal_id, obs_date, columns, row)."""
    ship(rows.sparkSession)
    chosen = rows.select("focal_id", "obs_date", "columns", "row")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.sort_by("obs_date")
        cells = table.column("row").combine_chunks()
        p = len(cells[0])
        m = cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, p).astype(float)
        key = zlib.crc32(str(table.column("focal_id")[0].as_py()).encode())
        filled = impute_matrix(m, key, rounds, trees, seed, tol, depth)
        flat = pa.array(filled.ravel(), pa.float64(), from_pandas=True)
        lists = pa.ListArray.from_arrays(np.arange(0, m.size + 1, p, dtype=np.int32), flat)
        return table.set_column(table.schema.get_field_index("row"), "row", lists)

    # A focal's work is not in proportion to its bytes, so tasks are not merged by size.
    return spread(chosen, ["focal_id"]).groupBy("focal_id").applyInArrow(run, chosen.schema)


def forest_impute_wide(wide: DataFrame, cols: list[str], order: str, **options) -> DataFrame:
    """The same for one wide matrix: ``cols`` are its columns, ``order`` is the column that tells its rows apart."""
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    rows = wide.select(
        F.lit("").alias("focal_id"), F.col(order).alias("obs_date"), F.lit(0).alias("columns"), cells.alias("row")
    )
    filled = forest_impute(rows, **options).withColumnRenamed("obs_date", order)
    others = wide.select(*[c for c in wide.columns if c not in cols])
    out = filled.select(order, *[F.col("row")[i].alias(c) for i, c in enumerate(cols)])
    return out if others.columns == [order] else others.join(out, order)
