"""Matrix imputation: chained ridge, low rank, nearest neighbours (the chained forest is in ``forest``).

Input is the row-vector form ``(focal_id, obs_date, columns, row)`` with NULL
for missing cells.

Chained ridge and soft-impute update missing cells round after round, but every
filled value is an affine function of the observed values of its row, and that
function is the same for all rows of a focal with the same missing pattern.
Cross products per (focal, pattern) therefore determine every round exactly:
one aggregation over the rows, a solve on the small matrices, one pass that
applies the resulting maps.  The number of Spark jobs does not depend on the
number of rounds or columns, and all focals advance together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pricepanel.functions.stats import dot
from pricepanel.lineage import cut, ship, spread
from pricepanel.operators import gram as G, solve as S

DOUBLES = T.ArrayType(T.DoubleType())


def missing_pattern(row: Column) -> Column:
    """Text of 0/1, 1 where the cell is missing."""
    return F.array_join(F.transform(row, lambda v: F.when(v.isNull(), "1").otherwise("0")), "")


def pattern_gram(rows: DataFrame) -> DataFrame:
    keyed = rows.withColumn("pattern", missing_pattern(F.col("row")))
    return G.vector_gram(keyed, ["focal_id", "pattern"], "row")


def _by_pattern(pdf: pd.DataFrame):
    """{pattern: (missing mask, n, mean, m2)} of one focal."""
    out = {}
    for pattern, part in pdf.groupby("pattern", sort=True):
        merged = G.merge(G.unpack(r.n, r.mean, r.m2) for r in part.itertuples(index=False))
        out[pattern] = (np.array([c == "1" for c in pattern]), *merged)
    return out


def _ridge_rounds(patterns: dict, rounds: int):
    """Affine maps of every round for chained ridge regression.

    Works in coordinates shifted by the observed column means, so the starting
    fill (the mean) is zero.  ``maps[pattern]`` is (p, 1 + p): constant and
    weights on the shifted row, with missing slots unused.
    """
    p = len(next(iter(patterns.values()))[0])
    seen = np.zeros(p)
    total = np.zeros(p)
    for miss, n, mean, _ in patterns.values():
        seen += n * ~miss
        total += np.where(miss, 0.0, n * mean)
    shift = total / np.maximum(seen, 1)
    n_all = sum(v[1] for v in patterns.values())

    maps, moments = {}, {}
    for key, (miss, n, mean, m2) in patterns.items():
        m = np.zeros((p, p + 1))
        m[~miss, 1 + np.flatnonzero(~miss)] = 1.0
        maps[key] = m
        d = np.where(miss, 0.0, mean - shift)
        u = np.empty((p + 1, p + 1))
        u[0, 0] = n
        u[0, 1:] = u[1:, 0] = n * d
        u[1:, 1:] = np.where(np.outer(~miss, ~miss), m2, 0.0) + n * np.outer(d, d)
        moments[key] = u

    gaps = n_all - seen
    order = [j for j in np.argsort(gaps / n_all, kind="stable") if gaps[j] > 0 and seen[j] > 0]
    if p == 1:
        order = []  # nothing to regress on: the mean start is the result
    history = {key: [] for key in patterns}
    const = np.zeros(p + 1)
    const[0] = 1.0
    for _ in range(rounds):
        for j in order:
            acc = np.zeros((p + 1, p + 1))
            for key, (miss, *_rest) in patterns.items():
                if not miss[j]:
                    full = np.vstack([const, maps[key]])
                    acc += full @ moments[key] @ full.T
            n = acc[0, 0]
            mean = acc[0, 1:] / n
            m2 = acc[1:, 1:] - n * np.outer(mean, mean)
            others = np.array([k for k in range(p) if k != j], dtype=int)
            b0, b = S.bayes_ridge(int(round(n)), mean, m2, others, j)
            for key, (miss, *_rest) in patterns.items():
                if miss[j]:
                    maps[key][j] = b0 * const + b @ maps[key][others]
        for key in patterns:
            history[key].append(maps[key].copy())
    return shift, history


def _soft_maps(patterns: dict, max_rank: int, share: float, tol: float, rounds: int):
    """Linear maps of soft-impute: missing cells start at zero, singular values are
    shrunk by ``share`` of the largest one, at most ``max_rank`` survive."""
    p = len(next(iter(patterns.values()))[0])
    n_all = sum(v[1] for v in patterns.values())
    rank = max(min(max_rank, min(n_all, p) - 1), 0)
    maps, moments = {}, {}
    for key, (miss, n, mean, m2) in patterns.items():
        maps[key] = np.diag((~miss).astype(float))
        d = np.where(miss, 0.0, mean)
        moments[key] = np.where(np.outer(~miss, ~miss), m2, 0.0) + n * np.outer(d, d)
    shrink = None
    for _ in range(rounds):
        total = sum(maps[k] @ moments[k] @ maps[k].T for k in patterns)
        values, vectors = np.linalg.eigh(total)
        s = np.sqrt(np.clip(values, 0, None))
        if shrink is None:
            shrink = s.max() * share
        kept = np.maximum(s - shrink, 0.0)
        # eigh sorts ascending: only the last ``rank`` directions may survive
        kept[: max(p - rank, 0)] = 0.0
        ratio = np.divide(kept, s, out=np.zeros_like(s), where=s > 0)
        project = (vectors * ratio) @ vectors.T
        moved = old = 0.0
        for key, (miss, *_rest) in patterns.items():
            if not miss.any():
                continue
            new = (project @ maps[key])[miss]
            step = new - maps[key][miss]
            moved += np.einsum("ij,jk,ik->", step, moments[key], step)
            old += np.einsum("ij,jk,ik->", maps[key][miss], moments[key], maps[key][miss])
            maps[key][miss] = new
        if old > 0 and np.sqrt(max(moved, 0) / old) < tol:
            break
    return maps


_MAP_SCHEMA = [
    T.StructField("pattern", T.StringType()),
    T.StructField("shift", DOUBLES),
    T.StructField("maps", T.ArrayType(DOUBLES)),
    T.StructField("status", T.StringType()),
]


def _isolated(solve_focal):
    """Run a focal's solve; a failure becomes a status on its rows instead of ending the job."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return solve_focal(pdf).assign(status="Success")
        except (ValueError, ArithmeticError) as e:
            patterns = sorted(pdf["pattern"].unique())
            return pd.DataFrame(
                {
                    "focal_id": pdf["focal_id"].iloc[0],
                    "pattern": patterns,
                    "shift": None,
                    "maps": None,
                    "status": f"Failed: {e}",
                }
            )

    return run


def _apply_map(row: Column, flat: Column) -> Column:
    """Completed row: observed cells as they are, missing ones from the map.

    ``flat`` holds per cell a constant and one weight per column; missing
    columns have weight zero.
    """
    p = F.size(row)

    def cell(j: Column) -> Column:
        weights = F.slice(flat, j * (p + 1) + 2, p)
        terms = F.zip_with(row, weights, lambda v, c: F.coalesce(v * c, F.lit(0.0)))
        return F.aggregate(terms, F.get(flat, j * (p + 1)), lambda acc, t: acc + t)

    return F.transform(row, lambda v, j: F.coalesce(v, cell(j)))


def iterative_impute(rows: DataFrame, rounds: int = 10, tol: float = 1e-3) -> DataFrame:
    """Chained Bayesian ridge imputation: mean start, fewest gaps first.

    A focal stops at the first round in which no cell moves by more than
    ``tol`` times its largest absolute observed value.
    """
    focal = rows.schema["focal_id"]
    schema = T.StructType([focal, *_MAP_SCHEMA])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        patterns = _by_pattern(pdf)
        shift, history = _ridge_rounds(patterns, rounds)

        def unshifted(m: np.ndarray) -> np.ndarray:
            """The same map on unshifted rows."""
            out = m.copy()
            out[:, 0] += shift - m[:, 1:] @ shift
            return out.ravel()
        return pd.DataFrame(
            {
                "focal_id": pdf["focal_id"].iloc[0],
                "pattern": list(history),
                "shift": [shift] * len(history),
                "maps": [[unshifted(m) for m in steps] for steps in history.values()],
            }
        )

    # Read by two passes below, so the small table of maps is solved and written once.
    maps = cut(
        spread(pattern_gram(rows), ["focal_id"])
        .groupBy("focal_id")
        .applyInPandas(_isolated(solve), schema)
    )
    mapped = rows.withColumn("pattern", missing_pattern(F.col("row"))).join(
        maps, ["focal_id", "pattern"]
    )
    filled = mapped.withColumn(
        "_steps", F.transform("maps", lambda m: _apply_map(F.col("row"), m))
    )
    start = F.transform("row", lambda v, i: F.coalesce(v, F.get("shift", i)))

    def moved(r: int) -> Column:
        before = F.get("_steps", F.lit(r - 1)) if r else start
        return F.max(
            F.array_max(F.zip_with(F.get("_steps", F.lit(r)), before, lambda a, b: F.abs(a - b)))
        )

    largest = F.max(F.array_max(F.transform("row", lambda v: F.abs(v))))
    stop = filled.groupBy("focal_id").agg(
        F.array(*[moved(r) for r in range(rounds)]).alias("_moved"), largest.alias("_largest")
    )
    first_quiet = F.array_position(
        F.transform("_moved", lambda m: m < F.lit(tol) * F.col("_largest")), True
    )
    stop = stop.select(
        "focal_id",
        F.when(first_quiet > 0, first_quiet).otherwise(rounds).cast("int").alias("rounds_used"),
    )
    final = _apply_map(F.col("row"), F.get("maps", F.col("rounds_used") - 1))
    return mapped.join(stop, "focal_id").select(
        "focal_id",
        "obs_date",
        "columns",
        F.coalesce(final, "row").alias("row"),
        (F.locate("1", "pattern") > 0).alias("had_missing"),
        "rounds_used",
        "status",
    )


def soft_impute(
    rows: DataFrame,
    rank: int = 3,
    share: float = 1 / 50,
    tol: float = 1e-3,
    rounds: int = 100,
) -> DataFrame:
    """Low-rank completion by iterated singular-value shrinkage."""
    focal = rows.schema["focal_id"]
    schema = T.StructType([focal, *_MAP_SCHEMA])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        patterns = _by_pattern(pdf)
        maps = _soft_maps(patterns, rank, share, tol, rounds)
        p = len(next(iter(maps.values())))
        flat = [[np.hstack([np.zeros((p, 1)), m]).ravel()] for m in maps.values()]
        return pd.DataFrame(
            {
                "focal_id": pdf["focal_id"].iloc[0],
                "pattern": list(maps),
                "shift": [np.zeros(p)] * len(maps),
                "maps": flat,
            }
        )

    maps = spread(pattern_gram(rows), ["focal_id"]).groupBy("focal_id").applyInPandas(_isolated(solve), schema)
    return (
        rows.withColumn("pattern", missing_pattern(F.col("row")))
        .join(maps, ["focal_id", "pattern"])
        .select(
            "focal_id",
            "obs_date",
            "columns",
            F.coalesce(_apply_map(F.col("row"), F.get("maps", F.lit(0))), "row").alias("row"),
            (F.locate("1", "pattern") > 0).alias("had_missing"),
            "status",
        )
    )


def clip_rows(rows: DataFrame) -> DataFrame:
    """Negative cells become 0."""
    return rows.withColumn("row", F.transform("row", lambda v: F.greatest(v, F.lit(0.0))))


def complete_matrix(rows: DataFrame, method: str = "iterative") -> DataFrame:
    """Matrix completion as the portfolio runs it: impute, then clip at zero."""
    done = {"iterative": iterative_impute, "soft": soft_impute}[method](rows)
    return clip_rows(done)


def rows_to_long(rows: DataFrame) -> DataFrame:
    """(focal_id, obs_date, entity, price); the base rate is entity ``base_rate``."""
    names = F.concat(F.array(F.lit("base_rate")), F.col("columns.entity"))
    return rows.select(
        "focal_id",
        "obs_date",
        F.inline(F.arrays_zip(names.alias("entity"), F.col("row").alias("price"))),
    )


# --- nearest neighbours ----------------------------------------------------------------

# Dates per tile; a task compares at most TILE x TILE rows at a time.
TILE = 512


def knn_impute(rows: DataFrame, k: int = 5, tile: int = TILE) -> DataFrame:
    """Distance-weighted mean of the ``k`` nearest dates that have the missing cell.

    The distance is Euclidean over the columns both dates have, scaled up to
    the full width.  Exact matches take all the weight; without any comparable
    donor the column mean is used.

    Dates are cut into tiles and every (target tile, donor tile) pair is one
    bounded group, which keeps only its own k best per missing cell; no pair of
    rows ever becomes a row.
    """
    w = Window.partitionBy("focal_id").orderBy("obs_date")
    numbered = rows.select(
        "focal_id",
        "obs_date",
        "row",
        F.floor((F.row_number().over(w) - 1) / tile).cast("int").alias("_tile"),
        F.floor((F.count(F.lit(1)).over(Window.partitionBy("focal_id")) - 1) / tile)
        .cast("int")
        .alias("_last"),
    )
    every = F.explode(F.sequence(F.lit(0), F.col("_last")))
    targets = numbered.where(F.exists("row", lambda v: v.isNull())).select(
        "focal_id", "obs_date", "row", F.col("_tile").alias("t"), every.alias("d")
    )
    donors = numbered.select(
        F.col("focal_id").alias("d_focal"),
        F.col("obs_date").alias("d_date"),
        F.col("row").alias("d_row"),
        every.alias("d_t"),
        F.col("_tile").alias("d_d"),
    )
    schema = T.StructType(
        [
            rows.schema["focal_id"],
            rows.schema["obs_date"],
            T.StructField("pos", T.IntegerType()),
            T.StructField("distance", T.DoubleType()),
            T.StructField("donor", rows.schema["obs_date"].dataType),
            T.StructField("value", T.DoubleType()),
        ]
    )
    names = [f.name for f in schema]

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=names)
        right = right.sort_values("d_date")
        x = np.stack(left["row"].to_numpy()).astype(float)
        y = np.stack(right["d_row"].to_numpy()).astype(float)
        p = x.shape[1]
        d2 = np.zeros((len(x), len(y)))
        shared = np.zeros((len(x), len(y)))
        for j in range(p):
            diff = x[:, j][:, None] - y[:, j][None, :]
            both = ~np.isnan(diff)
            d2 += np.where(both, diff * diff, 0.0)
            shared += both
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.where(shared > 0, np.sqrt(d2 * (p / shared)), np.inf)
        t_dates, d_dates = left["obs_date"].to_numpy(), right["d_date"].to_numpy()
        parts = []
        for j in range(p):
            t = np.flatnonzero(np.isnan(x[:, j]))
            d = np.flatnonzero(~np.isnan(y[:, j]))
            if not len(t) or not len(d):
                continue
            sub = dist[np.ix_(t, d)]
            best = np.argsort(sub, axis=1, kind="stable")[:, :k]
            chosen = np.take_along_axis(sub, best, axis=1)
            ok = np.isfinite(chosen)
            r, c = np.nonzero(ok)
            donor = d[best[r, c]]
            parts.append(
                pd.DataFrame(
                    {
                        "obs_date": t_dates[t[r]],
                        "pos": np.int32(j),
                        "distance": chosen[r, c],
                        "donor": d_dates[donor],
                        "value": y[donor, j],
                    }
                )
            )
        if not parts:
            return pd.DataFrame(columns=names)
        out = pd.concat(parts, ignore_index=True)
        out.insert(0, "focal_id", left["focal_id"].iloc[0])
        return out[names]

    ship(rows.sparkSession)
    found = (
        spread(targets, ["focal_id", "t", "d"])
        .groupBy("focal_id", "t", "d")
        .cogroup(
            spread(donors, ["d_focal", "d_t", "d_d"]).groupBy("d_focal", "d_t", "d_d")
        )
        .applyInPandas(nearest, schema)
    )
    best = found.groupBy("focal_id", "obs_date", "pos").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("distance", "donor", "value"))), 1, k).alias("_n")
    )
    exact = F.filter("_n", lambda n: n["distance"] == 0)
    ones = F.transform(exact, lambda n: F.lit(1.0))
    inverse = F.transform("_n", lambda n: F.try_divide(F.lit(1.0), n["distance"]))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    value = F.when(
        F.size(exact) > 0, dot(ones, F.transform(exact, lambda n: n["value"])) / F.size(exact)
    ).otherwise(dot(inverse, F.transform("_n", lambda n: n["value"])) / total(inverse))
    fills = (
        best.select("focal_id", "obs_date", "pos", value.alias("v"))
        .groupBy("focal_id", "obs_date")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "v"))).alias("_fill"))
    )
    means = (
        rows.select("focal_id", F.posexplode("row").alias("pos", "v"))
        .groupBy("focal_id", "pos")
        .agg(F.avg("v").alias("m"))
        .groupBy("focal_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "m"))).alias("_means"))
    )
    return (
        rows.join(fills, ["focal_id", "obs_date"], "left")
        .join(means, "focal_id")
        .select(
            "focal_id",
            "obs_date",
            "columns",
            F.transform(
                "row",
                lambda v, j: F.coalesce(
                    v, F.try_element_at("_fill", j), F.try_element_at("_means", j)
                ),
            ).alias("row"),
        )
    )
