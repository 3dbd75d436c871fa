"""Cross-product aggregates: the only thing a regression needs from the rows.

Two forms, both mergeable and centred (means and centred cross products instead
of raw sums, so that large price levels cost no digits):

* ``column_gram`` for a short fixed column list: built-in ``covar_pop``
  aggregates, evaluated map-side in the JVM.
* ``vector_gram`` for array features whose length differs between focals: each
  task reduces its Arrow batches to one partial per key.  A row of p features
  has p^2 products; emitting them as rows would multiply the data by p^2, so
  the products are formed by matrix multiplication inside the task and only
  p x p partials are shuffled.

A hot key therefore never travels as rows; its partials are merged by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from pricepanel.lineage import ship, spread

# Partials held by one task before it emits them (number of doubles).
_FLUSH_AT = 4_000_000


def column_gram(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, n, mean, m2): means and the full centred cross-product matrix, row-major.

    Rows with a NULL in any of ``cols`` must have been removed.
    """
    p = len(cols)
    aggs = [F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean")]
    aggs += [
        F.covar_pop(cols[i], cols[j]).alias(f"_c{i}_{j}") for i in range(p) for j in range(i, p)
    ]
    full = F.array(
        *[F.col("n") * F.col(f"_c{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)]
    )
    return df.groupBy(*keys).agg(*aggs).select(*keys, "n", "mean", full.alias("m2"))


def merge(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]):
    """Combine (n, mean, centred products) of disjoint row sets."""
    n, mean, m2 = 0, None, None
    for n_b, mean_b, m2_b in parts:
        if n_b == 0:
            continue
        if n == 0:
            n, mean, m2 = n_b, mean_b.copy(), m2_b.copy()
            continue
        d = mean_b - mean
        total = n + n_b
        m2 = m2 + m2_b + np.outer(d, d) * (n * n_b / total)
        mean = mean + d * (n_b / total)
        n = total
    return n, mean, m2


def vector_gram(
    df: DataFrame, keys: list[str], vector: str, weight: str | None = None
) -> DataFrame:
    """(keys, n, mean, m2) partials of an array column; at most a few per key and task.

    NULL elements count as 0; the caller keys rows by their missing pattern
    when that matters.  With ``weight``, the rows multiplied by that column are
    aggregated in the same pass and a column ``weighted`` tells the two apart.
    Combine partials with ``merge``.
    """
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + ([T.StructField("weighted", T.BooleanType())] if weight else [])
        + [
            T.StructField("n", T.LongType()),
            T.StructField("mean", T.ArrayType(T.DoubleType())),
            T.StructField("m2", T.ArrayType(T.DoubleType())),
        ]
    )

    def emit(held: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(held.keys()), columns=[*keys, "weighted"] if weight else keys)
        out["n"] = [v[0] for v in held.values()]
        out["mean"] = [v[1] for v in held.values()]
        out["m2"] = [v[2].ravel() for v in held.values()]
        return out

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        size = 0
        for batch in batches:
            if batch.empty:
                continue
            vectors = batch[vector].to_numpy()
            for key, where in batch.groupby(keys, sort=False, dropna=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                x = np.nan_to_num(np.stack(vectors[where]).astype(float))
                versions = [(key, x)]
                if weight:
                    w = batch[weight].to_numpy(dtype=float)[where]
                    versions = [((*key, False), x), ((*key, True), x * w[:, None])]
                for at, v in versions:
                    mean = v.mean(axis=0)
                    c = v - mean
                    part = (len(v), mean, c.T @ c)
                    if at in held:
                        part = merge(iter((held[at], part)))
                    else:
                        size += part[2].size
                    held[at] = part
            if size > _FLUSH_AT:
                yield emit(held)
                held, size = {}, 0
        if held:
            yield emit(held)

    ship(df.sparkSession)
    columns = [*keys, vector, *([weight] if weight else [])]
    return df.select(*columns).mapInPandas(reduce_batches, schema)


def merged(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One (keys, n, mean, m2) row per key from the partials of ``vector_gram``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, m2 = merge(unpack(r.n, r.mean, r.m2) for r in pdf.itertuples(index=False))
        return pdf.iloc[:1].assign(n=n, mean=[mean], m2=[m2.ravel()])

    ship(partials.sparkSession)
    chosen = partials.select(*keys, "n", "mean", "m2")
    return spread(chosen, keys).groupBy(*keys).applyInPandas(run, chosen.schema)


def unpack(row_n, row_mean, row_m2):
    """(n, mean, m2 matrix) of one aggregate row."""
    mean = np.asarray(row_mean, dtype=float)
    p = len(mean)
    return int(row_n), mean, np.asarray(row_m2, dtype=float).reshape(p, p)


def gram_table(gram: DataFrame, keys: list[str]) -> DataFrame:
    """Long form (keys, i, j, value) of complete aggregates, upper triangle."""
    p = F.size("mean")
    return (
        gram.select(*keys, p.alias("_p"), F.posexplode("m2").alias("_at", "value"))
        .select(
            *keys,
            F.floor(F.col("_at") / F.col("_p")).cast("int").alias("i"),
            (F.col("_at") % F.col("_p")).alias("j"),
            "value",
        )
        .where("i <= j")
    )
