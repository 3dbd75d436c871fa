"""Alignment, joins, reshaping and set operations on panels.

All joins are equi-joins on date and/or entity; which side is broadcast is left
to Spark, which knows the sizes at run time.  Grids are generated from date
ranges or date sets, never by a cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricepanel.functions.calendar import is_weekend


def overlap_bounds(*dfs: DataFrame, date: str = "obs_date") -> Column:
    """Scalar struct ``(lo, hi)``: latest start and earliest end of the inputs."""
    ranges = [df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")) for df in dfs]
    joined = reduce(DataFrame.unionByName, ranges)
    return joined.agg(F.struct(F.max("lo").alias("lo"), F.min("hi").alias("hi")).alias("w")).scalar()


def temporal_overlap(
    a: DataFrame, b: DataFrame, date: str = "obs_date"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both inputs cut to their common date range, and a one-row summary of it.

    Without overlap both results are empty and ``overlap_days`` is 0.
    """
    w = overlap_bounds(a, b, date=date)
    inside = F.col(date).between(w.getField("lo"), w.getField("hi"))
    days = F.greatest(F.datediff(w.getField("hi"), w.getField("lo")) + 1, F.lit(0))
    summary = a.sparkSession.range(1).select(
        w.getField("lo").alias("overlap_start"),
        w.getField("hi").alias("overlap_end"),
        days.cast("bigint").alias("overlap_days"),
    )
    return a.where(inside), b.where(inside), summary


def common_dates(*dfs: DataFrame, date: str = "obs_date") -> DataFrame:
    """Dates present in every input."""
    return reduce(DataFrame.intersect, [df.select(date) for df in dfs])


def base_rate(
    df: DataFrame, value: str = "price", keys: list[str] | None = None, date: str = "obs_date"
) -> DataFrame:
    """Daily minimum over segments."""
    return df.groupBy(*(keys or []), date).agg(F.min(value).alias("base_rate"))


def daily_mean(
    df: DataFrame, value: str = "price", keys: list[str] | None = None, date: str = "obs_date"
) -> DataFrame:
    return df.groupBy(*(keys or []), date).agg(F.avg(value).alias(f"mean_{value}"))


def daily_rollup(
    df: DataFrame, values: list[str], keys: list[str] | None = None, date: str = "obs_date"
) -> DataFrame:
    """Daily means; the calendar columns are recomputed from the date, which makes the
    roll-up independent of row order."""
    d = F.col(date)
    return (
        df.groupBy(*(keys or []), date)
        .agg(*[F.avg(v).alias(v) for v in values])
        .withColumns(
            {"day_of_week": F.weekday(d), "month": F.month(d), "is_weekend": is_weekend(d)}
        )
    )


def to_matrix(
    df: DataFrame,
    entities: list[str],
    value: str = "price",
    agg: str = "min",
    rows: str = "obs_date",
    columns: str = "entity",
) -> DataFrame:
    """Long to wide for a given column list (one job, no scan to discover columns)."""
    return df.groupBy(rows).pivot(columns, entities).agg(F.expr(f"{agg}(`{value}`)"))


def entity_list(df: DataFrame, columns: str = "entity") -> list[str]:
    """Sorted distinct column values of a matrix, for callers that have no registry.

    The result becomes one column each, so it is limited by what a table can
    have as columns, not by the number of rows.
    """
    return [r[0] for r in df.select(columns).distinct().orderBy(columns).collect()]


def to_long(
    m: DataFrame, ids: list[str], columns: str = "entity", value: str = "price"
) -> DataFrame:
    """Wide to long over every non-id column; NULL cells stay."""
    return m.unpivot(ids, [c for c in m.columns if c not in ids], columns, value)


def transpose(
    m: DataFrame, index: str, new_columns: list, new_index: str = "name"
) -> DataFrame:
    """Swap rows and columns of a wide matrix; ``new_columns`` are the index values kept."""
    long = to_long(m, [index], new_index, "_v")
    return long.groupBy(new_index).pivot(index, new_columns).agg(F.first("_v"))


def reindex_to(
    df: DataFrame,
    dates: DataFrame,
    keys: list[str] | None = None,
    on: list[str] | None = None,
    date: str = "obs_date",
) -> DataFrame:
    """Exactly the dates of ``dates`` for every series of ``df``.

    Other dates are dropped, absent ones appear with NULL values.  ``on`` names
    the columns that tie a series to its own date set (e.g. the focal); with
    none, all series share one set.  Date sets travel as arrays, whose length
    is bounded by the calendar.
    """
    keys, on = keys or ["entity"], on or []
    series = df.select(*keys).distinct()
    if on:
        sets = dates.groupBy(*on).agg(F.collect_set(date).alias("_dates"))
        grid = series.join(sets, on)
    else:
        shared = dates.agg(F.collect_set(date).alias("_dates")).scalar()
        grid = series.withColumn("_dates", shared)
    grid = grid.select(*keys, F.explode("_dates").alias(date))
    return grid.join(df, [*keys, date], "left")


def densify(
    df: DataFrame,
    keys: list[str] | None = None,
    start: Column | None = None,
    end: Column | None = None,
    per_series: bool = False,
    date: str = "obs_date",
) -> DataFrame:
    """Every calendar day for every series; days without a row get NULL values.

    The range is ``start..end`` when given (scalar columns), the series' own
    range with ``per_series``, and the overall range otherwise.
    """
    keys = keys or ["entity"]
    if start is not None and end is not None:
        series = df.select(*keys).distinct().withColumns({"_lo": start, "_hi": end})
    elif per_series:
        series = df.groupBy(*keys).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    else:
        span = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("s")).scalar()
        series = df.select(*keys).distinct().withColumns(
            {"_lo": span.getField("lo"), "_hi": span.getField("hi")}
        )
    grid = series.where(F.col("_lo") <= F.col("_hi")).select(
        *keys, F.explode(F.sequence("_lo", "_hi")).alias(date)
    )
    return grid.join(df, [*keys, date], "left")


def align_inner(a: DataFrame, b: DataFrame, on: list[str] | None = None) -> DataFrame:
    return a.join(b, on or ["obs_date"])


def attach(df: DataFrame, extra: DataFrame, on: list[str]) -> DataFrame:
    """Left equi-join of additional columns."""
    return df.join(extra, on, "left")


def semi_align(
    a: DataFrame, b: DataFrame, on: tuple[str, ...] = ("obs_date", "entity")
) -> tuple[DataFrame, DataFrame]:
    """Rows of each side whose date and whose entity occur on the other side.

    The two memberships are separate on purpose: a cell may be absent from the
    other side as long as its date and its entity are known there.
    """

    def keep(x: DataFrame, other: DataFrame) -> DataFrame:
        for c in on:
            x = x.join(other.select(c).distinct(), c, "left_semi")
        return x

    return keep(a, b), keep(b, a)


def missing_dates(base: DataFrame, df: DataFrame, date: str = "obs_date") -> DataFrame:
    """Dates of ``base`` that ``df`` lacks."""
    return base.select(date).distinct().join(df.select(date), date, "left_anti")


def missing_by_entity(df: DataFrame, panel: DataFrame, date: str = "obs_date") -> DataFrame:
    """(entity, date) for every date of ``df`` on which an entity of ``panel`` has no row."""
    entities = panel.agg(F.collect_set("entity").alias("e")).scalar()
    every = df.select(date).distinct().select(F.explode(entities).alias("entity"), date)
    return every.join(panel.select("entity", date), ["entity", date], "left_anti")


def drop_empty_entities(
    df: DataFrame, value: str = "price", keys: list[str] | None = None
) -> DataFrame:
    """Remove series without a single value."""
    keys = keys or ["entity"]
    alive = df.groupBy(*keys).agg(F.count(value).alias("_n")).where("_n > 0").select(*keys)
    return df.join(alive, keys, "left_semi")


def top_k(
    df: DataFrame,
    k: int,
    by: str,
    tie_break: str,
    ascending: bool = False,
    keys: list[str] | None = None,
) -> DataFrame:
    """Largest (smallest) ``k`` rows, overall or per group, ties settled by ``tie_break``.

    Per group the rank is a window limit that Spark evaluates before the
    shuffle as well, so a hot group ships only its own candidates.
    """
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    if not keys:
        return df.orderBy(order, tie_break).limit(k)
    w = Window.partitionBy(*keys).orderBy(order, tie_break)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def assert_panel(
    df: DataFrame,
    keys: list[str],
    value: str = "price",
    required: list[str] | None = None,
    raise_on_violation: bool = True,
) -> DataFrame:
    """Quality gates: unique cells, complete values, expected columns, non-empty sample.

    Returns one row per rule with its violation count.
    """
    absent = [c for c in (required or []) if c not in df.columns]
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count(value).alias("_v"))
    counts = cells.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_cells"),
        F.coalesce(F.sum(F.col("_n") - F.col("_v")), F.lit(0)).cast("bigint").alias("null_values"),
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("empty_sample"),
        F.lit(len(absent)).cast("bigint").alias("absent_columns"),
    )
    out = to_long(counts, [], "rule", "violations")
    if raise_on_violation:
        broken = [r for r in out.where("violations > 0").collect()]
        if broken:
            raise ValueError("; ".join(f"{r['rule']}={r['violations']}" for r in sorted(broken)))
    return out
