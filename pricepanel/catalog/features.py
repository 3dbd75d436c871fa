"""Feature engineering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.functions import calendar as C, stats
from pricepanel.operators import align as L, features as X
from pricepanel.sources import adapters as A


@query(
    "f1_calendar",
    sql="""SELECT obs_date, CAST(isodow(obs_date) - 1 AS INTEGER) AS day_of_week,
        CAST(month(obs_date) AS INTEGER) AS month, CAST(isodow(obs_date) >= 6 AS INTEGER) AS is_weekend,
        CAST(weekofyear(obs_date) AS INTEGER) AS week_of_year,
        CAST(dayofyear(obs_date) AS INTEGER) AS day_of_year FROM focal""",
    uses=["focal"],
)
def calendar(spark, root):
    return C.with_calendar(L.base_rate(A.focal_rows(spark, root))).drop("base_rate")


CYCLE = "round({f}(2 * pi() * {x} / {p}), 6) + 0.0 AS {n}"
PARTS = [
    ("isodow(obs_date) - 1", 7, "day"),
    ("month(obs_date)", 12, "month"),
    ("weekofyear(obs_date)", 52, "week"),
    ("dayofyear(obs_date)", 365, "day_of_year"),
]


@query(
    "f2_cyclic",
    sql="SELECT obs_date, "
    + ", ".join(
        CYCLE.format(f=f, x=f"({x})", p=p, n=f"{f}_{n}") for x, p, n in PARTS for f in ("sin", "cos")
    )
    + " FROM focal",
    uses=["focal"],
)
def cyclic(spark, root):
    out = C.with_cyclic(L.base_rate(A.focal_rows(spark, root))).drop("base_rate")
    return out.select("obs_date", *[F.round(c, 6).alias(c) for c in out.columns if c != "obs_date"])


@query(
    "f3_week_poly",
    sql="""SELECT focal_id, obs_date, round(w, 6) AS week_centered, round(w * w, 5) AS week_squared,
        round(w * w * w, 4) AS week_cubic, round(w * w * w * w, 3) AS week_quartic
        FROM (SELECT *, weekofyear(obs_date) - avg(weekofyear(obs_date)) OVER (PARTITION BY focal_id) AS w
              FROM portfolio)""",
    uses=["portfolio"],
)
def week_poly(spark, root):
    out = C.with_week_poly(A.portfolio(spark, root), ["focal_id"], degree=4)
    return out.select(
        "focal_id",
        "obs_date",
        F.round("week_centered", 6).alias("week_centered"),
        F.round("week_squared", 5).alias("week_squared"),
        F.round("week_cubic", 4).alias("week_cubic"),
        F.round("week_quartic", 3).alias("week_quartic"),
    )


@query(
    "f4_holiday",
    sql="""SELECT obs_date, CAST(month(obs_date) IN (12, 1) AS INTEGER) AS season,
        CAST(month(obs_date) IN (12, 1) OR (month(obs_date) = 7 AND day(obs_date) <= 7)
             OR (month(obs_date) = 11 AND day(obs_date) >= 22) AS INTEGER) AS extended FROM focal""",
    uses=["focal"],
)
def holiday(spark, root):
    d = F.col("obs_date")
    return L.base_rate(A.focal_rows(spark, root)).select(
        d, C.holiday(d).alias("season"), C.holiday(d, "extended").alias("extended")
    )


@query(
    "f5_season",
    sql="""SELECT obs_date, CAST(month(obs_date) IN (6, 7, 8, 12, 1) AS INTEGER) AS is_peak_season,
        CAST(month(obs_date) IN (6, 7, 8) AS INTEGER) AS is_summer,
        CAST(isodow(obs_date) >= 6 AS INTEGER) AS is_weekend FROM focal""",
    uses=["focal"],
)
def season(spark, root):
    d = F.col("obs_date")
    return L.base_rate(A.focal_rows(spark, root)).select(
        d,
        C.is_peak_season(d).alias("is_peak_season"),
        C.is_summer(d).alias("is_summer"),
        C.is_weekend(d).alias("is_weekend"),
    )


@query(
    "f6_diff",
    sql="""SELECT entity, obs_date, round(price - lag(price) OVER (PARTITION BY entity ORDER BY obs_date), 6)
        AS price_change FROM comp_dense""",
    uses=["comp_dense"],
)
def diff(spark, root):
    out = X.diff(L.densify(A.competitor_panel(spark, root)))
    return out.select("entity", "obs_date", F.round("price_change", 6).alias("price_change"))


@query(
    "f6_pct_change",
    sql="""SELECT entity, obs_date, round((level - prev) / nullif(prev, 0), 6) AS price_change_pct
        FROM (SELECT *, lag(level) OVER (PARTITION BY entity ORDER BY obs_date) AS prev FROM (
          SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date) AS level
          FROM comp_dense))""",
    uses=["comp_dense"],
)
def pct_change(spark, root):
    out = X.pct_change(L.densify(A.competitor_panel(spark, root)))
    return out.select("entity", "obs_date", F.round("price_change_pct", 6).alias("price_change_pct"))


@query(
    "f7_lags",
    sql="SELECT focal_id, obs_date, "
    + ", ".join(
        f"lag(base_rate, {k}) OVER (PARTITION BY focal_id ORDER BY obs_date) AS base_rate_lag_{k}"
        for k in (1, 2, 3, 4, 5, 7)
    )
    + " FROM portfolio",
    uses=["portfolio"],
)
def lags(spark, root):
    out = X.lags(A.portfolio(spark, root), (1, 2, 3, 4, 5, 7), "base_rate", ["focal_id"])
    return out.drop("base_rate")


@query(
    "f8_market_availability",
    sql="SELECT obs_date, round(avg(available), 6) AS market_availability FROM comp GROUP BY 1",
    uses=["comp"],
)
def market_availability(spark, root):
    out = X.market_availability(A.competitor_panel(spark, root))
    return out.withColumn("market_availability", F.round("market_availability", 6))


@query(
    "f9_market_mean",
    sql="""SELECT focal_id, obs_date, round(avg(price), 5) AS market_mean FROM region_panel GROUP BY 1, 2""",
    uses=["region_panel"],
)
def market_mean(spark, root):
    out = X.market_mean(A.region_panel(spark, root), keys=["focal_id"])
    return out.withColumn("market_mean", F.round("market_mean", 5))


def vectors(spark, root):
    return X.row_vectors(A.portfolio(spark, root), A.region_panel(spark, root))


# Dates of a focal that occur among its competitors, and the competitors with prices on them.
view(
    "focal_dates",
    ["region_panel"],
    """SELECT p.focal_id, p.obs_date, p.base_rate FROM portfolio p
       WHERE EXISTS (SELECT 1 FROM region_panel r WHERE r.focal_id = p.focal_id AND r.obs_date = p.obs_date)""",
)
view(
    "focal_columns",
    ["focal_dates"],
    """SELECT DISTINCT r.focal_id, r.entity, r.currency FROM region_panel r
       JOIN focal_dates d ON d.focal_id = r.focal_id AND d.obs_date = r.obs_date""",
)
view(
    "cells",
    ["focal_columns"],
    """SELECT d.focal_id, d.obs_date, c.entity, c.currency, r.price FROM focal_dates d
       JOIN focal_columns c ON c.focal_id = d.focal_id
       LEFT JOIN region_panel r ON r.focal_id = d.focal_id AND r.entity = c.entity AND r.obs_date = d.obs_date""",
)


view(
    "wide_cells",
    ["cells"],
    """SELECT d.focal_id, d.obs_date, list_prepend(d.base_rate, x.prices) AS v FROM focal_dates d
       JOIN (SELECT focal_id, obs_date, list(price ORDER BY entity) AS prices FROM cells GROUP BY 1, 2) x
       USING (focal_id, obs_date)""",
)


@query(
    "c17_design_vectors",
    sql="""SELECT d.focal_id, d.obs_date, list_prepend(d.base_rate, x.prices) AS row
        FROM focal_dates d JOIN (SELECT focal_id, obs_date, list(price ORDER BY entity) AS prices
                                 FROM cells GROUP BY 1, 2) x USING (focal_id, obs_date)""",
    uses=["cells"],
)
def design_vectors(spark, root):
    return vectors(spark, root).select("focal_id", "obs_date", "row")


# Feature names of the lagged data set.
DICTIONARY = """SELECT focal_id, entity || '_lag_' || k AS feature, 'lag' AS kind, CAST(k AS INTEGER) AS lag, currency
    FROM focal_columns, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
    UNION ALL SELECT focal_id, f, 'temporal', NULL, NULL
    FROM (SELECT DISTINCT focal_id FROM focal_columns),
      (SELECT unnest(['sin_day_of_week', 'cos_day_of_week', 'sin_month', 'cos_month', 'sin_day_of_year',
                      'cos_day_of_year', 'is_weekend']) AS f)"""


@query(
    "f10_select_features",
    sql=f"SELECT * FROM ({DICTIONARY}) WHERE kind = 'temporal' OR currency = 'USD'",
    uses=["focal_columns"],
)
def select_features(spark, root):
    """All lag features of every focal, then the USD rule on the description."""
    columns = vectors(spark, root).groupBy("focal_id").agg(F.first("columns").alias("columns"))
    every = columns.select(
        "focal_id",
        F.inline(
            F.concat(X.lag_names(F.col("columns"), None), X.described(C.LAG_TEMPORAL, "temporal"))
        ),
    )
    return X.select_features(every, "usd_lags")


@query(
    "f11_lag_profile",
    sql="""SELECT focal_id, n AS original_rows, greatest(n - 5, 0) AS final_rows, least(n, 5) AS rows_lost,
        round(greatest(n - 5, 0) / n * 100, 1) AS data_retention_pct, c + 3 + 5 * c + 7 AS total_features,
        5 * c AS lag_features, c AS price_columns, c - 1 AS num_competitors, 'Success' AS status
        FROM (SELECT focal_id, count(*) AS n FROM focal_dates GROUP BY 1)
        JOIN (SELECT focal_id, count(*) + 1 AS c FROM focal_columns GROUP BY 1) USING (focal_id)""",
    uses=["focal_columns"],
)
def lag_profile(spark, root):
    return X.lag_profile(vectors(spark, root))


_LAGGED = ", ".join(f"lag(v, {k}) OVER w AS lag_{k}" for k in X.LAGS)
_WAVES = ", ".join(
    f"round({fn}(2 * pi() * {part} / {period}), 9) + 0.0"
    for part, period in (("(isodow(obs_date) - 1)", 7), ("month(obs_date)", 12), ("dayofyear(obs_date)", 365))
    for fn in ("sin", "cos")
)


@query(
    "f11_lagged_rows",
    sql=f"""SELECT focal_id, obs_date, v AS row, {", ".join(f"lag_{k}" for k in X.LAGS)},
        [{_WAVES}, CAST(isodow(obs_date) >= 6 AS INTEGER)::DOUBLE] AS temporal
        FROM (SELECT *, {_LAGGED} FROM wide_cells WINDOW w AS (PARTITION BY focal_id ORDER BY obs_date))
        WHERE lag_{max(X.LAGS)} IS NOT NULL""",
    uses=["wide_cells"],
)
def lagged_rows(spark, root):
    """The lagged data set itself: prices of a date, of each lag, and the temporal block."""
    temporal = F.transform(C.lag_temporal_array(), lambda x: F.round(x, 9) + 0.0)
    return X.lagged_rows(vectors(spark, root)).select(
        "focal_id", "obs_date", "row", *[f"lag_{k}" for k in X.LAGS], temporal.alias("temporal")
    )


@query(
    "f13_alpha_grid",
    sql="""SELECT entity, round(list_sum(list_transform(g, lambda a: a)), 6) AS grid_sum, len(g) AS grid_len,
        round(g[1], 6) AS grid_first, round(g[len(g)], 6) AS grid_last,
        round(abs(pow(avg(price) / 1e5, 2)), 4) AS level2
        FROM comp, (SELECT list(pow(10, -4 + i * 5.0 / 49) ORDER BY i) AS g FROM range(50) t(i))
        GROUP BY entity, g""",
    uses=["comp"],
)
def alpha_grid(spark, root):
    grid = stats.log_grid(-4, 1, 50)
    return (
        A.competitor_panel(spark, root)
        .groupBy("entity")
        .agg(F.round(F.abs(F.pow(F.avg("price") / 1e5, F.lit(2))), 4).alias("level2"))
        .withColumn("_g", grid)
        .select(
            "entity",
            F.round(F.aggregate("_g", F.lit(0.0), lambda a, b: a + b), 6).alias("grid_sum"),
            F.size("_g").cast("bigint").alias("grid_len"),
            F.round(F.get("_g", F.lit(0)), 6).alias("grid_first"),
            F.round(F.get("_g", F.lit(49)), 6).alias("grid_last"),
            "level2",
        )
    )
