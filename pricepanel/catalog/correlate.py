"""Correlation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.catalog.profile import comp_dense
from pricepanel.catalog.features import vectors
from pricepanel.catalog.matrix import market_long, market_rows
from pricepanel.lineage import cut
from pricepanel.operators import align as L, correlate as R, features as X, forest, matrix as M, normalise as N
from pricepanel.operators.impute import both_ways, decayed
from pricepanel.sources import adapters as A

CORR = "covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"

view(
    "pairs",
    ["focal_rows", "comp"],
    """SELECT obs_date, f, c FROM (SELECT obs_date, avg(price) AS f FROM focal_rows GROUP BY 1)
       JOIN (SELECT obs_date, avg(price) AS c FROM comp GROUP BY 1) USING (obs_date)""",
)
view(
    "region_pairs",
    ["portfolio", "region_panel"],
    """SELECT focal_id, obs_date, f, c FROM (SELECT focal_id, obs_date, avg(base_rate) AS f FROM portfolio GROUP BY 1, 2)
       JOIN (SELECT focal_id, obs_date, avg(price) AS c FROM region_panel GROUP BY 1, 2)
       USING (focal_id, obs_date)""",
)


def pairs(spark, root):
    return R.paired_daily(A.focal_rows(spark, root), A.competitor_panel(spark, root))


def region_pairs(spark, root):
    target = A.portfolio(spark, root).withColumnRenamed("base_rate", "price")
    return R.paired_daily(target, A.region_panel(spark, root), keys=["focal_id"])


@query(
    "g1_level_corr",
    sql="SELECT count(*) AS n_dates, round(" + CORR.format(x="f", y="c") + ", 6) AS correlation FROM pairs",
    uses=["pairs"],
)
def level_corr(spark, root):
    return R.level_corr(pairs(spark, root)).withColumn("correlation", F.round("correlation", 6))


@query(
    "g1_level_corr_portfolio",
    sql="SELECT focal_id, count(*) AS n_dates, CASE WHEN count(*) >= 10 THEN round("
    + CORR.format(x="f", y="c")
    + ", 6) END AS correlation FROM region_pairs GROUP BY 1",
    uses=["region_pairs"],
)
def level_corr_portfolio(spark, root):
    out = R.level_corr(region_pairs(spark, root), ["focal_id"])
    return out.withColumn("correlation", F.round("correlation", 6))


@query(
    "g2_change_corr",
    sql="SELECT count(*) AS n_dates, round("
    + CORR.format(x="f", y="c")
    + """, 6) AS correlation FROM (SELECT f - lag(f) OVER (ORDER BY obs_date) AS f,
        c - lag(c) OVER (ORDER BY obs_date) AS c FROM pairs) WHERE f IS NOT NULL AND c IS NOT NULL""",
    uses=["pairs"],
)
def change_corr(spark, root):
    return R.change_corr(pairs(spark, root)).withColumn("correlation", F.round("correlation", 6))


@query(
    "g3_normalised_corr",
    sql="SELECT count(*) AS n_dates, round("
    + CORR.format(x="f", y="c")
    + ", 6) AS correlation FROM pairs",
    uses=["pairs"],
)
def normalised_corr(spark, root):
    """Rescaling is affine, so the correlation must equal the plain one."""
    out = R.normalised_corr(A.focal_rows(spark, root), A.competitor_panel(spark, root))
    return out.withColumn("correlation", F.round("correlation", 6))


def _lagged(keys: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    group = f"{keys}, " if keys else ""
    terms = " UNION ALL ".join(
        f"SELECT {group}{k} AS lag, f, c FROM (SELECT {group}"
        + (f"lag(f, {k}) OVER ({part}ORDER BY obs_date) AS f, c" if k > 0 else f"f, lag(c, {-k}) OVER ({part}ORDER BY obs_date) AS c")
        + (" FROM {t}) WHERE f IS NOT NULL AND c IS NOT NULL")
        for k in range(-5, 6)
    )
    by = f"GROUP BY {keys}, lag" if keys else "GROUP BY lag"
    rank = f"PARTITION BY {keys} " if keys else ""
    return f"""SELECT {group}lag, round(r, 6) AS correlation, CAST(first_value(lag) OVER
        ({rank}ORDER BY abs(r) DESC NULLS LAST, lag) AS INTEGER) AS best_lag
        FROM (SELECT {group}lag, CASE WHEN count(*) >= 5 THEN {CORR.format(x='f', y='c')} END AS r
              FROM ({terms}) {by})"""


@query("g4_lead_lag", sql=_lagged("").replace("{t}", "pairs"), uses=["pairs"])
def lead_lag(spark, root):
    return R.lead_lag(pairs(spark, root)).withColumn("correlation", F.round("correlation", 6))


@query(
    "g4_lead_lag_portfolio",
    sql=_lagged("focal_id").replace("{t}", "region_pairs"),
    uses=["region_pairs"],
)
def lead_lag_portfolio(spark, root):
    out = R.lead_lag(region_pairs(spark, root), keys=["focal_id"])
    return out.withColumn("correlation", F.round("correlation", 6))


@query(
    "g5_line_fit",
    sql="""SELECT focal_id, round(regr_slope(f, c), 6) AS slope, round(regr_intercept(f, c), 3) AS intercept
        FROM region_pairs GROUP BY 1""",
    uses=["region_pairs"],
)
def line_fit(spark, root):
    out = R.line_fit(region_pairs(spark, root), ["focal_id"])
    return out.select("focal_id", F.round("slope", 6).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(
    "g6_availability_corr",
    sql="SELECT round("
    + CORR.format(x="a", y="f")
    + ", 6) AS focal_corr, round("
    + CORR.format(x="a", y="c")
    + """, 6) AS comp_corr FROM pairs JOIN (SELECT obs_date, avg(available) AS a FROM comp GROUP BY 1)
        USING (obs_date)""",
    uses=["pairs"],
)
def availability_corr(spark, root):
    daily = L.daily_mean(A.competitor_panel(spark, root), "available")
    out = R.availability_corr(pairs(spark, root), daily)
    return out.select(F.round("focal_corr", 6).alias("focal_corr"), F.round("comp_corr", 6).alias("comp_corr"))


@query(
    "g7_segment_corr",
    sql="SELECT segment, count(c) AS n_dates, round("
    + CORR.format(x="CASE WHEN c IS NOT NULL THEN s END", y="CASE WHEN s IS NOT NULL THEN c END")
    + """, 6) AS correlation FROM (SELECT segment, obs_date, avg(price) AS s, count(*) AS n FROM focal_rows
        GROUP BY 1, 2) LEFT JOIN pairs USING (obs_date) GROUP BY 1
        HAVING sum(n) >= 30 AND count(c) >= 10""",
    uses=["pairs"],
)
def segment_corr(spark, root):
    market = pairs(spark, root).select("obs_date", "c")
    out = R.segment_corr(A.focal_rows(spark, root), market)
    return out.withColumn("correlation", F.round("correlation", 6))


@query(
    "g8_panel_corr",
    sql="SELECT focal_id, entity, round("
    + CORR.format(x="price", y="base_rate")
    + """, 6) AS correlation FROM region_panel JOIN portfolio USING (focal_id, obs_date)
        GROUP BY 1, 2""",
    uses=["region_panel"],
)
def panel_corr(spark, root):
    out = R.panel_corr(
        A.portfolio(spark, root),
        A.region_panel(spark, root),
        keys=["focal_id", "entity"],
        on=["focal_id", "obs_date"],
    )
    return out.withColumn("correlation", F.round("correlation", 6))


view(
    "candidates",
    ["comp_dense", "two_way", "decay_filled", "focal"],
    """SELECT b.entity, b.obs_date, b.price, t.price AS two_way, d.price AS decay
       FROM comp_dense b JOIN two_way t USING (entity, obs_date) JOIN decay_filled d USING (entity, obs_date)""",
)


def filled_both(dense):
    """Prices as they are, filled both ways and with decay, from one window sort."""
    keys, order = ["entity"], "obs_date"
    here, decay = decayed("price", keys, order)
    return (
        dense.withColumn("_rn", here)
        .withColumns({"two_way": both_ways("price", keys, order), "decay": decay})
        .drop("_rn")
    )


def candidates(spark, root):
    return filled_both(comp_dense(spark, root).select("entity", "obs_date", "price"))


#: Ranked over the masked panel; SQL has no form of the chained forest, so one pair of queries leaves it out.
METHODS = ["knn", "decay", "baseline"]
ALL_METHODS = ["knn", "forest", "decay", "baseline"]
_W = "OVER (PARTITION BY entity ORDER BY obs_date"
_PAST = f"last_value({{}} IGNORE NULLS) {_W})"
_NEXT = f"first_value({{}} IGNORE NULLS) {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
view(
    "rivals",
    ["knn_filled", "focal"],
    f"""SELECT g.entity, g.obs_date, g.price, k.price AS knn, g.baseline, g.decay FROM (
          SELECT entity, obs_date, price, coalesce({_PAST.format("price")}, {_NEXT.format("price")}) AS baseline,
                 coalesce(price, {_PAST.format("price")} * pow(0.99, rn - {_PAST.format("seen")}),
                          {_NEXT.format("price")}) AS decay
          FROM (SELECT *, CASE WHEN price IS NOT NULL THEN rn END AS seen FROM (
                  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY obs_date) AS rn FROM masked_grid))) g
        JOIN knn_filled k USING (entity, obs_date)""",
)


def rivals(spark, root, methods):
    """The masked panel and what each method makes of it, side by side; other methods are not run."""
    rows = market_rows(A.masked_panel(spark, root))
    out = filled_both(market_long(rows)).withColumnRenamed("two_way", "baseline")
    if "knn" in methods:
        out = out.join(market_long(M.knn_impute(rows), "knn"), ["entity", "obs_date"])
    if "forest" in methods:
        out = out.join(market_long(forest.forest_impute(rows), "forest"), ["entity", "obs_date"])
    return out.select("entity", "obs_date", "price", *methods)


def base(spark, root):
    return L.base_rate(A.focal_rows(spark, root))


def _with_focal(x: str) -> str:
    return CORR.format(x=x, y=f"CASE WHEN {x} IS NOT NULL THEN base_rate END")


view(
    "method_corr",
    ["rivals"],
    "SELECT entity, "
    + ", ".join(f"{_with_focal(x)} AS {n}" for x, n in [("price", "original")] + [(m, m) for m in METHODS])
    + " FROM rivals JOIN focal USING (obs_date) GROUP BY 1",
)
view(
    "distortion",
    ["method_corr"],
    " UNION ALL ".join(
        f"""SELECT '{m}' AS method, avg(abs({m} - original)) AS mean_distortion,
        max(abs({m} - original)) AS max_distortion FROM method_corr"""
        for m in METHODS
    ),
)


@query(
    "g9_corr_distortion",
    sql="""SELECT method, round(mean_distortion, 6) AS mean_distortion,
        round(max_distortion, 6) AS max_distortion FROM distortion""",
    uses=["distortion"],
)
def corr_distortion(spark, root):
    return ranking(spark, root, METHODS)


@query("g9_corr_distortion_all")
def corr_distortion_all(spark, root):
    return ranking(spark, root, ALL_METHODS)


def ranking(spark, root, methods):
    found = R.method_correlations(base(spark, root), rivals(spark, root, methods), methods)
    return R.corr_distortion(found, methods).select(
        "method",
        F.round("mean_distortion", 6).alias("mean_distortion"),
        F.round("max_distortion", 6).alias("max_distortion"),
    )


@query(
    "g10_best_imputation",
    sql="""SELECT entity, obs_date, m.method, round(CASE m.method WHEN 'knn' THEN knn
          WHEN 'decay' THEN decay ELSE baseline END, 3) AS price
        FROM rivals, (SELECT method FROM distortion ORDER BY mean_distortion, method LIMIT 1) m""",
    uses=["distortion"],
)
def best_imputation(spark, root):
    return best(spark, root, METHODS)


@query("g10_best_imputation_all")
def best_imputation_all(spark, root):
    return best(spark, root, ALL_METHODS)


def best(spark, root, methods):
    # Read by the ranking and by the choice, so written once.
    c = cut(rivals(spark, root, methods))
    d = R.corr_distortion(R.method_correlations(base(spark, root), c, methods), methods)
    return R.best_imputation(c, d, methods).select("entity", "obs_date", "method", F.round("price", 3).alias("price"))


@query(
    "g11_compare_imputations",
    sql=f"""SELECT entity, round(o, 6) AS original, round(i, 6) AS independent, round(b, 6) AS combined,
        round(abs(o - i), 6) AS independent_distortion, round(abs(o - b), 6) AS combined_distortion
        FROM (SELECT entity, {_with_focal('price')} AS o, {_with_focal('decay')} AS i,
              {_with_focal('two_way')} AS b FROM candidates JOIN focal USING (obs_date) GROUP BY 1)""",
    uses=["candidates"],
)
def compare_imputations(spark, root):
    out = R.compare_imputations(base(spark, root), candidates(spark, root), "decay", "two_way")
    return out.select("entity", *[F.round(c, 6).alias(c) for c in out.columns if c != "entity"])


@query(
    "g13_post_check",
    sql="SELECT count(*) AS n_dates, round("
    + CORR.format(x="normalized", y="c")
    + ", 6) AS correlation, abs("
    + CORR.format(x="normalized", y="c")
    + """) < 0.2 AS warning FROM focal_scaled
        JOIN (SELECT obs_date, avg(price) AS c FROM comp GROUP BY 1) USING (obs_date)""",
    uses=["focal_scaled"],
)
def post_check(spark, root):
    comp = A.competitor_panel(spark, root)
    scaled = N.mad_rescale(base(spark, root), comp, focal_value="base_rate")
    out = R.post_check(scaled, comp, target="normalized")
    return out.withColumn("correlation", F.round("correlation", 6))


# Every candidate of the in-sample design in long form: same-day prices, their lags, calendar features.
TEMPORAL = {
    "is_weekend": "CAST(isodow(obs_date) >= 6 AS INTEGER)",
    "day_of_year": "dayofyear(obs_date)",
    "week_of_year": "weekofyear(obs_date)",
    "week_centered": "wc",
    "week_squared": "wc * wc",
    "is_holiday": """CAST(month(obs_date) IN (12, 1) OR (month(obs_date) = 7 AND day(obs_date) <= 7)
        OR (month(obs_date) = 11 AND day(obs_date) >= 22) AS INTEGER)""",
    "is_peak_season": "CAST(month(obs_date) IN (6, 7, 8, 12, 1) AS INTEGER)",
    "is_summer": "CAST(month(obs_date) IN (6, 7, 8) AS INTEGER)",
} | {
    f"{f}_{name}": f"{f}(2 * pi() * ({x}) / {period})"
    for name, x, period in [
        ("day_of_week", "isodow(obs_date) - 1", 7),
        ("dow", "isodow(obs_date) - 1", 7),
        ("month", "month(obs_date)", 12),
        ("week", "weekofyear(obs_date)", 52),
        ("day_of_year", "dayofyear(obs_date)", 365),
    ]
    for f in ("sin", "cos")
}
LAGGED = ", ".join(
    f"lag(price, {k}) OVER (PARTITION BY focal_id, entity ORDER BY obs_date) AS lag_{k}" for k in range(1, 6)
)
view(
    "kept_dates",
    ["focal_dates"],
    """SELECT *, weekofyear(obs_date) - avg(weekofyear(obs_date)) OVER (PARTITION BY focal_id) AS wc FROM (
         SELECT * FROM focal_dates QUALIFY row_number() OVER (PARTITION BY focal_id ORDER BY obs_date) > 5)""",
)
view(
    "candidate_features",
    ["cells", "kept_dates"],
    f"""SELECT focal_id, obs_date, entity AS feature, price AS v FROM cells
        UNION ALL SELECT focal_id, obs_date, entity || '_' || name, v
          FROM (UNPIVOT (SELECT focal_id, obs_date, entity, {LAGGED} FROM cells)
                ON lag_1, lag_2, lag_3, lag_4, lag_5 INTO NAME name VALUE v)
        UNION ALL SELECT focal_id, obs_date, unnest([{", ".join(f"'{n}'" for n in TEMPORAL)}]),
          unnest([{", ".join(f"CAST({x} AS DOUBLE)" for x in TEMPORAL.values())}]) FROM kept_dates""",
)


@query(
    "g14_top_corr_features",
    sql="""SELECT focal_id, top, rank, feature, correlation FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY focal_id ORDER BY correlation DESC NULLS LAST, feature) AS INTEGER)
            AS rank FROM (SELECT focal_id, feature, round(abs("""
    + CORR.format(x="v", y="base_rate")
    + """), 6) AS correlation FROM candidate_features JOIN kept_dates USING (focal_id, obs_date)
            WHERE v IS NOT NULL AND base_rate IS NOT NULL GROUP BY 1, 2))
        JOIN (SELECT CAST(unnest([5, 10]) AS INTEGER) AS top) ON rank <= top""",
    uses=["candidate_features"],
)
def top_corr_features(spark, root):
    """The 5 and the 10 features of the in-sample design that correlate most with a focal's base rate."""
    rows = vectors(spark, root)
    columns = rows.groupBy("focal_id").agg(F.first("columns").alias("columns"))
    names = X.feature_dictionary(columns, "insample")
    best = R.top_features(X.insample_design(rows), names, 10)
    tops = F.explode(F.filter(F.array(F.lit(5), F.lit(10)), lambda k: k >= F.col("rank")))
    return best.select("focal_id", tops.alias("top"), "rank", "feature", "correlation")
