"""Regression queries.

Where SQL has no solver, the label and summary operators are checked on
single-regressor models, which SQL can fit; the full models are checked against
numpy in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.catalog.correlate import region_pairs
from pricepanel.catalog.features import vectors
from pricepanel.functions.calendar import INSTRUMENTS, with_instruments
from pricepanel.functions.stats import stars
from pricepanel.operators import align as L, gram as G, regress as R
from pricepanel.plans import causal
from pricepanel.sources import adapters as A


def track(spark, root):
    return causal.run(L.base_rate(A.focal_rows(spark, root)), A.competitor_panel(spark, root))


def first_stage(spark, root):
    return causal.first_stage(L.base_rate(A.focal_rows(spark, root)), A.competitor_panel(spark, root))


view(
    "filled",
    ["comp_on_focal"],
    """SELECT entity, obs_date, coalesce(
         last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date),
         first_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM comp_on_focal""",
)
# SQL text of the seven instruments in model order.
Z = [
    "sin(2 * pi() * month(obs_date) / 12)",
    "cos(2 * pi() * month(obs_date) / 12)",
    "sin(2 * pi() * (isodow(obs_date) - 1) / 7)",
    "cos(2 * pi() * (isodow(obs_date) - 1) / 7)",
    "sin(2 * pi() * weekofyear(obs_date) / 52)",
    "cos(2 * pi() * weekofyear(obs_date) / 52)",
    "CAST(month(obs_date) IN (12, 1) AS DOUBLE)",
]
view(
    "instrumented",
    ["filled"],
    "SELECT entity, obs_date, " + ", ".join(f"{e} AS z{i}" for i, e in enumerate(Z)) + ", price AS z7 FROM filled",
)


@query(
    "h0_gram",
    sql=" UNION ALL ".join(
        f"""SELECT entity, {i} AS i, {j} AS j, round(count(*) * covar_pop(z{i}, z{j}) / 1e9, 6) + 0.0 AS value
        FROM instrumented GROUP BY 1"""
        for i in range(8)
        for j in range(i, 8)
    ),
    uses=["instrumented"],
)
def gram(spark, root):
    panel = causal.filled_panel(L.base_rate(A.focal_rows(spark, root)), A.competitor_panel(spark, root))
    table = G.gram_table(R.stage1_gram(panel, ["entity"]), ["entity"])
    return table.withColumn("value", F.round(F.col("value") / 1e9, 6) + F.lit(0.0))


@query(
    "h0_gram_vectors",
    sql="""SELECT focal_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
          round(count(*) * covar_pop(coalesce(v[i + 1], 0), coalesce(v[j + 1], 0)) / 1e12, 6) + 0.0 AS value
        FROM (SELECT focal_id, v, i, unnest(range(i, len(v))) AS j
              FROM (SELECT focal_id, v, unnest(range(len(v))) AS i FROM wide_cells)) GROUP BY 1, 2, 3""",
    uses=["wide_cells"],
)
def gram_vectors(spark, root):
    """Arrow partials of the whole row vectors, merged: every cell of every focal."""
    partials = G.vector_gram(vectors(spark, root).withColumnRenamed("row", "v"), ["focal_id"], "v")
    cells = G.gram_table(G.merged(partials, ["focal_id"]), ["focal_id"])
    return cells.withColumn("value", F.round(F.col("value") / 1e12, 6) + F.lit(0.0))


@query("h1_stage1")
def stage1(spark, root):
    return first_stage(spark, root)["stage1"]


@query(
    "h2_fit_stats",
    sql="""SELECT focal_id, n, round(r2, 6) AS r2, round(r2 / nullif(1 - r2, 0) * (n - 2), 5) AS f_statistic
        FROM (SELECT focal_id, count(*) AS n, regr_r2(f, c) AS r2 FROM region_pairs GROUP BY 1)""",
    uses=["region_pairs"],
)
def fit_stats(spark, root):
    """F of the one-regressor model of every focal on its market."""
    fits = (
        region_pairs(spark, root)
        .groupBy("focal_id")
        .agg(F.count(F.lit(1)).alias("n"), F.regr_r2("f", "c").alias("r2"))
        .withColumn("k", F.lit(1))
    )
    out = R.fit_stats(fits)
    return out.select(
        "focal_id", "n", F.round("r2", 6).alias("r2"), F.round("f_statistic", 5).alias("f_statistic")
    )


@query(
    "h1_normal_equations",
    sql="SELECT entity, CAST(unnest(range(8)) AS INTEGER) AS i, 0.0::DOUBLE AS moment FROM (SELECT DISTINCT entity FROM filled)",
    uses=["filled"],
)
def normal_equations(spark, root):
    """Least squares leaves residuals orthogonal to the intercept and every instrument."""
    resid = with_instruments(first_stage(spark, root)["residuals"])
    z = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in INSTRUMENTS])
    return (
        resid.select("entity", "residual", F.posexplode(z).alias("i", "z"))
        .groupBy("entity", "i")
        .agg((F.round(F.abs(F.sum(F.col("residual") * F.col("z"))) / 1e6, 6)).alias("moment"))
    )


@query("h3_coef_table")
def coef_table(spark, root):
    return R.coef_table(first_stage(spark, root)["stage1"], ["entity"])


@query("h4_instrument_strength")
def instrument_strength(spark, root):
    return R.instrument_strength(first_stage(spark, root)["stage1"]).select(
        "entity", "n", "k", "r2", "f_statistic", "strength"
    )


@query(
    "h4_strength_counts",
    sql="""SELECT n_strong, n_weak, strong FROM (SELECT count(*) FILTER (f > 10) AS n_strong,
        count(*) FILTER (NOT coalesce(f > 10, false)) AS n_weak,
        coalesce(list(focal_id ORDER BY focal_id) FILTER (f > 10), []) AS strong
        FROM (SELECT focal_id, r2 / nullif(1 - r2, 0) * (n - 2) AS f FROM
          (SELECT focal_id, count(*) AS n, regr_r2(f, c) AS r2 FROM region_pairs GROUP BY 1)))""",
    uses=["region_pairs"],
)
def strength_counts(spark, root):
    fits = (
        region_pairs(spark, root)
        .groupBy("focal_id")
        .agg(F.count(F.lit(1)).alias("n"), F.regr_r2("f", "c").alias("r2"))
        .withColumn("k", F.lit(1))
    )
    return R.strength_counts(R.instrument_strength(fits).withColumn("entity", F.col("focal_id")))


@query("h5_residual_panel")
def residual_panel(spark, root):
    return first_stage(spark, root)["residuals"]


@query(
    "h5_residual_summary",
    sql="""SELECT entity, count(*) AS n, 0.0::DOUBLE AS mean, true AS below_total FROM filled GROUP BY 1""",
    uses=["filled"],
)
def residual_summary(spark, root):
    """Residuals of a model with intercept average to zero and vary no more than the prices."""
    resid = first_stage(spark, root)["residuals"]
    spread = resid.groupBy("entity").agg(F.stddev_samp("price").alias("total"))
    out = R.residual_summary(resid).join(spread, "entity")
    return out.select(
        "entity",
        "n",
        F.abs(F.round("mean", 5)).alias("mean"),
        (F.col("std") <= F.col("total")).alias("below_total"),
    )


@query(
    "h6_coef_summary",
    sql="""SELECT 'market' AS term, round(avg(s), 6) AS mean_coef, round(stddev_samp(s), 6) AS std_coef
        FROM (SELECT focal_id, regr_slope(f, c) AS s FROM region_pairs GROUP BY 1)""",
    uses=["region_pairs"],
)
def coef_summary(spark, root):
    slopes = (
        region_pairs(spark, root)
        .groupBy("focal_id")
        .agg(F.regr_slope("f", "c").alias("coef"))
        .withColumn("term", F.lit("market"))
    )
    out = R.coef_summary(slopes)
    return out.select("term", F.round("mean_coef", 6).alias("mean_coef"), F.round("std_coef", 6).alias("std_coef"))


@query("h6_stage1_coef_summary")
def stage1_coef_summary(spark, root):
    return R.coef_summary(R.coef_table(first_stage(spark, root)["stage1"], ["entity"]))


@query("h7_stage2_terms")
def stage2_terms(spark, root):
    return track(spark, root)["terms"]


@query(
    "h7_normal_equations",
    sql="SELECT 'FOCAL' AS focal_id, CAST(unnest(range(18)) AS INTEGER) AS i, 0.0::DOUBLE AS moment",
)
def stage2_normal_equations(spark, root):
    """Residuals of the minimum-norm fit are orthogonal to all 18 columns."""
    t = track(spark, root)
    x = t["design"].select("focal_id", "obs_date", F.concat(F.array(F.lit(1.0)), "x").alias("x"))
    return (
        t["predictions"]
        .join(x, ["focal_id", "obs_date"])
        .select("focal_id", "residual", F.posexplode("x").alias("i", "v"))
        .groupBy("focal_id", "i")
        .agg(F.round(F.abs(F.sum(F.col("residual") * F.col("v"))) / 1e6, 4).alias("moment"))
    )


@query("h8_stage2_inference")
def stage2_inference(spark, root):
    return track(spark, root)["stage2"]


@query("h9_endogeneity")
def endogeneity(spark, root):
    return R.endogeneity(track(spark, root)["terms"])


@query("h9_endogeneity_counts")
def endogeneity_counts(spark, root):
    return R.endogeneity_counts(R.endogeneity(track(spark, root)["terms"]))


@query("h10_compare_fit")
def compare_fit(spark, root):
    return R.compare_fit(track(spark, root)["stage2"])


view(
    "slopes",
    ["region_panel"],
    """SELECT focal_id, entity AS name, 10 * regr_slope(base_rate, price) AS coef
       FROM region_panel JOIN portfolio USING (focal_id, obs_date) GROUP BY 1, 2""",
)


def slope_terms(spark, root):
    """One-regressor effect (times ten, to reach every label) of each competitor on its focal."""
    joined = A.region_panel(spark, root).join(A.portfolio(spark, root), ["focal_id", "obs_date"])
    return joined.groupBy("focal_id", F.col("entity").alias("name")).agg(
        (F.regr_slope("base_rate", "price") * 10).alias("coef")
    ).withColumn("kind", F.lit("beta"))


@query(
    "h11_effects",
    sql="""SELECT focal_id, round(sum(coef), 5) AS total_effect,
        CASE WHEN sum(coef) > 0.1 THEN 'COMPLEMENTARY' WHEN sum(coef) < -0.1 THEN 'COMPETITIVE' ELSE 'NEUTRAL' END
          AS strategy, arg_max(name, abs(coef)) AS dominant, round(arg_max(coef, abs(coef)), 5) AS dominant_coef
        FROM slopes GROUP BY 1""",
    uses=["slopes"],
)
def effects(spark, root):
    out = R.effects(slope_terms(spark, root))
    return out.select(
        "focal_id",
        F.round("total_effect", 5).alias("total_effect"),
        "strategy",
        "dominant",
        F.round("dominant_coef", 5).alias("dominant_coef"),
    )


@query(
    "h11_effect_labels",
    sql="""SELECT focal_id, name, CASE WHEN coef > 0 THEN 'Complementary' ELSE 'Competitive' END AS direction,
        CASE WHEN abs(coef) > 0.5 THEN 'Strong' WHEN abs(coef) > 0.1 THEN 'Moderate' ELSE 'Weak' END AS magnitude
        FROM slopes""",
    uses=["slopes"],
)
def effect_labels(spark, root):
    return R.effect_labels(slope_terms(spark, root)).select("focal_id", "name", "direction", "magnitude")


@query("h12_temporal_effects")
def temporal_effects(spark, root):
    return R.temporal_effects(track(spark, root)["terms"])


@query(
    "h13_residual_diagnostics",
    sql="""SELECT focal_id, abs(round(avg(e), 3)) AS mean, round(stddev_pop(e), 3) AS std,
        round(sum(d * d) / sum(e * e), 6) AS durbin_watson, abs(avg(e)) > 0.01 AS mean_warning,
        sum(d * d) / sum(e * e) < 1.5 OR sum(d * d) / sum(e * e) > 2.5 AS serial_warning
        FROM (SELECT focal_id, e, e - lag(e) OVER (PARTITION BY focal_id ORDER BY obs_date) AS d FROM
          (SELECT focal_id, obs_date, f - b - s * c AS e FROM region_pairs JOIN
            (SELECT focal_id, regr_slope(f, c) AS s, regr_intercept(f, c) AS b FROM region_pairs GROUP BY 1)
            USING (focal_id))) GROUP BY 1""",
    uses=["region_pairs"],
)
def residual_diagnostics(spark, root):
    """Diagnostics of the one-regressor model of every focal on its market."""
    p = region_pairs(spark, root)
    line = p.groupBy("focal_id").agg(
        F.regr_slope("f", "c").alias("s"), F.regr_intercept("f", "c").alias("b")
    )
    resid = p.join(line, "focal_id").withColumn("residual", F.col("f") - F.col("b") - F.col("s") * F.col("c"))
    out = R.residual_diagnostics(resid)
    return out.select(
        "focal_id",
        F.abs(F.round("mean", 3)).alias("mean"),
        F.round("std", 3).alias("std"),
        F.round("durbin_watson", 6).alias("durbin_watson"),
        "mean_warning",
        "serial_warning",
    )


@query("h13_stage2_diagnostics")
def stage2_diagnostics(spark, root):
    return R.residual_diagnostics(track(spark, root)["predictions"])


@query("h14_predictions")
def predictions(spark, root):
    return track(spark, root)["predictions"]


@query(
    "h15_stars",
    sql="""SELECT stars, count(*) AS n FROM (SELECT CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**'
        WHEN p < 0.05 THEN '*' ELSE '' END AS stars FROM (SELECT pow(l_discount, 2) * 10 AS p FROM lineitem))
        GROUP BY 1""",
)
def significance_stars(spark, root):
    p = F.pow("l_discount", F.lit(2)) * 10
    return (
        A.table(spark, root, "lineitem")
        .groupBy(stars(p).alias("stars"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "h15_equation",
    sql="""SELECT focal_id, array_to_string(list_prepend('1.000', list(printf('%+.4f', round(coef, 4)) || '×' || name
          ORDER BY name)), ' ') AS equation FROM slopes GROUP BY 1""",
    uses=["slopes"],
)
def equation(spark, root):
    terms = F.sort_array(
        F.collect_list(
            F.struct(
                F.col("name").alias("feature"),
                F.round("coef", 4).alias("coef"),
                F.lit(None).cast("double").alias("p_value"),
            )
        )
    )
    return slope_terms(spark, root).groupBy("focal_id").agg(
        R.equation(F.lit(1.0), terms).alias("equation")
    )


@query(
    "h20_exclusions",
    sql="""SELECT focal_id, CASE WHEN focal_id IN ('NATION_3', 'NATION_15') THEN 'Excluded: Data quality issues'
        ELSE 'kept' END AS status FROM registry""",
    uses=["registry"],
)
def exclusions(spark, root):
    kept, out = R.exclude(A.registry(spark, root), ["NATION_3", "NATION_15"], "Data quality issues")
    return kept.withColumn("status", F.lit("kept")).unionByName(out)


@query("h21_model_record")
def model_record(spark, root):
    """Nested result document of the causal model."""
    t = track(spark, root)
    fit = R.compare_fit(t["stage2"])
    total = R.effects(t["terms"])
    counts = R.endogeneity_counts(R.endogeneity(t["terms"]))
    diag = R.residual_diagnostics(t["predictions"])
    kinds = t["terms"].groupBy("focal_id").agg(
        *[
            F.map_from_entries(
                F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("name", "coef"))))
            ).alias(n)
            for k, n in [
                ("beta", "competitor_coefficients"),
                ("theta", "residual_coefficients"),
                ("gamma", "temporal_coefficients"),
            ]
        ]
    )
    return (
        kinds.join(fit, "focal_id")
        .join(total, "focal_id")
        .join(counts, "focal_id")
        .join(diag.select("focal_id", "durbin_watson"), "focal_id")
        .select(
            "focal_id",
            F.lit("2SRI").alias("model_type"),
            F.array(*[F.lit(i) for i in INSTRUMENTS]).alias("temporal_features_used"),
            "competitor_coefficients",
            "residual_coefficients",
            "temporal_coefficients",
            F.struct(
                "r2_2sri", "r2_ols", "rmse_2sri", "rmse_ols", "total_effect", "dominant",
                "n_endogenous", "endogeneity_detected", "durbin_watson",
            ).alias("model_performance"),
        )
    )


@query("b17_run_metadata")
def run_metadata(spark, root):
    """Run record of the preparation: counts, range, correlation, removals, fills."""
    from pricepanel.catalog.profile import comp_dense
    from pricepanel.operators import correlate, impute, normalise

    focal_rows, comp = A.focal_rows(spark, root), comp_dense(spark, root)
    rates = L.base_rate(focal_rows)
    flagged_f = normalise.iqr_flag(focal_rows, "segment")
    flagged_c = normalise.iqr_flag(comp, "entity")
    filled = impute.ffill_bfill(comp.select("entity", "obs_date", "price"))
    fills = impute.fill_stats(comp, filled)
    check = correlate.post_check(rates, filled)
    span = rates.agg(
        F.struct(
            F.count(F.lit(1)).alias("days"),
            F.min("obs_date").alias("date_start"),
            F.max("obs_date").alias("date_end"),
            F.array(F.min("base_rate"), F.max("base_rate")).alias("base_rate_range"),
        ).alias("s")
    ).scalar()
    removed = lambda df: df.agg(F.count_if("is_outlier").alias("n")).scalar()
    return spark.range(1).select(
        span.alias("focal"),
        check.select("correlation").scalar().alias("final_correlation"),
        F.struct(removed(flagged_f).alias("focal"), removed(flagged_c).alias("competitor")).alias("outliers_removed"),
        fills.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("entity", "filled")))).alias("m"))
        .scalar()
        .alias("cross_entity_fills"),
        (filled.agg(F.count_if(F.col("price").isNull()).alias("n")).scalar() == 0).alias("data_completeness"),
    )
