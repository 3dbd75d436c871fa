"""Matrix imputation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.align import ENTITIES
from pricepanel.catalog.base import query, view
from pricepanel.catalog.features import vectors
from pricepanel.operators import align as L, forest, matrix as M, quality as Q
from pricepanel.sources import adapters as A


def summarised(rows):
    return M.rows_to_long(rows).groupBy("focal_id", "entity").agg(
        F.count("price").alias("n"), F.avg("price").alias("mean"), F.min("price").alias("low")
    )


@query("d14_iterative_impute")
def iterative_impute(spark, root):
    return M.rows_to_long(M.iterative_impute(vectors(spark, root)))


@query("d15_soft_impute")
def soft_impute(spark, root):
    return M.rows_to_long(M.soft_impute(vectors(spark, root)))


# Observed cells must survive every imputation unchanged and no cell may stay empty.
KEPT = """SELECT focal_id, entity, count(*) AS n, count(price) AS n_observed, round(sum(price) / 1e6, 5) AS total,
    0::BIGINT AS n_empty FROM cells GROUP BY 1, 2"""


def kept_cells(before, after):
    b = M.rows_to_long(before).withColumnRenamed("price", "was")
    return (
        b.join(M.rows_to_long(after), ["focal_id", "obs_date", "entity"])
        .where(F.col("entity") != "base_rate")
        .groupBy("focal_id", "entity")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("was").alias("n_observed"),
            F.round(F.sum(F.when(F.col("was").isNotNull(), F.col("price"))) / 1e6, 5).alias("total"),
            F.count_if(F.col("price").isNull()).alias("n_empty"),
        )
    )


@query("d14_observed_cells_kept", sql=KEPT, uses=["cells"])
def iterative_kept(spark, root):
    rows = vectors(spark, root)
    return kept_cells(rows, M.iterative_impute(rows))


@query("d15_observed_cells_kept", sql=KEPT, uses=["cells"])
def soft_kept(spark, root):
    rows = vectors(spark, root)
    return kept_cells(rows, M.soft_impute(rows))


# Pairwise nearest neighbours over the five fixed columns of the masked panel.
view(
    "wide_masked",
    ["masked"],
    "SELECT obs_date, "
    + ", ".join(f"min(price) FILTER (entity = '{e}') AS v{i}" for i, e in enumerate(ENTITIES))
    + " FROM masked GROUP BY 1",
)
D2 = " + ".join(f"coalesce((t.v{i} - d.v{i}) * (t.v{i} - d.v{i}), 0)" for i in range(5))
SHARED = " + ".join(f"CAST(t.v{i} IS NOT NULL AND d.v{i} IS NOT NULL AS INTEGER)" for i in range(5))
KNN = " UNION ALL ".join(
    f"""SELECT obs_date, '{e}' AS entity, CASE WHEN count(*) FILTER (dist = 0) > 0
          THEN avg(v) FILTER (dist = 0) ELSE sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) END AS price
        FROM (SELECT t.obs_date, d.v{i} AS v, sqrt(({D2}) * 5.0 / ({SHARED})) AS dist
              FROM wide_masked t JOIN wide_masked d ON d.v{i} IS NOT NULL
              WHERE t.v{i} IS NULL AND ({SHARED}) > 0
              QUALIFY row_number() OVER (PARTITION BY t.obs_date ORDER BY dist, d.obs_date) <= 5) GROUP BY 1"""
    for i, e in enumerate(ENTITIES)
)


view(
    "masked_grid",
    ["wide_masked"],
    """SELECT w.obs_date, e.entity, p.price FROM wide_masked w CROSS JOIN (SELECT DISTINCT entity FROM masked) e
       LEFT JOIN masked p ON p.obs_date = w.obs_date AND p.entity = e.entity""",
)
view(
    "knn_filled",
    ["masked_grid"],
    f"""SELECT g.obs_date, g.entity, coalesce(g.price, f.price, m.m) AS price FROM masked_grid g
        JOIN (SELECT entity, avg(price) AS m FROM masked GROUP BY 1) m USING (entity)
        LEFT JOIN ({KNN}) f ON f.obs_date = g.obs_date AND f.entity = g.entity""",
)


def market_rows(panel):
    """The whole panel as the rows of one focal."""
    names = L.entity_list(panel)
    m = L.to_matrix(panel, names)
    return m.select(
        F.lit("MARKET").alias("focal_id"),
        "obs_date",
        F.array(*[F.struct(F.lit(e).alias("entity"), F.lit("USD").alias("currency")) for e in names]).alias("columns"),
        F.array(*[F.col(f"`{e}`") for e in names]).alias("row"),
    )


def market_long(rows, value="price"):
    return rows.select(
        "obs_date", F.inline(F.arrays_zip(F.col("columns.entity").alias("entity"), F.col("row").alias(value)))
    )


@query(
    "d12_knn_impute",
    sql="SELECT obs_date, entity, round(price, 4) AS price FROM knn_filled",
    uses=["knn_filled"],
)
def knn_impute(spark, root):
    rows = market_rows(A.masked_panel(spark, root))
    return market_long(M.knn_impute(rows)).withColumn("price", F.round("price", 4))


@query("d12_knn_impute_portfolio")
def knn_impute_portfolio(spark, root):
    return M.rows_to_long(M.knn_impute(vectors(spark, root)))


@query("d13_mice_forest")
def mice_forest(spark, root):
    panel = A.competitor_panel(spark, root)
    names = L.entity_list(panel)
    return forest.forest_impute_wide(L.to_matrix(panel, names), names, "obs_date")


@query("d13_forest_portfolio")
def forest_portfolio(spark, root):
    return M.rows_to_long(forest.forest_impute(vectors(spark, root)))


PAIR = """covar_pop({x}, {y}) / nullif(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END)
    * stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END), 0)"""
@query(
    "g12_pair_correlations",
    sql="SELECT focal_id, i, j, round("
    + PAIR.format(x="a", y="b")
    + """, 5) AS correlation FROM (SELECT focal_id, i, j, v[i + 1] AS a, v[j + 1] AS b FROM wide_cells,
        (SELECT CAST(unnest(range(5)) AS INTEGER) AS i) p, (SELECT CAST(unnest(range(5)) AS INTEGER) AS j) q
        WHERE i < len(v) AND j < len(v))
        WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2, 3""",
    uses=["wide_cells"],
)
def pair_correlations(spark, root):
    out = Q.pair_correlations(vectors(spark, root))
    return out.withColumn("correlation", F.round("correlation", 5))


@query(
    "g12_corr_preserved",
    sql="SELECT focal_id, round((1 - avg(d)) * 100, 4) AS correlation_preserved_pct FROM (SELECT focal_id, j, avg(abs(b - a)) AS d FROM (SELECT focal_id, i, j, "
    + PAIR.format(x="x", y="y")
    + " AS b, "
    + PAIR.format(x="fx", y="fy")
    + """ AS a FROM (SELECT focal_id, i, j, v[i + 1] AS x, v[j + 1] AS y,
          coalesce(v[i + 1], m[i + 1]) AS fx, coalesce(v[j + 1], m[j + 1]) AS fy
        FROM wide_cells JOIN (SELECT focal_id, list(mean ORDER BY k) AS m FROM (SELECT focal_id, k, avg(v[k + 1]) AS mean
            FROM wide_cells, (SELECT unnest(range(5)) AS k) WHERE k < len(v) GROUP BY 1, 2) GROUP BY 1) USING (focal_id),
        (SELECT CAST(unnest(range(5)) AS INTEGER) AS i) p, (SELECT CAST(unnest(range(5)) AS INTEGER) AS j) q
        WHERE i < len(v) AND j < len(v)) GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1""",
    uses=["wide_cells"],
)
def corr_preserved(spark, root):
    """Preservation under column-mean imputation of every focal's matrix."""
    rows = vectors(spark, root)
    means = (
        rows.select("focal_id", F.posexplode("row").alias("k", "v"))
        .groupBy("focal_id", "k")
        .agg(F.avg("v").alias("m"))
        .groupBy("focal_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("k", "m"))).alias("means"))
    )
    filled = rows.join(means, "focal_id").withColumn(
        "row", F.transform("row", lambda v, k: F.coalesce(v, F.try_element_at("means", k)))
    )
    out = Q.corr_preserved(rows, filled)
    return out.withColumn("correlation_preserved_pct", F.round("correlation_preserved_pct", 4))


@query("d14_matrix_completion_summary")
def matrix_completion_summary(spark, root):
    """One row per focal: size, missing share, correlation kept by chained ridge imputation."""
    rows = vectors(spark, root)
    done = M.complete_matrix(rows)
    size = rows.groupBy("focal_id").agg(
        F.count(F.lit(1)).alias("matrix_rows"),
        F.max(F.size("row")).alias("matrix_cols"),
        F.sum(F.size(F.filter("row", lambda v: v.isNull()))).alias("missing_values"),
        F.min("obs_date").alias("date_start"),
        F.max("obs_date").alias("date_end"),
    )
    states = done.groupBy("focal_id").agg(F.max("status").alias("status"))
    out = size.join(Q.corr_preserved(rows, done), "focal_id", "left").join(states, "focal_id")
    cells = F.col("matrix_rows") * F.col("matrix_cols")
    summary = out.withColumns(
        {
            "num_competitors": F.col("matrix_cols") - 1,
            "missing_pct": F.try_divide(F.col("missing_values") * 100, cells),
            "method": F.when(F.col("status") == "Success", "IterativeImputer").otherwise("Failed"),
        }
    )
    return A.registry(spark, root).join(summary, "focal_id", "left").withColumn(
        "status", F.coalesce("status", F.lit("Skipped: no data"))
    )


@query(
    "d13_forest_kept_cells",
    sql="""SELECT entity, d.n AS n_cells, count(price) AS n_observed, count(price) AS n_kept, 0 AS n_empty
        FROM comp, (SELECT count(DISTINCT obs_date) AS n FROM comp) d GROUP BY entity, d.n""",
    uses=["comp"],
)
def forest_kept_cells(spark, root):
    """Every observed cell survives the forest imputation and no cell stays empty."""
    panel = A.competitor_panel(spark, root).select("entity", "obs_date", F.col("price").alias("seen"))
    filled = L.to_long(mice_forest(spark, root), ["obs_date"])
    return (
        filled.join(panel, ["entity", "obs_date"], "left")
        .groupBy("entity")
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.count("seen").alias("n_observed"),
            F.count_if(F.col("seen") == F.col("price")).alias("n_kept"),
            F.count_if(F.col("price").isNull()).cast("int").alias("n_empty"),
        )
    )


@query(
    "d13_forest_portfolio_cells",
    sql="""SELECT focal_id, entity, count(*) AS n, count(price) AS n_observed, count(price) AS n_kept,
        0::BIGINT AS n_empty, 0::BIGINT AS n_outside FROM cells GROUP BY 1, 2""",
    uses=["cells"],
)
def forest_portfolio_cells(spark, root):
    """Observed cells stay, no cell stays empty, and every filled cell lies between the observed ones of its column."""
    before = vectors(spark, root)
    was = M.rows_to_long(before).withColumnRenamed("price", "was").where(F.col("entity") != "base_rate")
    span = was.groupBy("focal_id", "entity").agg(F.min("was").alias("low"), F.max("was").alias("high"))
    both = was.join(M.rows_to_long(forest.forest_impute(before)), ["focal_id", "obs_date", "entity"])
    return (
        both.join(span, ["focal_id", "entity"])
        .groupBy("focal_id", "entity")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("was").alias("n_observed"),
            F.count_if(F.col("was") == F.col("price")).alias("n_kept"),
            F.count_if(F.col("price").isNull()).alias("n_empty"),
            F.count_if(~F.col("price").between(F.col("low") - 1e-6, F.col("high") + 1e-6)).alias("n_outside"),
        )
    )
