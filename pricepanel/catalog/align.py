"""Alignment, join, reshape and set queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from pricepanel.catalog.base import query, view
from pricepanel.functions import text as T
from pricepanel.operators import align as L
from pricepanel.operators.profile import gap_profile
from pricepanel.sources import adapters as A

# Column names of the expected tables below; the queries take theirs from the panel.
ENTITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "c1_temporal_overlap",
    sql="""SELECT lo AS overlap_start, hi AS overlap_end, date_diff('day', lo, hi) + 1 AS overlap_days,
        (SELECT count(*) FROM focal_rows WHERE obs_date BETWEEN lo AND hi) AS focal_rows_in,
        (SELECT count(*) FROM comp WHERE obs_date BETWEEN lo AND hi) AS comp_rows_in
        FROM (SELECT greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi
              FROM (SELECT min(obs_date) lo, max(obs_date) hi FROM focal_rows) a,
                   (SELECT min(obs_date) lo, max(obs_date) hi FROM comp) b)""",
    uses=["focal_rows", "comp"],
)
def temporal_overlap(spark, root):
    f, c, summary = L.temporal_overlap(A.focal_rows(spark, root), A.competitor_panel(spark, root))
    return summary.withColumns(
        {
            "focal_rows_in": f.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "comp_rows_in": c.agg(F.count(F.lit(1)).alias("n")).scalar(),
        }
    )


@query(
    "c2_common_dates",
    sql="""SELECT obs_date FROM focal INTERSECT SELECT obs_date FROM comp
        INTERSECT SELECT obs_date FROM portfolio""",
    uses=["focal", "comp", "portfolio"],
)
def common_dates(spark, root):
    return L.common_dates(
        L.base_rate(A.focal_rows(spark, root)),
        A.competitor_panel(spark, root),
        A.portfolio(spark, root),
    )


@query(
    "c3_base_rate",
    sql="SELECT obs_date, round(base_rate, 6) AS base_rate FROM focal",
    uses=["focal"],
)
def base_rate(spark, root):
    return L.base_rate(A.focal_rows(spark, root)).withColumn("base_rate", F.round("base_rate", 6))


@query(
    "c3_portfolio_base_rate",
    sql="SELECT focal_id, obs_date, base_rate FROM portfolio",
    uses=["portfolio"],
)
def portfolio_base_rate(spark, root):
    return A.portfolio(spark, root)


@query(
    "c4_daily_mean",
    sql="SELECT obs_date, round(avg(price), 5) AS mean_price FROM comp GROUP BY 1",
    uses=["comp"],
)
def daily_mean(spark, root):
    out = L.daily_mean(A.competitor_panel(spark, root))
    return out.withColumn("mean_price", F.round("mean_price", 5))


@query(
    "c5_daily_rollup",
    sql="""SELECT entity, obs_date, round(avg(price), 5) AS price, round(avg(available), 6) AS available,
        CAST(isodow(obs_date) - 1 AS INTEGER) AS day_of_week, CAST(month(obs_date) AS INTEGER) AS month,
        CAST(isodow(obs_date) >= 6 AS INTEGER) AS is_weekend FROM comp GROUP BY 1, 2""",
    uses=["comp"],
)
def daily_rollup(spark, root):
    out = L.daily_rollup(A.competitor_panel(spark, root), ["price", "available"], ["entity"])
    return out.withColumns({"price": F.round("price", 5), "available": F.round("available", 6)})


MATRIX = (
    "SELECT obs_date, "
    + ", ".join(f"min(price) FILTER (entity = '{e}') AS \"{e}\"" for e in ENTITIES)
    + " FROM comp GROUP BY 1"
)
view("comp_matrix", ["comp"], MATRIX)


@query("c6_matrix", sql="SELECT * FROM comp_matrix", uses=["comp_matrix"])
def matrix(spark, root):
    panel = A.competitor_panel(spark, root)
    return L.to_matrix(panel, L.entity_list(panel))


@query(
    "c7_matrix_to_long",
    sql="UNPIVOT (SELECT * FROM comp_matrix) ON COLUMNS(* EXCLUDE (obs_date)) INTO NAME entity VALUE price",
    uses=["comp_matrix"],
)
def matrix_to_long(spark, root):
    panel = A.competitor_panel(spark, root)
    m = L.to_matrix(panel, L.entity_list(panel))
    return L.to_long(m, ["obs_date"]).where(F.col("price").isNotNull())


view(
    "comp_on_focal",
    ["comp", "focal"],
    """SELECT e.entity, f.obs_date, c.price, c.available FROM (SELECT DISTINCT entity FROM comp) e,
       (SELECT DISTINCT obs_date FROM focal) f
       LEFT JOIN comp c ON c.entity = e.entity AND c.obs_date = f.obs_date""",
)


@query(
    "c8_reindex_to_focal",
    sql="SELECT entity, obs_date, price FROM comp_on_focal",
    uses=["comp_on_focal"],
)
def reindex_to_focal(spark, root):
    focal = L.base_rate(A.focal_rows(spark, root))
    return L.reindex_to(A.competitor_panel(spark, root), focal).select("entity", "obs_date", "price")


@query(
    "c8_reindex_per_focal",
    sql="""SELECT s.focal_id, s.entity, d.obs_date, r.price
        FROM (SELECT DISTINCT focal_id, entity FROM region_panel) s
        JOIN portfolio d ON d.focal_id = s.focal_id
        LEFT JOIN region_panel r ON r.focal_id = s.focal_id AND r.entity = s.entity
          AND r.obs_date = d.obs_date""",
    uses=["region_panel"],
)
def reindex_per_focal(spark, root):
    out = L.reindex_to(
        A.region_panel(spark, root), A.portfolio(spark, root), ["focal_id", "entity"], ["focal_id"]
    )
    return out.select("focal_id", "entity", "obs_date", "price")


@query(
    "c9_densify",
    sql="SELECT entity, obs_date, price FROM comp_dense",
    uses=["comp_dense"],
)
def densify(spark, root):
    return L.densify(A.competitor_panel(spark, root)).select("entity", "obs_date", "price")


@query(
    "c9_densify_portfolio",
    sql="""SELECT g.focal_id, g.obs_date, p.base_rate FROM
        (SELECT focal_id, CAST(unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS DATE)
            AS obs_date FROM portfolio GROUP BY focal_id) g
        LEFT JOIN portfolio p ON p.focal_id = g.focal_id AND p.obs_date = g.obs_date""",
    uses=["portfolio"],
)
def densify_portfolio(spark, root):
    return L.densify(A.portfolio(spark, root), ["focal_id"], per_series=True)


@query(
    "c10_transpose",
    sql="SELECT entity AS name, obs_date, price FROM comp WHERE price IS NOT NULL",
    uses=["comp"],
)
def transpose(spark, root):
    """Date x entity matrix turned into entity x date over the whole date axis, compared cell by cell."""
    panel = A.competitor_panel(spark, root)
    m = L.to_matrix(panel, L.entity_list(panel)).withColumn("obs_date", F.col("obs_date").cast("string"))
    turned = L.transpose(m, "obs_date", L.entity_list(m, "obs_date"))
    cells = L.to_long(turned, ["name"], "obs_date", "price")
    return cells.where(F.col("price").isNotNull()).withColumn("obs_date", F.to_date("obs_date"))


@query(
    "c11_align_inner",
    sql="""SELECT obs_date, round(base_rate, 6) AS base_rate, entity, price
        FROM focal JOIN comp USING (obs_date)""",
    uses=["focal", "comp"],
)
def align_inner(spark, root):
    out = L.align_inner(L.base_rate(A.focal_rows(spark, root)), A.competitor_panel(spark, root))
    return out.select("obs_date", F.round("base_rate", 6).alias("base_rate"), "entity", "price")


@query(
    "c12_attach",
    sql="""SELECT obs_date, round(base_rate, 6) AS base_rate, round(m, 6) AS market_availability
        FROM focal LEFT JOIN (SELECT obs_date, avg(available) AS m FROM comp GROUP BY 1) USING (obs_date)""",
    uses=["focal", "comp"],
)
def attach(spark, root):
    market = L.daily_mean(A.competitor_panel(spark, root), "available")
    out = L.attach(L.base_rate(A.focal_rows(spark, root)), market, ["obs_date"])
    return out.select(
        "obs_date",
        F.round("base_rate", 6).alias("base_rate"),
        F.round("mean_available", 6).alias("market_availability"),
    )


@query(
    "c13_semi_align",
    sql="""WITH m AS (SELECT * FROM masked WHERE price IS NOT NULL)
        SELECT 'a' AS side, entity, obs_date FROM comp WHERE obs_date IN (SELECT obs_date FROM m)
          AND entity IN (SELECT entity FROM m)
        UNION ALL SELECT 'b', entity, obs_date FROM m WHERE obs_date IN (SELECT obs_date FROM comp)
          AND entity IN (SELECT entity FROM comp)""".replace("WITH m AS", "SELECT * FROM (WITH m AS")
    + ")",
    uses=["masked"],
)
def semi_align(spark, root):
    a, b = L.semi_align(
        A.competitor_panel(spark, root), A.masked_panel(spark, root).where("price IS NOT NULL")
    )
    return a.select(F.lit("a").alias("side"), "entity", "obs_date").unionByName(
        b.select(F.lit("b").alias("side"), "entity", "obs_date")
    )


@query(
    "c14_missing_dates",
    sql="""SELECT entity, obs_date FROM focal, (SELECT DISTINCT entity FROM comp) e
        EXCEPT SELECT entity, obs_date FROM comp""",
    uses=["focal", "comp"],
)
def missing_dates(spark, root):
    """Dates of the focal panel that each entity lacks."""
    return L.missing_by_entity(L.base_rate(A.focal_rows(spark, root)), A.competitor_panel(spark, root))


@query(
    "c15_concat",
    sql="""SELECT source, count(*) AS n, round(sum(price) / 1e6, 6) AS total FROM (
        SELECT 'focal' AS source, price FROM focal_rows UNION ALL SELECT 'competitor', price FROM comp)
        GROUP BY 1""",
    uses=["focal_rows", "comp"],
)
def concat(spark, root):
    a = A.focal_rows(spark, root).select(F.lit("focal").alias("source"), "price")
    b = A.competitor_panel(spark, root).select(F.lit("competitor").alias("source"), "price")
    return (
        a.unionByName(b)
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price") / 1e6, 6).alias("total"))
    )


@query(
    "c16_drop_empty_entities",
    sql="""SELECT focal_id, count(*) AS n_days FROM (
          SELECT r.focal_id, d.obs_date FROM registry r, comp_dates d) g
        WHERE focal_id IN (SELECT focal_id FROM portfolio WHERE base_rate IS NOT NULL) GROUP BY 1""",
    uses=["registry", "portfolio", "comp_dates"],
)
def drop_empty_entities(spark, root):
    """Every registered focal on the full calendar; the one without prices disappears."""
    span = L.overlap_bounds(A.competitor_panel(spark, root))
    grid = A.registry(spark, root).select(
        "focal_id", F.explode(F.sequence(span.getField("lo"), span.getField("hi"))).alias("obs_date")
    )
    cells = grid.join(A.portfolio(spark, root), ["focal_id", "obs_date"], "left")
    alive = L.drop_empty_entities(cells, "base_rate", ["focal_id"])
    return alive.groupBy("focal_id").agg(F.count(F.lit(1)).alias("n_days"))


@query(
    "c18_display_names",
    sql="""SELECT entity, CASE entity WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low' ELSE entity END
        AS display_name, max(price) AS max_price FROM comp GROUP BY 1""",
    uses=["comp"],
)
def display_names(spark, root):
    return (
        A.competitor_panel(spark, root)
        .groupBy("entity")
        .agg(F.max("price").alias("max_price"))
        .withColumn("display_name", T.display_name(F.col("entity"), {"1-URGENT": "Urgent", "5-LOW": "Low"}))
    )


@query(
    "c19_sorted_panel",
    sql="""SELECT entity, obs_date, price, row_number() OVER (PARTITION BY entity ORDER BY obs_date) AS position
        FROM comp ORDER BY entity, obs_date""",
    uses=["comp"],
)
def sorted_panel(spark, root):
    """Row order by key, as a position inside each series and as the output order."""
    w = Window.partitionBy("entity").orderBy("obs_date")
    return (
        A.competitor_panel(spark, root)
        .select("entity", "obs_date", "price", F.row_number().over(w).cast("bigint").alias("position"))
        .orderBy("entity", "obs_date")
    )


@query(
    "c20_top_days",
    sql="""SELECT focal_id, obs_date, base_rate FROM portfolio ORDER BY base_rate DESC, focal_id LIMIT 10""",
    uses=["portfolio"],
)
def top_days(spark, root):
    return L.top_k(A.portfolio(spark, root), 10, "base_rate", "focal_id")


@query(
    "c20_bottom_days_per_focal",
    sql="""SELECT focal_id, obs_date, base_rate FROM portfolio
        QUALIFY row_number() OVER (PARTITION BY focal_id ORDER BY base_rate, obs_date) <= 5""",
    uses=["portfolio"],
)
def bottom_days_per_focal(spark, root):
    return L.top_k(
        A.portfolio(spark, root), 5, "base_rate", "obs_date", ascending=True, keys=["focal_id"]
    )


@query(
    "c21_filters",
    sql="""SELECT entity, count(*) AS n, min(obs_date) AS first_day, max(price) AS top FROM comp
        WHERE obs_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND price > 50000
          AND entity IN ('1-URGENT', '2-HIGH') GROUP BY 1""",
    uses=["comp"],
)
def filters(spark, root):
    kept = A.competitor_panel(spark, root).where(
        F.col("obs_date").between("1996-01-01", "1998-12-31")
        & (F.col("price") > 50000)
        & F.col("entity").isin("1-URGENT", "2-HIGH")
    )
    return kept.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("obs_date").alias("first_day"),
        F.max("price").alias("top"),
    )


@query(
    "f12_text_helpers",
    sql="""SELECT DISTINCT entity, upper(left(list_extract(string_split(entity, '-'), -2), 4)) AS short,
        contains(entity, '-USD') AS has_usd, replace(entity, '-USD', '') AS bare
        FROM (SELECT 'chain-' || lower(entity) || '-' || currency AS entity FROM region_panel)""",
    uses=["region_panel"],
)
def text_helpers(spark, root):
    ids = A.region_panel(spark, root).select("entity", "currency").distinct()
    e = F.concat(F.lit("chain-"), F.lower("entity"), F.lit("-"), F.col("currency"))
    return ids.select(e.alias("entity")).select(
        "entity",
        T.short_label(F.col("entity")).alias("short"),
        F.col("entity").contains("-USD").alias("has_usd"),
        T.strip_suffix(F.col("entity"), "-USD").alias("bare"),
    )
