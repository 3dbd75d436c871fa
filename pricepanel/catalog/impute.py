"""Imputation queries based on windows and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.catalog.profile import GAPS, comp_dense, hourly_dense
from pricepanel.operators import align as L, impute as I
from pricepanel.sources import adapters as A


def price_only(df, decimals=6):
    return df.select("entity", "obs_date", F.round("price", decimals).alias("price"))


FFILL = "last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date)"
BFILL = """first_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
TWO_WAY = f"coalesce({FFILL}, {BFILL})"

view(
    "two_way",
    ["comp_dense"],
    f"SELECT entity, obs_date, {TWO_WAY} AS price FROM comp_dense",
)
TWO_WAY_SQL = "SELECT entity, obs_date, round(price, 6) AS price FROM two_way"


@query(
    "d1_ffill",
    sql=f"SELECT entity, obs_date, round({FFILL}, 6) AS price FROM comp_dense",
    uses=["comp_dense"],
)
def ffill(spark, root):
    return price_only(I.ffill(comp_dense(spark, root)))


@query(
    "d2_fill_group_median",
    sql=f"""SELECT entity, obs_date, round(coalesce(f, median(f) OVER (PARTITION BY entity)), 6) AS price
        FROM (SELECT entity, obs_date, {FFILL} AS f FROM comp_dense)""",
    uses=["comp_dense"],
)
def fill_group_median(spark, root):
    return price_only(I.fill_group_median(comp_dense(spark, root)))


CASCADE_GRID = """SELECT e.focal_id AS entity, d.obs_date, p.base_rate AS price
    FROM registry e, comp_dates d
    LEFT JOIN portfolio p ON p.focal_id = e.focal_id AND p.obs_date = d.obs_date"""


@query(
    "d3_fill_cascade",
    sql=f"""SELECT entity, obs_date, round(coalesce({TWO_WAY},
          (SELECT median(base_rate) FROM portfolio)), 6) AS price FROM ({CASCADE_GRID})""",
    uses=["registry", "portfolio", "comp_dates"],
)
def fill_cascade(spark, root):
    """Whole registry on one calendar; the focal without data takes the market median."""
    rates = A.portfolio(spark, root).select(
        F.col("focal_id").alias("entity"), "obs_date", F.col("base_rate").alias("price")
    )
    span = L.overlap_bounds(A.competitor_panel(spark, root))
    grid = (
        A.registry(spark, root)
        .select(
            F.col("focal_id").alias("entity"),
            F.explode(F.sequence(span.getField("lo"), span.getField("hi"))).alias("obs_date"),
        )
        .join(rates, ["entity", "obs_date"], "left")
    )
    return price_only(I.fill_cascade(grid, rates))


@query(
    "d4_fill_availability",
    sql="SELECT entity, obs_date, round(coalesce("
    + TWO_WAY.replace("price", "available")
    + ", 1.0), 6) AS available FROM comp_dense",
    uses=["comp_dense"],
)
def fill_availability(spark, root):
    out = I.fill_availability(comp_dense(spark, root))
    return out.select("entity", "obs_date", F.round("available", 6).alias("available"))


DECAY = f"""SELECT entity, obs_date, coalesce(price, f * pow(0.99, rn - seen), b) AS price FROM (
    SELECT entity, obs_date, price, {FFILL} AS f, {BFILL} AS b, rn,
        last_value(CASE WHEN price IS NOT NULL THEN rn END IGNORE NULLS)
            OVER (PARTITION BY entity ORDER BY obs_date) AS seen
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY obs_date) AS rn FROM comp_dense))"""
view("decay_filled", ["comp_dense"], DECAY)


@query(
    "d5_decay_fill",
    sql="SELECT entity, obs_date, round(price, 6) AS price FROM decay_filled",
    uses=["decay_filled"],
)
def decay_fill(spark, root):
    return price_only(I.decay_fill(comp_dense(spark, root)))


@query("d6_interpolate_after_fill", sql=TWO_WAY_SQL, uses=["two_way"])
def interpolate_after_fill(spark, root):
    return price_only(I.interpolate(comp_dense(spark, root)))


@query(
    "d6_interpolate",
    sql=f"""SELECT entity, obs_date, round(coalesce(price, pv + (nv - pv) * ((rn - pn) / (nn - pn)), pv), 4)
        AS price FROM (SELECT entity, obs_date, price, rn, {FFILL} AS pv, {BFILL} AS nv,
          last_value(known_at IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date) AS pn,
          first_value(known_at IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nn
        FROM (SELECT *, CASE WHEN price IS NOT NULL THEN rn END AS known_at FROM (SELECT *,
          row_number() OVER (PARTITION BY entity ORDER BY obs_date) AS rn FROM comp_dense)))""",
    uses=["comp_dense"],
)
def interpolate(spark, root):
    return price_only(I.interpolate(comp_dense(spark, root), pre_fill=False), 4)


@query("d7_ffill_bfill", sql=TWO_WAY_SQL, uses=["two_way"])
def ffill_bfill(spark, root):
    return price_only(I.ffill_bfill(comp_dense(spark, root)))


@query("d8_baseline_fill", sql=TWO_WAY_SQL, uses=["two_way"])
def baseline_fill(spark, root):
    return price_only(I.baseline_fill(comp_dense(spark, root)))


@query(
    "d9_impute_by_gap",
    sql="""SELECT entity, obs_date, m.method, round(CASE WHEN m.method = 'time_series_decay'
          THEN d.price ELSE t.price END, 6) AS price
        FROM decay_filled d JOIN two_way t USING (entity, obs_date) JOIN ("""
    + GAPS.format(t="comp_dense", o="obs_date")
    + ") m USING (entity)",
    uses=["decay_filled", "two_way"],
)
def impute_by_gap(spark, root):
    out = I.impute_by_gap(comp_dense(spark, root))
    return out.select("entity", "obs_date", "method", F.round("price", 6).alias("price"))


@query("d10_impute_univariate", sql=TWO_WAY_SQL, uses=["two_way"])
def impute_univariate(spark, root):
    return price_only(I.impute_univariate(comp_dense(spark, root)))


@query(
    "d11_complete_panel",
    sql=f"""SELECT entity, obs_date, round({TWO_WAY}, 6) AS price FROM (
        SELECT e.entity, d.obs_date, c.price FROM (SELECT DISTINCT entity FROM comp) e,
          (SELECT CAST(unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS DATE)
             AS obs_date FROM focal) d
        LEFT JOIN comp c ON c.entity = e.entity AND c.obs_date = d.obs_date)""",
    uses=["comp", "focal"],
)
def complete_panel(spark, root):
    span = L.overlap_bounds(L.base_rate(A.focal_rows(spark, root)))
    return price_only(
        I.complete_panel(A.competitor_panel(spark, root), span.getField("lo"), span.getField("hi"))
    )


@query(
    "d16_fill_mean",
    sql=f"""SELECT entity, obs_date, round(coalesce(price, avg(price) OVER (PARTITION BY entity),
        (SELECT avg(base_rate) FROM portfolio)), 3) AS price FROM ({CASCADE_GRID})""",
    uses=["registry", "portfolio", "comp_dates"],
)
def fill_mean(spark, root):
    span = L.overlap_bounds(A.competitor_panel(spark, root))
    grid = A.registry(spark, root).select(
        F.col("focal_id").alias("entity"),
        F.explode(F.sequence(span.getField("lo"), span.getField("hi"))).alias("obs_date"),
    )
    rates = A.portfolio(spark, root).select(
        F.col("focal_id").alias("entity"), "obs_date", F.col("base_rate").alias("price")
    )
    return price_only(I.fill_mean(grid.join(rates, ["entity", "obs_date"], "left")), 3)


@query(
    "d17_clip_nonneg",
    sql="SELECT event_id, greatest(value, 0) AS value FROM events",
)
def clip_nonneg(spark, root):
    return I.clip_nonneg(A.table(spark, root, "events").select("event_id", "value"), "value")


@query(
    "d18_extend_calendar",
    sql=f"""SELECT entity, obs_date, round({FFILL}, 6) AS price FROM (
        SELECT e.entity, d.obs_date, c.price FROM (SELECT DISTINCT entity FROM comp) e,
          (SELECT CAST(unnest(generate_series((SELECT min(obs_date) FROM comp),
             greatest((SELECT max(obs_date) FROM comp), (SELECT max(obs_date) FROM focal)),
             INTERVAL 1 DAY)) AS DATE) AS obs_date) d
        LEFT JOIN comp c ON c.entity = e.entity AND c.obs_date = d.obs_date)""",
    uses=["comp", "focal"],
)
def extend_calendar(spark, root):
    focal = L.base_rate(A.focal_rows(spark, root))
    return price_only(I.extend_calendar(A.competitor_panel(spark, root), focal))


@query(
    "d19_fill_zero",
    sql="SELECT entity, obs_date, coalesce(price, 0.0) AS price FROM comp_dense",
    uses=["comp_dense"],
)
def fill_zero(spark, root):
    return I.fill_zero(comp_dense(spark, root), ["price"]).select("entity", "obs_date", "price")


@query(
    "d20_complete_cases",
    sql="SELECT * FROM comp_matrix WHERE "
    + " AND ".join(f'"{e}" IS NOT NULL' for e in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
    uses=["comp_matrix"],
)
def complete_cases(spark, root):
    from pricepanel.catalog.align import matrix

    return I.complete_cases(matrix(spark, root))


@query(
    "d21_fill_stats",
    sql="""SELECT b.entity, count(*) FILTER (b.price IS NULL) AS original_nulls,
        count(*) FILTER (b.price IS NULL) - count(*) FILTER (a.price IS NULL) AS filled
        FROM comp_dense b JOIN (SELECT entity, obs_date, """ + FFILL + """ AS price FROM comp_dense) a
        ON a.entity = b.entity AND a.obs_date = b.obs_date GROUP BY 1""",
    uses=["comp_dense"],
)
def fill_stats(spark, root):
    dense = comp_dense(spark, root)
    return I.fill_stats(dense, I.ffill(dense))


@query(
    "d9_impute_by_gap_hourly",
    sql="""WITH z AS (SELECT 1) SELECT entity, obs_hour, m.method, round(CASE WHEN m.method = 'time_series_decay'
          THEN coalesce(price, f * pow(0.99, rn - seen), b) ELSE coalesce(f, b) END, 6) AS price
        FROM (SELECT *, last_value(price IGNORE NULLS) OVER w AS f,
            last_value(CASE WHEN price IS NOT NULL THEN rn END IGNORE NULLS) OVER w AS seen,
            first_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY obs_hour
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b
          FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY obs_hour) AS rn FROM hourly_dense)
          WINDOW w AS (PARTITION BY entity ORDER BY obs_hour)) JOIN (""".replace("WITH z AS (SELECT 1) ", "")
    + GAPS.format(t="hourly_dense", o="obs_hour")
    + ") m USING (entity)",
    uses=["hourly_dense"],
)
def impute_by_gap_hourly(spark, root):
    out = I.impute_by_gap(hourly_dense(spark, root), order="obs_hour")
    return out.select("entity", "obs_hour", "method", F.round("price", 6).alias("price"))
