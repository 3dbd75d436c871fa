"""Outlier, rescaling and detrending queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.operators import align as L, normalise as N
from pricepanel.sources import adapters as A


@query(
    "e1_iqr_by_entity",
    sql="""SELECT segment, count(*) AS n, count(*) FILTER (price < q1 - 3 * (q3 - q1)
          OR price > q3 + 3 * (q3 - q1)) AS outliers
        FROM focal_rows JOIN (SELECT segment, quantile_cont(price, 0.25) AS q1,
          quantile_cont(price, 0.75) AS q3 FROM focal_rows GROUP BY 1) USING (segment) GROUP BY 1""",
    uses=["focal_rows"],
)
def iqr_by_entity(spark, root):
    out = N.iqr_flag(A.focal_rows(spark, root), "segment")
    return out.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("outliers")
    )


@query(
    "e1_iqr_filter",
    sql="""SELECT entity, obs_date, price FROM comp JOIN (SELECT entity, quantile_cont(price, 0.25) AS q1,
          quantile_cont(price, 0.75) AS q3 FROM comp GROUP BY 1) USING (entity)
        WHERE NOT (price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1))""",
    uses=["comp"],
)
def iqr_filter(spark, root):
    out = N.iqr_flag(A.competitor_panel(spark, root), "entity", multiplier=1.5)
    return out.where("NOT is_outlier").select("entity", "obs_date", "price")


@query(
    "e2_iqr_global",
    sql="""SELECT count(*) AS n, count(*) FILTER (price < q1 - 3 * (q3 - q1)
          OR price > q3 + 3 * (q3 - q1)) AS outliers FROM focal_rows,
        (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM focal_rows)""",
    uses=["focal_rows"],
)
def iqr_global(spark, root):
    out = N.iqr_flag(A.focal_rows(spark, root))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("outliers"))


view(
    "focal_scaled",
    ["focal", "comp"],
    """SELECT obs_date, base_rate, (base_rate - fm) / fd * cd + cm AS normalized FROM focal,
       (SELECT median(base_rate) AS fm, (SELECT median(abs(base_rate - m)) FROM focal,
           (SELECT median(base_rate) AS m FROM focal)) AS fd FROM focal),
       (SELECT median(price) AS cm, (SELECT median(abs(price - m)) FROM comp,
           (SELECT median(price) AS m FROM comp)) AS cd FROM comp)""",
)


@query(
    "e3_mad_rescale",
    sql="SELECT obs_date, round(normalized, 4) AS normalized FROM focal_scaled",
    uses=["focal_scaled"],
)
def mad_rescale(spark, root):
    out = N.mad_rescale(
        L.base_rate(A.focal_rows(spark, root)),
        A.competitor_panel(spark, root),
        focal_value="base_rate",
    )
    return out.select("obs_date", F.round("normalized", 4).alias("normalized"))


@query(
    "e4_standardise",
    sql="""SELECT entity, obs_date, round((price - avg(p) OVER w) / CASE WHEN stddev_pop(p) OVER w = 0
          THEN 1 ELSE stddev_pop(p) OVER w END, 6) AS z
        FROM (SELECT *, CASE WHEN obs_date < DATE '1999-01-01' THEN price END AS p FROM comp)
        WINDOW w AS (PARTITION BY entity)""",
    uses=["comp"],
)
def standardise(spark, root):
    """Fitted on the years before 1999, applied to every row."""
    out = N.standardise(
        A.competitor_panel(spark, root), "price", fit=F.col("obs_date") < "1999-01-01"
    )
    return out.select("entity", "obs_date", F.round("z", 6).alias("z"))


view(
    "detrended",
    ["portfolio"],
    """SELECT *, (base_rate - trend) / trend AS deviation FROM (SELECT *, avg(base_rate) OVER
       (PARTITION BY focal_id ORDER BY obs_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS trend
       FROM portfolio)""",
)


@query(
    "e5_detrend",
    sql="SELECT focal_id, obs_date, round(deviation, 6) AS deviation FROM detrended",
    uses=["detrended"],
)
def detrend(spark, root):
    out = N.detrend(A.portfolio(spark, root), "base_rate", ["focal_id"])
    return out.select("focal_id", "obs_date", F.round("deviation", 6).alias("deviation"))


@query(
    "e6_retrend",
    sql="SELECT focal_id, obs_date, round(base_rate, 4) AS level FROM detrended",
    uses=["detrended"],
)
def retrend(spark, root):
    """Trend and deviation put back together give the price again."""
    out = N.detrend(A.portfolio(spark, root), "base_rate", ["focal_id"])
    level = N.retrend(F.col("trend"), F.col("deviation"))
    return out.select("focal_id", "obs_date", F.round(level, 4).alias("level"))
