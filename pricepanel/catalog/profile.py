"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query
from pricepanel.operators import align, profile as P
from pricepanel.operators.quantile import exact_quantiles
from pricepanel.sources import adapters as A


def comp_dense(spark, root):
    return align.densify(A.competitor_panel(spark, root))


def r6(name):
    return F.round(name, 6).alias(name)


@query(
    "b1_shape",
    sql="""SELECT count(*) AS n_rows, 3::BIGINT AS n_cols,
           ['obs_date:date','segment:string','price:double'] AS types FROM focal_rows""",
    uses=["focal_rows"],
)
def shape(spark, root):
    return P.shape(A.focal_rows(spark, root))


@query(
    "b2_distinct_counts",
    sql="SELECT count(DISTINCT entity) AS n_entity, count(DISTINCT obs_date) AS n_obs_date FROM comp",
    uses=["comp"],
)
def distinct_counts(spark, root):
    return P.distinct_counts(A.competitor_panel(spark, root), ["entity", "obs_date"])


@query(
    "b3_null_census",
    sql="""SELECT count(*) FILTER (entity IS NULL) AS entity,
        count(*) FILTER (obs_date IS NULL) AS obs_date, count(*) FILTER (price IS NULL) AS price,
        count(*) FILTER (available IS NULL) AS available,
        count(*) FILTER (entity IS NULL) + count(*) FILTER (obs_date IS NULL)
        + count(*) FILTER (price IS NULL) + count(*) FILTER (available IS NULL) AS total_nulls
        FROM comp_dense""",
    uses=["comp_dense"],
)
def null_census(spark, root):
    return P.null_census(comp_dense(spark, root))


@query(
    "b4_missing_by_entity",
    sql="""SELECT entity, count(price) AS valid, count(*) - count(price) AS missing,
        round((count(*) - count(price)) / count(*), 6) AS missing_rate
        FROM comp_dense GROUP BY 1""",
    uses=["comp_dense"],
)
def missing_by_entity(spark, root):
    out = P.missing_by(comp_dense(spark, root), "entity")
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "b4_missing_by_entity_valid",
    sql="""SELECT entity, count(price) AS valid, count(*) - count(price) AS missing,
        round((count(*) - count(price)) / count(price), 6) AS missing_rate
        FROM comp_dense GROUP BY 1""",
    uses=["comp_dense"],
)
def missing_by_entity_valid(spark, root):
    out = P.missing_by(comp_dense(spark, root), "entity", denom="valid")
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "b5_missing_by_date",
    sql="""SELECT obs_date, count(*) - count(price) AS missing FROM comp_dense GROUP BY 1
        HAVING count(*) - count(price) > 2""",
    uses=["comp_dense"],
)
def missing_by_date(spark, root):
    return P.missing_by_date(comp_dense(spark, root))


@query(
    "b6_invalid_prices",
    sql="SELECT count(*) FILTER (value <= 0) AS invalid FROM events",
)
def invalid_prices(spark, root):
    return P.invalid_prices(A.table(spark, root, "events"), "value")


@query(
    "b7_quantiles",
    sql="""SELECT round(quantile_cont(price, 0.01), 6) AS q01, round(quantile_cont(price, 0.5), 6) AS q50,
        round(quantile_cont(price, 0.99), 6) AS q99 FROM focal_rows""",
    uses=["focal_rows"],
)
def quantiles(spark, root):
    out = exact_quantiles(A.focal_rows(spark, root), "price", {"q01": 0.01, "q50": 0.5, "q99": 0.99})
    return out.select(r6("q01"), r6("q50"), r6("q99"))


@query(
    "b7_quantiles_by_segment",
    sql="""SELECT segment, round(quantile_cont(price, 0.25), 6) AS q25,
        round(quantile_cont(price, 0.75), 6) AS q75 FROM focal_rows GROUP BY 1""",
    uses=["focal_rows"],
)
def quantiles_by_segment(spark, root):
    out = exact_quantiles(
        A.focal_rows(spark, root), "price", {"q25": 0.25, "q75": 0.75}, ["segment"]
    )
    return out.select("segment", r6("q25"), r6("q75"))


@query(
    "b8_segment_stats",
    sql="""SELECT segment, round(avg(price), 5) AS mean, round(stddev_samp(price), 5) AS std,
        count(price) AS n FROM focal_rows GROUP BY 1""",
    uses=["focal_rows"],
)
def segment_stats(spark, root):
    out = P.segment_stats(A.focal_rows(spark, root))
    return out.select("segment", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "n")


@query(
    "b9_availability_rate",
    sql="SELECT entity, round(avg(available), 6) AS availability FROM comp GROUP BY 1",
    uses=["comp"],
)
def availability_rate(spark, root):
    out = P.availability_rate(A.competitor_panel(spark, root))
    return out.select("entity", r6("availability"))


@query(
    "b10_price_bounds",
    sql="""SELECT side, count(*) AS n, count(*) FILTER (price <= 0 OR price > b.bound) AS invalid,
        round(max(b.bound), 4) AS upper_bound
        FROM (SELECT 'focal' AS side, price FROM focal_rows UNION ALL SELECT 'competitor', price FROM comp) r,
        (SELECT 1.5 * greatest((SELECT quantile_cont(price, 0.99) FROM focal_rows),
                               (SELECT quantile_cont(price, 0.99) FROM comp)) AS bound) b
        GROUP BY 1""",
    uses=["focal_rows", "comp"],
)
def price_bounds(spark, root):
    focal, comp = A.focal_rows(spark, root), A.competitor_panel(spark, root)
    a, b = P.flag_price_bounds(focal, comp)
    bound = P.price_bound(focal, comp).scalar()
    both = a.select(F.lit("focal").alias("side"), "invalid").unionByName(
        b.select(F.lit("competitor").alias("side"), "invalid")
    )
    return (
        both.groupBy("side")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("invalid").alias("invalid"))
        .withColumn("upper_bound", F.round(bound, 4))
    )


@query(
    "b11_missing_grid",
    sql="SELECT entity, obs_date, CAST(price IS NULL AS INTEGER) AS is_missing FROM comp_dense",
    uses=["comp_dense"],
)
def missing_grid(spark, root):
    return P.missing_grid(comp_dense(spark, root))


HIST = """SELECT bin, count(*) AS n, round(max(lo + (bin - 1) * w), 4) AS left_edge FROM (
    SELECT lo, w, least({n}, CAST(floor((price - lo) / w) AS INTEGER) + 1) AS bin
    FROM {t}, (SELECT min(price) AS lo, (max(price) - min(price)) / {n} AS w FROM {t}) b)
    GROUP BY 1"""


@query("b12_histogram", sql=HIST.format(n=30, t="focal_rows"), uses=["focal_rows"])
def histogram(spark, root):
    out = P.histogram(A.focal_rows(spark, root), bins=30)
    return out.withColumn("left_edge", F.round("left_edge", 4))


@query(
    "b12_histogram_by_entity",
    sql="""SELECT entity, bin, count(*) AS n, round(max(lo + (bin - 1) * w), 4) AS left_edge FROM (
        SELECT entity, lo, w, least(20, CAST(floor((price - lo) / w) AS INTEGER) + 1) AS bin
        FROM comp JOIN (SELECT entity, min(price) AS lo, (max(price) - min(price)) / 20 AS w
                        FROM comp GROUP BY 1) b USING (entity)) GROUP BY 1, 2""",
    uses=["comp"],
)
def histogram_by_entity(spark, root):
    out = P.histogram(A.competitor_panel(spark, root), bins=20, keys=["entity"])
    return out.withColumn("left_edge", F.round("left_edge", 4))


GAPS = """SELECT entity, total_missing, round(total_missing * 100.0 / n, 6) AS pct_missing,
    coalesce(max_gap, 0) AS max_gap, coalesce(num_gaps, 0) AS num_gaps,
    round(coalesce(avg_gap, 0), 6) AS avg_gap, coalesce(gap_sizes, []) AS gap_sizes,
    CASE WHEN coalesce(max_gap, 0) = 0 THEN 'none' WHEN max_gap <= 1 THEN 'forward_fill'
         WHEN max_gap <= 3 THEN 'linear_interpolation' WHEN max_gap <= 7 THEN 'time_series_decay'
         ELSE 'univariate_mice' END AS method
    FROM (SELECT entity, count(*) AS n, count(*) - count(price) AS total_missing
          FROM {t} GROUP BY 1) b
    LEFT JOIN (SELECT entity, max(sz) AS max_gap, count(*) AS num_gaps, avg(sz) AS avg_gap,
                      list(sz ORDER BY start) AS gap_sizes
        FROM (SELECT entity, isl, count(*) AS sz, min(o) AS start
              FROM (SELECT entity, o, m, rn - row_number() OVER (PARTITION BY entity, m ORDER BY o) AS isl
                    FROM (SELECT entity, {o} AS o, price IS NULL AS m,
                                 row_number() OVER (PARTITION BY entity ORDER BY {o}) AS rn FROM {t}))
              WHERE m GROUP BY 1, 2) GROUP BY 1) g USING (entity)"""


@query("b13_gap_profile", sql=GAPS.format(t="comp_dense", o="obs_date"), uses=["comp_dense"])
def gap_profile(spark, root):
    out = P.gap_profile(comp_dense(spark, root))
    return out.withColumns(
        {"pct_missing": F.round("pct_missing", 6), "avg_gap": F.round("avg_gap", 6)}
    )


@query(
    "b13_gap_profile_hourly",
    sql=GAPS.format(t="hourly_dense", o="obs_hour"),
    uses=["hourly_dense"],
)
def gap_profile_hourly(spark, root):
    dense = hourly_dense(spark, root)
    out = P.gap_profile(dense, order="obs_hour")
    return out.withColumns(
        {"pct_missing": F.round("pct_missing", 6), "avg_gap": F.round("avg_gap", 6)}
    )


def hourly_dense(spark, root):
    """Hourly grid of the event panel (hours instead of days)."""
    panel = A.hourly_panel(spark, root)
    span = panel.agg(
        F.struct(F.min("obs_hour").alias("lo"), F.max("obs_hour").alias("hi")).alias("s")
    ).scalar()
    hours = F.sequence(span.getField("lo"), span.getField("hi"), F.expr("INTERVAL 1 HOUR"))
    grid = panel.select("entity").distinct().select("entity", F.explode(hours).alias("obs_hour"))
    return grid.join(panel, ["entity", "obs_hour"], "left")


@query(
    "b14_value_counts",
    sql="""SELECT method, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM (""" + GAPS.format(t="comp_dense", o="obs_date") + ") GROUP BY 1",
    uses=["comp_dense"],
)
def value_counts(spark, root):
    out = P.value_counts(P.gap_profile(comp_dense(spark, root)), "method")
    return out.withColumn("share", F.round("share", 6))


@query(
    "b15_range_summary",
    sql="""SELECT min(price) AS min_value, max(price) AS max_value, min(obs_date) AS date_start,
        max(obs_date) AS date_end FROM focal_rows""",
    uses=["focal_rows"],
)
def range_summary(spark, root):
    return P.range_summary(A.focal_rows(spark, root))


@query(
    "b16_readiness",
    sql="""SELECT u.check_name, u.passed, round(score, 6) AS score,
        CASE WHEN score >= 0.7 THEN 'ready' WHEN score >= 0.5 THEN 'cautious'
             ELSE 'preparation_needed' END AS verdict
        FROM (SELECT c, list_sum(list_transform(c, lambda x: CAST(x.passed AS INTEGER))) / 7 AS score FROM (SELECT [
          {'check_name': 'sufficient_overlap', 'passed': days >= 100},
          {'check_name': 'clean_price_data', 'passed': finv + cinv = 0},
          {'check_name': 'missing_data_manageable', 'passed': cnull / crow < 0.05},
          {'check_name': 'price_variation_adequate', 'passed': fsd > 0 AND csd > 0},
          {'check_name': 'meaningful_correlation', 'passed': abs(r) > 0.2},
          {'check_name': 'multiple_competitors', 'passed': ents >= 3},
          {'check_name': 'instruments_available', 'passed': true}] AS c
        FROM (SELECT greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi
              FROM (SELECT min(obs_date) lo, max(obs_date) hi FROM focal_rows) a,
                   (SELECT min(obs_date) lo, max(obs_date) hi FROM comp_dense) b) w,
        LATERAL (SELECT count(*) FILTER (price <= 0) AS finv,
                 stddev_samp(price) FILTER (obs_date BETWEEN w.lo AND w.hi) AS fsd FROM focal_rows) f,
        LATERAL (SELECT count(*) AS crow, count(*) - count(price) AS cnull, count(*) FILTER (price <= 0) AS cinv,
                 stddev_samp(price) FILTER (obs_date BETWEEN w.lo AND w.hi) AS csd,
                 count(DISTINCT entity) AS ents FROM comp_dense) c,
        LATERAL (SELECT count(*) AS days, corr(fm, cm) AS r FROM
            (SELECT obs_date, avg(price) AS fm FROM focal_rows WHERE obs_date BETWEEN w.lo AND w.hi GROUP BY 1)
            JOIN (SELECT obs_date, avg(price) AS cm FROM comp_dense WHERE obs_date BETWEEN w.lo AND w.hi GROUP BY 1)
            USING (obs_date)) j)), UNNEST(c) AS t(u)""",
    uses=["focal_rows", "comp_dense"],
)
def readiness(spark, root):
    out = P.readiness(A.focal_rows(spark, root), comp_dense(spark, root))
    return out.withColumn("score", F.round("score", 6))


@query(
    "b18_quality_gates",
    sql="""SELECT rule, violations FROM (
        SELECT 'duplicate_cells' AS rule, count(*) AS violations FROM
          (SELECT entity, obs_date FROM comp_dense GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'null_values', count(*) - count(price) FROM comp_dense
        UNION ALL SELECT 'empty_sample', CAST(count(*) = 0 AS BIGINT) FROM comp_dense
        UNION ALL SELECT 'absent_columns', 1::BIGINT)""",
    uses=["comp_dense"],
)
def quality_gates(spark, root):
    return align.assert_panel(
        comp_dense(spark, root),
        ["entity", "obs_date"],
        required=["price", "price_normalized"],
        raise_on_violation=False,
    )
