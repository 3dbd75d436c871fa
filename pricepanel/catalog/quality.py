"""Imputation quality queries: the dense panel before, the decay fill after."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query, view
from pricepanel.catalog.profile import comp_dense
from pricepanel.operators import align as L, impute as I, quality as Q
from pricepanel.sources import adapters as A


def before_after(spark, root):
    pre = comp_dense(spark, root).select("entity", "obs_date", "price")
    return pre, I.decay_fill(pre)


MISSING = """SELECT entity, count(*) AS total_cells, count(*) - count(b.price) AS missing_before,
    count(*) - count(a.price) AS missing_after, (count(*) - count(b.price)) / count(*) * 100 AS pct_missing,
    (count(*) - count(a.price)) / count(*) * 100 AS pct_missing_after, count(a.price) - count(b.price) AS n_imputed
    FROM comp_dense b JOIN decay_filled a USING (entity, obs_date) GROUP BY 1"""
DELTA = """SELECT entity, """ + ", ".join(
    f"{f}({side}.price) AS {tag}_{n}"
    for side, tag in (("b", "pre"), ("a", "post"))
    for f, n in (("avg", "mean"), ("stddev_samp", "std"), ("median", "median"), ("min", "min"), ("max", "max"))
) + " FROM comp_dense b JOIN decay_filled a USING (entity, obs_date) GROUP BY 1"
KS = """SELECT entity, na AS n_first, nb AS n_second, d AS ks_statistic,
    CASE WHEN lam <= 0 THEN 1.0
      WHEN lam < 1 THEN least(1, greatest(0, 1 - sqrt(2 * pi()) / lam
        * (SELECT sum(exp(-pow(2 * k - 1, 2) * pow(pi(), 2) / (8 * lam * lam))) FROM range(1, 101) t(k))))
      ELSE least(1, greatest(0, (SELECT sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END
        * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)))) END AS ks_pvalue
    FROM (SELECT *, d * sqrt(na * nb / (na + nb)) AS lam FROM (
      SELECT entity, CAST(max(na) AS BIGINT) AS na, CAST(max(nb) AS BIGINT) AS nb,
             max(abs(ca / na - cb / nb)) AS d FROM (
        SELECT entity, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY entity) AS na,
               sum(b) OVER (PARTITION BY entity) AS nb
        FROM (SELECT entity, price, count(*) FILTER (s) AS a, count(*) FILTER (NOT s) AS b FROM (
            SELECT entity, price, true AS s FROM comp_dense WHERE price IS NOT NULL
            UNION ALL SELECT entity, price, false FROM decay_filled WHERE price IS NOT NULL) GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY entity ORDER BY price)) GROUP BY 1))"""
view("missing_report", ["comp_dense", "decay_filled"], MISSING)
view("delta_report", ["comp_dense", "decay_filled"], DELTA)
view("ks_report", ["comp_dense", "decay_filled"], KS)
view(
    "graded",
    ["missing_report", "delta_report", "ks_report"],
    """SELECT *, CASE WHEN n_issues = 0 THEN 5 WHEN n_issues = 1 AND n_warnings = 0 THEN 4 WHEN n_issues = 1 THEN 3
              ELSE 2 END AS quality_score,
         CASE WHEN n_issues = 0 THEN 'EXCELLENT' WHEN n_issues = 1 AND n_warnings = 0 THEN 'GOOD'
              WHEN n_issues = 1 THEN 'FAIR' ELSE 'POOR' END AS quality
       FROM (SELECT *, post_mean - pre_mean AS mean_delta,
         CAST(abs(post_mean - pre_mean) > 0.1 * pre_std AS INTEGER) + CAST(NOT ks_pvalue > 0.05 AS INTEGER)
           + CAST(missing_after > 0 AND missing_after >= missing_before AS INTEGER) AS n_issues,
         CAST(abs(post_std - pre_std) > 0.1 * pre_std AS INTEGER) AS n_warnings
       FROM missing_report JOIN delta_report USING (entity) JOIN ks_report USING (entity))""",
)


@query(
    "j1_missing_delta",
    sql="""SELECT entity, total_cells, missing_before, missing_after, round(pct_missing, 5) AS pct_missing,
        round(pct_missing_after, 5) AS pct_missing_after, n_imputed FROM missing_report""",
    uses=["missing_report"],
)
def missing_delta(spark, root):
    pre, post = before_after(spark, root)
    return Q.missing_delta(pre, post, ["entity"]).withColumns(
        {"pct_missing": F.round("pct_missing", 5), "pct_missing_after": F.round("pct_missing_after", 5)}
    )


@query(
    "j2_dist_delta",
    sql="SELECT entity, "
    + ", ".join(
        f"round({t}_{n}, 4) AS {t}_{n}" for t in ("pre", "post") for n in ("mean", "std", "median", "min", "max")
    )
    + ", "
    + ", ".join(f"round(post_{n} - pre_{n}, 4) AS {n}_delta" for n in ("mean", "std", "median"))
    + " FROM delta_report",
    uses=["delta_report"],
)
def dist_delta(spark, root):
    pre, post = before_after(spark, root)
    out = Q.dist_delta(pre, post, ["entity"])
    return out.select("entity", *[F.round(c, 4).alias(c) for c in out.columns if c != "entity"])


@query(
    "j3_ks_2samp",
    sql="""SELECT entity, n_first, n_second, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue,
        ks_pvalue <= 0.05 AS ks_significant FROM ks_report""",
    uses=["ks_report"],
)
def ks_2samp(spark, root):
    pre, post = before_after(spark, root)
    return Q.ks_2samp(pre, post, ["entity"]).withColumns(
        {"ks_statistic": F.round("ks_statistic", 6), "ks_pvalue": F.round("ks_pvalue", 6)}
    )


def report(spark, root):
    pre, post = before_after(spark, root)
    return Q.validate_imputation(pre, post, ["entity"])


@query(
    "j4_grade",
    sql="""SELECT entity, quality_score, quality, n_issues, n_warnings FROM graded""",
    uses=["graded"],
)
def grade(spark, root):
    return report(spark, root).select(
        "entity",
        "quality_score",
        "quality",
        F.size("issues").alias("n_issues"),
        F.size("warnings").alias("n_warnings"),
    )


@query(
    "j4_grade_texts",
    sql="""SELECT entity, quality, concat_ws('; ',
          CASE WHEN abs(mean_delta) > 0.1 * pre_std
            THEN printf('Mean shifted by $%+.2f (%+.1f%%)', mean_delta, mean_delta / pre_mean * 100) END,
          CASE WHEN NOT ks_pvalue > 0.05 THEN printf('Distribution changed (KS p = %.4f)', ks_pvalue) END,
          CASE WHEN missing_after > 0 AND missing_after >= missing_before
            THEN 'Missing values not reduced' END) AS issues,
        concat_ws('; ', CASE WHEN abs(post_std - pre_std) > 0.1 * pre_std
          THEN printf('Std dev changed by %+.1f%%', (post_std - pre_std) / pre_std * 100) END) AS warnings
        FROM graded""",
    uses=["graded"],
)
def grade_texts(spark, root):
    return report(spark, root).select(
        "entity",
        "quality",
        F.array_join("issues", "; ").alias("issues"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


@query(
    "j5_quality_shares",
    sql="""SELECT q.quality, count(g.entity) AS n, round(count(g.entity) * 100.0 / (SELECT count(*) FROM graded), 4) AS pct
        FROM (SELECT unnest(['EXCELLENT', 'GOOD', 'FAIR', 'POOR']) AS quality) q LEFT JOIN graded g USING (quality)
        GROUP BY 1""",
    uses=["graded"],
)
def quality_shares(spark, root):
    return Q.quality_shares(report(spark, root)).withColumn("pct", F.round("pct", 4))


@query(
    "j5_quality_summary",
    sql="""SELECT count(*) AS n_groups, round(avg(pct_missing), 5) AS mean_pct_missing,
        round(median(pct_missing), 5) AS median_pct_missing, round(avg(mean_delta), 3) AS mean_of_mean_delta,
        round(median(mean_delta), 3) AS median_of_mean_delta,
        count(*) FILTER (mean_delta < -10) AS n_negative_bias, count(*) FILTER (mean_delta > 10) AS n_positive_bias
        FROM graded""",
    uses=["graded"],
)
def quality_summary(spark, root):
    out = Q.quality_summary(report(spark, root))
    return out.withColumns(
        {
            "mean_pct_missing": F.round("mean_pct_missing", 5),
            "median_pct_missing": F.round("median_pct_missing", 5),
            "mean_of_mean_delta": F.round("mean_of_mean_delta", 3),
            "median_of_mean_delta": F.round("median_of_mean_delta", 3),
        }
    )


@query(
    "j5_best_and_worst",
    sql="""SELECT * FROM (SELECT 'best' AS list, entity, quality_score, quality FROM graded
        ORDER BY quality_score DESC, entity LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'worst', entity, quality_score, quality FROM graded
        ORDER BY quality_score, entity LIMIT 5)""",
    uses=["graded"],
)
def best_and_worst(spark, root):
    return Q.best_and_worst(report(spark, root), "entity").select("list", "entity", "quality_score", "quality")


@query(
    "j3_ks_segments",
    sql="""SELECT segment, CAST(na AS BIGINT) AS n_first, CAST(nb AS BIGINT) AS n_second, round(d, 6) AS ks_statistic FROM (
        SELECT segment, max(na) AS na, max(nb) AS nb, max(abs(ca / na - cb / nb)) AS d FROM (
          SELECT segment, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY segment) AS na,
                 sum(b) OVER (PARTITION BY segment) AS nb FROM (
            SELECT segment, price, count(*) FILTER (obs_date < DATE '1998-01-01') AS a,
                   count(*) FILTER (obs_date >= DATE '1998-01-01') AS b FROM focal_rows GROUP BY 1, 2)
          WINDOW w AS (PARTITION BY segment ORDER BY price)) GROUP BY 1)""",
    uses=["focal_rows"],
)
def ks_segments(spark, root):
    """Raw rows of every segment, early against late years."""
    from pricepanel.operators.quantile import ks_two_sample

    rows = A.focal_rows(spark, root).withColumn("early", F.col("obs_date") < "1998-01-01")
    out = ks_two_sample(rows, "price", "early", ["segment"])
    return out.withColumn("ks_statistic", F.round("ks_statistic", 6))


# Lattice paths as a walk along i + j = k, weighted so that no count overflows; list slot i + 1 holds point (i, k - i).
view(
    "ks_by_year",
    ["comp_dense", "decay_filled"],
    """SELECT entity, year, CAST(max(na) AS BIGINT) AS n, CAST(max(nb) AS BIGINT) AS m, max(abs(ca / na - cb / nb)) AS d
       FROM (SELECT entity, year, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER v AS na, sum(b) OVER v AS nb
         FROM (SELECT entity, year, price, count(*) FILTER (s) AS a, count(*) FILTER (NOT s) AS b FROM (
             SELECT entity, year(obs_date) AS year, price, true AS s FROM comp_dense WHERE price IS NOT NULL
             UNION ALL SELECT entity, year(obs_date), price, false FROM decay_filled WHERE price IS NOT NULL)
           GROUP BY 1, 2, 3)
         WINDOW w AS (PARTITION BY entity, year ORDER BY price), v AS (PARTITION BY entity, year))
       GROUP BY 1, 2""",
)


@query(
    "j3_ks_exact",
    sql="""SELECT * FROM (WITH RECURSIVE walk AS (
        SELECT entity, year, n, m, d, CAST(round(d * n * m) AS BIGINT) AS h, 0::BIGINT AS k,
               list_transform(range(n + 1), lambda i: CASE WHEN i = 0 AND d > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS w
        FROM ks_by_year WHERE n > 0 AND m > 0
        UNION ALL
        SELECT entity, year, n, m, d, h, k + 1, list_transform(range(n + 1), lambda i:
            CASE WHEN i > k + 1 OR k + 1 - i > m OR abs(i * m - (k + 1 - i) * n) >= h THEN 0.0::DOUBLE
            ELSE w[i + 1] * m / (n + m) + CASE WHEN i > 0 THEN w[i] * n / (n + m) ELSE 0.0::DOUBLE END END)
        FROM walk WHERE k < n + m),
      stirling AS (SELECT entity, year, n, m, d, w[n + 1] AS staying,
          exp(lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1) + n * ln(n / (n + m)) + m * ln(m / (n + m))) AS every
        FROM walk WHERE k = n + m)
      SELECT entity, CAST(year AS INTEGER) AS year, n AS n_first, m AS n_second, round(d, 6) AS ks_statistic,
             abs(round(greatest(0, least(1, 1 - staying / every)), 6)) AS ks_pvalue FROM stirling)""",
    uses=["ks_by_year"],
)
def ks_exact(spark, root):
    pre, post = (d.withColumn("year", F.year("obs_date")) for d in before_after(spark, root))
    out = Q.ks_2samp(pre, post, ["entity", "year"], exact=True).where("n_first > 0 AND n_second > 0")
    return out.select(
        "entity", "year", "n_first", "n_second",
        F.round("ks_statistic", 6).alias("ks_statistic"), F.round("ks_pvalue", 6).alias("ks_pvalue"),
    )
