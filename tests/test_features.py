import datetime as dt
import math
import statistics

from pyspark.sql import functions as F

from helpers import close, day, series, values_of
from pricepanel.functions import calendar as C, text as T
from pricepanel.functions.stats import safe_corr
from pricepanel.operators import correlate as R, features as X, normalise as N
from pricepanel.operators.quantile import exact_quantiles, ks_two_sample


def dates(spark, *ds):
    return spark.createDataFrame([(d,) for d in ds], "obs_date DATE")


def test_iso_weeks_and_leap_day(spark):
    df = dates(spark, dt.date(2024, 12, 30), dt.date(2025, 1, 1), dt.date(2020, 12, 31), dt.date(2024, 12, 31))
    got = {r["obs_date"]: (r["week_of_year"], r["day_of_year"]) for r in C.with_calendar(df).collect()}
    assert got[dt.date(2024, 12, 30)][0] == 1
    assert got[dt.date(2025, 1, 1)][0] == 1
    assert got[dt.date(2020, 12, 31)][0] == 53
    assert got[dt.date(2024, 12, 31)][1] == 366


def test_lags_follow_rows_not_days(spark):
    df = series(spark, [1, 2, 3]).where(F.col("obs_date") != day(2)).unionByName(series(spark, [4], start=3))
    assert values_of(X.lags(df, (1,)), "price_lag_1") == [None, 1, 2]


def test_pct_change_pads_and_survives_zero(spark):
    out = values_of(X.pct_change(series(spark, [10, None, 15, 0, 5])), "price_change_pct")
    assert close(out, [None, 0, 0.5, -1, None])


def test_single_row_and_constant(spark):
    one = series(spark, [5])
    assert values_of(X.diff(one), "price_change") == [None]
    assert one.agg(safe_corr(F.col("price"), F.col("price")).alias("r")).first()["r"] is None
    flat = series(spark, [3, 3, 3])
    assert values_of(N.standardise(flat), "z") == [0, 0, 0]


def test_mad_rescale(spark):
    f, c = series(spark, [1, 2, 3, 4, 100]), series(spark, [10, 20, 30], "B")
    assert close(values_of(N.mad_rescale(f, c), "normalized"), [0, 10, 20, 30, 990])
    assert values_of(N.mad_rescale(series(spark, [1, 1, 1, 2]), c), "normalized") == [None] * 4
    holed = series(spark, [1, None, 3])
    assert values_of(N.mad_rescale(holed, c, null_poisons=True), "normalized") == [None] * 3


def test_iqr_null_is_no_outlier(spark):
    out = N.iqr_flag(series(spark, [1, 2, 3, 4, None, 1000]), "entity")
    assert values_of(out, "is_outlier") == [False] * 5 + [True]


def test_zero_trend_gives_null(spark):
    assert values_of(N.detrend(series(spark, [0, 0, 3]), n=2), "deviation") == [None, None, 1]


def test_lead_lag_direction(spark):
    x = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9]
    y = [0, 0] + x[:-2]
    rows = [(day(i), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    out = R.lead_lag(spark.createDataFrame(rows[2:], "obs_date DATE, f DOUBLE, c DOUBLE")).collect()
    assert {r["best_lag"] for r in out} == {2}
    assert math.isclose(next(r["correlation"] for r in out if r["lag"] == 2), 1.0)


def test_short_label_and_names(spark):
    df = spark.createDataFrame([("chain-us-grand-plaza-USD",)], "e STRING")
    row = df.select(T.short_label(F.col("e")).alias("s"), T.display_name(F.col("e"), {}).alias("d")).first()
    assert (row["s"], row["d"]) == ("PLAZ", "chain-us-grand-plaza-USD")


def test_lag_count_ignores_names(spark):
    rows = spark.createDataFrame(
        [("F", day(i), [("flagstaff-USD", "USD")], [1.0, 2.0]) for i in range(8)],
        "focal_id STRING, obs_date DATE, columns ARRAY<STRUCT<entity: STRING, currency: STRING>>, row ARRAY<DOUBLE>",
    )
    out = X.lag_profile(rows).first()
    assert (out["lag_features"], out["final_rows"], out["data_retention_pct"]) == (10, 3, 37.5)
    assert X.oos_design(rows).count() == 3


def test_exact_quantiles_with_hot_group(spark):
    hot = spark.range(3000).select(F.lit("H").alias("g"), ((F.col("id") * 7919) % 1013 - 500).cast("double").alias("v"))
    cold = spark.range(5).select(F.lit("C").alias("g"), F.col("id").cast("double").alias("v"))
    df = hot.unionByName(cold)
    got = {r["g"]: r for r in exact_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.99}, ["g"]).collect()}
    for g in ("H", "C"):
        want = df.where(F.col("g") == g).agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.99)))).first()[0]
        assert close([got[g]["a"], got[g]["b"], got[g]["c"]], want)
    sample = sorted(r["v"] for r in df.where("g = 'H'").collect())
    assert got["H"]["b"] == statistics.median(sample)


def test_ks(spark):
    def stat(a, b):
        rows = [("k", float(v), True) for v in a] + [("k", float(v), False) for v in b]
        df = spark.createDataFrame(rows, "k STRING, v DOUBLE, s BOOLEAN")
        return ks_two_sample(df, "v", "s", ["k"]).first()["ks_statistic"]

    assert stat([1, 2, 3], [1, 2, 3]) == 0
    assert stat([1, 2, 3], [11, 12, 13]) == 1
    assert math.isclose(stat([-2, -1, 5], [-1, 5, 5, 7]), 1 / 3 + 1 / 12)
