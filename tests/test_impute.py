import pytest
from pyspark.sql import functions as F

from helpers import close, day, series, values_of
from pricepanel.operators import align as L, impute as I, profile as P

GAP_MIX = [None, 10, None, None, 16, None]


def test_two_way_fill(spark):
    assert values_of(I.ffill_bfill(series(spark, GAP_MIX))) == [10, 10, 10, 10, 16, 16]


def test_univariate_equals_two_way(spark):
    df = series(spark, GAP_MIX)
    assert values_of(I.impute_univariate(df)) == values_of(I.ffill_bfill(df))


def test_decay(spark):
    assert close(values_of(I.decay_fill(series(spark, GAP_MIX))), [10, 10, 9.9, 9.801, 16, 15.84])


def test_true_interpolation(spark):
    out = values_of(I.interpolate(series(spark, GAP_MIX), pre_fill=False))
    assert close(out, [None, 10, 12, 14, 16, 16])


def test_group_median_after_ffill(spark):
    out = values_of(I.fill_group_median(series(spark, [None, 4, None, 8])))
    assert out == [4, 4, 4, 8]


def test_cascade_market_median_for_empty_series(spark):
    a, b = series(spark, [1, 2, 3]), series(spark, [None, None, None], "B")
    grid = a.unionByName(b)
    assert values_of(I.fill_cascade(grid, grid), key="B") == [2, 2, 2]


@pytest.mark.parametrize(
    "gap, method",
    [
        (0, "none"),
        (1, "forward_fill"),
        (3, "linear_interpolation"),
        (7, "time_series_decay"),
        (8, "univariate_mice"),
    ],
)
def test_gap_routes(spark, gap, method):
    row = P.gap_profile(series(spark, [1] + [None] * gap + [2])).first()
    assert (row["max_gap"], row["method"]) == (gap, method)
    assert row["gap_sizes"] == ([gap] if gap else [])


def test_route_picks_decay(spark):
    df = series(spark, [10] + [None] * 5 + [20])
    assert close(values_of(I.impute_by_gap(df)), values_of(I.decay_fill(df)))


def test_extend_calendar_starts_at_own_first_date(spark):
    base = series(spark, [0] * 6).select("obs_date")
    out = I.extend_calendar(series(spark, [5, None, 7], start=2), base)
    assert [r["obs_date"] for r in out.orderBy("obs_date").collect()] == [day(i) for i in range(2, 6)]
    assert values_of(out) == [5, 5, 7, 7]


def test_fill_stats_clip_and_means(spark):
    df = series(spark, [None, -2, 4])
    stats = I.fill_stats(df, I.ffill_bfill(df)).first()
    assert (stats["original_nulls"], stats["filled"]) == (1, 1)
    assert values_of(I.clip_nonneg(df)) == [None, 0, 4]
    assert values_of(I.fill_mean(df)) == [1, -2, 4]


def test_drop_empty_and_reindex(spark):
    df = series(spark, [1, 2]).unionByName(series(spark, [None, None], "B"))
    assert {r["entity"] for r in L.drop_empty_entities(df).collect()} == {"A"}
    dates = series(spark, [0, 0], start=1).select("obs_date")
    out = L.reindex_to(series(spark, [1, 2]), dates)
    assert values_of(out) == [2, None]


def test_matrix_round_trip(spark):
    df = series(spark, [1, 2]).unionByName(series(spark, [3, 4], "B"))
    back = L.to_long(L.to_matrix(df, ["A", "B"]), ["obs_date"])
    key = lambda d: sorted((r["entity"], r["obs_date"], r["price"]) for r in d.collect())
    assert key(back) == key(df)


def test_quality_gates(spark):
    df = series(spark, [1, None]).unionByName(series(spark, [1]))
    with pytest.raises(ValueError, match="duplicate_cells=1"):
        L.assert_panel(df, ["entity", "obs_date"])
    clean = L.assert_panel(series(spark, [1, 2]), ["entity", "obs_date"], required=["price"])
    assert clean.agg(F.sum("violations")).first()[0] == 0


def test_semi_align_and_overlap(spark):
    a = series(spark, [1, 2, 3]).unionByName(series(spark, [9], "Z"))
    b = series(spark, [1, 2], start=1)
    left, right = L.semi_align(a, b)
    assert {(r["entity"], r["obs_date"]) for r in left.collect()} == {("A", day(1)), ("A", day(2))}
    assert right.count() == 2
    far = series(spark, [1], start=100)
    x, y, summary = L.temporal_overlap(a, far)
    assert (x.count(), y.count(), summary.first()["overlap_days"]) == (0, 0, 0)
