import pytest

from helpers import series
from pricepanel.lineage import scratch_path
from pricepanel.sources import io


def test_newline_in_status_is_one_row(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([("A", 'Failed: x\n"y"', None)], "focal_id STRING, status STRING, r2 DOUBLE")
    io.write_panel(df, path, "csv")
    back = io.read_panel(spark, path, "focal_id STRING, status STRING, r2 DOUBLE", multiline=True)
    assert [tuple(r) for r in back.collect()] == [("A", 'Failed: x\n"y"', None)]


def test_nan_is_null_and_optional_columns(spark):
    path = scratch_path(spark, "t")
    series(spark, [1, None, float("nan")]).write.parquet(path)
    back = io.read_panel(spark, path, "entity STRING, obs_date DATE, price DOUBLE", "parquet", optional={"min_stay": "int"})
    assert sorted((r["price"] is None, r["min_stay"]) for r in back.collect()) == [(False, None), (True, None), (True, None)]


def test_existing_output_is_never_overwritten(spark):
    path = scratch_path(spark, "t")
    io.write_panel(series(spark, [1]), path)
    with pytest.raises(Exception):
        io.write_panel(series(spark, [2]), path)


def test_file_name_becomes_focal(spark):
    path = scratch_path(spark, "t")
    series(spark, [1, 2]).coalesce(1).write.option("header", True).csv(path)
    out = io.scan_glob(spark, f"{path}/*.csv", "entity STRING, obs_date DATE, price DOUBLE", r"-c000\.csv")
    assert out.select("focal_id").distinct().count() == 1
    assert out.first()["focal_id"].startswith("part-00000")


def test_transposed(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("A", 1.0, None)], "name STRING, `2024-01-01` DOUBLE, `2024-01-02` DOUBLE").write.option("header", True).csv(path)
    got = sorted((r["entity"], str(r["obs_date"]), r["price"]) for r in io.read_transposed(spark, path).collect())
    assert got == [("A", "2024-01-01", 1.0), ("A", "2024-01-02", None)]
