"""Source and sink queries: every one writes what the tables contain and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.catalog.base import query
from pricepanel.lineage import scratch_path
from pricepanel.operators import align as L, profile as P
from pricepanel.sources import adapters as A, io

PANEL = "entity STRING, obs_date DATE, price DOUBLE, available DOUBLE"


@query(
    "a1_csv_panel",
    sql="""SELECT entity, obs_date, price, round(available, 6) AS available, CAST(NULL AS INTEGER) AS min_stay
        FROM comp""",
    uses=["comp"],
)
def csv_panel(spark, root):
    path = scratch_path(spark, "csv")
    io.write_panel(A.competitor_panel(spark, root).select("entity", "obs_date", "price", "available"), path, "csv")
    back = io.read_panel(spark, path, PANEL, optional={"min_stay": "int"})
    return back.withColumn("available", F.round("available", 6))


@query(
    "a2_parse_dates",
    sql="SELECT CAST(o_orderdate AS DATE) AS obs_date, count(*) AS n FROM orders GROUP BY 1",
)
def parse_dates(spark, root):
    o = A.table(spark, root, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("obs_date")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a3_indexed_csv",
    sql="SELECT obs_date, round(base_rate, 6) AS base_rate FROM focal",
    uses=["focal"],
)
def indexed_csv(spark, root):
    path = scratch_path(spark, "indexed")
    rates = L.base_rate(A.focal_rows(spark, root)).withColumnRenamed("obs_date", "_c0")
    io.write_panel(rates, path, "csv")
    back = io.read_indexed(spark, path, "obs_date DATE, base_rate DOUBLE")
    return back.withColumn("base_rate", F.round("base_rate", 6))


@query(
    "a4_transposed_matrix",
    sql="SELECT entity, obs_date, price FROM comp WHERE price IS NOT NULL",
    uses=["comp"],
)
def transposed_matrix(spark, root):
    """One row per entity, stored with every date as a column name."""
    dated = A.competitor_panel(spark, root).withColumn("day", F.col("obs_date").cast("string"))
    days = L.entity_list(dated, "day")
    path = scratch_path(spark, "transposed")
    io.write_panel(L.to_matrix(dated, days, rows="entity", columns="day"), path, "csv")
    return io.read_transposed(spark, path).where(F.col("price").isNotNull())


@query(
    "a5_scan_portfolio",
    sql="""SELECT focal_id, count(p.obs_date) AS n_rows,
        CASE WHEN count(p.obs_date) = 0 THEN 'Skipped: no data' ELSE 'Loaded' END AS status
        FROM registry LEFT JOIN portfolio p USING (focal_id) GROUP BY 1""",
    uses=["registry", "portfolio"],
)
def scan_portfolio(spark, root):
    rows, skipped = io.scan_portfolio(A.registry(spark, root), A.portfolio(spark, root))
    loaded = rows.groupBy("focal_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("status", F.lit("Loaded"))
    return loaded.unionByName(skipped.select("focal_id", F.lit(0).cast("bigint").alias("n_rows"), "status"))


@query(
    "a6_glob_scan",
    sql="SELECT focal_id AS owner, 1 AS n_files, count(*) AS n_rows FROM portfolio GROUP BY 1",
    uses=["portfolio"],
)
def glob_scan(spark, root):
    """Files of one folder; the identifier comes from the file name."""
    path = scratch_path(spark, "glob")
    io.write_panel(A.portfolio(spark, root).repartition(5, "focal_id"), path, "csv")
    back = io.scan_glob(
        spark, f"{path}/*.csv", "owner STRING, obs_date DATE, base_rate DOUBLE", r"-c000\.csv"
    )
    return back.groupBy("owner").agg(
        F.count_distinct("focal_id").alias("n_files"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "a7_json_meta",
    sql="""SELECT entity, count(price) AS valid, count(*) - count(price) AS missing,
        'linear' AS method FROM comp_dense GROUP BY 1""",
    uses=["comp_dense"],
)
def json_meta(spark, root):
    """Metadata documents written and read back; the absent key takes its default."""
    dense = L.densify(A.competitor_panel(spark, root))
    path = scratch_path(spark, "meta")
    io.write_models(P.missing_by(dense, "entity"), path)
    return io.read_meta(
        spark,
        path,
        "entity STRING, valid BIGINT, missing BIGINT, method STRING",
        {"method": F.lit("linear")},
        multiline=False,
    )


@query(
    "a8_partitioned_sink",
    sql="SELECT focal_id, count(*) AS n, max(base_rate) AS top FROM portfolio GROUP BY 1",
    uses=["portfolio"],
)
def partitioned_sink(spark, root):
    path = scratch_path(spark, "panel")
    io.write_panel(A.portfolio(spark, root), path, partition_by=["focal_id"])
    back = spark.read.schema("obs_date DATE, base_rate DOUBLE, focal_id STRING").parquet(path)
    return back.groupBy("focal_id").agg(F.count(F.lit(1)).alias("n"), F.max("base_rate").alias("top"))


@query(
    "a9_json_sink",
    sql="""SELECT entity, n, round(mean, 5) AS mean FROM (SELECT entity, count(*) AS n, avg(price) AS mean
        FROM comp GROUP BY 1)""",
    uses=["comp"],
)
def json_sink(spark, root):
    path = scratch_path(spark, "models")
    record = (
        A.competitor_panel(spark, root)
        .groupBy("entity")
        .agg(F.struct(F.count("price").alias("n"), F.avg("price").alias("mean")).alias("metrics"))
    )
    io.write_models(record, path)
    back = spark.read.schema("entity STRING, metrics STRUCT<n: BIGINT, mean: DOUBLE>").json(path)
    return back.select("entity", F.col("metrics.n").alias("n"), F.round("metrics.mean", 5).alias("mean"))


@query(
    "a10_multiline_csv",
    sql="SELECT entity, 'Failed: bad ' || chr(10) || '\"' || entity || '\"' AS status, count(*) AS n FROM comp GROUP BY 1",
    uses=["comp"],
)
def multiline_csv(spark, root):
    path = scratch_path(spark, "multiline")
    status = F.concat(F.lit('Failed: bad \n"'), "entity", F.lit('"'))
    counts = A.competitor_panel(spark, root).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    io.write_panel(counts.select("entity", status.alias("status"), "n"), path, "csv")
    return io.read_panel(spark, path, "entity STRING, status STRING, n BIGINT", multiline=True)
