"""Readers and writers.

Schemas are explicit: nothing is inferred, so a scan never reads a file twice.
Portfolio outputs are one table partitioned by ``focal_id`` instead of one file
per focal, which keeps partition pruning and avoids a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pricepanel.functions.stats import nan_to_null


def read_panel(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "csv",
    multiline: bool = False,
    optional: dict[str, str] | None = None,
) -> DataFrame:
    """Panel table with header; NaN becomes NULL, absent optional columns are added as NULL.

    ``multiline`` allows newlines inside quoted text at the price of unsplittable files.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        df = reader.csv(path, header=True, multiLine=multiline, escape='"', nanValue="NaN")
    else:
        df = reader.format(fmt).load(path)
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    df = df.withColumns({c: nan_to_null(F.col(c)) for c in doubles})
    missing = {k: t for k, t in (optional or {}).items() if k not in df.columns}
    return df.withColumns({k: F.lit(None).cast(t) for k, t in missing.items()})


def read_indexed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV whose first column is an unnamed index; the schema supplies all names."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=True)


def read_transposed(
    spark: SparkSession, path: str, index: str = "entity", value: str = "price"
) -> DataFrame:
    """Entities in rows and dates as column names, turned into (entity, obs_date, price)."""
    wide = spark.read.csv(path, header=True)
    wide = wide.withColumnRenamed(wide.columns[0], index)
    return wide.unpivot([index], None, "obs_date", value).select(
        index,
        F.to_date("obs_date").alias("obs_date"),
        nan_to_null(F.col(value).cast("double")).alias(value),
    )


def scan_portfolio(registry: DataFrame, panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(panel rows of registered focals, one 'Skipped' row per focal without data)."""
    rows = panel.join(registry, "focal_id", "left_semi")
    skipped = registry.join(panel.select("focal_id"), "focal_id", "left_anti").withColumn(
        "status", F.lit("Skipped: no data")
    )
    return rows, skipped


def scan_glob(
    spark: SparkSession, pattern: str, schema: T.StructType | str, suffix: str, fmt: str = "csv"
) -> DataFrame:
    """All files matching ``pattern``; ``focal_id`` is the file name without ``suffix``."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(pattern).select(
        F.regexp_replace(F.col("_metadata.file_name"), f"{suffix}$", "").alias("focal_id"), "*"
    )


def read_meta(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    defaults: dict[str, Column] | None = None,
    multiline: bool = True,
) -> DataFrame:
    """JSON documents; a key that is absent takes its default."""
    df = spark.read.schema(schema).json(path, multiLine=multiline)
    return df.withColumns({k: F.coalesce(F.col(k), v) for k, v in (defaults or {}).items()})


def write_panel(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_models(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Nested model records as JSON lines, one document per focal."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
