"""Price panels derived from the star-schema tables.

Every adapter aggregates to one row per panel cell straight from a pruned
parquet scan.  From then on the size of a window partition is the number of
calendar dates of one entity, never the number of source rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def competitor_panel(spark: SparkSession, root: str) -> DataFrame:
    """(entity, obs_date, price, available): one competitor per order priority."""
    return (
        table(spark, root, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("entity"),
            F.to_date("o_orderdate").alias("obs_date"),
        )
        .agg(
            F.min("o_totalprice").alias("price"),
            F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)).alias("available"),
        )
    )


def focal_rows(spark: SparkSession, root: str) -> DataFrame:
    """(obs_date, segment, price): raw rows of one focal, several per date."""
    return table(spark, root, "lineitem").select(
        F.to_date("l_shipdate").alias("obs_date"),
        F.col("l_returnflag").alias("segment"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )


def _nations(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "nation").select(
        F.col("n_nationkey"),
        F.col("n_regionkey"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_regionkey") == 4, "EUR").otherwise("USD").alias("currency"),
    )


def portfolio(spark: SparkSession, root: str) -> DataFrame:
    """(focal_id, obs_date, base_rate): daily minimum per nation.

    The fact table is reduced to (customer, date) before it meets the customer
    dimension, and the nation names are attached to the finished panel, so the
    join never carries raw orders and no side needs a forced broadcast.
    """
    per_customer = (
        table(spark, root, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("obs_date"))
        .agg(F.min("o_totalprice").alias("base_rate"))
    )
    customers = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "obs_date")
        .agg(F.min("base_rate").alias("base_rate"))
    )
    return per_nation.join(
        _nations(spark, root), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("name").alias("focal_id"), "obs_date", "base_rate")


def region_panel(spark: SparkSession, root: str) -> DataFrame:
    """(focal_id, entity, currency, obs_date, price): competitors share the focal's region."""
    rates = portfolio(spark, root)
    nations = _nations(spark, root)
    pairs = (
        nations.select(F.col("name").alias("focal_id"), "n_regionkey")
        .join(
            nations.select(F.col("name").alias("entity"), "currency", "n_regionkey"),
            "n_regionkey",
        )
        .where(F.col("focal_id") != F.col("entity"))
        .drop("n_regionkey")
    )
    return rates.withColumnRenamed("focal_id", "entity").join(pairs, "entity").select(
        "focal_id", "entity", "currency", "obs_date", F.col("base_rate").alias("price")
    )


def hourly_panel(spark: SparkSession, root: str) -> DataFrame:
    """(entity, obs_hour, price): event values averaged per hour and event type."""
    return (
        table(spark, root, "events")
        .groupBy(
            F.col("event_type").alias("entity"),
            F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).alias("obs_hour"),
        )
        .agg(F.avg("value").alias("price"))
    )


def registry(spark: SparkSession, root: str) -> DataFrame:
    """(focal_id): every nation plus one identifier that has no data at all."""
    known = table(spark, root, "nation").select(F.col("n_name").alias("focal_id"))
    absent = known.agg(F.lit("NATION_WITHOUT_DATA").alias("focal_id"))
    return known.unionByName(absent)


def masked_panel(spark: SparkSession, root: str) -> DataFrame:
    """Competitor panel with about a tenth of the cells hidden by a fixed calendar rule.

    ``truth`` keeps the hidden value so imputation error can be measured.
    """
    hidden = (F.dayofyear("obs_date") * 7 + F.length("entity")) % 10 == 0
    return competitor_panel(spark, root).select(
        "entity",
        "obs_date",
        F.when(~hidden, F.col("price")).alias("price"),
        F.col("price").alias("truth"),
    )
