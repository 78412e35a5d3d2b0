"""A ledger made from order tables: one posting per order line.

Customers stand for properties, regions for organisations, nations for stores.
Returned lines are expenses; line number 7 flips the sign, so that every
category holds both signs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schema import AMOUNT_TYPE, LEDGER_SCHEMA


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def properties(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: what a posting says about its property.

    Sizes of the joined sides are left to Spark, which knows them: nation and
    region are broadcast while they are below its threshold, not by decree.
    """
    day = F.col("o_orderdate").cast("date")
    leases = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(day).cast("string").alias("lease_start"),
            F.max(day).cast("string").alias("lease_end"),
        )
    )
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(leases, "c_custkey")
        .select(
            "c_custkey",
            F.col("c_name").alias("property_id"),
            F.when(F.col("c_custkey") % 50 == 0, F.lit(""))
            .otherwise(F.col("c_mktsegment"))
            .alias("house_type"),
            "lease_start",
            "lease_end",
            F.col("r_name").alias("org"),
            F.col("n_name").alias("shop"),
        )
    )


def postings(spark: SparkSession, folder: str, properties: DataFrame) -> DataFrame:
    """One row per order line.

    Properties go to orders first, so that lines, the largest table, are shuffled
    once. Given a stored ``properties`` table both joins read their two sides
    straight from shuffles, which lets Spark split a hot customer or order.
    """
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        .join(properties, "c_custkey")
        .drop("c_custkey")
    )
    returned = F.col("l_returnflag") == "R"
    flipped = F.col("l_linenumber") == 7
    price = F.col("l_extendedprice")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("category"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.when(returned != flipped, -price).otherwise(price).cast(AMOUNT_TYPE).alias("amount"),
    )
    return (
        lines.join(orders, "o_orderkey")
        .withColumn("date", F.make_date("year", "month", F.lit(1)))
        .select(*LEDGER_SCHEMA.names)
    )
