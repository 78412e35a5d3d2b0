"""Small tables beside a stored ledger that answer what needs no single posting.

``_totals`` is a ledger of sums: one row for each month, organisation, store, house type,
category and sign of the amount, with the postings' sum. Whatever adds up amounts by sign
over these columns gets the same figures from it. ``_properties`` numbers the property
keys, in their order. ``_active`` has, for each year and category, the numbers of the
properties with a posting as bitmaps; the bitmaps of several are joined by OR, so that
properties are counted exactly without their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.filters import Rollup

TOTALS, PROPERTIES, ACTIVE = "_totals", "_properties", "_active"
KEYS = ["org", "shop", "house_type", "category"]
_SUM = T.DecimalType(28, 2)
_SCHEMAS = {
    TOTALS: "year int, month int, org string, shop string, house_type string, category string, amount decimal(28,2)",
    PROPERTIES: "property_id string, number long",
    ACTIVE: "year int, category string, bucket long, bitmap binary",
}


def totals(ledger: DataFrame) -> DataFrame:
    """The ledger of sums. Amounts of 0 are a row of their own, so that keys that occur
    with them alone occur here."""
    keys = ["year", "month", *KEYS]
    return (
        ledger.groupBy(*keys, F.signum("amount").alias("sign"))
        .agg(F.sum("amount").cast(_SUM).alias("amount"))
        .select(*keys, "amount")
    )


def numbered(ledger: DataFrame) -> DataFrame:
    """Property keys with a number each that rises with them; numbers have gaps."""
    return (
        ledger.select("property_id")
        .distinct()
        .repartitionByRange("property_id")
        .sortWithinPartitions("property_id")
        .withColumn("number", F.monotonically_increasing_id())
    )


def active(ledger: DataFrame, properties: DataFrame) -> DataFrame:
    """Bitmaps of the properties of each year and category, in buckets of numbers."""
    return (
        ledger.select("year", "category", "property_id")
        .distinct()
        .join(properties, "property_id")
        .groupBy("year", "category", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    )


def write_rollup(ledger: DataFrame, path: str) -> None:
    """Store the three tables beside the ledger at ``path``, which is read three times."""
    spark = ledger.sparkSession
    totals(ledger).hint("rebalance").write.parquet(f"{path}/{TOTALS}")
    numbered(ledger).write.parquet(f"{path}/{PROPERTIES}")
    active(ledger, _read(spark, path, PROPERTIES)).hint("rebalance").write.parquet(f"{path}/{ACTIVE}")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{path}/{name}")


def read_rollup(spark: SparkSession, path: str) -> Rollup | None:
    """The tables beside a ledger, if they were stored whole."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{ACTIVE}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    return Rollup(*(_read(spark, path, name) for name in (TOTALS, PROPERTIES, ACTIVE)))
