"""Readings: from a table, a database, or derived from the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.config import READINGS_SCHEMA
from coldloop.functions.calendar import cyclic_features, to_naive_timestamp
from coldloop.functions.numeric import finite_or_null

# Event types that count as a running compressor in the derived readings.
RUNNING_EVENTS = ("click", "purchase")


def normalise(raw: DataFrame) -> DataFrame:
    """Readings columns in fixed types, non-finite as null, plus the calendar date ``d``.

    Rows without an asset or a timestamp have no place in any time order, so they go.
    """
    typed = raw.withColumn("timestamp", to_naive_timestamp(F.col("timestamp")))
    columns = []
    for field in READINGS_SCHEMA.fields:
        col = F.col(field.name)
        if field.dataType.typeName() == "double":
            col = finite_or_null(col.cast("double"))
        columns.append(col.cast(field.dataType).alias(field.name))
    return (
        typed.select(*columns)
        .where(F.col("asset_id").isNotNull() & F.col("timestamp").isNotNull())
        .withColumn("d", F.to_date("timestamp"))
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return normalise(spark.table(name))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: str, upper: str, partitions: int, **options: str) -> DataFrame:
    """A database table, read in parallel ranges of one column."""
    reader = (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions)
    )
    return normalise(reader.load())


def from_events(events: DataFrame, assets: int | None = 2) -> DataFrame:
    """One reading per event. ``assets=None`` makes every user an asset of its own."""
    # Values have two decimals, so no product lies halfway; rint avoids decimal arithmetic.
    cents = F.rint(F.col("value") * 100).cast("bigint")
    running = F.col("event_type").isin(*RUNNING_EVENTS)
    asset = F.col("user_id") if assets is None else F.col("user_id") % assets
    return normalise(events.select(
        asset.alias("asset_id"),
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("timestamp"),
        ((1000 + cents % 2500).cast("double") / F.lit(100.0)).alias("T_ext"),
        ((550 + cents % 300).cast("double") / F.lit(100.0)).alias("T_int"),
        F.when(running, 1.0).otherwise(0.0).alias("Etat_Compresseur"),
        (F.when(running, 3000 + cents % 1500).otherwise(cents % 200).cast("double")
         / F.lit(100.0)).alias("Puissance_Elec_kW"),
    ))


def read_events(spark: SparkSession, sf_dir: str, assets: int | None = 2) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), assets)


def with_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(cyclic_features(F.col("timestamp")))
