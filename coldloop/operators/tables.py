"""Result tables as shown to a user: projected, rounded, sorted, paged, or as JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import OPTIMISATION_COLUMNS, RAW_COLUMNS, SLOPE_COLUMNS
from coldloop.functions.calendar import date_label, timestamp_text
from coldloop.functions.numeric import half_even

PAGE_SIZE = 20


def optimisation_rows(twin: DataFrame) -> DataFrame:
    """The columns the result table stores, with the timestamp as text."""
    return twin.withColumn("timestamp", timestamp_text(F.col("timestamp"))).select(
        "asset_id", *OPTIMISATION_COLUMNS, "d")


def rounded(df: DataFrame) -> DataFrame:
    """Every floating-point column to 2 digits, slopes to 4, halves to even."""
    fractional = (T.DoubleType, T.FloatType)
    return df.select(*(
        half_even(F.col(f.name), 4 if f.name in SLOPE_COLUMNS else 2).alias(f.name)
        if isinstance(f.dataType, fractional) else F.col(f.name)
        for f in df.schema.fields))


def newest_first(df: DataFrame) -> DataFrame:
    """Newest timestamp first; the other columns settle equal timestamps."""
    rest = [c for c in df.columns if c != "timestamp"]
    return df.orderBy(F.col("timestamp").desc(), *rest)


def page(df: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page (from 0) of the newest-first order."""
    return newest_first(df).offset(number * size).limit(size)


def page_before(df: DataFrame, timestamp: str, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows ``timestamp`` in the newest-first order.

    A filter on the key, so the depth of the page costs nothing; rows that share the last shown
    timestamp belong to the page before.
    """
    return newest_first(df.where(F.col("timestamp") < F.lit(timestamp))).limit(size)


def simulation_table(sliced: DataFrame) -> DataFrame:
    """The raw columns of each day's slice, rounded."""
    return rounded(
        sliced.withColumn("timestamp", timestamp_text(F.col("timestamp")))
        .select("asset_id", "d", "k", *RAW_COLUMNS))


# JSON defaults to milliseconds; records keep the full timestamp.
RECORD_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def to_records(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.to_json(F.struct("*"), RECORD_OPTIONS).alias("record"))


def from_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    parsed = records.select(F.from_json("record", schema, RECORD_OPTIONS).alias("row"))
    return parsed.select("row.*")


def day_labels(days: DataFrame) -> DataFrame:
    """Date label and the bounds of the day's time axis."""
    opening = F.col("d").cast("timestamp_ntz")
    return days.select(
        "asset_id", "d", date_label(F.col("d")).alias("label"),
        timestamp_text(opening).alias("axis_start"),
        timestamp_text(opening + F.expr("interval 1 day")).alias("axis_end"))
