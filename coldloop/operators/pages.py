"""Pages of the newest-first order at the cost of a page, however deep it lies.

``PageIndex`` answers any page by its number. The table is written once, parted by ranges of the
order, with one count per part; a page reads and sorts the parts that hold its ranks only.
``Cursor`` goes on from the last row shown without any index.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from coldloop.operators.tables import PAGE_SIZE, newest_first


def newest_order(df: DataFrame) -> list[Column]:
    """The order of ``newest_first``: equal timestamps are settled by the other columns."""
    return [F.col("timestamp").desc(), *(F.col(c) for c in df.columns if c != "timestamp")]


class PageIndex:
    """Pages of a table below ``path``.

    Range bounds are over all columns, so any number of rows may share a timestamp; rows equal in
    every column share a part. The driver holds one count per part.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        counts = sorted(spark.read.parquet(f"{path}/counts").collect(), key=lambda row: row[0])
        self.column = spark.read.parquet(f"{path}/counts").columns[0]
        ends = list(accumulate(n for _, n in counts))
        self.parts = [(part, end - n, end) for (part, n), end in zip(counts, ends)]
        self.rows = ends[-1] if ends else 0

    @classmethod
    def build(cls, df: DataFrame, path: str, parts: int | None = None) -> PageIndex:
        """Writes the ranges of ``df`` and their counts; without ``parts`` Spark sizes them."""
        spark, column = df.sparkSession, "part"
        while column in df.columns:
            column += "_"
        ranges = [parts] if parts else []
        (df.repartitionByRange(*ranges, *newest_order(df))
         .withColumn(column, F.spark_partition_id())
         .write.partitionBy(column).parquet(f"{path}/rows"))
        written = spark.read.schema(f"`{column}` int").parquet(f"{path}/rows")
        written.groupBy(column).agg(F.count("*").alias("n")).coalesce(1).write.parquet(
            f"{path}/counts")
        df.limit(0).write.parquet(f"{path}/schema")
        return cls(spark, path)

    def pages(self, size: int = PAGE_SIZE) -> int:
        return math.ceil(self.rows / size)

    def page(self, number: int, size: int = PAGE_SIZE) -> DataFrame:
        """One page, from 0; none of its rows where it lies behind the last one."""
        first = number * size
        wanted = [p for p in self.parts if p[1] < first + size and p[2] > first]
        schema = self.spark.read.parquet(f"{self.path}/schema").schema.add(self.column, "integer")
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        rows = stored.where(F.col(self.column).isin([p[0] for p in wanted])).drop(self.column)
        skipped = first - wanted[0][1] if wanted else 0
        return newest_first(rows).offset(skipped).limit(size)


@dataclass(frozen=True)
class Cursor:
    """The last row shown, and how many rows equal to it have been shown."""

    row: Row
    seen: int

    @classmethod
    def after(cls, shown: list[Row], before: Cursor | None = None) -> Cursor | None:
        """Where to go on after ``shown``, the page that followed ``before``."""
        if not shown:
            return before
        last = _values(shown[-1])
        same = sum(_values(row) == last for row in shown)
        if before is not None and _values(before.row) == last:
            same += before.seen
        return cls(shown[-1], same)


def _values(row: Row) -> list:
    return ["NaN" if isinstance(v, float) and math.isnan(v) else v for v in row]


def following(df: DataFrame, cursor: Cursor | None, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows ``cursor`` (None: the first one).

    A filter on the order's key, so earlier rows are not sorted. Rows that share the last shown
    timestamp, or repeat the last row, come on the page that they belong to.
    """
    if cursor is None:
        return newest_first(df).limit(size)
    rest = [c for c in df.columns if c != "timestamp"]

    def shown(name: str) -> Column:
        return F.lit(cursor.row[name]).cast(df.schema[name].dataType).alias(name)

    time, at = F.col("timestamp"), shown("timestamp")
    later = F.struct(*rest) >= F.struct(*map(shown, rest)) if rest else F.lit(True)
    if cursor.row["timestamp"] is None:
        kept = time.isNull() & later
    else:
        # The first part alone can reach the scan; rows without a time come last.
        kept = (time.isNull() | (time <= at)) & (F.coalesce(time < at, F.lit(True)) | later)
    return newest_first(df.where(kept)).offset(cursor.seen).limit(size)
