"""The day twin over a stream of readings.

Each micro-batch runs the batch operators on its new rows plus what earlier batches left
behind: per asset the opening rows of the current date, the rows they borrow and the last
few rows, with their positions. That is all later rows can depend on, so it stays bounded per asset, and a
crowded asset is trimmed in parallel before its rows meet.

A batch may bring rows out of order: with an ``allowance`` rows wait until the newest timestamp
seen of their asset is that much later, and are then taken in order. A row that comes even later than that,
not newer than what its asset has already processed, cannot be placed any more; it goes to a
table of rejected rows. Rows still waiting when a stream ends are processed by ``flush``, whose
results are provisional: the next batch takes them back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import READINGS_SCHEMA, TwinConfig
from coldloop.operators import days as D
from coldloop.operators.layout import measure
from coldloop.operators.scorers import ThermalScorer
from coldloop.plans.twin import controlled, forecast, reach_of

# Rows kept between batches: a reading, its date, its position and where its date begins.
RETAINED_SCHEMA = T.StructType(READINGS_SCHEMA.fields + [
    T.StructField("d", T.DateType()),
    T.StructField("pos", T.LongType()),
    T.StructField("day_first", T.LongType()),
])
WAITING_SCHEMA = T.StructType(READINGS_SCHEMA.fields + [T.StructField("d", T.DateType())])
REJECTED_SCHEMA = T.StructType(WAITING_SCHEMA.fields + [T.StructField("batch", T.StringType())])
OUTPUT_COLUMNS = ("asset_id", "d", "k", "timestamp", "t_int_pred", "t_int_opt", "etat_opt",
                  "pente_chauffe", "pente_froid")


@dataclass
class StreamingTwin:
    """``foreachBatch`` handler; state and results live in tables below ``path``.

    A batch reads the state of the batch before it and overwrites its own result folder
    and state slot, so a batch that is run again gives the same tables.
    """

    spark: SparkSession
    path: str
    cfg: TwinConfig = field(default_factory=TwinConfig)
    thermal: ThermalScorer | None = None
    allowance: dt.timedelta = dt.timedelta(0)
    last: int = -1

    def __post_init__(self) -> None:
        self.cfg = replace(self.cfg, reach=max(self.cfg.reach, reach_of(self.thermal, self.cfg)))

    def _slot(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}-{batch_id % 2}"

    def _before(self, name: str, schema: T.StructType, batch_id: int) -> DataFrame:
        """What the batch before left behind."""
        if batch_id == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._slot(name, batch_id - 1))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.last < batch_id - 1 or self.last < 0:  # a restart may follow a flush
            self._withdraw()
        self._process(batch, batch_id, f"{batch_id}")
        self.last = batch_id

    def flush(self) -> None:
        """Processes what still waits, as if nothing more came; state stays as it is."""
        empty = self.spark.createDataFrame([], WAITING_SCHEMA)
        self._process(empty, self.last + 1, "waiting")

    def _withdraw(self) -> None:
        for name, schema in (("results", self._result_schema()), ("rejected", WAITING_SCHEMA)):
            (self.spark.createDataFrame([], schema)
             .write.mode("overwrite").parquet(f"{self.path}/{name}/batch=waiting"))

    def _result_schema(self) -> T.StructType:
        whole = {"asset_id": T.LongType(), "d": T.DateType(), "k": T.IntegerType(),
                 "timestamp": T.TimestampNTZType()}
        return T.StructType([T.StructField(c, whole.get(c, T.DoubleType()))
                             for c in OUTPUT_COLUMNS])

    def _process(self, batch: DataFrame, batch_id: int, label: str) -> None:
        cfg, final = self.cfg, label == "waiting"
        retained = self._before("state", RETAINED_SCHEMA, batch_id)
        waiting = self._before("waiting", WAITING_SCHEMA, batch_id)
        newest = retained.groupBy("asset_id").agg(
            F.max(F.struct("timestamp", "reading_id")).alias("newest"),
            F.max("pos").alias("last_known"))
        stamp = F.struct("timestamp", "reading_id")
        arrived = (
            batch.select(*WAITING_SCHEMA.names).unionByName(waiting)
            .join(newest, "asset_id", "left")
            .withColumn("late", F.coalesce(stamp <= F.col("newest"), F.lit(False)))
            .drop("newest", "last_known")
        ).persist()
        (arrived.where("late").select(*WAITING_SCHEMA.names)
         .write.mode("overwrite").parquet(f"{self.path}/rejected/batch={label}"))
        on_time = arrived.where(~F.col("late")).drop("late")
        if self.allowance and not final:
            seen = arrived.select("asset_id", "timestamp").unionByName(
                retained.select("asset_id", "timestamp")).groupBy("asset_id").agg(
                    F.max("timestamp").alias("seen"))
            on_time = on_time.join(seen, "asset_id")
            settled = F.col("timestamp") <= F.col("seen") - F.lit(self.allowance)
            held, on_time = (on_time.where(~settled).drop("seen"),
                             on_time.where(settled).drop("seen"))
        else:
            held = on_time.limit(0)
        if not final:
            held.write.mode("overwrite").parquet(self._slot("waiting", batch_id))
        on_time = on_time.persist()
        salts = measure(on_time).day_salts

        # Positions of the new rows continue each asset's count.
        counted = D.day_index(on_time).join(newest.drop("newest"), "asset_id", "left")
        base = F.coalesce(F.col("last_known") + 1, F.lit(0))
        new_days = counted.select(
            *D.KEY, (F.col("first_pos") + base).alias("first_new"),
            (F.col("last_pos") + base).alias("last_new"))
        old_days = retained.groupBy(*D.KEY).agg(
            F.min("day_first").alias("day_first"), F.max("pos").alias("last_old"))
        days = new_days.join(old_days, list(D.KEY), "full").select(
            *D.KEY, F.coalesce("day_first", "first_new").alias("first_pos"),
            F.coalesce("last_new", "last_old").alias("last_pos"), "first_new")

        fresh = self._trimmed(on_time, new_days, salts)
        rows = (
            retained.select(*READINGS_SCHEMA.names, "d", "pos").withColumn("fresh", F.lit(False))
            .unionByName(fresh.withColumn("fresh", F.lit(True)))
            .join(days.select(*D.KEY, "first_pos"), list(D.KEY))
        ).persist()
        frames = self._frames(rows, days)
        scored = controlled(forecast(frames, cfg, self.thermal), cfg).where("fresh")
        (scored.select(*OUTPUT_COLUMNS)
         .write.mode("overwrite").parquet(f"{self.path}/results/batch={label}"))
        if not final:
            self._keep(rows).write.mode("overwrite").parquet(self._slot("state", batch_id))
        for used in (rows, on_time, arrived):
            used.unpersist()

    def _trimmed(self, on_time: DataFrame, new_days: DataFrame, salts: int) -> DataFrame:
        """New rows that can matter: each date's first and last ones, with positions."""
        cfg = self.cfg
        heads = (
            D.end_rows(on_time, cfg.head_rows, salts=salts)
            .join(new_days, list(D.KEY))
            .withColumn("pos", F.col("first_new") + F.col("rank") - 1)
        )
        tails = (
            D.end_rows(on_time, cfg.context_rows, newest=True, salts=salts)
            .join(new_days, list(D.KEY))
            .withColumn("pos", F.col("last_new") - F.col("rank") + 1)
            .where(F.col("pos") >= F.col("first_new") + cfg.head_rows)
        )
        return heads.unionByName(tails).select(*READINGS_SCHEMA.names, "d", "pos")

    def _frames(self, rows: DataFrame, days: DataFrame) -> D.Frames:
        """Day frames for the dates that received rows, from positioned rows."""
        cfg = self.cfg
        touched = days.where(F.col("first_new").isNotNull())
        heads = (
            rows.join(touched.select(*D.KEY), list(D.KEY), "left_semi")
            .withColumn("rank", F.col("pos") - F.col("first_pos") + 1)
            .where(F.col("rank") <= cfg.head_rows).drop("pos", "first_pos")
        )
        last = days.select(*D.KEY, "last_pos")
        tails = (
            rows.join(last, list(D.KEY))
            .withColumn("rank", F.col("last_pos") - F.col("pos") + 1)
            .where(F.col("rank") <= cfg.context_rows).drop("pos", "first_pos", "last_pos")
        )
        sources = D.borrowed_days(days, cfg.context_rows).join(
            touched.select(*D.KEY), list(D.KEY), "left_semi")
        return D.assemble(heads, tails, days.select(*D.KEY, "first_pos", "last_pos"),
                          sources, cfg)

    def _keep(self, rows: DataFrame) -> DataFrame:
        """Each asset's current date up to its slice's end, what that borrows, and the last rows."""
        cfg = self.cfg
        asset = Window.partitionBy("asset_id")
        from_current = F.col("pos") - F.max("first_pos").over(asset)
        from_newest = F.max("pos").over(asset) - F.col("pos")
        return (
            rows.withColumns({"from_current": from_current, "from_newest": from_newest})
            .where(F.col("from_current").between(-cfg.context_rows, cfg.head_rows - 1)
                   | (F.col("from_newest") < cfg.context_rows))
            .withColumnRenamed("first_pos", "day_first")
            .select(*RETAINED_SCHEMA.names)
        )

    def results(self) -> DataFrame:
        return self.spark.read.schema(self._result_schema()).parquet(f"{self.path}/results")

    def rejected(self) -> DataFrame:
        """Rows that came too late, with the batch that brought them."""
        return self.spark.read.schema(REJECTED_SCHEMA).parquet(f"{self.path}/rejected")


def run_available(stream: DataFrame, twin: StreamingTwin) -> DataFrame:
    """Processes everything the source has now and returns all results so far."""
    query = (
        stream.writeStream.foreachBatch(twin)
        .option("checkpointLocation", f"{twin.path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    twin.flush()
    return twin.results()
