"""The day twin over a stream, with state by asset in Spark's state store.

A batch costs what its own assets cost: their states are read and written, no others. Rows may come
out of order: an asset's rows wait until its own newest timestamp is ``allowance`` later, so a
reading from the future holds up nobody else's rows and rejects none of them. Rows that come even
later, not newer than what their asset has processed, go to the rejected rows. With ``idle``, rows
of an asset that has gone silent are processed once the newest time of the fleet is that much
later, by a timer. Without an asset or a timestamp a reading has no place and was dropped before.

Results go to a folder per batch, which a repeated batch overwrites; state and progress are the
query's checkpoint. ``flush`` reads what still waits out of the state store and writes it as
provisional results, which the next batch takes back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from coldloop.config import READINGS_SCHEMA, TwinConfig
from coldloop.functions.calendar import EPOCH, epoch_micros
from coldloop.streaming.controller import OUTPUT_COLUMNS
from coldloop.streaming.online import (
    READING_COLUMNS, STATE_SCHEMA, TWIN_COLUMNS, AssetState, MeanForecast, packed, unpacked)

WAITING_SCHEMA = ("reading_id long, micros long, day long, T_ext double, T_int double, "
                  "Etat_Compresseur double, Puissance_Elec_kW double")
TWIN, LATE = "twin", "late"
#: Rows of both kinds; each has nulls in the other's columns.
OUT_SCHEMA = ("kind string, asset_id long, reading_id long, micros long, day long, k int, "
              "T_ext double, T_int double, Etat_Compresseur double, Puissance_Elec_kW double, "
              "t_int_pred double, t_int_opt double, etat_opt double, pente_chauffe double, "
              "pente_froid double")
OUT_COLUMNS = [f.split()[0] for f in OUT_SCHEMA.split(", ")]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PREFIX = "spark.sql.streaming.stateStore."


def numbers(readings: DataFrame) -> DataFrame:
    """Readings with time as whole numbers, which the state keeps."""
    return readings.select(
        "asset_id", "reading_id", epoch_micros(F.col("timestamp")).alias("micros"),
        F.unix_date(F.to_date("timestamp")).cast("long").alias("day"), *READING_COLUMNS[3:])


def moment(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH))


def shaped(rows: pd.DataFrame, kind: str, asset: int) -> pd.DataFrame:
    return rows.assign(kind=kind, asset_id=asset).reindex(columns=OUT_COLUMNS)


def taken(state: AssetState, rows: pd.DataFrame, until: int | None, cfg: TwinConfig,
          forecast: MeanForecast) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Processes the rows up to ``until`` (None: all) and returns the twin's rows and the rest."""
    rows = rows.sort_values(["micros", "reading_id"], kind="stable")
    settled = rows["micros"] <= until if until is not None else pd.Series(True, rows.index)
    now = rows[settled]
    return (state.advance(now, cfg, forecast) if len(now)
            else pd.DataFrame([], columns=TWIN_COLUMNS)), rows[~settled]


@dataclass
class TwinProcessor(StatefulProcessor):
    """One asset's readings of a batch, its state and the rows of it that wait."""

    cfg: TwinConfig
    forecast: MeanForecast
    allowance: int
    idle: int | None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.asset = handle.getValueState("asset", STATE_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame],
                        timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        state = unpacked(self.asset.get() if self.asset.exists() else None)
        arrived = pd.concat(list(rows))[list(READING_COLUMNS)]
        if state.newest is not None:
            micros, reading = state.newest
            late = (arrived["micros"] < micros) | (
                (arrived["micros"] == micros) & (arrived["reading_id"] <= reading))
            if late.any():
                yield shaped(arrived[late], LATE, key[0])
            arrived = arrived[~late]
        if len(arrived):
            newest = int(arrived["micros"].max())
            state.seen = newest if state.seen is None else max(state.seen, newest)
            held = self._held()
            rows = pd.concat([held, arrived]) if len(held) else arrived
            yield from self._advance(key, state, rows, state.seen - self.allowance)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if len(held):
            yield from self._advance(key, unpacked(self.asset.get()), held, None)

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.waiting.get()), columns=list(READING_COLUMNS))

    def _advance(self, key: tuple, state: AssetState, rows: pd.DataFrame,
                 until: int | None) -> Iterator[pd.DataFrame]:
        found, rest = taken(state, rows, until, self.cfg, self.forecast)
        self.asset.update(packed(state))
        if len(rest):
            self.waiting.put([tuple(r) for r in rest.astype(object).itertuples(index=False)])
        else:
            self.waiting.clear()
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if len(rest):
                self.handle.registerTimer((int(rest["micros"].max()) + self.idle) // 1000)
        if len(found):
            yield shaped(found, TWIN, key[0])

    def close(self) -> None:
        pass


@dataclass
class KeyedTwin:
    """The twin of a stream of readings; state and results live below ``path``."""

    spark: SparkSession
    path: str
    cfg: TwinConfig = field(default_factory=TwinConfig)
    forecast: MeanForecast = field(default_factory=MeanForecast)
    allowance: dt.timedelta = dt.timedelta(0)
    idle: dt.timedelta | None = None
    touched: bool = False

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Processes everything the source has now, batch by batch."""
        micro = dt.timedelta(microseconds=1)
        rows, mode = numbers(stream), "None"
        if self.idle is not None:
            # The clock is a column of its own, which the state operator does not get: Spark would
            # drop rows behind it, and here they are placed or rejected by asset.
            clock = rows.withColumn("clock", F.timestamp_micros("micros"))
            rows, mode = clock.withWatermark("clock", "0 seconds").drop("clock"), "EventTime"
        for name, value in (("providerClass", ROCKSDB),
                            ("rocksdb.changelogCheckpointing.enabled", "true")):
            self.spark.conf.set(PREFIX + name, value)
        out = rows.groupBy("asset_id").transformWithStateInPandas(
            TwinProcessor(self.cfg, self.forecast, self.allowance // micro,
                          None if self.idle is None else self.idle // micro),
            OUT_SCHEMA, "Append", mode)
        return (out.writeStream.foreachBatch(self._write)
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True).start())

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        self._save(batch, f"{batch_id}")
        self._save(batch.sparkSession.createDataFrame([], OUT_SCHEMA), "waiting")
        self.touched = True

    def _save(self, rows: DataFrame, label: str) -> None:
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{self.path}/out/batch={label}")

    def flush(self) -> None:
        """Processes what still waits, as if nothing more came; the state stays as it is."""
        if not self.touched:
            return

        def state(name: str) -> DataFrame:
            return (self.spark.read.format("statestore").option("path", self.checkpoint)
                    .option("stateVarName", name).load())
        waiting = state("waiting").select("key.asset_id", "list_element.*")
        known = state("asset").select("key.asset_id", F.struct("value.*").alias("state"))
        cfg, forecast = self.cfg, self.forecast

        def finish(rows: pd.DataFrame) -> pd.DataFrame:
            held = rows["state"].iloc[0]
            held = held.values() if isinstance(held, dict) else held
            found, _ = taken(unpacked(tuple(held)), rows[list(READING_COLUMNS)], None, cfg, forecast)
            return shaped(found, TWIN, int(rows["asset_id"].iloc[0]))

        self._save(waiting.join(known, "asset_id").groupBy("asset_id")
                   .applyInPandas(finish, OUT_SCHEMA), "waiting")

    def _out(self, kind: str) -> DataFrame:
        schema = T.StructType(T._parse_datatype_string(OUT_SCHEMA).fields
                              + [T.StructField("batch", T.StringType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/out")
        return rows.where(F.col("kind") == kind).withColumns({
            "timestamp": moment(F.col("micros")), "d": F.date_from_unix_date(F.col("day").cast("int"))})

    def results(self) -> DataFrame:
        return self._out(TWIN).select(*OUTPUT_COLUMNS)

    def rejected(self) -> DataFrame:
        """Rows that came too late, with the batch that brought them."""
        return self._out(LATE).select(*READINGS_SCHEMA.names, "d", "batch")


def run_available(stream: DataFrame, twin: KeyedTwin) -> DataFrame:
    """Processes everything the source has now and returns all results so far."""
    twin.start(stream).awaitTermination()
    twin.flush()
    return twin.results()
