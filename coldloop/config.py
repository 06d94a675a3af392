"""Constants and schemas shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Model input order, raw table columns and result-table columns.
FEATURES = (
    "T_ext", "T_int", "Etat_Compresseur", "T_int_lag_1",
    "day_sin", "day_cos", "hour_sin", "hour_cos",
)
RAW_COLUMNS = (
    "timestamp", "T_ext", "T_int", "Etat_Compresseur", "Puissance_Elec_kW",
    "day_sin", "day_cos", "hour_sin", "hour_cos",
)
OPTIMISATION_COLUMNS = (
    "timestamp", "t_int_opt", "etat_opt", "pwr_opt", "pente_chauffe", "pente_froid",
)
SLOPE_COLUMNS = ("pente_chauffe", "pente_froid")


@dataclass(frozen=True)
class TwinConfig:
    """Parameters of the twin; the defaults are the published constants."""

    lookback: int = 12
    setpoint: float = 7.0
    band_high: float = 0.5
    band_low: float = 0.3
    rows_per_day: int = 144
    slope_memory: int = 10
    default_heating: float = 0.04
    default_cooling: float = -0.12
    minutes_per_row: int = 10
    #: Earlier readings a scorer looks back on, where that is more than the lookback.
    reach: int = 0

    @property
    def switch_on_above(self) -> float:
        return self.setpoint + self.band_high

    @property
    def switch_off_below(self) -> float:
        return self.setpoint - self.band_low

    @property
    def context_rows(self) -> int:
        """Earlier readings a day needs: the lookback (or what a scorer looks back on, if
        that is more), and one more for the lag feature."""
        return max(self.lookback, self.reach) + 1

    @property
    def head_rows(self) -> int:
        """Rows at the start of a date that can belong to its slice or precede it."""
        return self.lookback + self.rows_per_day


READINGS_SCHEMA = T.StructType([
    T.StructField("asset_id", T.LongType()),
    T.StructField("reading_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("T_ext", T.DoubleType()),
    T.StructField("T_int", T.DoubleType()),
    T.StructField("Etat_Compresseur", T.DoubleType()),
    T.StructField("Puissance_Elec_kW", T.DoubleType()),
])

OPTIMISATION_SCHEMA = T.StructType([
    T.StructField("asset_id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("t_int_opt", T.DoubleType()),
    T.StructField("etat_opt", T.DoubleType()),
    T.StructField("pwr_opt", T.DoubleType()),
    T.StructField("pente_chauffe", T.DoubleType()),
    T.StructField("pente_froid", T.DoubleType()),
    T.StructField("d", T.DateType()),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("mae", T.StringType()),
    T.StructField("rmse", T.StringType()),
])
