"""The day twin of one asset, reading by reading, with a state that does not grow.

The state is what later readings depend on: the asset's position, where its date begins, the last
few temperatures and states, the slopes in memory and where the controller stands. Sums are taken
in whole units as in the batch operators, so a stream and a batch give the same bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd

from coldloop.config import TwinConfig
from coldloop.functions.numeric import TEMPERATURE_DIGITS

SCALE = 10.0 ** TEMPERATURE_DIGITS
#: Readings as whole numbers: microseconds and days since 1970.
READING_COLUMNS = ("reading_id", "micros", "day", "T_ext", "T_int", "Etat_Compresseur",
                   "Puissance_Elec_kW")
TWIN_COLUMNS = ("day", "k", "micros", "t_int_pred", "t_int_opt", "etat_opt", "pente_chauffe",
                "pente_froid")


def units_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole units and which of them are known."""
    scaled = np.rint(values * SCALE)
    known = np.abs(scaled) < 2.0 ** 63
    return np.where(known, scaled, 0.0).astype(np.int64), known


@dataclass(frozen=True)
class MeanForecast:
    """Mean of the previous ``steps`` known temperatures, as ``lookback_mean`` gives it."""

    steps: int = 12

    def __call__(self, temperatures: np.ndarray) -> np.ndarray:
        """A forecast for every reading from those before it; NaN without any."""
        units, known = units_of(temperatures)
        at = np.arange(len(units))
        low = np.maximum(at - self.steps, 0)
        sums, counts = (np.concatenate([[0], np.cumsum(x)]) for x in (units, known))
        n = counts[at] - counts[low]
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = (sums[at] - sums[low]).astype(np.float64) / n
        return np.where(n > 0, np.rint(mean) / SCALE, np.nan)


@dataclass
class Side:
    """The slopes of one compressor state: the latest ones, and the last mean of them."""

    mean: float
    memory: list[int | None] = field(default_factory=list)

    def add(self, slope: int | None, cfg: TwinConfig) -> None:
        self.memory = [*self.memory, slope][-cfg.slope_memory:]
        known = [x for x in self.memory if x is not None]
        if known:
            self.mean = float(sum(known)) / (len(known) * SCALE)


@dataclass
class AssetState:
    """Where one asset stands. ``newest`` is the last processed stamp, ``seen`` the newest that
    ever came."""

    position: int = -1
    newest: tuple[int, int] | None = None
    seen: int | None = None
    day: int | None = None
    day_first: int = 0
    temperatures: list[float] = field(default_factory=list)
    states: list[float] = field(default_factory=list)
    heating: Side | None = None
    cooling: Side | None = None
    before: float = float("nan")
    temperature: float = float("nan")
    state: float = float("nan")

    def advance(self, rows: pd.DataFrame, cfg: TwinConfig, forecast: MeanForecast) -> pd.DataFrame:
        """Takes readings in time order and returns the twin's rows for those in a day's slice."""
        context = len(self.temperatures)
        inside = np.concatenate([self.temperatures, rows["T_int"].to_numpy(np.float64)])
        states = np.concatenate([self.states, rows["Etat_Compresseur"].to_numpy(np.float64)])
        predicted = forecast(inside)
        days, micros = rows["day"].to_numpy(), rows["micros"].to_numpy()
        starts = np.flatnonzero(np.diff(days, prepend=days[0] - 1))
        found = []
        for start, stop in zip(starts, [*starts[1:], len(days)]):
            if self.day is None or days[start] != self.day:
                self.day, self.day_first = int(days[start]), self.position + 1 + int(start)
            opening = max(self.day_first, cfg.lookback)
            first = max(start, opening - self.position - 1)
            for i in range(first, min(stop, opening + cfg.rows_per_day - self.position - 1)):
                k, at = self.position + 1 + i - opening, context + i
                if k == 0:
                    self._open(inside[at - 1], states[at - 1], cfg)
                found.append((self.day, int(k), int(micros[i]),
                              *self._step(predicted[at], states[at], cfg)))
        self.position += len(rows)
        keep = max(cfg.context_rows, forecast.steps)
        self.temperatures, self.states = inside[-keep:].tolist(), states[-keep:].tolist()
        last = rows.iloc[-1]
        self.newest = (int(last["micros"]), int(last["reading_id"]))
        return pd.DataFrame(found, columns=TWIN_COLUMNS)

    def _open(self, temperature: float, state: float, cfg: TwinConfig) -> None:
        self.heating, self.cooling = Side(cfg.default_heating), Side(cfg.default_cooling)
        self.before = self.temperature = temperature
        self.state = state

    def _step(self, predicted: float, recorded: float, cfg: TwinConfig) -> Iterator[float]:
        (now, was), (known, knew) = units_of(np.array([predicted, self.before]))
        slope = int(now) - int(was) if known and knew else None
        (self.heating if recorded == 0 else self.cooling).add(slope, cfg)
        if self.temperature > cfg.switch_on_above:
            self.state = 1.0
        elif self.temperature < cfg.switch_off_below:
            self.state = 0.0
        yield from (predicted, self.temperature, self.state, self.heating.mean, self.cooling.mean)
        self.before = predicted
        self.temperature += self.cooling.mean if self.state == 1 else self.heating.mean


#: An ``AssetState`` as one row of plain values.
STATE_SCHEMA = (
    "position long, newest_micros long, newest_id long, seen long, day long, day_first long, "
    "temperatures array<double>, states array<double>, heating_mean double, "
    "heating_memory array<long>, cooling_mean double, cooling_memory array<long>, before double, "
    "temperature double, state double")


def packed(state: AssetState) -> tuple:
    sides = [(s.mean, list(s.memory)) if s else (None, []) for s in (state.heating, state.cooling)]
    return (state.position, *(state.newest or (None, None)), state.seen, state.day,
            state.day_first, state.temperatures, state.states, *sides[0], *sides[1],
            state.before, state.temperature, state.state)


def unpacked(row: Sequence | None) -> AssetState:
    if row is None:
        return AssetState()
    (position, micros, reading, seen, day, day_first, temperatures, states, heating, heated,
     cooling, cooled, before, temperature, state) = row

    def listed(values: Sequence) -> list[float]:
        return [float("nan") if x is None else x for x in values]

    def side(mean: float | None, memory: Sequence) -> Side | None:
        return None if mean is None else Side(mean, [None if x is None else int(x) for x in memory])

    before, temperature, state = listed((before, temperature, state))
    return AssetState(
        position, None if micros is None else (micros, reading), seen, day, day_first,
        listed(temperatures), listed(states), side(heating, heated), side(cooling, cooled),
        before, temperature, state)
