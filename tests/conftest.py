from __future__ import annotations

import datetime as dt

import pytest

from coldloop.config import READINGS_SCHEMA
from coldloop.session import local_session
from coldloop.sources.readings import normalise


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_readings(spark):
    """Readings from (asset, timestamp, T_int, state[, power]) tuples, ids in given order."""
    def make(rows):
        full = [
            (asset, i, ts, 15.0 + i % 7, temperature, state,
             extra[0] if extra else (30.0 if state == 1 else 1.0))
            for i, (asset, ts, temperature, state, *extra) in enumerate(rows)]
        return normalise(spark.createDataFrame(full, READINGS_SCHEMA))
    return make


@pytest.fixture
def day_of():
    """``n`` timestamps from midnight of a date, ten minutes apart unless told otherwise."""
    def stamps(day: dt.date, n: int, step: float = 10.0):
        midnight = dt.datetime.combine(day, dt.time.min)
        return [midnight + dt.timedelta(minutes=step * i) for i in range(n)]
    return stamps
