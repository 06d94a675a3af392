"""Telemetry twin for thermostat-controlled equipment, as PySpark DataFrame functions."""

from coldloop.config import FEATURES, TwinConfig

__all__ = ["FEATURES", "TwinConfig"]
