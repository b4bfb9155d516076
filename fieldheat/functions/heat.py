"""Degree-hour and lapse-rate formulas, in Fahrenheit and feet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAPSE_F_PER_1000_FT = 3.5


def degree_hours(temp: Column, base: Column, upper: Column) -> Column:
    """Heat above the base in one hour, capped at the upper threshold.

    NULL temperature or base gives NULL; a NULL upper threshold means no cap. Written with
    conditions because least and greatest skip NULLs.
    """
    above_base = temp - base
    return (
        F.when(above_base < 0, F.lit(0.0))
        .when(temp > upper, upper - base)
        .otherwise(above_base)
    )


def lapse_shift(elev_dif: Column, rate: float = LAPSE_F_PER_1000_FT) -> Column:
    """Degrees to add to a station's reading for a field that lies elev_dif feet higher."""
    return -elev_dif / 1000 * rate
