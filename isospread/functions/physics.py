"""Physical formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
STEFAN_BOLTZMANN = 5.67e-8
REFERENCE_PRESSURE_PA = 100000.0
STANDARD_LEVELS_HPA = (1000, 925, 850, 700, 500, 400, 300, 250, 200, 150, 100)
TBRT_ATTRS = {"long_name": "brightness temperature from FLNT", "units": "K"}
PLEV_ATTRS = {"long_name": "pressure", "units": "hPa"}


def null_if_nan(value: Column) -> Column:
    """NULL is the only missing value in the library."""
    return F.nullif(value, F.lit(float("nan")).cast("double"))


def brightness_temperature(flux: Column) -> Column:
    """Temperature (K) of a black body emitting ``flux`` (W/m2); NULL for a negative flux."""
    return null_if_nan(F.pow(flux / F.lit(STEFAN_BOLTZMANN), F.lit(0.25)))


def hybrid_pressure(
    hyam: Column, hybm: Column, ps: Column, p0: float = REFERENCE_PRESSURE_PA
) -> Column:
    """Pressure (Pa) on a hybrid level."""
    return hyam * F.lit(float(p0)) + hybm * ps


def hpa_to_pa(level: Column) -> Column:
    return level * F.lit(100.0)
