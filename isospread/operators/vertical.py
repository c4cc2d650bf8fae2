"""Hybrid model levels to pressure levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isospread.functions.physics import (
    PLEV_ATTRS,
    REFERENCE_PRESSURE_PA,
    STANDARD_LEVELS_HPA,
    hpa_to_pa,
    hybrid_pressure,
    null_if_nan,
)
from isospread.operators.grids import GridCube
from isospread.sources.storage import broadcast_if_small


def pressure_from_hybrid(
    cube: DataFrame,
    coefficients: DataFrame,
    surface_pressure: DataFrame,
    column: Sequence[str],
    lev: str = "lev",
    p0: float = REFERENCE_PRESSURE_PA,
) -> DataFrame:
    """Add ``pressure`` (Pa) to each cell from its level's coefficients and its column's ``ps``.

    The coefficient table has a row per level. Surface pressure is as large as a horizontal
    field and joins on the column's coordinates; adaptive execution splits a column that many
    cells share.
    """
    levels = broadcast_if_small(coefficients.select(lev, "hyam", "hybm"))
    surface = surface_pressure.select(*column, "ps")
    placed = cube.join(levels, lev).join(surface, list(column))
    pressure = hybrid_pressure(F.col("hyam"), F.col("hybm"), F.col("ps"), p0)
    return placed.select(*cube.columns, pressure.alias("pressure"))


def _interpolated(target: Column) -> Column:
    p, value = F.col("p0"), F.col("v0")
    run, rise = F.col("p1") - p, F.col("v1") - value
    between = value + (target - p) * rise / run
    return F.when(target == p, value).when(target > p, between)


def interp_to_pressure(
    nodes: DataFrame,
    column: Sequence[str],
    value: str,
    pressure: str = "pressure",
    levels_hpa: Sequence[float] = STANDARD_LEVELS_HPA,
) -> DataFrame:
    """Interpolate a field linearly in pressure: one row per column and target level.

    A level outside the column's range is NULL. Nodes with a missing value are ignored; of
    several nodes at one pressure the smallest value counts. Columns are shuffled and sorted
    once, and every target level is emitted by the segment that holds it, so there is no join
    with the levels. A column, as long as the model has levels, is sorted within one task.
    """
    keys = list(column)
    valid = null_if_nan(F.col(value)).isNotNull() & F.col(pressure).isNotNull()
    found = nodes.select(
        *keys,
        F.when(valid, F.col(pressure)).alias("p0"),
        F.when(valid, F.col(value)).alias("v0"),
    )

    upward = Window.partitionBy(*keys).orderBy(F.col("p0").asc_nulls_last(), "v0")
    segments = (
        found.withColumn("first", F.row_number().over(upward) == 1)
        .withColumn("below", F.lag("p0").over(upward))
        .filter(F.col("first") | ~F.equal_null("below", "p0"))
        .withColumn("p1", F.lead("p0").over(upward))
        .withColumn("v1", F.lead("v0").over(upward))
    )

    def belongs(level: Column) -> Column:
        target = hpa_to_pa(level)
        under = F.col("first") & (F.col("p0").isNull() | (target < F.col("p0")))
        inside = (target >= F.col("p0")) & (F.col("p1").isNull() | (target < F.col("p1")))
        return F.coalesce(under | inside, F.lit(False))

    levels = F.array(*(F.lit(float(level)) for level in levels_hpa))
    target = hpa_to_pa(F.col("plev"))
    return (
        segments.withColumn("plev", F.explode(F.filter(levels, belongs)))
        .select(*keys, "plev", _interpolated(target).alias(value))
        .withMetadata("plev", PLEV_ATTRS)
    )


def remap_hybrid_to_pressure(
    cube: DataFrame,
    coefficients: DataFrame,
    surface_pressure: DataFrame,
    column: Sequence[str],
    value: str,
    lev: str = "lev",
    p0: float = REFERENCE_PRESSURE_PA,
    levels_hpa: Sequence[float] = STANDARD_LEVELS_HPA,
) -> DataFrame:
    """Remap a merged field from hybrid levels to pressure levels; ``lev`` becomes ``plev``."""
    placed = pressure_from_hybrid(cube, coefficients, surface_pressure, column, lev, p0)
    return interp_to_pressure(placed, column, value, levels_hpa=levels_hpa)


def remap_from_member(
    cube: GridCube,
    value: str,
    lev: str = "lev",
    surface: str = "PS",
    coefficients: Sequence[str] = ("hyam", "hybm"),
    p0: float = REFERENCE_PRESSURE_PA,
    levels_hpa: Sequence[float] = STANDARD_LEVELS_HPA,
) -> DataFrame:
    """Remap a field to pressure levels with its own member's surface pressure and coefficients.

    ``surface`` has no levels, and ``coefficients`` have little else; both are aligned with the
    field inside the cube. The field and its surface pressure are shuffled by column once, and the
    interpolation works on those partitions. A column without surface pressure is NULL throughout.
    """
    together = cube.select(value, surface, *coefficients)
    column = [c for c in together.columns if c not in (lev, value, surface, *coefficients)]
    hyam, hybm = coefficients
    pressure = hybrid_pressure(F.col(hyam), F.col(hybm), F.col(surface), p0)
    placed = together.select(*column, lev, value, pressure.alias("pressure"))
    return interp_to_pressure(placed, column, value, levels_hpa=levels_hpa)
