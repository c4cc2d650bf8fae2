"""Selecting and coarsening along members, time and space."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isospread.operators.grids import GridCube
from isospread.sources.storage import broadcast_if_small, settle

MEMBER = "ensemble_member"
Statistic = Callable[[Column], Column]


def first_n_members(df: DataFrame, n: int = 2, column: str = MEMBER) -> DataFrame:
    """Rows of the first ``n`` members in name order. At most ``n`` rows are broadcast."""
    first = df.select(column).distinct().orderBy(column).limit(n)
    return df.join(F.broadcast(first), column, "left_semi")


def time_cutoffs(df: DataFrame, n: int = 10, member: str = MEMBER) -> DataFrame:
    """Each member's ``n``-th distinct time, or its last: one row per member.

    Only distinct labels are ranked, and the rank limit is applied before their shuffle. A
    missing time is no label.
    """
    labels = df.select(member, "time").where(F.col("time").isNotNull()).distinct()
    ranked = labels.withColumn(
        "step", F.row_number().over(Window.partitionBy(member).orderBy("time"))
    )
    return ranked.filter(F.col("step") <= n).groupBy(member).agg(F.max("time").alias("cutoff"))


def first_n_timesteps(df: DataFrame, n: int = 10, member: str = MEMBER) -> DataFrame:
    """Rows at each member's first ``n`` distinct times, and rows without a time.

    The cutoffs are computed first, from the member and time columns alone, so that the main
    pass is a filter against a small table and does not shuffle the cells. The last cutoff of
    all members goes to the scan as a literal.
    """
    cutoffs = settle(time_cutoffs(df, n, member))
    # as text, so that a time without a zone never passes through the driver's
    last = cutoffs.agg(F.max("cutoff").cast("string")).head()[0]
    timeless = F.col("time").isNull()
    if last is not None:
        df = df.filter(timeless | (F.col("time") <= F.lit(last).cast(df.schema["time"].dataType)))
    return (
        df.join(broadcast_if_small(cutoffs), member, "left")
        .filter(timeless | (F.col("time") <= F.col("cutoff")))
        .select(*df.columns)
    )


def subset(df: DataFrame | GridCube, **ranges: tuple[Any, Any]) -> DataFrame | GridCube:
    """Rows whose coordinates lie in closed ranges: ``subset(df, time=(a, b), lat=(-30, 30))``.

    Bounds become literals of the column's own type, so that the comparison reaches the scan.
    Of variables on several grids each grid is limited along the coordinates that it has.
    """
    if isinstance(df, GridCube):
        for name, bounds in ranges.items():
            df = df.map(partial(subset, **{name: bounds}), [name])
        return df
    for name, bounds in ranges.items():
        kind = df.schema[name].dataType
        texts = (b.isoformat(sep=" ") if isinstance(b, datetime) else b for b in bounds)
        low, high = (F.lit(b).cast(kind) for b in texts)
        df = df.filter(F.col(name).between(low, high))
    return df


def start_of(unit: str, time: Column) -> Column:
    """Start of the year, month, day or hour, without passing through the session time zone."""
    day = F.to_date(time)
    if unit == "hour":
        midnight = day.cast("timestamp_ntz")
        return midnight + F.make_dt_interval(hours=F.hour(time))
    if unit in ("year", "month"):
        day = F.trunc(day, unit)
    elif unit != "day":
        raise ValueError(f"unit must be year, month, day or hour, not {unit!r}")
    return day.cast("timestamp_ntz")


def _resample(
    df: DataFrame, keys: list[Column], variables: Sequence[str], statistic: Statistic
) -> DataFrame:
    return df.groupBy(*keys).agg(*(statistic(F.col(v)).alias(v) for v in variables))


def resample_time(
    df: DataFrame, unit: str, variables: Sequence[str], statistic: Statistic
) -> DataFrame:
    """One value per member, cell and calendar unit."""
    others = [c for c in df.columns if c not in ("time", *variables)]
    keys = [*map(F.col, others), start_of(unit, F.col("time")).alias("time")]
    return _resample(df, keys, variables, statistic).select(*df.columns)


def resample_space(
    df: DataFrame, steps: dict[str, float], variables: Sequence[str], statistic: Statistic
) -> DataFrame:
    """One value per coarse cell; ``steps`` gives the cell size of each coarsened coordinate."""
    others = [c for c in df.columns if c not in (*steps, *variables)]
    coarse = [
        (F.floor(F.col(c) / F.lit(float(step))) * F.lit(float(step))).cast("double").alias(c)
        for c, step in steps.items()
    ]
    return _resample(df, [*map(F.col, others), *coarse], variables, statistic).select(*df.columns)
