"""User functions on every member, and members side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isospread.functions.physics import TBRT_ATTRS, brightness_temperature
from isospread.operators.grids import GridCube
from isospread.sources.storage import broadcast_if_small, settle

MEMBER = "ensemble_member"


def require_member(df: DataFrame, where: str) -> DataFrame:
    """User functions must keep the member column."""
    if MEMBER not in df.columns:
        raise ValueError(f"{where} must keep the column {MEMBER!r}; got {df.columns}")
    return df


def apply_native(
    df: DataFrame, function: Callable[..., DataFrame], *args: object, **kwargs: object
) -> DataFrame:
    """Apply a DataFrame function to all members at once."""
    result = df.transform(function, *args, **kwargs)
    return require_member(result, getattr(function, "__name__", "the function"))


def apply_blocks(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Apply a pandas function to Arrow batches of rows, without a shuffle.

    For code that works on any block of cells and cannot be written with columns.
    """
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return require_member(df.mapInPandas(each, schema), "the block function")


def apply_groups(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    within: Sequence[str],
) -> DataFrame:
    """Apply a pandas function to whole groups of one member, such as a cell's time series.

    A group must fit in a task, so a member is always divided by further keys; pass finer ones
    where groups are long. ``apply_blocks`` has no such bound.
    """
    if not within:
        raise ValueError("name keys that divide a member, e.g. ['lat', 'lon']")
    keys = [MEMBER, *within]
    return require_member(df.groupBy(*keys).applyInPandas(function, schema), "the group function")


def apply_group_batches(
    df: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
    within: Sequence[str],
    order: Sequence[str] = ("time",),
) -> DataFrame:
    """Apply a function to whole groups of one member, handed on in batches and in order.

    A group may be longer than a task's memory: the function gets an iterator of its batches, sorted
    by ``order``, and yields results as it goes. What it keeps between batches is its own affair.
    Rows are shuffled and sorted once.
    """
    if not within:
        raise ValueError("name keys that divide a member, e.g. ['lat', 'lon']")
    keys = [MEMBER, *within]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from function(batches)

    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return require_member(ordered.groupBy(*keys).applyInPandas(each, schema), "the group function")


def brightness(cube: DataFrame | GridCube) -> DataFrame:
    """The sample analysis: ``FLNT`` and the brightness temperature ``TBRT`` made from it.

    Of variables on several grids only the cells of ``FLNT``'s own are used.
    """
    if isinstance(cube, GridCube):
        cube = cube.select("FLNT")
    keys = [c for c in (MEMBER, "time", "lev", "lat", "lon") if c in cube.columns]
    return cube.select(
        *keys, "FLNT", brightness_temperature(F.col("FLNT")).alias("TBRT")
    ).withMetadata("TBRT", TBRT_ATTRS)


def identity(df: DataFrame) -> DataFrame:
    """Preprocessing that was skipped."""
    return df


def concat_members(members: Mapping[str, DataFrame]) -> DataFrame:
    """Stack separate member tables along ``ensemble_member``; missing variables become NULL."""
    labelled = [df.withColumn(MEMBER, F.lit(name)) for name, df in members.items()]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
    return whole.select(MEMBER, *(c for c in whole.columns if c != MEMBER))


#: Members whose presence one number holds.
WORD_BITS = 62


def concat_members_dense(cube: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Every member at every coordinate of any member, padded with NULL.

    Members are bit positions, and a coordinate holds the bitmap of those it has, which is combined
    before the shuffle: rows of the cube are neither shuffled nor gathered. The rows of the members
    that are missing are made from the bitmap. A cell given twice stays twice.
    """
    keys = [c for c in cube.columns if c not in (MEMBER, *variables)]
    numbered = settle(
        cube.select(MEMBER).distinct().select(
            MEMBER, (F.row_number().over(Window.orderBy(MEMBER)) - 1).alias("_bit")
        )
    )
    n = numbered.count()
    if not n:
        return cube.select(MEMBER, *keys, *variables)
    numbers = broadcast_if_small(numbered)
    words = range(-(-n // WORD_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_bit") % WORD_BITS).cast("int"))
    of_word = F.floor(F.col("_bit") / WORD_BITS)
    present = cube.join(numbers, MEMBER).groupBy(*keys).agg(
        *(F.bit_or(F.when(of_word == w, bit)).alias(f"_word{w}") for w in words)
    )
    bitmap = F.array(*(F.coalesce(F.col(f"_word{w}"), F.lit(0).cast("long")) for w in words))

    def absent(i: Column) -> Column:
        word = F.get(bitmap, F.floor(i / WORD_BITS).cast("int"))
        return F.getbit(word, (i % WORD_BITS).cast("int")) == 0

    missing = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), absent)
    rest = present.select(*keys, F.explode(missing).alias("_bit")).join(numbers, "_bit")
    empty = (F.lit(None).cast(cube.schema[v].dataType).alias(v) for v in variables)
    return cube.select(MEMBER, *keys, *variables).unionByName(rest.select(MEMBER, *keys, *empty))
