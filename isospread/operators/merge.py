"""From cells of many files to one cube with a column per variable.

Each merge is a single aggregation on the coordinates. Its aggregates keep fixed-size numeric
state, so rows are combined before the shuffle and no group is ever gathered in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isospread.functions.physics import null_if_nan
from isospread.sources.storage import broadcast_if_small, settle

MEMBER = "ensemble_member"
MEMBER_NUMBER = "member_number"
FILE_ORDER = "file_order"
ENDS = {"min": F.min, "max": F.max}


def coordinates(
    df: DataFrame, without: Sequence[str] = ("var", "path", "value", FILE_ORDER)
) -> list[str]:
    """The key columns of a table of cells."""
    return [c for c in df.columns if c not in without]


def rising_numbers(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a text column with a number that rises in their order.

    A range-partitioned sort with partition-wise increasing ids: no single task sees all
    values, and a task that is run again numbers its sorted values the same way. Between two
    executions the numbers may differ, so settle the result.
    """
    ordered = df.select(column).distinct().orderBy(column)
    return ordered.withColumn(name, F.monotonically_increasing_id())


def number_files(case_files: DataFrame, ordered: bool) -> tuple[DataFrame, DataFrame]:
    """Numbers in place of long names, so that no cell carries its path or member name.

    Returns the files as ``(path, member_number)``, with ``file_order`` if they are to be
    ``ordered``, and the members' names. Both come from one settled table and agree.
    """
    files = case_files.withColumnRenamed("casename", MEMBER)
    files = files.join(rising_numbers(files, MEMBER, MEMBER_NUMBER), MEMBER)
    if ordered:
        files = files.join(rising_numbers(files, "path", FILE_ORDER), "path")
    files = settle(files)
    return files.drop(MEMBER), files.select(MEMBER_NUMBER, MEMBER).distinct()


def number_cells(cells: DataFrame, files: DataFrame) -> DataFrame:
    """Cells with their member's number and their file's place in path order.

    ``files`` holds files, not cells. Pass it settled: it is counted, and broadcast when it is
    small, so that the cells are not shuffled.
    """
    return cells.join(broadcast_if_small(files), "path").drop("path")


def name_members(df: DataFrame, names: DataFrame | None) -> DataFrame:
    """Put names in place of member numbers; ``None`` means that there are none to replace."""
    if names is None:
        return df
    others = [c for c in df.columns if c != MEMBER_NUMBER]
    return df.join(broadcast_if_small(names), MEMBER_NUMBER).select(MEMBER, *others)


def label_members(cells: DataFrame, case_files: DataFrame) -> DataFrame:
    """Cells with the name of the member their file belongs to; pass ``case_files`` settled."""
    members = broadcast_if_small(case_files.withColumnRenamed("casename", MEMBER))
    columns = [c for c in cells.columns if c != MEMBER]
    return cells.join(members, "path").select(MEMBER, *columns)


def file_intervals(cells: DataFrame, of: Sequence[str] = ("var",)) -> DataFrame:
    """The first and last time of each file: a catalogue of intervals, one row for each path and
    the columns in ``of``. Settle it; files without times are left out."""
    return (
        cells.where(F.col("time").isNotNull())
        .groupBy(*of, "path")
        .agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    )


def overlapping_pieces(intervals: DataFrame, of: Sequence[str] = ("var",)) -> DataFrame:
    """Files that begin before or when an earlier one of the same member and variable ends.

    Works on the catalogue of intervals alone and reads no cell: in order of their first times a
    file overlaps if it begins no later than the latest end of all before it, a running maximum.
    Returns the catalogue's columns with that end as ``covered_until``. Of files with the same
    first time the first by path is the earlier one.
    """
    before = Window.partitionBy(*of).orderBy("first_time", "path").rowsBetween(Window.unboundedPreceding, -1)
    found = intervals.withColumn("covered_until", F.max("last_time").over(before))
    return found.where(F.col("first_time") <= F.col("covered_until"))


def concat_time_pieces(pieces: Sequence[DataFrame], check: bool = True) -> DataFrame:
    """Put pieces of the same variables one after another in time.

    With ``check``, a cell found twice raises; without it this is a plain union.
    """
    whole = reduce(lambda a, b: a.unionByName(b), pieces)
    if not check:
        return whole
    keys = coordinates(whole, ("path", "value"))
    once = F.when(F.col("n") == 1, F.col("value")).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("cell found twice:"), *_shown(keys)))
    )
    return (
        whole.groupBy(*keys)
        .agg(F.max("value").alias("value"), F.count("*").alias("n"))
        .select(*keys, once.alias("value"))
    )


def _shown(keys: Sequence[str]) -> list[Column]:
    return [F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]


def _value_of(var: str) -> Column:
    return F.when(F.col("var") == var, null_if_nan(F.col("value")))


def merge_no_conflicts(
    cells: DataFrame, variables: Sequence[str], names: DataFrame | None = None
) -> DataFrame:
    """One column per variable; values of the same cell must agree or be missing.

    A conflict in any of the variables raises, whichever of them are used later. The result is
    unique on its coordinates. ``names`` replaces member numbers once the cells are grouped.
    """
    extremes = [
        pick(_value_of(v)).alias(f"{v}_{end}")
        for v in variables
        for end, pick in ENDS.items()
    ]
    grouped = name_members(cells.groupBy(*coordinates(cells)).agg(*extremes), names)
    keys = [c for c in grouped.columns if c not in {f"{v}_{end}" for v in variables for end in ENDS}]

    def agrees(v: str) -> Column:
        differ = F.col(f"{v}_min") != F.col(f"{v}_max")
        message = F.concat_ws(" ", F.lit(f"conflicting values of {v}:"), *_shown(keys))
        return F.when(differ, F.raise_error(message).cast("boolean")).otherwise(True)

    # a filter, since a column that is not used would be pruned with its check
    for v in variables:
        grouped = grouped.filter(agrees(v))
    return grouped.select(*keys, *(F.col(f"{v}_max").alias(v) for v in variables))


def find_conflicts(cells: DataFrame) -> DataFrame:
    """Cells whose sources disagree, with the smallest and largest value."""
    keys = coordinates(cells, ("path", "value", FILE_ORDER))
    value = null_if_nan(F.col("value"))
    return (
        cells.groupBy(*keys)
        .agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
        .filter("min_value <> max_value")
    )


def merge_override(
    cells: DataFrame, variables: Sequence[str], names: DataFrame | None = None
) -> DataFrame:
    """One column per variable; the first file in path order wins, even with a missing value.

    Paths are replaced by their order number first, unless the cells carry it already: the
    aggregation state is then numeric and the shuffle carries no path.
    """
    if FILE_ORDER not in cells.columns:
        order = settle(rising_numbers(cells, "path", FILE_ORDER))
        cells = number_cells(cells, order)

    def first(v: str) -> Column:
        rank = F.when(F.col("var") == v, F.col(FILE_ORDER))
        return F.min_by(null_if_nan(F.col("value")), rank).alias(v)

    return name_members(
        cells.groupBy(*coordinates(cells)).agg(*map(first, variables)), names
    )


def merge(
    cells: DataFrame, variables: Sequence[str], mode: str, names: DataFrame | None = None
) -> DataFrame:
    if mode == "no_conflicts":
        return merge_no_conflicts(cells, variables, names)
    if mode == "override":
        return merge_override(cells, variables, names)
    raise ValueError(f"unknown merge mode {mode!r}")
