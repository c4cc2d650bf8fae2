"""Cell tables: one row per value, with the file it came from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isospread.functions.physics import null_if_nan
from isospread.operators.discovery import keep_variables

CELLS_SCHEMA = (
    "path STRING, var STRING, time TIMESTAMP_NTZ, lev DOUBLE, lat DOUBLE, lon DOUBLE, "
    "value DOUBLE"
)
#: The partition column of a grouped layout, and how many groups it has.
GROUP = "file_group"
FILE_GROUPS = 256
#: What ends the run's name in a file's name.
RUN_END = ".cam."


def file_group(path: Column) -> Column:
    """The group of a file, by the name of its run: files of one run lie together, so that a few
    members are found in a few groups."""
    name = F.substring_index(path, "/", -1)
    return F.pmod(F.crc32(F.substring_index(name, RUN_END, 1)), F.lit(FILE_GROUPS)).cast("int")


def write_cells(cells: DataFrame, path: str) -> None:
    """Write cells by variable and file group, in order of their files and times.

    Adaptive execution splits large groups among tasks. Within a file of the table a row group
    covers a short range of paths and times, which its statistics tell a reader.
    """
    keys = ["var", GROUP]
    order = [*keys, "path", *(c for c in ("time",) if c in cells.columns)]
    (
        cells.withColumn(GROUP, file_group(F.col("path")))
        .hint("rebalance", *(F.col(c) for c in keys))
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_cells(
    spark: SparkSession, paths: str | list[str], variables: Iterable[str], grouped: bool = False
) -> DataFrame:
    """Scan Parquet cells of the wanted variables.

    The schema is declared, so ``var`` may be a stored column or a partition folder; either
    way the filter prunes row groups or folders. ``grouped`` says that the table was written by
    ``write_cells``, and keeps its group column, by which ``cells_of_files`` prunes. NaN becomes
    NULL here, once.
    """
    schema = f"{CELLS_SCHEMA}, {GROUP} INT" if grouped else CELLS_SCHEMA
    cells = spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
    return keep_variables(cells, variables).withColumn("value", null_if_nan(cells["value"]))


def cells_of_files(cells: DataFrame, files: DataFrame) -> DataFrame:
    """Cells from which those of other files are left out as far as the scan can tell.

    Of a grouped table only the groups of the given files are listed and read, and of these only
    row groups that reach into the range of the files' paths: both become literals of the scan.
    What remains of other files goes in the join by path. ``files`` has a ``path`` and should be
    settled; at most ``FILE_GROUPS`` numbers and two paths reach the driver. A table without
    groups is returned as it is.
    """
    if GROUP not in cells.columns:
        return cells
    group = file_group(F.col("path"))
    wanted = files.agg(F.collect_set(group).alias("groups"), F.min("path"), F.max("path")).head()
    if not wanted.groups:
        return cells.where(F.lit(False)).drop(GROUP)
    inside = F.col(GROUP).isin(*sorted(wanted.groups)) & F.col("path").between(*wanted[1:])
    return cells.where(inside).drop(GROUP)
