"""File catalogues: ``path, var, fname`` rows, one per stored file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isospread import registry
from isospread.operators.discovery import keep_extension, keep_variables
from isospread.sources.listing import FolderListing

CATALOG_SCHEMA = "path STRING, var STRING, fname STRING"


def list_files(spark: SparkSession, root: str, variables: Iterable[str]) -> DataFrame:
    """List ``root/<var>/`` for the given variables; file contents are never read.

    The file's folder is its variable.
    """
    folders = [f"{root.rstrip('/')}/{var}" for var in variables]
    # Match the reader's path spelling (file:/x, file:///x or /x) to what was asked for.
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.nc*")
        .load(folders)
        .select(F.regexp_replace("path", "^file:/*", "/").alias("path"))
    )
    parts = F.split("path", "/")
    return listing.select(
        "path",
        F.element_at(parts, -2).alias("var"),
        F.element_at(parts, -1).alias("fname"),
    )


def list_folders(spark: SparkSession, root: str, variables: Iterable[str]) -> DataFrame:
    """The same listing by one task for each variable's folder, however many files it holds.

    For large archives on a local or mounted path, or a store that PyArrow knows by its URI.
    ``list_files`` reaches any store that Spark's readers do, at a task for each large file.
    """
    spark.dataSource.register(FolderListing)
    return (
        spark.read.format(FolderListing.name())
        .option("root", root)
        .option("variables", ",".join(variables))
        .option("contains", ".nc")
        .load()
    )


def scan_for_discovery(
    catalog: DataFrame, variable: str = registry.EXEMPLAR_VARIABLE
) -> DataFrame:
    """Files of the exemplar variable; members without such files are never found."""
    return keep_extension(keep_variables(catalog, [variable]))


def scan_by_variable(catalog: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Files of the requested variables, listed once for all members."""
    return keep_extension(keep_variables(catalog, variables))


def catalog_of_cells(cells: DataFrame) -> DataFrame:
    """The catalogue of a table of cells: its distinct source files."""
    return (
        cells.select("path", "var")
        .distinct()
        .withColumn("fname", F.element_at(F.split("path", "/"), -1))
    )
