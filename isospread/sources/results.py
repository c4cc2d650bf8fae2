"""Saved results: one partition folder per member, or one combined table.

A set of members that is saved again and again is kept by runs and a manifest. Each run writes its
members into a folder of its own; a manifest, with one row for each member, names the run whose
files count. Only once a run's files are complete is the next version of the manifest written, and
only then are runs removed that it no longer names. A run that fails anywhere leaves what was saved
before as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from isospread.sources.storage import broadcast_if_small, settle

MEMBER = "ensemble_member"
RUN = "run"
MANIFEST = "_manifest"


def write_members(df: DataFrame, path: str, order: Sequence[str] = ("time",)) -> None:
    """Write each member under its own folder; other members' folders stay as they are.

    Rows are rebalanced by member: adaptive execution gives a large member several files of
    about the advisory size and lets small members share a task. Within a task rows are sorted
    by member and ``order``, so a task has one file open at a time.
    """
    keys = [MEMBER, *(c for c in order if c in df.columns)]
    (
        df.hint("rebalance", F.col(MEMBER))
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MEMBER)
        .parquet(path)
    )


def read_members(
    spark: SparkSession, path: str, schema: StructType, member: str | None = None
) -> DataFrame:
    """Read saved members, or only one. The declared schema keeps ``001`` a string."""
    df = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return df if member is None else df.filter(df[MEMBER] == member)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the shared store, or none if there is no such folder."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifest's complete versions, in order."""
    names = _folders(spark, f"{path}/{MANIFEST}")
    done = [n for n in names if "_SUCCESS" in _folders(spark, f"{path}/{MANIFEST}/{n}")]
    return sorted(int(n.removeprefix("version-")) for n in done if n.startswith("version-"))


def _version_path(path: str, version: int) -> str:
    return f"{path}/{MANIFEST}/version-{version:08d}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Each saved member with the run whose files count, or None where nothing was saved."""
    found = _versions(spark, path)
    if not found:
        return None
    return spark.read.schema(f"{MEMBER} STRING, {RUN} STRING").parquet(_version_path(path, found[-1]))


def commit_members(df: DataFrame, members: DataFrame, path: str) -> None:
    """Save ``df`` in place of everything saved before for the named ``members``.

    Other members stay as they are; a named member without rows has nothing afterwards. Readers see
    either the manifest of before or the new one. One writer at a time.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    write_members(df, f"{path}/{RUN}={run}")
    written = (
        spark.read.schema(StructType([StructField(MEMBER, StringType())]))
        .parquet(f"{path}/{RUN}={run}")
        .distinct()
        .withColumn(RUN, F.lit(run))
    )
    versions = _versions(spark, path)
    before = read_manifest(spark, path)
    if before is not None:
        named = broadcast_if_small(settle(members.select(MEMBER).distinct()))
        written = written.unionByName(before.join(named, MEMBER, "left_anti"))
    written.write.mode("overwrite").parquet(_version_path(path, versions[-1] + 1 if versions else 1))
    # from here on the new version counts; what it doesn't name is only space
    now = read_manifest(spark, path)
    live = {f"{RUN}={r[0]}" for r in now.select(RUN).distinct().collect()}
    for name in _folders(spark, path):
        if name.startswith(f"{RUN}=") and name not in live:
            _remove(spark, f"{path}/{name}")
    for version in versions:
        _remove(spark, _version_path(path, version))


def read_committed(
    spark: SparkSession, path: str, schema: StructType, member: str | None = None
) -> DataFrame:
    """Read what the manifest names: each member from the run that last saved it."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], schema)
    if member is not None:
        manifest = manifest.where(F.col(MEMBER) == member)
    runs = [r[0] for r in manifest.select(RUN).distinct().collect()]  # a name for each run in use
    if not runs:
        return spark.createDataFrame([], schema)
    with_run = StructType([*schema.fields, StructField(RUN, StringType())])
    df = (
        spark.read.schema(with_run)
        .option("basePath", path)
        .parquet(*(f"{path}/{RUN}={run}" for run in runs))
    )
    if member is not None:
        df = df.where(F.col(MEMBER) == member)
    return df.join(broadcast_if_small(manifest), [MEMBER, RUN], "left_semi").select(*schema.fieldNames())


def write_combined(df: DataFrame, path: str) -> None:
    """Write all members as one table."""
    df.write.mode("overwrite").parquet(path)
