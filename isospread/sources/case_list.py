"""Case lists: text with one case per line."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_case_list(cases: DataFrame, path: str) -> None:
    """Write the names in order. Adaptive execution leaves one part file for a short list."""
    cases.select("casename").orderBy("casename").write.mode("overwrite").text(path)


def read_case_list(spark: SparkSession, path: str) -> DataFrame:
    """Read whole lines, with or without a final newline; blank lines are skipped.

    A blank case would be contained in every path.
    """
    lines = spark.read.text(path).select(F.col("value").alias("casename"))
    return lines.filter(F.trim("casename") != "")


def case_list_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_case_list(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
