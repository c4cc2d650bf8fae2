"""Names and folders of saved results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXTENSION = ".nc"
TESTING_SUFFIX = "_TESTINGMODE"
NO_TIMESTR = "NONE"


def save_name(data_freq: str, field: str) -> str:
    return f"{data_freq}_{field}"


def case_list_name(ensemble: str) -> str:
    return f"casenames_{ensemble}.txt"


def ensemble_folder(save_path: str, ensemble: str) -> str:
    return f"{save_path.rstrip('/')}/{ensemble}/"


def members_folder(save_path: str, ensemble: str) -> str:
    return ensemble_folder(save_path, ensemble) + "INDIVIDUAL-FILES/"


def _time_part(timestr: Column) -> Column:
    return F.when(timestr == NO_TIMESTR, F.lit("")).otherwise(timestr)


def _suffix(testing: Column) -> Column:
    return F.concat(F.when(testing, F.lit(TESTING_SUFFIX)).otherwise(F.lit("")), F.lit(EXTENSION))


def member_name(
    ensemble: Column, member: Column, save: Column, timestr: Column, testing: Column
) -> Column:
    """File name of one member's result."""
    stem = F.concat_ws("_", ensemble, member, save, _time_part(timestr))
    return F.concat(stem, _suffix(testing))


def combined_name(
    ensemble: Column, save: Column, n_members: Column, timestr: Column, testing: Column
) -> Column:
    """File name of the combined result."""
    count = F.concat(n_members.cast("string"), F.lit("members"))
    stem = F.concat_ws("_", ensemble, save, count, _time_part(timestr))
    return F.concat(stem, _suffix(testing))


def dataset_name(*parts: str, timestr: str | None, testing: bool) -> str:
    """Folder name of a saved table, from the same parts as the file names."""
    stem = "_".join([*parts, timestr or ""])
    return stem + (TESTING_SUFFIX if testing else "")
