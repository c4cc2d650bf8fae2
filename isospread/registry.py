"""What the library knows about each ensemble and output frequency."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Ensemble(NamedTuple):
    """How one ensemble stores and names its files.

    ``pairing`` says how split historical/scenario runs are glued together:
    ``by_number`` over all cases, ``by_forcing`` within each forcing, or ``None``.
    """

    name: str
    base_path: str
    name_filter: str
    split_left: str
    split_right: str
    pairing: str | None = None
    drop_case_tokens: tuple[str, ...] = ()
    file_tokens: tuple[str, ...] = ()
    keep_file_tokens: bool = False


# They must equal the published archive layout and run names.
ENSEMBLES = (
    Ensemble(
        "CESM2-LE",
        "/glade/campaign/cgd/cesm/CESM2-LE/timeseries/atm/proc/tseries/",
        "",
        "f09_g17.",
        ".cam.",
    ),
    Ensemble(
        "CESM2-SF",
        "/glade/campaign/cesm/collections/CESM2-SF/timeseries/atm/proc/tseries/",
        "",
        "f09_g17.",
        ".cam.",
        pairing="by_forcing",
    ),
    Ensemble(
        "CESM1-LE",
        "/glade/campaign/cesm/collections/cesmLE/CESM-CAM5-BGC-LE/atm/proc/tseries/",
        "C5CNBDRD",
        "b.e11.",
        ".cam.",
        pairing="by_number",
        drop_case_tokens=("OIC",),
        file_tokens=("OIC", "xaer", "xbmb", "xghg", "xlulc"),
        keep_file_tokens=False,
    ),
    Ensemble(
        "CESM1-SF",
        "/glade/campaign/cesm/collections/cesmLE/CESM-CAM5-BGC-LE/atm/proc/tseries/",
        "TRLENS_RCP85",
        "b.e11.",
        ".cam.",
        drop_case_tokens=("xlulc",),
    ),
)
PAIRED_FORCINGS = ("AAER", "BMB", "EE", "GHG")
UNPAIRED_FORCING = "xAER"
SKIPPED_NUMBER_PREFIX = "1"
CASE_DELIMITER = "&&"
EXEMPLAR_VARIABLE = "T"
MERGE_MODES = {"month_1": "no_conflicts", "day_1": "override"}
FREQUENCY_FOLDERS = {
    ("CESM1-LE", "month_1"): "monthly",
    ("CESM1-SF", "month_1"): "monthly",
}


def resolve_ensemble(ensemble: str | Ensemble) -> Ensemble:
    """Look an ensemble up by name, whatever its case; user-made ones pass through."""
    if isinstance(ensemble, Ensemble):
        return ensemble
    known = {e.name: e for e in ENSEMBLES}
    if ensemble.upper() not in known:
        raise ValueError(f"unsupported ensemble {ensemble!r}; choose from {sorted(known)}")
    return known[ensemble.upper()]


def merge_mode(data_freq: str) -> str:
    """Merge rule for a frequency, keyed on the name the user gave."""
    if data_freq not in MERGE_MODES:
        raise ValueError(f"no merge mode for {data_freq!r}; choose from {sorted(MERGE_MODES)}")
    return MERGE_MODES[data_freq]


def frequency_folder(ensemble: str | Ensemble, data_freq: str) -> str:
    """Directory that holds a frequency, which differs between ensembles."""
    return FREQUENCY_FOLDERS.get((resolve_ensemble(ensemble).name, data_freq), data_freq)


def data_path(ensemble: str | Ensemble, data_freq: str) -> str:
    ens = resolve_ensemble(ensemble)
    return f"{ens.base_path}{frequency_folder(ens, data_freq)}/"


def ensemble_registry(spark: SparkSession) -> DataFrame:
    """The registry as a table, one row per ensemble."""
    rows = [
        (e.name, e.base_path, e.name_filter, e.split_left, e.split_right,
         list(e.file_tokens), e.keep_file_tokens)
        for e in ENSEMBLES
    ]
    return spark.createDataFrame(
        rows,
        "ensemble STRING, base_path STRING, name_filter STRING, split_left STRING, "
        "split_right STRING, tokens ARRAY<STRING>, tokens_include BOOLEAN",
    )


def frequency_folder_column(ensemble: Column, data_freq: Column) -> Column:
    """Column form of :func:`frequency_folder`."""
    folder = data_freq
    for (name, freq), alias in FREQUENCY_FOLDERS.items():
        folder = F.when((ensemble == name) & (data_freq == freq), F.lit(alias)).otherwise(folder)
    return folder


def resolve_paths(files: DataFrame) -> DataFrame:
    """Add ``path`` to rows of ``(ensemble, data_freq, var, fname)``.

    The registry has a fixed handful of rows, so it is always broadcast. A name that is not
    registered raises when the row is computed.
    """
    registry = ensemble_registry(files.sparkSession).select("ensemble", "base_path")
    base = F.when(
        F.col("base_path").isNull(),
        F.raise_error(F.concat(F.lit("unsupported ensemble: "), F.col("ensemble"))),
    ).otherwise(F.col("base_path"))
    folder = frequency_folder_column(F.col("ensemble"), F.col("data_freq"))
    path = F.concat(base, folder, F.lit("/"), F.col("var"), F.lit("/"), F.col("fname"))
    return (
        files.join(F.broadcast(registry), "ensemble", "left")
        .withColumn("path", path)
        .drop("base_path")
    )
