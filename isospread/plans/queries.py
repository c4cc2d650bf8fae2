"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from isospread import registry
from isospread.functions import naming, physics, text
from isospread.operators import assign, axis, discovery, grids, members, merge, vertical
from isospread.plans import run
from isospread.plans.fixtures import fixture
from isospread.plans.options import RunOptions
from isospread.sources import case_list, catalog as catalogs, cells as cell_tables, results
from isospread.sources.storage import scratch_path, settle

Query = Callable[[SparkSession, str], DataFrame]

LE = "CESM1-LE"
SINGLE_FORCING = "CESM2-SF"
LEFT_OUT = "CESM1-SF"
VARIABLES = ["FLNT", "PS", "T"]
COLUMN = ["col_id"]
CELL_OPTIONS = RunOptions(LE, "month_1", ("FLNT", "T"))
CATALOG_OPTIONS = RunOptions(LE, "month_1", ("FLNT", "PS", "T"))

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c in columns else c for c in df.columns))


# Catalogues and file-name filters


@query
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.scan_for_discovery(fixture(spark, sf_dir, "fx_catalog"))


@query
def catalog_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.scan_by_variable(fixture(spark, sf_dir, "fx_catalog"), ["FLNT", "PS"])


@query
def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.catalog_counts(fixture(spark, sf_dir, "fx_catalog"), LE)


@query
def filter_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.keep_extension(fixture(spark, sf_dir, "fx_catalog"))


@query
def filter_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.keep_prefix(fixture(spark, sf_dir, "fx_catalog"))


@query
def filter_ensemble_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.keep_ensemble_token(fixture(spark, sf_dir, "fx_catalog"), LE)


@query
def filter_exclude_sf(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixture(spark, sf_dir, "fx_catalog_left_out")
    return discovery.pair_cases(discovery.case_names(files, LEFT_OUT), LEFT_OUT)


@query
def filter_token_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.keep_by_token_list(fixture(spark, sf_dir, "fx_catalog"), LE)


@query
def filter_timestr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.keep_timestr(fixture(spark, sf_dir, "fx_catalog"), "199503")


@query
def case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.case_names(fixture(spark, sf_dir, "fx_catalog"), LE)


@query
def case_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.case_numbers(case_names(spark, sf_dir))


# Members and their files


@query
def pair_cases_le(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run.discover_cases(fixture(spark, sf_dir, "fx_catalog"), CATALOG_OPTIONS)


@query
def pair_cases_sf(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = RunOptions(SINGLE_FORCING, "month_1", ("T",))
    return run.discover_cases(fixture(spark, sf_dir, "fx_catalog_forcing"), options)


@query
def pair_cases_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairing where the number of runs grows with the table."""
    return run.discover_cases(fixture(spark, sf_dir, "fx_catalog_runs"), CELL_OPTIONS)


@query
def pair_cases_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.pair_cases(case_names(spark, sf_dir), LE, match="exact")


@query
def case_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "casenames")
    case_list.write_case_list(pair_cases_le(spark, sf_dir), path)
    return case_list.read_case_list(spark, path)


@query
def resolve_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.resolve_paths(fixture(spark, sf_dir, "fx_requests"))


@query
def assign_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = fixture(spark, sf_dir, "fx_catalog")
    cases = settle(run.discover_cases(catalog, CATALOG_OPTIONS))
    return run.case_files_of(catalog, cases, CATALOG_OPTIONS)


@query
def assign_files_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of runs whose number grows with the table."""
    catalog = fixture(spark, sf_dir, "fx_catalog_runs")
    cases = settle(run.discover_cases(catalog, CELL_OPTIONS))
    return run.case_files_of(catalog, cases, CELL_OPTIONS)


@query
def assign_files_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = discovery.keep_extension(fixture(spark, sf_dir, "fx_catalog"))
    cases = settle(pair_cases_le(spark, sf_dir))
    return assign.assign_files(files, cases, match="exact", ensemble=LE)


@query
def files_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.files_per_case(assign_files(spark, sf_dir))


@query
def members_without_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = discovery.keep_extension(fixture(spark, sf_dir, "fx_catalog"))
    cases = settle(pair_cases_le(spark, sf_dir))
    return assign.members_without_files(cases, assign.assign_files(files, cases, "199503"))


# Cells and merges


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixture(spark, sf_dir, "fx_cells")
    return merge.label_members(cells, _case_files(spark, sf_dir))


def _case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = settle(catalogs.catalog_of_cells(fixture(spark, sf_dir, "fx_cells")))
    cases = settle(run.discover_cases(catalog, CELL_OPTIONS))
    return settle(run.case_files_of(catalog, cases, CELL_OPTIONS))


@query
def member_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)


@query
def member_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table grouped by file, of which only the members' groups are read."""
    path = scratch_path(spark, "cells")
    cell_tables.write_cells(fixture(spark, sf_dir, "fx_cells"), path)
    case_files = _case_files(spark, sf_dir)
    grouped = cell_tables.read_cells(spark, path, ["FLNT", "T"], grouped=True).drop("lev")
    return merge.label_members(cell_tables.cells_of_files(grouped, case_files), case_files)


@query
def member_sink_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved members after half of them were analysed again, with twice the flux."""
    path = scratch_path(spark, "committed")
    analysed = members.brightness(fixture(spark, sf_dir, "fx_cube"))
    results.commit_members(analysed, analysed, path)
    again = analysed.where(F.col("ensemble_member") < "l").withColumn("FLNT", F.col("FLNT") * 2)
    results.commit_members(again, again, path)
    return _rounded(results.read_committed(spark, path, analysed.schema), "TBRT")


@query
def overlapping_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each member and variable that overlap in time, by the catalogue of intervals."""
    of = [merge.MEMBER, "var"]
    cells = fixture(spark, sf_dir, "fx_cube_long")
    return merge.overlapping_pieces(settle(merge.file_intervals(cells, of)), of)


@query
def concat_time_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _labelled(spark, sf_dir).drop("path")
    early = F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz")
    return merge.concat_time_pieces([cells.filter(early), cells.filter(~early)])


@query
def merge_no_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_no_conflicts(fixture(spark, sf_dir, "fx_cube_long"), VARIABLES)


@query
def merge_conflict_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = (F.col("path") == "piece_b") & (F.col("lat") == 6)
    value = F.when(shifted, F.col("value") + 1).otherwise(F.col("value"))
    cells = fixture(spark, sf_dir, "fx_cube_long").withColumn("value", value)
    return merge.find_conflicts(cells)


@query
def merge_conflict_check_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on cells that carry their file's number in place of its path."""
    shifted = (F.col("path") == "piece_b") & (F.col("lat") == 6)
    value = F.when(shifted, F.col("value") + 1).otherwise(F.col("value"))
    order = F.when(F.col("path") == "piece_a", 0).otherwise(1).cast("long")
    cells = fixture(spark, sf_dir, "fx_cube_long").withColumn("value", value)
    return merge.find_conflicts(cells.withColumn(merge.FILE_ORDER, order).drop("path"))


@query
def merge_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_override(fixture(spark, sf_dir, "fx_cube_long"), VARIABLES)


def _grid_cube(spark: SparkSession, sf_dir: str) -> grids.GridCube:
    variables = ["FLNT", "PS", "T", "hyam", "hybm"]
    return grids.merge_grids(fixture(spark, sf_dir, "fx_grid_cells"), variables)


@query
def merge_mixed_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field with levels beside one without, each merged on its own grid."""
    return _grid_cube(spark, sf_dir).select("T", "PS")


@query
def brightness_mixed_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample analysis of a member that has variables with levels, too."""
    return _rounded(members.brightness(_grid_cube(spark, sf_dir)), "TBRT")


@query
def first_n_timesteps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis.first_n_timesteps(fixture(spark, sf_dir, "fx_cube"), 10)


@query
def first_n_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis.first_n_members(fixture(spark, sf_dir, "fx_cube"), 2)


@query
def subset_time_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = datetime(2024, 1, 5), datetime(2024, 1, 20)
    return axis.subset(fixture(spark, sf_dir, "fx_cube"), time=times, lat=(4.0, 20.0))


@query
def resample_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = fixture(spark, sf_dir, "fx_cube")
    return _rounded(axis.resample_time(cube, "day", ["FLNT"], F.mean), "FLNT")


@query
def resample_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = fixture(spark, sf_dir, "fx_cube")
    steps = {"lat": 4.0, "lon": 2.0}
    return _rounded(axis.resample_space(cube, steps, ["FLNT"], F.mean), "FLNT")


# User functions and physics


@query
def skip_preprocess_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole analysis whose preprocessing, which would empty the cube, is skipped."""
    options = RunOptions(LE, "month_1", ("FLNT",), skip_preprocess=True)

    def nothing(cube: DataFrame, kwargs: dict) -> DataFrame:
        return cube.limit(0)

    cells = fixture(spark, sf_dir, "fx_cells")
    case_files = _case_files(spark, sf_dir)
    return run.analyse_members(cells, case_files, options, nothing, None)


@query
def parse_kwargs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_kwargs")
    pairs = F.explode(text.parse_kwargs_column(F.col("s"))).alias("key", "value")
    return rows.select("event_id", pairs)


@query
def brightness_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(members.brightness(fixture(spark, sf_dir, "fx_cube")), "TBRT")


def _scaled(cube: DataFrame, kwargs: dict[str, str]) -> DataFrame:
    northern = axis.subset(cube, lat=(float(kwargs["SOUTH"]), 90.0))
    return northern.withColumn("FLNT", F.col("FLNT") * F.lit(float(kwargs["SCALE"])))


@query
def apply_per_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = fixture(spark, sf_dir, "fx_cube")
    kwargs = text.parse_kwargs("south&&8_scale&&2")
    scaled = members.apply_native(cube, _scaled, kwargs)
    return _rounded(members.apply_native(scaled, members.brightness), "TBRT")


def _block_brightness(block: pd.DataFrame) -> pd.DataFrame:
    flux = block["FLNT"].where(block["FLNT"] >= 0)
    return block.assign(TBRT=(flux / physics.STEFAN_BOLTZMANN) ** 0.25)


@query
def apply_per_member_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = fixture(spark, sf_dir, "fx_cube")
    schema = StructType([*cube.schema.fields, StructField("TBRT", DoubleType())])
    return _rounded(members.apply_blocks(cube, _block_brightness, schema), "TBRT")


def _below_maximum(series: pd.DataFrame) -> pd.DataFrame:
    return series.assign(FLNT=series["FLNT"] - series["FLNT"].max())


@query
def apply_groups_below_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell's time series of every member, as a pandas function sees it."""
    cube = fixture(spark, sf_dir, "fx_cube")
    return members.apply_groups(cube, _below_maximum, cube.schema, ["lat", "lon"])


def _running_mean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The mean of each value and the two before it; two rows are kept between batches."""
    before = None
    for batch in batches:
        joined = batch if before is None else pd.concat([before, batch])
        mean = joined["FLNT"].rolling(3, min_periods=1).mean()
        yield batch.assign(FLNT=mean.iloc[len(joined) - len(batch) :])
        before = joined.tail(2)


@query
def apply_running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell's time series of every member, batch by batch."""
    cube = fixture(spark, sf_dir, "fx_cube")
    found = members.apply_group_batches(cube, _running_mean, cube.schema, ["lat", "lon"])
    return _rounded(found, "FLNT")


@query
def pressure_from_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = fixture(spark, sf_dir, "fx_hybrid")
    placed = vertical.pressure_from_hybrid(
        nodes.select("col_id", "lev", "value"),
        settle(nodes.select("lev", "hyam", "hybm").distinct()),
        nodes.select("col_id", "ps").distinct(),
        COLUMN,
    )
    return _rounded(placed, "pressure")


@query
def interp_to_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = fixture(spark, sf_dir, "fx_hybrid")
    pressure = physics.hybrid_pressure(F.col("hyam"), F.col("hybm"), F.col("ps"))
    placed = nodes.withColumn("pressure", pressure)
    levels = vertical.interp_to_pressure(placed, COLUMN, "value")
    return _rounded(levels, "value")


@query
def remap_hybrid_to_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = fixture(spark, sf_dir, "fx_hybrid")
    levels = vertical.remap_hybrid_to_pressure(
        nodes.select("col_id", "lev", "value"),
        settle(nodes.select("lev", "hyam", "hybm").distinct()),
        nodes.select("col_id", "ps").distinct(),
        COLUMN,
        "value",
    )
    return _rounded(levels, "value")


@query
def remap_from_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with surface pressure and coefficients of the member itself."""
    return _rounded(vertical.remap_from_member(_grid_cube(spark, sf_dir), "T"), "T")


# Results


def _saved_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    analysed = members.brightness(fixture(spark, sf_dir, "fx_cube"))
    path = scratch_path(spark, "members")
    results.write_members(analysed, path)
    return results.read_members(spark, path, analysed.schema)


@query
def member_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_saved_members(spark, sf_dir), "TBRT")


@query
def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = settle(pair_cases_le(spark, sf_dir))
    parts = F.lit(LE), F.lit(naming.save_name("month_1", "tbrt"))
    count = found.select(F.count("*")).scalar()
    return found.select(
        "casename",
        naming.member_name(parts[0], F.col("casename"), parts[1], F.lit("NONE"), F.lit(False))
        .alias("member_file"),
        naming.member_name(parts[0], F.col("casename"), parts[1], F.lit("199503"), F.lit(True))
        .alias("test_file"),
        naming.combined_name(*parts, count, F.lit("NONE"), F.lit(False)).alias("combined_file"),
    )


@query
def concat_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = _saved_members(spark, sf_dir)
    path = scratch_path(spark, "combined")
    results.write_combined(saved, path)
    return _rounded(spark.read.schema(saved.schema).parquet(path), "TBRT")


@query
def concat_members_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members.concat_members_dense(fixture(spark, sf_dir, "fx_cube"), ["FLNT"])


@query
def ensemble_brightness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From cells and file names to every member's brightness temperature."""
    cells = fixture(spark, sf_dir, "fx_cells")
    options = RunOptions(LE, "month_1", ("FLNT",))
    case_files = _case_files(spark, sf_dir)
    analysed = run.analyse_members(cells, case_files, options, analyse=members.brightness)
    return _rounded(analysed, "TBRT")


@query
def run_ensemble_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run: find members, analyse, save each, read them again and combine."""
    cells = fixture(spark, sf_dir, "fx_cells")
    options = RunOptions(LE, "month_1", ("FLNT",), save_path=scratch_path(spark, "run"))
    catalog = settle(catalogs.catalog_of_cells(cells))
    done = run.run_ensemble(spark, catalog, cells, options)
    return _rounded(spark.read.schema(done.members.schema).parquet(done.combined_path), "TBRT")


@query
def ensemble_brightness_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the first two members and ten time steps, by the override rule."""
    cells = fixture(spark, sf_dir, "fx_cells")
    options = RunOptions(LE, "day_1", ("FLNT",), test_members=True, test_times=True)
    catalog = settle(catalogs.catalog_of_cells(cells))
    found = run.discover_cases(catalog, options)
    cases = settle(axis.first_n_members(found, column="casename"))
    case_files = settle(run.case_files_of(catalog, cases, options))
    analysed = run.analyse_members(cells, case_files, options, analyse=members.brightness)
    return _rounded(analysed, "TBRT")
