"""One analysis, applied to every member."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isospread.operators import assign, axis, discovery, grids, members, merge
from isospread.operators.grids import GridCube
from isospread.plans.options import TEST_MEMBERS, TEST_TIMES, RunOptions
from isospread.sources import case_list, catalog as catalogs, cells as cell_tables, results
from isospread.sources.storage import broadcast_if_small, settle

log = logging.getLogger(__name__)

Preprocess = Callable[[DataFrame | GridCube, dict], DataFrame | GridCube]
Analyse = Callable[[DataFrame | GridCube], DataFrame]


class RunResult(NamedTuple):
    cases: DataFrame
    without_files: DataFrame | None = None
    members: DataFrame | None = None
    members_path: str | None = None
    combined_path: str | None = None


def discover_cases(catalog: DataFrame, options: RunOptions) -> DataFrame:
    """Distinct case names of the ensemble, split runs glued together.

    The names are settled, because pairing reads them twice and the catalogue can be long.
    """
    files = catalogs.scan_for_discovery(catalog)
    names = settle(discovery.case_names(files, options.ensemble))
    return discovery.pair_cases(names, options.ensemble, options.match)


def choose_cases(spark: SparkSession, catalog: DataFrame, options: RunOptions) -> DataFrame:
    """The supplied case list if it is wanted and exists, else the discovered cases.

    Discovered cases are saved as the case list of the run.
    """
    if options.use_provided_casenames:
        supplied = case_list.case_list_if_present(spark, options.case_list)
        if supplied is not None:
            return settle(supplied.distinct())
        log.warning("no case list at %s; discovering cases", options.case_list)
    cases = settle(discover_cases(catalog, options))
    case_list.write_case_list(cases, options.case_list)
    return cases


def case_files_of(catalog: DataFrame, cases: DataFrame, options: RunOptions) -> DataFrame:
    files = catalogs.scan_by_variable(catalog, options.variables)
    return assign.assign_files(
        files, cases, options.timestr, options.match, options.ensemble
    )


def analyse_members(
    cells: DataFrame,
    case_files: DataFrame,
    options: RunOptions,
    preprocess: Preprocess | None = None,
    analyse: Analyse | None = None,
) -> DataFrame:
    """Find each cell's member, truncate, merge, preprocess and analyse in one plan.

    ``case_files`` should be settled, being read several times. Truncation comes before the
    merge, so that dropped times are never shuffled. Until the cells are merged a member is a
    number. Variables on different grids reach the user's functions as a ``GridCube``.
    """
    files, names = merge.number_files(case_files, options.merge_mode == "override")
    wanted = discovery.keep_variables(cells, options.variables)
    wanted = cell_tables.cells_of_files(wanted, files)
    numbered = merge.number_cells(wanted, files)
    if options.truncates_time:
        numbered = axis.first_n_timesteps(numbered, TEST_TIMES, merge.MEMBER_NUMBER)
    cube = grids.merge_grids(numbered, options.variables, options.merge_mode, names).whole()
    if preprocess is not None and not options.skip_preprocess:
        cube = members.apply_native(cube, preprocess, dict(options.preprocess_kwargs))
    if analyse is not None:
        cube = members.apply_native(cube, analyse)
    return cube.stacked() if isinstance(cube, GridCube) else cube


def run_ensemble(
    spark: SparkSession,
    catalog: DataFrame,
    cells: DataFrame,
    options: RunOptions,
    preprocess: Preprocess | None = None,
    analyse: Analyse | None = members.brightness,
) -> RunResult:
    """Find the members, analyse each the same way, and save them apart and combined.

    With ``skip_analysis`` only the cases are found. Members without files are reported and
    left out, or raise with ``strict``.
    """
    cases = choose_cases(spark, catalog, options)
    if options.skip_analysis:
        return RunResult(cases)
    if options.test_members:
        cases = settle(axis.first_n_members(cases, TEST_MEMBERS, "casename"))

    case_files = settle(case_files_of(catalog, cases, options))
    missing = settle(assign.members_without_files(cases, case_files))
    lacking = missing.count()
    if lacking:
        log.warning("%d members have no files; see RunResult.without_files", lacking)
        if options.strict:
            first = missing.agg(F.min("casename")).head()[0]
            raise ValueError(f"no files for member {first} ({lacking} such members)")

    analysed = analyse_members(cells, case_files, options, preprocess, analyse)
    processed = settle(case_files.select(F.col("casename").alias(results.MEMBER)).distinct())
    results.commit_members(analysed, processed, options.members_path)
    saved = results.read_committed(spark, options.members_path, analysed.schema).join(
        broadcast_if_small(processed), results.MEMBER, "left_semi"
    )
    written = saved.select(results.MEMBER).distinct()

    combined_path = None
    if options.concat_results:
        combined_path = options.combined_path(written.count())
        results.write_combined(saved, combined_path)
    return RunResult(cases, missing, saved, options.members_path, combined_path)
