import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from isospread import RunOptions, run_ensemble
from isospread.operators import axis, members
from isospread.plans import run
from isospread.sources import case_list, cells as cell_tables, results
from isospread.sources.catalog import CATALOG_SCHEMA

HISTORICAL = "B20TRC5CNBDRD.f09_g16"
SCENARIO = "BRCP85C5CNBDRD.f09_g16"


def day(n):
    return dt.datetime(2000, 1, 1) + dt.timedelta(days=n)


def path(run, number, var):
    return f"/data/{var}/b.e11.{run}.{number}.cam.h0.{var}.200001.nc"


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    """Three members of two runs each, 8 days per run, stored by variable."""
    rows = [
        (path(run, f"{m:03d}", var), var, day(d + shift), None, lat, 0.0,
         float("nan") if lat == 2.0 else 200.0 + m)
        for m in (1, 2, 3)
        for run, shift in ((HISTORICAL, 0), (SCENARIO, 8))
        for var in ("T", "FLNT")
        for d in range(8)
        for lat in (1.0, 2.0)
    ]
    folder = str(tmp_path_factory.mktemp("cells"))
    df = spark.createDataFrame(rows, cell_tables.CELLS_SCHEMA)
    df.write.mode("overwrite").partitionBy("var").parquet(folder)
    return cell_tables.read_cells(spark, folder, ["T", "FLNT"])


@pytest.fixture(scope="module")
def catalog(spark):
    paths = [
        path(run, f"{m:03d}", var)
        for m in (1, 2, 3) for run in (HISTORICAL, SCENARIO) for var in ("T", "FLNT")
    ]
    # Member 4 has files of the exemplar variable only.
    paths.append(path(HISTORICAL, "004", "T"))
    rows = [(p, p.split("/")[2], p.split("/")[3]) for p in paths]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def options(tmp_path, **changes):
    given = {
        "ensemble": "CESM1-LE", "data_freq": "month_1", "variables": ["FLNT"],
        "save_path": str(tmp_path), "field_name": "tbrt",
    }
    return RunOptions(**{**given, **changes})


def test_whole_run(spark, catalog, cells, tmp_path):
    result = run_ensemble(spark, catalog, cells, options(tmp_path))
    assert result.cases.count() == 4
    assert [r.casename for r in result.without_files.collect()] == [f"{HISTORICAL}.004"]
    saved = result.members
    assert saved.count() == 3 * 16 * 2
    names = {r[0] for r in saved.select("ensemble_member").distinct().collect()}
    assert f"{HISTORICAL}.001&&{SCENARIO}.001" in names and len(names) == 3
    assert saved.filter("lat = 2 AND FLNT IS NULL AND TBRT IS NULL").count() == 48
    assert saved.schema["TBRT"].metadata["units"] == "K"
    assert result.members_path == f"{tmp_path}/CESM1-LE/INDIVIDUAL-FILES/CESM1-LE_month_1_tbrt_"
    assert result.combined_path == f"{tmp_path}/CESM1-LE/CESM1-LE_month_1_tbrt_3members_"
    combined = spark.read.parquet(result.combined_path)
    assert combined.exceptAll(saved).count() == 0 and combined.count() == 96
    listed = case_list.read_case_list(spark, f"{tmp_path}/CESM1-LE/casenames_CESM1-LE.txt")
    assert listed.count() == 4


def test_testing_mode_truncates_and_marks(spark, catalog, cells, tmp_path):
    chosen = options(tmp_path, test_members=True, test_times=True, data_freq="day_1")
    result = run_ensemble(spark, catalog, cells, chosen)
    assert result.members_path.endswith("CESM1-LE_day_1_tbrt__TESTINGMODE")
    assert result.combined_path.endswith("_2members__TESTINGMODE")
    assert result.members.count() == 2 * 10 * 2


def test_time_truncation_alone_does_nothing(spark, catalog, cells, tmp_path):
    chosen = options(tmp_path, test_times=True, concat_results=False)
    result = run_ensemble(spark, catalog, cells, chosen)
    assert result.members.count() == 96 and result.combined_path is None
    assert "TESTINGMODE" not in result.members_path


def test_skipping_the_analysis_only_lists_cases(spark, catalog, cells, tmp_path):
    result = run_ensemble(spark, catalog, cells, options(tmp_path, skip_analysis=True))
    assert result.members is None and result.cases.count() == 4
    assert not glob.glob(f"{tmp_path}/CESM1-LE/INDIVIDUAL-FILES/*")


def test_supplied_cases_and_preprocessing(spark, catalog, cells, tmp_path):
    listed = tmp_path / "mine.txt"
    listed.write_text(f"{SCENARIO}.002\n{HISTORICAL}.003")
    chosen = options(
        tmp_path, casenames_path=str(listed), use_provided_casenames=True,
        skip_preprocess=False, preprocess_kwargs="lat&&1",
    )

    def preprocess(cube, kwargs):
        return axis.subset(cube, lat=(float(kwargs["LAT"]), float(kwargs["LAT"])))

    result = run_ensemble(spark, catalog, cells, chosen, preprocess)
    names = {r[0] for r in result.members.select("ensemble_member").distinct().collect()}
    assert names == {f"{SCENARIO}.002", f"{HISTORICAL}.003"}
    assert result.members.count() == 16
    assert listed.read_text().endswith("003")


def test_missing_case_list_falls_back_to_discovery(spark, catalog, cells, tmp_path):
    chosen = options(tmp_path, use_provided_casenames=True, skip_analysis=True)
    assert run_ensemble(spark, catalog, cells, chosen).cases.count() == 4
    assert case_list.read_case_list(spark, chosen.case_list).count() == 4


def test_strict_run_raises_for_members_without_files(spark, catalog, cells, tmp_path):
    with pytest.raises(ValueError, match="no files for member"):
        run_ensemble(spark, catalog, cells, options(tmp_path, strict=True))


def test_time_string_limits_the_files(spark, catalog, cells, tmp_path):
    chosen = options(tmp_path, timestr="BRCP85", concat_results=False)
    result = run_ensemble(spark, catalog, cells, chosen)
    assert result.members.count() == 3 * 8 * 2
    assert result.members_path.endswith("CESM1-LE_month_1_tbrt_BRCP85")


def test_user_functions_must_keep_the_member(spark, catalog, cells, tmp_path):
    with pytest.raises(ValueError, match="ensemble_member"):
        run_ensemble(
            spark, catalog, cells, options(tmp_path),
            analyse=lambda cube: cube.groupBy("time").agg(F.mean("FLNT").alias("FLNT")),
        )


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"ensemble": "CESM9"}, "unsupported ensemble"),
        ({"data_freq": "hour_6"}, "no merge mode"),
        ({"test_members": "MAYBE"}, "test_members"),
        ({"match": "regex"}, "match"),
        ({"variables": "FLNT"}, "variables"),
        ({"preprocess_kwargs": "TRUE"}, "malformed"),
    ],
)
def test_bad_options_raise(tmp_path, changes, message):
    with pytest.raises(ValueError, match=message):
        options(tmp_path, **changes)


def test_cells_are_pruned_by_variable(spark, tmp_path, capsys):
    rows = [("/d/x.nc", v, day(0), None, 0.0, 0.0, 1.0) for v in ("T", "PS")]
    df = spark.createDataFrame(rows, cell_tables.CELLS_SCHEMA)
    df.write.partitionBy("var").parquet(str(tmp_path / "c"))
    found = cell_tables.read_cells(spark, str(tmp_path / "c"), ["T"]).select("time", "value")
    assert found.count() == 1
    found.explain("formatted")
    out = capsys.readouterr().out
    assert "PartitionFilters: [" in out and "ReadSchema: struct<time:timestamp_ntz,value:double>" in out


@pytest.mark.parametrize("data_freq", ["month_1", "day_1"])
def test_user_subsetting_reaches_the_scan(spark, catalog, cells, tmp_path, capsys, data_freq):
    chosen = options(tmp_path, skip_preprocess=False, data_freq=data_freq)
    cases = run.discover_cases(catalog, chosen)
    case_files = run.case_files_of(catalog, cases, chosen)

    def preprocess(cube, kwargs):
        return axis.subset(cube, time=(day(1), day(2)), lat=(1.0, 1.0))

    found = run.analyse_members(cells, case_files, chosen, preprocess, members.brightness)
    assert found.count() == 6
    found.explain("formatted")
    pushed = capsys.readouterr().out
    assert "GreaterThanOrEqual(time," in pushed and "LessThanOrEqual(lat," in pushed
    assert "SortMergeJoin" not in pushed and "SortAggregate" not in pushed


def small_cube(spark, *names, value=1.0):
    rows = [(m, day(d), 0.0, value) for m in names for d in range(3)]
    return spark.createDataFrame(
        rows, "ensemble_member STRING, time TIMESTAMP_NTZ, lat DOUBLE, FLNT DOUBLE"
    )


def test_rewriting_one_member_leaves_the_others(spark, tmp_path):
    out = str(tmp_path / "m")
    first = small_cube(spark, "001", "a&&b")
    results.write_members(first, out)
    results.write_members(small_cube(spark, "001", value=2.0), out)
    saved = results.read_members(spark, out, first.schema)
    rows = {(r.ensemble_member, r.FLNT) for r in saved.collect()}
    assert rows == {("001", 2.0), ("a&&b", 1.0)} and saved.count() == 6
    assert saved.columns == first.columns
    assert results.read_members(spark, out, first.schema, "001").count() == 3


def test_files_are_in_time_order(spark, tmp_path):
    out = str(tmp_path / "m")
    rows = spark.range(0, 5_000, 1, 4).select(
        F.format_string("%03d", F.col("id") % 100).alias("ensemble_member"),
        F.timestamp_add("HOUR", F.pmod(F.hash("id"), F.lit(500)), F.lit("2000-01-01").cast(
            "timestamp_ntz")).alias("time"),
        F.col("id").cast("double").alias("FLNT"),
    )
    results.write_members(rows, out)
    saved = results.read_members(spark, out, rows.schema)
    assert saved.exceptAll(rows).count() == 0 and saved.count() == 5_000
    files = glob.glob(f"{out}/ensemble_member=001/part-*")
    times = [t for f in files for t in pq.read_table(f).column("time").to_pylist()]
    assert len(files) == 1 and len(times) == 50 and times == sorted(times)


def test_a_large_member_is_written_by_several_tasks(spark, tmp_path):
    out = str(tmp_path / "m")
    hot = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("ensemble_member"),
        F.lit(day(0)).cast("timestamp_ntz").alias("time"),
        F.rand(1).alias("lat"), F.rand(2).alias("FLNT"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        results.write_members(hot, out)
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{out}/ensemble_member=hot/part-*")) > 2
    assert results.read_members(spark, out, hot.schema).count() == 300_000


def test_pandas_blocks_and_groups(spark):
    cube = small_cube(spark, "a", "b")

    def double(block):
        return block.assign(FLNT=block["FLNT"] * 2)

    assert {r.FLNT for r in members.apply_blocks(cube, double, cube.schema).collect()} == {2.0}

    def anomaly(series):
        return series.assign(FLNT=series["FLNT"] - series["FLNT"].mean())

    found = members.apply_groups(cube, anomaly, cube.schema, ["lat"])
    assert {r.FLNT for r in found.collect()} == {0.0} and found.count() == 6
    with pytest.raises(ValueError, match="divide a member"):
        members.apply_groups(cube, anomaly, cube.schema, [])


def test_stateless_functions_run_on_a_stream(spark, cells, tmp_path):
    source = str(tmp_path / "in")
    small_cube(spark, "a", "b").write.parquet(source)
    stream = spark.readStream.schema(small_cube(spark, "a").schema).parquet(source)
    analysed = members.apply_native(axis.subset(stream, lat=(0.0, 0.0)), members.brightness)
    query = (
        analysed.writeStream.format("memory").queryName("bright").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.awaitTermination(60)
    assert spark.table("bright").count() == 6


def test_a_member_without_rows_keeps_none_of_an_earlier_run(spark, catalog, cells, tmp_path):
    chosen = options(tmp_path)
    run_ensemble(spark, catalog, cells, chosen)
    fewer = cells.filter(~F.col("path").contains(".002."))
    result = run_ensemble(spark, catalog, fewer, chosen)
    assert result.combined_path.endswith("_2members_")
    combined = spark.read.parquet(result.combined_path)
    for table in (result.members, combined):
        names = {r[0] for r in table.select("ensemble_member").distinct().collect()}
        assert len(names) == 2 and not any("002" in n for n in names)
