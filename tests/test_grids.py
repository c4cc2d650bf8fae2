import datetime as dt

import pytest
from pyspark.sql import functions as F

from isospread import RunOptions
from isospread.operators import axis, grids, members, merge, vertical
from isospread.plans import run
from isospread.plans.queries import _grid_cube
from isospread.sources.cells import CELLS_SCHEMA

DAY = dt.datetime(2000, 1, 1)
SCHEMA = CELLS_SCHEMA.replace("path STRING", "ensemble_member STRING, path STRING")
LEVELS = [float(n) for n in range(1, 31)]


@pytest.fixture(scope="module")
def cells(spark):
    """One point with 30 levels of T, FLNT without levels, coefficients, and a scalar."""
    rows = [("m", "t", "T", DAY, lev, lat, 0.0, 200 + lev) for lev in LEVELS for lat in (1.0, 2.0)]
    rows += [("m", "f", "FLNT", DAY, None, lat, 0.0, 240.5) for lat in (1.0, 2.0)]
    rows += [("m", "p", "PS", DAY, None, 1.0, 0.0, 100000.0)]
    rows += [("m", "t", v, None, lev, None, None, k * lev) for lev in LEVELS for v, k in (("hyam", 0.01), ("hybm", 0.02))]
    rows += [("m", "s", "P0", None, None, None, None, 1e5)]
    return spark.createDataFrame(rows, SCHEMA)


VARIABLES = ["T", "FLNT", "PS", "hyam", "hybm", "P0"]


def test_each_variable_has_its_own_coordinates(cells):
    found = grids.coordinates_by_variable(cells, VARIABLES)
    assert found["T"] == ("time", "lev", "lat", "lon") and found["FLNT"] == ("time", "lat", "lon")
    assert found["hyam"] == ("lev",) and found["P0"] == ()


def test_a_flux_has_no_empty_rows_beside_levels(cells):
    cube = grids.merge_grids(cells, VARIABLES)
    bright = members.brightness(cube)
    assert bright.columns == ["ensemble_member", "time", "lat", "lon", "FLNT", "TBRT"]
    assert bright.count() == 2 and bright.where("TBRT IS NULL").count() == 0
    assert [g.variables for g in cube.grids] == [("T",), ("FLNT", "PS"), ("hyam", "hybm"), ("P0",)]
    assert cube.stacked().count() == 60 + 2 + 30 + 1


def test_grids_join_on_demand(cells):
    cube = grids.merge_grids(cells, VARIABLES)
    both = cube.select("T", "PS", "hyam", "P0")
    assert both.columns == ["ensemble_member", "time", "lev", "lat", "lon", "T", "PS", "hyam", "P0"]
    assert both.count() == 60 and both.where("PS IS NULL").count() == 30
    assert both.where("hyam = 0.01 * lev AND P0 = 1e5").count() == 60
    with pytest.raises(ValueError, match="all of these coordinates"):
        cube.select("FLNT", "hyam")
    with pytest.raises(ValueError, match="no variable"):
        cube.select("Q")


def test_subsetting_goes_along_the_coordinates_of_each_grid(cells):
    cube = axis.subset(grids.merge_grids(cells, VARIABLES), lat=(1.5, 9.0), lev=(1.0, 3.0))
    assert [g.table.count() for g in cube.grids] == [3, 1, 3, 1]


def test_a_conflict_on_one_grid_raises(spark, cells):
    other = spark.createDataFrame([("m", "g", "FLNT", DAY, None, 1.0, 0.0, 1.0)], SCHEMA)
    cube = grids.merge_grids(cells.union(other), VARIABLES)
    with pytest.raises(Exception, match="conflicting values of FLNT"):
        members.brightness(cube).collect()
    assert cube.select("T").count() == 60


def test_override_takes_the_first_file_of_each_grid(spark, cells):
    other = spark.createDataFrame([("m", "a", "FLNT", DAY, None, 1.0, 0.0, 1.0)], SCHEMA)
    cube = grids.merge_grids(cells.union(other), VARIABLES, "override")
    assert {r.lat: r.FLNT for r in cube.select("FLNT").collect()} == {1.0: 1.0, 2.0: 240.5}


def test_cells_without_further_coordinates_need_no_look_up(spark, cells, monkeypatch):
    monkeypatch.setattr(grids, "coordinates_by_variable", None)
    flat = cells.where("var IN ('FLNT', 'PS')").drop("lev")
    cube = grids.merge_grids(flat, ["FLNT", "PS"]).whole()
    assert cube.columns == ["ensemble_member", "time", "lat", "lon", "FLNT", "PS"]
    assert sorted(map(tuple, cube.collect())) == sorted(
        map(tuple, merge.merge_no_conflicts(flat, ["FLNT", "PS"]).collect())
    )


def test_a_variable_without_cells_is_null(cells):
    cube = grids.merge_grids(cells, ["T", "Q"]).whole()
    assert cube.count() == 60 and cube.where("Q IS NOT NULL").count() == 0


def test_no_cells_at_all(cells):
    none = grids.merge_grids(cells.limit(0), ["T", "FLNT"]).whole()
    assert none.columns == ["ensemble_member", "time", "lev", "lat", "lon", "T", "FLNT"] and none.count() == 0


def test_pieces_overlap_by_their_intervals(spark):
    rows = [("m", "T", p, DAY + dt.timedelta(days=d)) for p, a, b in (
        ("long", 0, 30), ("inside", 3, 4), ("touching", 30, 31), ("apart", 40, 50), ("same", 40, 41),
    ) for d in (a, b)]
    cells = spark.createDataFrame([*rows, ("m", "T", "timeless", None)], "m string, var string, path string, time timestamp_ntz")
    of = ["m", "var"]
    found = merge.overlapping_pieces(merge.file_intervals(cells, of), of)
    assert {r.path: (r.covered_until - DAY).days for r in found.collect()} == {"inside": 30, "touching": 30, "same": 50}


def test_dense_cube_of_many_members_gathers_no_rows(spark):
    rows = [(f"{m:03d}", DAY, float(x), 1.0) for m in range(130) for x in range(4) if (m * x) % 7 < 3]
    cube = spark.createDataFrame(rows, "ensemble_member string, time timestamp_ntz, lat double, FLNT double")
    dense = members.concat_members_dense(cube, ["FLNT"])
    assert dense.count() == 130 * 4 and dense.where("FLNT IS NOT NULL").count() == len(rows)
    assert dense.select("ensemble_member", "lat").distinct().count() == 130 * 4
    assert "collect_list" not in dense._jdf.queryExecution().optimizedPlan().toString()
    assert members.concat_members_dense(cube.limit(0), ["FLNT"]).count() == 0


def test_groups_larger_than_a_batch_come_in_order(spark):
    rows = [(m, DAY + dt.timedelta(hours=(7 * i) % 100), 1.0, 2.0, float((7 * i) % 100)) for i in range(100) for m in ("a", "b")]
    cube = spark.createDataFrame(rows, "ensemble_member string, time timestamp_ntz, lat double, lon double, FLNT double")

    def counted(batches):
        before, n = -1.0, 0
        for batch in batches:
            n += 1
            assert batch["FLNT"].is_monotonic_increasing and batch["FLNT"].iloc[0] > before and len(batch) <= 10
            before = batch["FLNT"].iloc[-1]
            yield batch.assign(FLNT=float(n))

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        found = members.apply_group_batches(cube, counted, cube.schema, ["lat", "lon"]).collect()
    finally:
        spark.conf.set(key, before)
    assert len(found) == 200 and max(r.FLNT for r in found) == 10
    with pytest.raises(ValueError, match="divide a member"):
        members.apply_group_batches(cube, counted, cube.schema, [])


def test_a_run_hands_several_grids_to_the_user(spark, cells):
    files = cells.select(F.col("ensemble_member").alias("casename"), "path").distinct()
    options = RunOptions("CESM1-LE", "month_1", ["T", "FLNT"], skip_preprocess=False)
    seen = []

    def preprocess(cube, kwargs):
        seen.append(type(cube))
        return axis.subset(cube, lat=(1.5, 9.0))

    plain = cells.drop("ensemble_member")
    done = run.analyse_members(plain, files, options, preprocess, members.brightness)
    assert seen == [grids.GridCube] and [(r.lat, r.FLNT) for r in done.collect()] == [(2.0, 240.5)]
    stacked = run.analyse_members(plain, files, options, None, None)
    assert stacked.count() == 62 and stacked.where("T IS NULL").count() == 2


def test_remap_with_the_members_own_pressure(cells):
    cube = grids.merge_grids(cells, VARIABLES)
    found = {(r.lat, r.plev): r["T"] for r in vertical.remap_from_member(cube, "T").collect()}
    # pressure is 1000 Pa + 2000 Pa a level where there is a surface pressure
    assert found[1.0, 300.0] == pytest.approx(210.0) and found[1.0, 100.0] == pytest.approx(200 + 10 / 3)
    assert found[1.0, 1000.0] is None and len(found) == 22
    assert all(v is None for (lat, _), v in found.items() if lat == 2.0)


def test_remap_shuffles_the_field_by_column_once(spark):
    cube = _grid_cube(spark, "/root/testdata/sf0.001")
    plan = vertical.remap_from_member(cube, "T")._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("Window")] if "Window" in plan else plan
    assert "Exchange" not in after
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
