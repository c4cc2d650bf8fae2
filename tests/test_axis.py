import datetime as dt

import pytest
from pyspark.sql import functions as F

from isospread.operators import axis, members

SCHEMA = "ensemble_member STRING, time TIMESTAMP_NTZ, lat DOUBLE, lon DOUBLE, FLNT DOUBLE"


def day(n):
    return dt.datetime(2000, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def cube(spark):
    rows = [
        (m, day(t + shift), lat, 0.0, float(t))
        for m, shift in (("a", 0), ("b", 100))
        for t in range(12)
        for lat in (1.0, 2.0)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_first_ten_of_twelve_times(cube):
    found = axis.first_n_timesteps(cube, 10)
    assert found.count() == 40
    counts = found.groupBy("ensemble_member").agg(F.countDistinct("time").alias("n")).collect()
    assert {r.n for r in counts} == {10}


def test_fewer_times_than_asked_for_are_all_kept(cube):
    assert axis.first_n_timesteps(cube, 50).count() == cube.count()


def test_truncation_filters_without_shuffling_cells(cube):
    plan = axis.first_n_timesteps(cube, 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_first_members_in_name_order(spark, cube):
    more = cube.unionByName(cube.withColumn("ensemble_member", F.lit("Z")))
    found = axis.first_n_members(more, 2)
    assert {r[0] for r in found.select("ensemble_member").distinct().collect()} == {"Z", "a"}


def test_subset_is_closed_and_reaches_the_scan(spark, cube, tmp_path, capsys):
    path = str(tmp_path / "cube")
    cube.write.parquet(path)
    stored = spark.read.parquet(path)
    found = axis.subset(stored, time=(day(2), day(4)), lat=(1.0, 1.0))
    assert found.count() == 3
    found.explain("formatted")
    pushed = next(l for l in capsys.readouterr().out.splitlines() if "PushedFilters" in l)
    for name in ("time", "lat"):
        assert f"GreaterThanOrEqual({name}" in pushed and f"LessThanOrEqual({name}" in pushed


@pytest.mark.parametrize("zone", ["UTC", "America/Denver"])
def test_starts_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on this day does not exist in Denver.
    moment = dt.datetime(2024, 3, 10, 2, 30, 5)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(moment,)], "time TIMESTAMP_NTZ")
        units = ("year", "month", "day", "hour")
        row = df.select(*(axis.start_of(u, F.col("time")).alias(u) for u in units)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.asDict() == {
        "year": dt.datetime(2024, 1, 1),
        "month": dt.datetime(2024, 3, 1),
        "day": dt.datetime(2024, 3, 10),
        "hour": dt.datetime(2024, 3, 10, 2),
    }


def test_resampling_uses_the_given_statistic(cube):
    months = axis.resample_time(cube, "month", ["FLNT"], F.max)
    assert months.columns == cube.columns
    rows = {(r.ensemble_member, r.time.month, r.lat, r.FLNT) for r in months.collect()}
    assert ("a", 1, 1.0, 11.0) in rows
    coarse = axis.resample_space(cube, {"lat": 4.0}, ["FLNT"], F.count)
    assert coarse.columns == cube.columns and {r.FLNT for r in coarse.collect()} == {2}
    with pytest.raises(ValueError, match="unit"):
        axis.start_of("week", F.col("time"))


def test_negative_coordinates_go_to_the_cell_below(spark):
    df = spark.createDataFrame([("a", day(0), -0.5, 0.0, 1.0)], SCHEMA)
    assert axis.resample_space(df, {"lat": 2.0}, ["FLNT"], F.mean).first().lat == -2.0


def test_separate_members_stack_and_fill(spark, cube):
    one = cube.filter("ensemble_member = 'a'").drop("ensemble_member")
    other = one.withColumn("TBRT", F.lit(1.0)).drop("FLNT")
    whole = members.concat_members({"x": one, "y": other})
    assert whole.columns[0] == "ensemble_member" and whole.count() == 48
    assert whole.filter("ensemble_member = 'y' AND FLNT IS NULL AND TBRT = 1").count() == 24


def test_dense_cube_has_every_member_at_every_coordinate(spark, cube):
    extra = spark.createDataFrame([("c", day(0), 1.0, None, 5.0)], SCHEMA)
    dense = members.concat_members_dense(cube.unionByName(extra), ["FLNT"])
    assert dense.count() == 3 * (24 * 2 + 1)
    given = dense.filter("FLNT IS NOT NULL")
    assert given.exceptAll(cube.unionByName(extra).select(*dense.columns)).count() == 0
    assert given.count() == cube.count() + 1
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_cell_given_twice_stays_twice_in_the_dense_cube(spark, cube):
    dense = members.concat_members_dense(cube.union(cube.limit(1)), ["FLNT"])
    assert dense.count() == members.concat_members_dense(cube, ["FLNT"]).count() + 1


def test_a_missing_time_is_no_step(spark):
    rows = [("a", day(d), 0.0, 0.0, 1.0) for d in range(12)] + [("a", None, 0.0, 0.0, 2.0), ("b", None, 0.0, 0.0, 3.0)]
    found = axis.first_n_timesteps(spark.createDataFrame(rows, SCHEMA), 10)
    assert found.filter("time IS NOT NULL").count() == 10
    assert found.filter("time IS NULL").count() == 2
