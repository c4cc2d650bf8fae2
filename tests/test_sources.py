import os

import pytest
from pyspark.sql import functions as F

from isospread.plans.fixtures import fixture
from isospread.sources import catalog, cells as cell_tables, results
from isospread.sources.storage import settle

SF = "/root/testdata/sf0.001"


def cube(spark, *names, value=1.0, rows=3):
    of = F.explode(F.array(*map(F.lit, names))).alias("ensemble_member")
    return spark.range(rows).select(
        of, F.timestamp_add("DAY", "id", F.lit("2000-01-01").cast("timestamp_ntz")).alias("time"),
        F.lit(value).alias("FLNT"),
    )


def saved(spark, path, schema, member=None):
    rows = results.read_committed(spark, path, schema, member).collect()
    return sorted((r.ensemble_member, r.FLNT) for r in rows)


# a listing


def test_many_sparse_files_are_listed_by_few_tasks(spark, tmp_path):
    for var in ("T", "PS", "Q"):
        (tmp_path / var).mkdir()
    for i in range(3_000):
        with open(tmp_path / ("T", "PS")[i % 2] / f"b{i}.nc", "wb") as file:
            file.truncate(1 << 30)  # sparse
    (tmp_path / "Q" / "q.nc").write_bytes(b"")
    for name in ("b.txt", ".b.nc", "_b.nc", "b.nc.tmp"):
        (tmp_path / "T" / name).write_bytes(b"")
    (tmp_path / "T" / "folder.nc").mkdir()
    found = catalog.list_folders(spark, str(tmp_path), ["T", "PS"])
    assert found.rdd.getNumPartitions() == 2
    assert found.columns == ["path", "var", "fname"] and found.count() == 3_001
    rows = {tuple(r) for r in found.collect()}
    assert (f"{tmp_path}/T/b.nc.tmp", "T", "b.nc.tmp") in rows
    assert all(path == f"{tmp_path}/{var}/{name}" and os.path.exists(path) for path, var, name in rows)


def test_both_listings_agree(spark, tmp_path):
    for var, name in (("T", "b1.nc"), ("T", "b1.nc.tmp"), ("T", "b1.txt"), ("PS", "b2.nc")):
        (tmp_path / var).mkdir(exist_ok=True)
        (tmp_path / var / name).write_bytes(b"x")
    (tmp_path / "Q").mkdir()
    for variables in (["T", "PS"], ["T"]):
        ours, theirs = (f(spark, str(tmp_path), variables) for f in (catalog.list_folders, catalog.list_files))
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    assert catalog.list_folders(spark, f"file://{tmp_path}", ["Q"]).count() == 0
    with pytest.raises(Exception, match="none"):
        catalog.list_folders(spark, str(tmp_path), ["none"]).collect()


# cells by file group


@pytest.fixture(scope="module")
def grouped(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grouped"))
    cell_tables.write_cells(fixture(spark, SF, "fx_cells"), path)
    return cell_tables.read_cells(spark, path, ["FLNT", "T"], grouped=True)


def test_only_the_groups_of_the_members_are_scanned(spark, grouped):
    one = settle(grouped.where(F.col("path").contains(".007.")).select("path").distinct())
    few = cell_tables.cells_of_files(grouped, one)
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "9999")
    plan = few._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(key, before)
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "file_group" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(path" in scan and "LessThanOrEqual(path" in scan
    # as many folders are read as the member's runs have groups
    groups = {r[0] for r in one.select(cell_tables.file_group(F.col("path"))).distinct().collect()}
    assert len(groups) <= 2
    read = few.select(F.regexp_extract(F.input_file_name(), "file_group=([0-9]+)", 1)).distinct()
    assert {int(r[0]) for r in read.collect()} == groups
    found = few.join(one, "path", "left_semi")
    wanted = grouped.drop("file_group").join(one, "path", "left_semi")
    assert found.count() == wanted.count() > 0 and found.exceptAll(wanted).count() == 0
    assert few.count() < grouped.count() / 5


def test_files_without_cells_and_tables_without_groups(spark, grouped):
    none = spark.createDataFrame([], "path STRING")
    assert cell_tables.cells_of_files(grouped, none).count() == 0
    plain = grouped.drop("file_group")
    assert cell_tables.cells_of_files(plain, none) is plain


# the manifest


def test_a_failed_write_leaves_the_earlier_result_whole(spark, tmp_path):
    path = str(tmp_path / "m")
    first = cube(spark, "001", "002")
    results.commit_members(first, first, path)
    before = saved(spark, path, first.schema)
    bad = cube(spark, "001", "003", value=2.0).withColumn(
        "FLNT", F.when(F.col("ensemble_member") == "003", F.raise_error(F.lit("broken")).cast("double")).otherwise(2.0)
    )
    with pytest.raises(Exception, match="broken"):
        results.commit_members(bad, first, path)
    assert saved(spark, path, first.schema) == before and len(before) == 6
    # the next run that succeeds removes what the failed one left
    again = cube(spark, "001", "002", value=5.0)
    results.commit_members(again, again, path)
    assert {v for _, v in saved(spark, path, first.schema)} == {5.0}
    assert len([f for f in os.listdir(path) if f.startswith("run=")]) == 1
    assert len([f for f in os.listdir(f"{path}/_manifest") if not f.startswith(".")]) == 1


def test_a_manifest_that_is_not_complete_does_not_count(spark, tmp_path):
    path = str(tmp_path / "m")
    first = cube(spark, "001")
    results.commit_members(first, first, path)
    os.makedirs(f"{path}/_manifest/version-00000002")
    assert saved(spark, path, first.schema) == [("001", 1.0)] * 3
    results.commit_members(cube(spark, "001", value=3.0), first, path)
    assert saved(spark, path, first.schema) == [("001", 3.0)] * 3


def test_members_that_are_not_named_stay(spark, tmp_path):
    path = str(tmp_path / "m")
    first = cube(spark, "001", "a&&b", "x/=y")
    results.commit_members(first, first, path)
    results.commit_members(cube(spark, "001", value=2.0), cube(spark, "001"), path)
    assert saved(spark, path, first.schema) == sorted(
        [("001", 2.0)] * 3 + [("a&&b", 1.0)] * 3 + [("x/=y", 1.0)] * 3
    )
    assert saved(spark, path, first.schema, "a&&b") == [("a&&b", 1.0)] * 3
    assert saved(spark, path, first.schema, "none") == []


def test_a_named_member_without_rows_has_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    first = cube(spark, "001", "002")
    assert results.read_committed(spark, path, first.schema).count() == 0
    results.commit_members(first, first, path)
    results.commit_members(cube(spark, "002", value=4.0), first, path)
    assert saved(spark, path, first.schema) == [("002", 4.0)] * 3
    results.commit_members(first.limit(0), first, path)
    assert saved(spark, path, first.schema) == []
