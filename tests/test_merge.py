import datetime as dt

import pytest
from pyspark.sql import functions as F

from isospread.operators import merge
from isospread.sources.storage import broadcast_if_small, settle

SCHEMA = (
    "ensemble_member STRING, var STRING, path STRING, time TIMESTAMP_NTZ, lat DOUBLE, "
    "value DOUBLE"
)
DAY = dt.datetime(2000, 1, 1)


def cells(spark, *rows):
    """Rows of (var, path, lat, value) for one member and day."""
    return spark.createDataFrame([("m", v, p, DAY, lat, x) for v, p, lat, x in rows], SCHEMA)


def merged(df, *columns):
    return sorted(tuple(r[c] for c in ("lat", *columns)) for r in df.collect())


def test_agreeing_and_missing_values_merge(spark):
    found = merge.merge_no_conflicts(
        cells(
            spark,
            ("A", "p", 1.0, 5.0), ("A", "q", 1.0, None), ("A", "r", 1.0, float("nan")),
            ("B", "p", 1.0, 7.0), ("A", "p", 2.0, 6.0), ("A", "q", 2.0, 6.0),
        ),
        ["A", "B"],
    )
    assert merged(found, "A", "B") == [(1.0, 5.0, 7.0), (2.0, 6.0, None)]
    assert found.columns == ["ensemble_member", "time", "lat", "A", "B"]


def test_conflict_raises_and_names_the_cell(spark):
    found = merge.merge_no_conflicts(
        cells(spark, ("A", "p", 1.0, 1.0), ("A", "q", 1.0, 2.0)), ["A"]
    )
    with pytest.raises(Exception, match="conflicting values of A: .*lat=1.0"):
        found.collect()


def test_conflicts_are_listed(spark):
    found = merge.find_conflicts(
        cells(
            spark, ("A", "p", 1.0, 1.0), ("A", "q", 1.0, 2.0), ("A", "p", 2.0, 1.0),
            ("A", "q", 2.0, 1.0), ("B", "q", 1.0, 9.0), ("A", "q", 3.0, float("nan")),
            ("A", "p", 3.0, 4.0),
        )
    )
    rows = [(r["var"], r["lat"], r.min_value, r.max_value) for r in found.collect()]
    assert rows == [("A", 1.0, 1.0, 2.0)]


def test_first_file_in_path_order_wins_even_if_missing(spark):
    found = merge.merge_override(
        cells(
            spark, ("A", "q", 1.0, 2.0), ("A", "p", 1.0, 1.0), ("A", "p", 2.0, None),
            ("A", "q", 2.0, 2.0), ("A", "q", 3.0, 3.0), ("B", "p", 3.0, 4.0),
        ),
        ["A", "B"],
    )
    assert merged(found, "A", "B") == [(1.0, 1.0, None), (2.0, None, None), (3.0, 3.0, 4.0)]


def test_file_order_follows_paths(spark):
    paths = spark.range(1000).select(F.format_string("/d/%04d.nc", F.col("id")).alias("path"))
    rows = merge.rising_numbers(paths.repartition(7), "path", "file_order").collect()
    by_order = [r.path for r in sorted(rows, key=lambda r: r.file_order)]
    assert by_order == sorted(by_order) and len(by_order) == 1000


def test_file_order_survives_the_join_back(spark):
    case_files = spark.range(2000).select(
        F.format_string("m%02d", F.col("id") % 7).alias("casename"),
        F.format_string("/d/%04d.nc", (F.col("id") * 977) % 2000).alias("path"),
    )
    files, names = merge.number_files(case_files.repartition(5), ordered=True)
    rows = sorted(files.collect(), key=lambda r: r.file_order)
    assert [r.path for r in rows] == sorted(r.path for r in rows)
    by_number = {r.member_number: r.ensemble_member for r in names.collect()}
    expected = {r.path: r.casename for r in case_files.collect()}
    assert {r.path: by_number[r.member_number] for r in rows} == expected


def test_merges_keep_numeric_state(spark):
    table = cells(spark, ("A", "p", 1.0, 1.0))
    for df in (merge.merge_no_conflicts(table, ["A"]), merge.merge_override(table, ["A"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_missing_level_is_a_coordinate_value(spark):
    schema = SCHEMA.replace("lat DOUBLE", "lev DOUBLE, lat DOUBLE")
    table = spark.createDataFrame(
        [("m", "PS", "p", DAY, None, 1.0, 9.0), ("m", "PS", "q", DAY, None, 1.0, 9.0),
         ("m", "T", "t", DAY, 3.0, 1.0, 8.0)], schema,
    )
    found = merge.merge_no_conflicts(table, ["PS", "T"])
    rows = {(r.lev, r.PS, r["T"]) for r in found.collect()}
    assert rows == {(None, 9.0, None), (3.0, None, 8.0)}


def test_time_pieces(spark):
    early = cells(spark, ("A", "p", 1.0, 1.0))
    late = early.withColumn("time", F.lit(dt.datetime(2000, 2, 1)).cast("timestamp_ntz"))
    assert merge.concat_time_pieces([early, late]).count() == 2
    with pytest.raises(Exception, match="cell found twice: .*var=A"):
        merge.concat_time_pieces([early, early]).collect()
    assert merge.concat_time_pieces([early, early], check=False).count() == 2


def test_labels_come_from_the_file(spark):
    table = cells(spark, ("A", "/x/1.nc", 1.0, 1.0), ("A", "/x/2.nc", 1.0, 2.0)).drop(
        "ensemble_member"
    )
    case_files = spark.createDataFrame(
        [("m1", "/x/1.nc"), ("m2", "/x/1.nc")], "casename STRING, path STRING"
    )
    found = merge.label_members(table, case_files)
    assert sorted((r.ensemble_member, r.value) for r in found.collect()) == [
        ("m1", 1.0), ("m2", 1.0),
    ]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown merge mode"):
        merge.merge(cells(spark), ["A"], "minimal")


def test_broadcast_only_below_the_limit(spark):
    small, large = settle(spark.range(10)), settle(spark.range(200_000))

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(small, 10_000))
    assert not hinted(broadcast_if_small(large, 10_000))


def test_label_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(merge, "broadcast_if_small", lambda df: broadcast_if_small(df, 1))
    table = cells(spark, *(("A", f"/x/{i % 3}.nc", float(i), 1.0) for i in range(9))).drop(
        "ensemble_member"
    )
    case_files = settle(
        spark.createDataFrame([("m", f"/x/{i}.nc") for i in range(3)], "casename STRING, path STRING")
    )
    assert merge.label_members(table, case_files).count() == 9
    found = merge.merge_override(merge.label_members(table, case_files), ["A"])
    assert found.count() == 9
    files, names = merge.number_files(case_files, ordered=True)
    for mode in ("override", "no_conflicts"):
        cube = merge.merge(merge.number_cells(table, files), ["A"], mode, names)
        assert cube.columns == ["ensemble_member", "time", "lat", "A"] and cube.count() == 9


def test_numbered_members_merge_like_named_ones(spark):
    table = cells(
        spark, ("A", "/a.nc", 1.0, 1.0), ("A", "/b.nc", 1.0, 2.0), ("A", "/c.nc", 1.0, 5.0)
    ).drop("ensemble_member")
    case_files = spark.createDataFrame(
        [("x", "/a.nc"), ("y", "/b.nc"), ("y", "/c.nc")], "casename STRING, path STRING"
    )
    files, names = merge.number_files(case_files, ordered=True)
    numbered = merge.number_cells(table, files)
    assert "path" not in numbered.columns and "ensemble_member" not in numbered.columns
    rows = merge.merge(numbered, ["A"], "override", names).collect()
    assert sorted((r.ensemble_member, r["A"]) for r in rows) == [("x", 1.0), ("y", 2.0)]
    with pytest.raises(Exception, match="conflicting values of A: ensemble_member=y"):
        merge.merge(numbered, ["A"], "no_conflicts", names).collect()


def test_a_conflict_raises_whatever_is_selected(spark):
    table = cells(
        spark, ("A", "/a.nc", 1.0, 1.0), ("A", "/b.nc", 1.0, 2.0), ("B", "/a.nc", 1.0, 5.0)
    )
    merged = merge.merge_no_conflicts(table, ["A", "B"])
    for use in (lambda: merged.select("B").collect(), merged.count):
        with pytest.raises(Exception, match="conflicting values of A"):
            use()


def test_conflicts_of_numbered_cells(spark):
    table = cells(spark, ("A", "/a.nc", 1.0, 1.0), ("A", "/b.nc", 1.0, 2.0))
    order = F.when(F.col("path") == "/a.nc", 0).otherwise(1).cast("long")
    numbered = table.withColumn(merge.FILE_ORDER, order).drop("path")
    assert merge.find_conflicts(numbered).count() == merge.find_conflicts(table).count() == 1
