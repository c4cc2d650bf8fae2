import random

import pytest

from isospread import RunOptions, resolve_ensemble
from isospread.operators import assign, discovery
from isospread.registry import Ensemble, data_path, merge_mode, resolve_paths
from isospread.sources import case_list, catalog


def files(spark, *names, var="T"):
    rows = [(f"/data/{var}/{n}", var, n) for n in names]
    return spark.createDataFrame(rows, catalog.CATALOG_SCHEMA)


def cases(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "casename STRING")


def values(df, column="casename"):
    return sorted(r[column] for r in df.collect())


def test_extension_is_contained_not_a_suffix(spark):
    kept = discovery.keep_extension(files(spark, "b1.nc", "b1.nc.tmp", "b1.txt"))
    assert values(kept, "fname") == ["b1.nc", "b1.nc.tmp"]


def test_missing_left_splitter_raises_with_the_name(spark):
    found = discovery.case_names(files(spark, "bxyz_C5CNBDRD.cam.h0.nc"), "CESM1-LE")
    with pytest.raises(Exception, match="bxyz_C5CNBDRD.cam.h0.nc"):
        found.collect()


def test_names_that_are_filtered_out_need_no_splitter(spark):
    names = discovery.case_names(
        files(spark, "axyz.nc", "bxyz.txt", "b.e11.B20TRC5CNBDRD.f09_g16.001.cam.h0.T.nc"),
        "CESM1-LE",
    )
    assert values(names) == ["B20TRC5CNBDRD.f09_g16.001"]


def test_case_name_without_right_splitter_keeps_the_rest(spark):
    names = discovery.case_names(files(spark, "b.f09_g17.X.001.nc"), "CESM2-LE")
    assert values(names) == ["X.001.nc"]


def test_case_name_ends_at_a_repeated_left_splitter(spark):
    names = discovery.case_names(files(spark, "b.f09_g17.X.f09_g17.Y.cam.nc"), "CESM2-LE")
    assert values(names) == ["X."]


def test_number_pairing_drops_oic_and_1xx(spark):
    found = discovery.pair_cases(
        cases(spark, "B20.001", "BRCP.001", "B20.101", "BRCP.101", "BRCP.OIC.001", "B20.002"),
        "CESM1-LE",
    )
    assert values(found) == ["B20.001&&BRCP.001", "B20.002"]


def test_containment_can_pull_in_a_1xx_case(spark):
    names = cases(spark, "X.001", "X.0010.101")
    assert values(discovery.pair_cases(names, "CESM1-LE")) == ["X.001&&X.0010.101"]
    assert values(discovery.pair_cases(names, "CESM1-LE", match="exact")) == ["X.001"]


def test_containment_hazard_of_scenario_names(spark):
    names = cases(spark, "CESM2-SF-GHG.370", "CESM2-SF-GHG-SSP370.001")
    both = "CESM2-SF-GHG-SSP370.001&&CESM2-SF-GHG.370"
    assert values(discovery.pair_cases(names, "CESM2-SF")) == ["CESM2-SF-GHG-SSP370.001", both]
    exact = discovery.pair_cases(names, "CESM2-SF", match="exact")
    assert values(exact) == ["CESM2-SF-GHG-SSP370.001", "CESM2-SF-GHG.370"]


def test_forcings_pair_apart_and_xaer_stays_single(spark):
    found = discovery.pair_cases(
        cases(spark, "SF-EE.001", "SF-EE-SSP370.001", "SF-GHG.001", "SF-xAER.001", "SF-BMB.002"),
        "CESM2-SF",
    )
    assert values(found) == [
        "SF-BMB.002", "SF-EE-SSP370.001&&SF-EE.001", "SF-GHG.001", "SF-xAER.001",
    ]


def test_a_number_twice_in_a_case_and_short_names(spark):
    found = discovery.pair_cases(cases(spark, "001.001", "01", "7"), "CESM1-LE")
    assert values(found) == ["001.001", "001.001&&01", "7"]


def brute_force_pairs(names):
    glued = set()
    for number in {n[-3:] for n in names}:
        if not number.startswith("1"):
            glued.add("&&".join(sorted(n for n in names if number in n)))
    return sorted(glued)


def test_pairing_equals_brute_force(spark):
    names = [f"{kind}.{i:03d}" for kind in ("A.012", "B", "C.3") for i in range(0, 140, 3)]
    found = discovery.pair_cases(cases(spark, *names), "CESM1-LE")
    assert values(found) == brute_force_pairs(names)


def test_pairing_covers_every_kept_case(spark):
    names = [f"{kind}.{i:03d}" for kind in ("A", "B") for i in range(1, 43)]
    glued = values(discovery.pair_cases(cases(spark, *names), "CESM1-LE"))
    assert {piece for g in glued for piece in g.split("&&")} == set(names)


def test_single_forcing_of_the_first_generation_drops_land_use(spark):
    found = discovery.pair_cases(cases(spark, "A.xghg.001", "A.xlulc.001"), "CESM1-SF")
    assert values(found) == ["A.xghg.001"]


def test_token_list_needs_an_entry(spark):
    with pytest.raises(ValueError, match="no token list"):
        discovery.keep_by_token_list(files(spark, "b.nc"), "CESM2-LE")
    kept = discovery.keep_by_token_list(files(spark, "b.OIC.nc", "b.nc"), "CESM1-LE")
    assert values(kept, "fname") == ["b.nc"]
    include = resolve_ensemble("CESM1-LE")._replace(keep_file_tokens=True)
    kept = discovery.keep_by_token_list(files(spark, "b.OIC.nc", "b.nc"), include)
    assert values(kept, "fname") == ["b.OIC.nc"]


def test_time_string_is_case_sensitive_and_optional(spark):
    listed = files(spark, "b.abc.nc", "b.ABC.nc")
    assert values(discovery.keep_timestr(listed, "abc"), "fname") == ["b.abc.nc"]
    assert discovery.keep_timestr(listed, None).count() == 2
    assert discovery.keep_timestr(listed, "NONE").count() == 2


def test_file_with_two_pieces_is_assigned_once(spark):
    listed = files(spark, "b.A.001.B.001.nc", "b.A.001.nc", "b.C.001.nc")
    found = assign.assign_files(listed, cases(spark, "A.001&&B.001"))
    assert values(found, "path") == ["/data/T/b.A.001.B.001.nc", "/data/T/b.A.001.nc"]


def test_assignment_equals_brute_force_on_whole_paths(spark):
    names = ["A.001", "A.0010&&data", "b.x", "/T/b", "zz&&A.001&&nc"]
    listed = ["b.A.001.nc", "b.A.0010.nc", "b.x.A.001.nc", "b.y.nc", "q"]
    found = assign.assign_files(files(spark, *listed), cases(spark, *names))
    expected = sorted(
        (c, f"/data/T/{f}")
        for c in names for f in listed
        if any(piece in f"/data/T/{f}" for piece in c.split("&&"))
    )
    assert sorted(map(tuple, found.collect())) == expected


def test_containment_is_by_characters_and_needs_text(spark):
    listed = files(spark, "b.Ä.é01.nc", "b.ab01.nc", "")
    found = assign.assign_files(listed, cases(spark, "é01", "Ä.é", "01.nc&&", "ab01.ncx"))
    assert sorted(map(tuple, found.collect())) == [
        ("01.nc&&", "/data/T/b.ab01.nc"), ("01.nc&&", "/data/T/b.Ä.é01.nc"),
        ("Ä.é", "/data/T/b.Ä.é01.nc"), ("é01", "/data/T/b.Ä.é01.nc"),
    ]
    assert assign.assign_files(listed, cases(spark, "x").filter("false")).count() == 0


def test_assignment_by_parsed_name(spark):
    listed = files(
        spark, "b.f09_g17.X.001.cam.nc", "b.f09_g17.X.0012.cam.nc", "b.other.nc"
    )
    found = assign.assign_files(listed, cases(spark, "X.001"), match="exact", ensemble="CESM2-LE")
    assert values(found, "path") == ["/data/T/b.f09_g17.X.001.cam.nc"]
    assert assign.assign_files(listed, cases(spark, "X.001")).count() == 2


def test_members_without_files(spark):
    found = assign.assign_files(files(spark, "b.A.001.nc"), cases(spark, "A.001", "A.002"))
    left = assign.members_without_files(cases(spark, "A.001", "A.002"), found)
    assert values(left) == ["A.002"]


def test_a_file_held_by_a_third_of_all_rows(spark):
    hot = files(spark, *(["b.A.001.nc"] * 300), *(f"b.B.{i:03d}.nc" for i in range(600)))
    found = assign.assign_files(hot, cases(spark, "A.001", *(f"B.{i:03d}" for i in range(600))))
    assert found.count() == 601


def no_nested_loops(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_containment_joins_are_hashed(spark):
    names = cases(spark, "A.001", "B.001")
    assert no_nested_loops(discovery.pair_cases(names, "CESM1-LE"))
    assert no_nested_loops(discovery.pair_cases(names, "CESM2-SF"))
    assert no_nested_loops(assign.assign_files(files(spark, "b.A.001.nc"), names))


def test_containment_equals_brute_force_for_needles_of_all_lengths(spark):
    rng = random.Random(5)
    def some(n):
        return "".join(rng.choice("abé.") for _ in range(n))
    hay = [None, "", *(some(rng.randrange(1, 40)) for _ in range(150))]
    needles = [None, "", "zzzzzzzzzz", *(some(n) for n in (1, 2, 3, 7, 8, 9, 12) for _ in range(6))]
    needles += [h[a:a + 9] for h in hay[2:60] if len(h) > 12 for a in (0, 3, len(h) - 9)]
    rows = spark.createDataFrame([(h,) for h in hay + hay[:30]], "t STRING")
    wanted = spark.createDataFrame([(n,) for n in needles + needles[:20]], "s STRING")
    found = discovery.contains_pairs(rows, "t", wanted, "s").distinct().collect()
    expected = {(h, n) for h in hay if h for n in needles if n and n in h}
    assert len(found) == len(expected)
    assert {(r.t, r.s) for r in found} == expected


def test_containment_keeps_within_its_keys(spark):
    rows = spark.createDataFrame(
        [("x", "run.001"), ("y", "run.001"), (None, "run.001"), ("y", "run.002")], "k STRING, t STRING"
    )
    wanted = spark.createDataFrame([("y", "001"), (None, "001"), ("z", "002")], "k STRING, s STRING")
    found = discovery.contains_pairs(rows, "t", wanted, "s", ["k"]).select("k", "t", "s")
    assert sorted(map(tuple, found.collect())) == [("y", "run.001", "001")]


def test_needles_that_share_common_grams_are_looked_up_by_their_rare_ones(spark):
    head = "b.e11.B20TRC5CNBDRD.f09_g16."
    hay = spark.range(3000).selectExpr(f"concat('{head}', lpad(id, 6, '0'), '.cam.h0.T.nc') AS t")
    wanted = spark.range(3000).selectExpr(f"concat('{head}', lpad(id, 6, '0')) AS s")
    found = discovery.contains_pairs(hay, "t", wanted, "s")
    assert len(found.collect()) == 3000
    plan = found._jdf.queryExecution().executedPlan()
    joined = [n for n in _nodes(plan) if n.nodeName() in ("BroadcastHashJoin", "SortMergeJoin")]
    candidates = max(n.metrics().apply("numOutputRows").value() for n in joined)
    assert 3000 <= candidates <= 4 * 3000


def _nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _nodes(plan.plan())
    children = plan.children()
    below = [_nodes(children.apply(i)) for i in range(children.size())]
    return [plan, *(n for nodes in below for n in nodes)]


def test_no_text_is_shuffled_with_the_pieces(spark):
    hay = spark.range(50).selectExpr("concat('b.e11.run.', id) AS t")
    wanted = spark.range(50).selectExpr("concat('e11.run.', id) AS s")
    plan = discovery.contains_pairs(hay, "t", wanted, "s")._jdf.queryExecution()
    cut = [n for n in _nodes(plan.sparkPlan()) if n.nodeName() == "Project" and "_gram" in
           [n.output().apply(i).name() for i in range(n.output().size())]]
    assert cut
    for node in cut:
        assert "t" not in [node.output().apply(i).name() for i in range(node.output().size())]


def test_listing_a_folder(spark, tmp_path):
    for var, name in (("T", "b1.nc"), ("T", "b1.nc.tmp"), ("T", "b1.txt"), ("PS", "b2.nc")):
        (tmp_path / var).mkdir(exist_ok=True)
        (tmp_path / var / name).write_bytes(b"x")
    found = catalog.list_files(spark, str(tmp_path), ["T", "PS"])
    assert sorted(map(tuple, found.collect())) == [
        (f"{tmp_path}/PS/b2.nc", "PS", "b2.nc"),
        (f"{tmp_path}/T/b1.nc", "T", "b1.nc"),
        (f"{tmp_path}/T/b1.nc.tmp", "T", "b1.nc.tmp"),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_case_list_without_final_newline(spark, tmp_path):
    path = tmp_path / "cases.txt"
    path.write_text("X.001\n\nX.002")
    assert values(case_list.read_case_list(spark, str(path))) == ["X.001", "X.002"]
    assert case_list.case_list_if_present(spark, str(tmp_path / "none.txt")) is None


def test_case_list_is_written_in_order(spark, tmp_path):
    path = str(tmp_path / "cases")
    case_list.write_case_list(cases(spark, "B.002", "A&&B", "A.001"), path)
    lines = [f.read_text() for f in sorted((tmp_path / "cases").glob("part-*"))]
    assert "".join(lines) == "A&&B\nA.001\nB.002\n"


def test_registry_lookups():
    assert resolve_ensemble("cesm1-le").name == "CESM1-LE"
    with pytest.raises(ValueError, match="unsupported ensemble"):
        resolve_ensemble("CESM3")
    assert data_path("CESM1-LE", "month_1").endswith("/monthly/")
    assert data_path("CESM2-LE", "month_1").endswith("/month_1/")
    assert data_path("CESM1-LE", "day_1").endswith("/day_1/")
    assert merge_mode("day_1") == "override"
    with pytest.raises(ValueError, match="hour_6"):
        merge_mode("hour_6")


def test_unregistered_ensemble_in_a_table_raises(spark):
    rows = spark.createDataFrame(
        [("CESM3", "month_1", "T", "b.nc")], "ensemble STRING, data_freq STRING, var STRING, "
        "fname STRING",
    )
    with pytest.raises(Exception, match="unsupported ensemble: CESM3"):
        resolve_paths(rows).collect()


def test_own_ensemble(spark):
    own = Ensemble("MINE", "/mine/", "", "run.", ".out.")
    names = discovery.case_names(files(spark, "b.run.7.out.T.nc"), own)
    assert values(discovery.pair_cases(names, own)) == ["7"]
    assert RunOptions(own, "month_1", ("T",)).data_path == "/mine/month_1/"
