from types import SimpleNamespace

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import queries
from isospread.plans.oracles import ORACLES
from isospread.sources import storage
from isospread.sources.storage import settle, shared_dir

REFUSE = "spark.sql.legacy.setCommandRejectsSparkCoreConfs"
FOLDER = "spark.checkpoint.dir"


def cluster(spark, named, warehouse, **others):
    """The session as code on a cluster sees it, with settings of its own."""
    context = SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None, defaultParallelism=4,
        applicationId=spark.sparkContext.applicationId,
    )
    conf = {FOLDER: named, "spark.sql.warehouse.dir": str(warehouse)}
    kept = {"_jvm": spark._jvm, "_jsc": spark._jsc, "range": spark.range, "read": spark.read}
    return SimpleNamespace(sparkContext=context, conf=conf, **(kept | others))


@pytest.fixture
def on_cluster(spark, monkeypatch, tmp_path):
    """The session itself with a cluster's master and a folder named without a scheme."""
    before = spark.conf.get(FOLDER, None)
    spark.conf.set(REFUSE, "false")
    spark.conf.set(FOLDER, str(tmp_path / "shared"))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    yield tmp_path / "shared"
    if before is None:
        spark.conf.unset(FOLDER)
    else:
        spark.conf.set(FOLDER, before)
    spark.conf.unset(REFUSE)


def test_a_cluster_settles_in_a_local_folder_that_all_share(spark, on_cluster):
    settled = settle(spark.range(0, 1_000, 1, 5))
    assert sorted(r.id for r in settled.collect()) == list(range(1_000))
    assert [p.name.split("-")[0] for p in on_cluster.iterdir()] == ["settled"]  # no probe is left


def test_without_a_folder_a_cluster_uses_the_warehouse(spark, tmp_path):
    assert shared_dir(cluster(spark, None, tmp_path)) == f"{tmp_path}/isospread-scratch"


def test_a_folder_that_cannot_be_written_gives_way_to_the_warehouse(spark, tmp_path):
    (tmp_path / "file").write_text("")
    found = shared_dir(cluster(spark, str(tmp_path / "file"), tmp_path))
    assert found == f"{tmp_path}/isospread-scratch"


def test_folders_that_lose_files_are_refused(spark, tmp_path):
    def lost(start, end, step, tasks):  # as the driver sees it where executors have other disks
        return spark.range(start, end, step, tasks).where("id % 2 = 0")

    with pytest.raises(RuntimeError, match="share none"):
        shared_dir(cluster(spark, str(tmp_path / "own"), tmp_path / "w", range=lost))


def test_executors_of_a_local_cluster_are_no_local_session(spark, tmp_path):
    session = cluster(spark, None, tmp_path)
    session.sparkContext.master = "local-cluster[2,1,1024]"
    assert shared_dir(session) == f"{tmp_path}/isospread-scratch"


def test_a_named_scheme_is_taken_as_it_is(spark, tmp_path):
    named = f"file://{tmp_path}/mounted"
    assert shared_dir(cluster(spark, named, tmp_path)) == named
    assert not (tmp_path / "mounted").exists()


def test_a_folder_is_tried_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_SHARED", {})
    for _ in range(2):
        assert shared_dir(cluster(spark, str(tmp_path), tmp_path / "w")) == str(tmp_path)
    assert len(storage._SHARED) == 1


# queries that settle tables


def texts(rows, n, seed):
    """``id`` and ``text``, of which each eleventh is a copy of the row five before."""
    numbered = rows.withColumn("of", F.when(F.col("id") % 11 == 7, F.col("id") - 5).otherwise(F.col("id")))
    word = lambda i: F.concat(
        F.lower(F.conv(F.abs(F.xxhash64("of", i, F.lit(seed))) % 900, 10, 26)), F.lit("a")
    )
    return numbered.select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), word), " ").alias("text"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables of rows made here."""
    folder = tmp_path_factory.mktemp("tables")
    rows, day = spark.range(600), "TIMESTAMP_NTZ '1995-01-01 00:00:00'"
    made = {
        "orders": rows.selectExpr(
            "id AS o_orderkey", "id * 7 % 130 AS o_custkey", "substr('OFP', int(id % 3) + 1, 1) AS o_orderstatus",
            f"timestampadd(DAY, int(id * 11 % 90), {day}) AS o_orderdate",
        ),
        "lineitem": rows.selectExpr(
            "id div 4 AS l_orderkey", "int(id % 4) + 1 AS l_linenumber", "double(id % 50) AS l_quantity"
        ),
        "events": rows.selectExpr(
            "id AS event_id", "timestampadd(HOUR, int(id * 13 % 700), TIMESTAMP_NTZ '2024-01-01 00:10:00') AS ts",
            "id * 3 % 200 AS user_id", "element_at(array('click', 'error', 'view'), int(id % 3) + 1) AS event_type",
            "double(id % 97) AS value",
        ),
        "documents": texts(spark.range(80), 60, 1).selectExpr(
            "id AS doc_id", "text", "'en' AS lang", "concat('s', id % 3) AS source", "length(text) AS n_chars"
        ),
        "labels": spark.range(0, 80, 2).selectExpr(
            "id AS doc_id", "int(id % 3 = 0) AS quality", "int(id % 4 = 0) AS toxic"
        ),
        "benchmark": texts(spark.range(5), 40, 2).selectExpr("id AS item_id", "text"),
        "conversations": texts(spark.range(90), 12, 3).selectExpr(
            "id div 6 AS conv_id", "id % 6 AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "text"
        ),
    }
    for name, table in made.items():
        table.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def normal(df):
    lists = [c for c in df.columns if df[c].map(lambda v: isinstance(v, list)).any()]
    return check.normal(df.assign(**{c: df[c].map(str) for c in lists}))


QUERIES_THAT_SETTLE = [
    "op1_mix_sources",
    "op3_toxicity",
    "op8_jaccard_join",
    "op11_align_tokenizers",
    "op12_conversation_repair",
    "op13_sketch_near_copies",
    "assign_files",
    "assign_files_exact",
    "assign_files_runs",
    "case_list_roundtrip",
    "concat_members",
    "concat_members_dense",
    "ensemble_brightness",
    "concat_time_pieces",
    "ensemble_brightness_test",
    "first_n_timesteps",
    "files_per_case",
    "member_scan",
    "member_scan_pruned",
    "member_sink",
    "member_sink_rerun",
    "members_without_files",
    "output_names",
    "merge_override",
    "overlapping_pieces",
    "pair_cases_le",
    "pair_cases_runs",
    "pressure_from_hybrid",
    "pair_cases_sf",
    "remap_hybrid_to_pressure",
]


@pytest.mark.parametrize("name", QUERIES_THAT_SETTLE)
def test_a_query_gives_its_rows_on_a_cluster(spark, tables, on_cluster, monkeypatch, name):
    found = queries()[name](spark, tables).toPandas()
    assert len(found) and list(on_cluster.iterdir())
    if name in ORACLES:
        duck = duckdb.connect()
        for table in ("orders", "lineitem", "events"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet/*.parquet'")
        expected = duck.execute(ORACLES[name]).df()
    else:
        monkeypatch.setattr(spark.sparkContext, "master", "local[4]")
        expected = queries()[name](spark, tables).toPandas()
    pd.testing.assert_frame_equal(normal(found), normal(expected), check_dtype=False, rtol=0, atol=1e-9)
