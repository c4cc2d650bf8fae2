import duckdb
import pandas as pd
import pytest

import check
from __spark_entry__ import entry
from isospread.plans.oracles import ORACLES
from isospread.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    mine = check.normal(found.toPandas())
    theirs = check.normal(duck.execute(ORACLES[name]).df())
    assert len(mine) > 0
    pd.testing.assert_frame_equal(mine, theirs, check_dtype=False, rtol=0, atol=1e-9)

    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in ("apply_per_member_pandas", "apply_groups_below_maximum", "apply_running_mean"):
        assert "Python" not in plan and "Pandas" not in plan


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["ensemble_member", "time", "lat", "lon", "FLNT", "TBRT"]
    assert found.count() > 0
