import numpy as np
import pytest
from pyspark.sql import functions as F

from isospread.functions.physics import STANDARD_LEVELS_HPA
from isospread.operators import vertical

SCHEMA = "col LONG, pressure DOUBLE, x DOUBLE"


def interpolated(spark, nodes, levels):
    df = spark.createDataFrame(nodes, SCHEMA)
    found = vertical.interp_to_pressure(df, ["col"], "x", levels_hpa=levels)
    rows = found.collect()
    assert len(rows) == len({(r.col, r.plev) for r in rows})
    return {(r.col, r.plev): r.x for r in rows}


def test_edges_of_the_column(spark):
    nodes = [(1, 10000.0, 1.0), (1, 20000.0, 3.0), (1, 50000.0, 9.0)]
    found = interpolated(spark, nodes, [50, 100, 150, 200, 500, 600])
    assert found == {
        (1, 50.0): None, (1, 100.0): 1.0, (1, 150.0): 2.0,
        (1, 200.0): 3.0, (1, 500.0): 9.0, (1, 600.0): None,
    }


def test_odd_columns(spark):
    nodes = [
        (1, 30000.0, 4.0),
        (2, 10000.0, None), (2, 20000.0, float("nan")), (2, None, 1.0),
        (3, 10000.0, 0.0), (3, 20000.0, None), (3, 30000.0, 2.0),
        (4, 10000.0, 8.0), (4, 10000.0, 2.0), (4, 30000.0, 4.0), (4, 30000.0, 7.0),
    ]
    found = interpolated(spark, nodes, [100, 200, 300])
    assert found == {
        (1, 100.0): None, (1, 200.0): None, (1, 300.0): 4.0,
        (2, 100.0): None, (2, 200.0): None, (2, 300.0): None,
        (3, 100.0): 0.0, (3, 200.0): 1.0, (3, 300.0): 2.0,
        (4, 100.0): 2.0, (4, 200.0): 3.0, (4, 300.0): 4.0,
    }


def test_equals_numpy_on_random_columns(spark):
    rng = np.random.default_rng(5)
    nodes, expected = [], {}
    for col in range(60):
        n = int(rng.integers(1, 30))
        p = np.sort(rng.choice(np.arange(5000, 110000, 500), n, replace=False)).astype(float)
        x = rng.normal(size=n)
        nodes += [(col, float(a), float(b)) for a, b in zip(p, x)]
        nodes += [(col, float(p[0]), float(x[0]))] * int(rng.integers(0, 3))
        for level in STANDARD_LEVELS_HPA:
            outside = level * 100 < p[0] or level * 100 > p[-1]
            expected[col, float(level)] = None if outside else np.interp(level * 100.0, p, x)
    rng.shuffle(nodes)
    nodes = [(int(c), float(p), float(x)) for c, p, x in nodes]
    found = interpolated(spark, nodes, STANDARD_LEVELS_HPA)
    assert found.keys() == expected.keys()
    for key, want in expected.items():
        assert found[key] == (None if want is None else pytest.approx(want, abs=1e-12))


def test_one_long_column(spark):
    nodes = spark.range(50_000).select(
        F.lit(1).cast("long").alias("col"),
        (F.col("id") * 2.5).alias("pressure"), (F.col("id") * 5.0).alias("x"),
    )
    found = vertical.interp_to_pressure(nodes, ["col"], "x")
    assert {(r.plev, r.x) for r in found.collect()} == {
        (float(p), p * 200.0) for p in STANDARD_LEVELS_HPA
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_pressure_and_remap(spark):
    coefficients = spark.createDataFrame(
        [(1.0, 0.1, 0.0), (2.0, 0.1, 0.4), (3.0, 0.0, 1.0)], "lev DOUBLE, hyam DOUBLE, hybm DOUBLE"
    )
    cube = spark.createDataFrame(
        [(c, k, float(k * 10)) for c in (1, 2) for k in (1.0, 2.0, 3.0)],
        "col LONG, lev DOUBLE, x DOUBLE",
    )
    ps = spark.createDataFrame([(1, 100000.0), (2, 90000.0)], "col LONG, ps DOUBLE")
    placed = vertical.pressure_from_hybrid(cube, coefficients, ps, ["col"])
    got = {(r.col, r.lev): r.pressure for r in placed.collect()}
    assert got[1, 1.0] == 10000.0 and got[1, 2.0] == 50000.0 and got[2, 3.0] == 90000.0

    levels = vertical.remap_hybrid_to_pressure(cube, coefficients, ps, ["col"], "x")
    assert levels.schema["plev"].metadata == {"long_name": "pressure", "units": "hPa"}
    assert "lev" not in levels.columns
    values = {(r.col, r.plev): r.x for r in levels.collect()}
    assert len(values) == 22
    assert values[1, 1000.0] == 30.0 and values[1, 500.0] == 20.0 and values[1, 100.0] == 10.0
    assert values[2, 1000.0] is None
    # At a native level the native value comes back.
    assert values[1, 300.0] == pytest.approx(15.0)


def test_no_join_with_the_levels(spark):
    nodes = spark.createDataFrame([(1, 1.0, 1.0)], SCHEMA)
    plan = vertical.interp_to_pressure(nodes, ["col"], "x")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text
