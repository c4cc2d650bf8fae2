"""Input tables for the registered queries, derived from the given tables.

Each is one SQL text for both engines; only the names of the zone-less timestamp type and of
the function that makes rows of an array differ.
All are deterministic and read their whole table; catalogues grow up to the number of distinct names,
which is bounded for all but ``fx_catalog_runs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOUR = "cast(concat(substr(cast(ts AS STRING), 1, 13), ':00:00') AS {ntz})"

# Per-variable listing of split runs, with wrong prefixes and extensions, control runs without
# the ensemble token, OIC runs and 1XX members.
CATALOG = """
SELECT concat('/data/', var, '/', fname) AS path, var, fname FROM (
  SELECT var, concat(
    CASE WHEN o_orderkey % 13 = 0 THEN 'f.e11.' ELSE 'b.e11.' END,
    CASE o_orderkey % 4 WHEN 0 THEN 'B20TRC5CNBDRD' WHEN 1 THEN 'BRCP85C5CNBDRD'
                        WHEN 2 THEN 'B1850C5CN' ELSE 'BRCP85C5CNBDRD.OIC' END,
    '.f09_g16.', lpad(cast(o_custkey % 120 AS STRING), 3, '0'), '.cam.h0.', var, '.',
    cast(year(o_orderdate) * 100 + month(o_orderdate) AS STRING),
    CASE WHEN o_orderkey % 11 = 0 THEN '.txt' ELSE '.nc' END) AS fname
  FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'FLNT' ELSE 'PS' END AS var
        FROM {orders}) o) f
GROUP BY var, fname
"""

# Runs whose names grow in number with the customers. Letters stand for a customer's digits, but
# for some, so that a member number stands in other runs as well.
CATALOG_RUNS = """
SELECT concat('/data/', var, '/', fname) AS path, var, fname FROM (
  SELECT var, concat('b.e11.',
    CASE WHEN o_orderkey % 2 = 0 THEN 'B20TRC5CNBDRD' ELSE 'BRCP85C5CNBDRD' END, '.f09_g16.',
    CASE WHEN o_custkey % 97 = 0 THEN cast(o_custkey AS STRING)
         ELSE translate(cast(o_custkey AS STRING), '0123456789', 'abcdefghij') END,
    '.', lpad(cast(o_custkey % 1000 AS STRING), 3, '0'), '.cam.h0.', var, '.',
    cast(year(o_orderdate) * 100 + month(o_orderdate) AS STRING), '.nc') AS fname
  FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'FLNT' ELSE 'T' END AS var FROM {orders}) o) f
GROUP BY var, fname
"""

# Single-forcing runs whose scenario half carries another name; xAER is unpaired.
CATALOG_FORCING = """
SELECT concat('/data/T/', fname) AS path, 'T' AS var, fname FROM (
  SELECT concat('b.e21.B1850cmip6.f09_g17.CESM2-SF-',
    CASE o_orderkey % 5 WHEN 0 THEN 'AAER' WHEN 1 THEN 'BMB' WHEN 2 THEN 'EE'
                        WHEN 3 THEN 'GHG' ELSE 'xAER' END,
    CASE WHEN o_custkey % 2 = 0 AND o_orderkey % 5 < 4 THEN '-SSP370' ELSE '' END,
    '.', lpad(cast(o_orderkey % 17 AS STRING), 3, '0'), '.cam.h0.T.',
    cast(year(o_orderdate) AS STRING), '.nc') AS fname
  FROM {orders}) f
GROUP BY fname
"""

# Runs that leave one forcing out, of which xlulc is not used.
CATALOG_LEFT_OUT = """
SELECT concat('/data/T/', fname) AS path, 'T' AS var, fname FROM (
  SELECT concat('b.e11.',
    CASE WHEN o_orderkey % 7 = 0 THEN 'B20TRC5CNBDRD' ELSE 'B20TRLENS_RCP85' END, '.f09_g16.',
    CASE o_orderkey % 4 WHEN 0 THEN 'xaer' WHEN 1 THEN 'xbmb' WHEN 2 THEN 'xghg'
                        ELSE 'xlulc' END,
    '.', lpad(cast(o_custkey % 20 + 1 AS STRING), 3, '0'), '.cam.h0.T.',
    cast(year(o_orderdate) * 100 + month(o_orderdate) AS STRING), '.nc') AS fname
  FROM {orders}) f
GROUP BY fname
"""

# Requested files of all ensembles and frequencies.
REQUESTS = """
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'CESM2-LE' WHEN 1 THEN 'CESM2-SF'
                           WHEN 2 THEN 'CESM1-LE' ELSE 'CESM1-SF' END AS ensemble,
       CASE o_custkey % 3 WHEN 0 THEN 'month_1' WHEN 1 THEN 'day_1' ELSE 'hour_6' END AS data_freq,
       CASE o_orderstatus WHEN 'O' THEN 'T' WHEN 'F' THEN 'FLNT' ELSE 'PS' END AS var,
       concat('b.', cast(o_custkey AS STRING), '.nc') AS fname
FROM {orders}
GROUP BY 1, 2, 3, 4
"""

# A merged cube; a member lacks most cells of the others, and some fluxes are negative.
CUBE = """
SELECT event_type AS ensemble_member, %s AS time, cast(user_id %% 32 AS double) AS lat,
       cast(floor(user_id / 32) AS double) AS lon, max(value) - 1 AS FLNT
FROM {events}
GROUP BY 1, 2, 3, 4
""" % HOUR

# Two source pieces per cell that overlap and agree.
CUBE_LONG = """
SELECT ensemble_member, var, path, time, lat, lon,
       CASE WHEN path = 'piece_a' AND lat %% 2 = 0 THEN v
            WHEN path = 'piece_b' AND lat %% 3 = 0 THEN v END AS value
FROM (SELECT ensemble_member, var, time, lat, lon, v, {explode} AS path
      FROM (SELECT event_type AS ensemble_member,
                   CASE event_id %% 3 WHEN 0 THEN 'FLNT' WHEN 1 THEN 'PS' ELSE 'T' END AS var,
                   %s AS time, cast(user_id %% 8 AS double) AS lat,
                   cast(floor(user_id / 8) AS double) AS lon, max(value) AS v
            FROM {events}
            GROUP BY 1, 2, 3, 4, 5) c) p
""" % HOUR

# Cells with the file they came from: 40 members, split runs, a file per variable and day.
CELLS = """
SELECT concat('/data/', var, '/b.e11.', run, '.f09_g16.', member, '.cam.h0.', var, '.', day, '.nc')
         AS path,
       var, time, lat, lon, max(value) AS value
FROM (SELECT CASE event_id %% 3 WHEN 0 THEN 'T' ELSE 'FLNT' END AS var,
             CASE WHEN ts < cast('2024-01-16 00:00:00' AS {ntz}) THEN 'B20TRC5CNBDRD'
                  ELSE 'BRCP85C5CNBDRD' END AS run,
             lpad(cast(user_id %% 40 + 1 AS STRING), 3, '0') AS member,
             replace(substr(cast(ts AS STRING), 1, 10), '-', '') AS day,
             %s AS time, cast(floor(user_id / 40) %% 48 AS double) AS lat,
             cast(floor(user_id / 1920) AS double) AS lon, value
      FROM {events}) e
GROUP BY 1, 2, 3, 4, 5
""" % HOUR

# One vertical column per order, up to seven levels.
HYBRID = """
SELECT l_orderkey AS col_id, cast(l_linenumber AS double) AS lev, max(l_quantity) AS value,
       cast(0.005 AS double) * l_linenumber AS hyam, cast(0.135 AS double) * l_linenumber AS hybm,
       cast(95000 + (l_orderkey % 100) * 100 AS double) AS ps
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber
"""

# Cells of variables on grids of their own: T has levels, PS and FLNT have none, and the
# coefficients have nothing but levels. Some columns lack PS, and T comes in two agreeing pieces.
GRID_CELLS = """
SELECT ensemble_member, var, path, time, lev, lat, lon, max(value) AS value FROM (
  SELECT ensemble_member, 'T' AS var, piece AS path, time, lev, lat, lon, value
  FROM (SELECT *, {explode} AS piece FROM {columns}) t
  UNION ALL
  SELECT ensemble_member, 'PS', 'piece_a', time, cast(NULL AS double), lat, lon, ps
  FROM {columns} WHERE col_id % 13 > 0
  UNION ALL
  SELECT ensemble_member, 'FLNT', 'piece_a', time, cast(NULL AS double), lat, lon, value * 5
  FROM {columns}
  UNION ALL
  SELECT ensemble_member, 'hyam', 'piece_a', cast(NULL AS {ntz}), lev, cast(NULL AS double),
         cast(NULL AS double), cast(0.005 AS double) * lev FROM {columns}
  UNION ALL
  SELECT ensemble_member, 'hybm', 'piece_a', cast(NULL AS {ntz}), lev, cast(NULL AS double),
         cast(NULL AS double), cast(0.135 AS double) * lev FROM {columns}) c
GROUP BY ensemble_member, var, path, time, lev, lat, lon
""".replace("{columns}", """(
  SELECT l_orderkey AS col_id, concat('m', cast(l_orderkey % 4 AS STRING)) AS ensemble_member,
         cast('2000-01-01 00:00:00' AS {ntz}) AS time, cast(l_linenumber AS double) AS lev,
         cast(l_orderkey % 90 AS double) AS lat, cast(floor(l_orderkey / 90) AS double) AS lon,
         cast(max(l_quantity) AS double) AS value,
         cast(95000 + (l_orderkey % 100) * 100 AS double) AS ps
  FROM {lineitem} GROUP BY l_orderkey, l_linenumber) x""")

# Preprocessing arguments as text, some with a repeated key.
KWARGS = """
SELECT event_id, concat('DATALEV&&', cast(user_id AS STRING), '_KIND&&', event_type,
                        CASE WHEN event_id % 5 = 0 THEN '_DATALEV&&250' ELSE '' END) AS s
FROM {events}
"""

FIXTURES = {
    "fx_catalog": CATALOG,
    "fx_catalog_runs": CATALOG_RUNS,
    "fx_catalog_forcing": CATALOG_FORCING,
    "fx_catalog_left_out": CATALOG_LEFT_OUT,
    "fx_requests": REQUESTS,
    "fx_cube": CUBE,
    "fx_cube_long": CUBE_LONG,
    "fx_cells": CELLS,
    "fx_hybrid": HYBRID,
    "fx_grid_cells": GRID_CELLS,
    "fx_kwargs": KWARGS,
}
TABLES = ("orders", "events", "lineitem")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a Spark table, read from the Parquet files in ``sf_dir``."""
    text = FIXTURES[name].replace("{ntz}", "TIMESTAMP_NTZ")
    text = text.replace("{explode}", "explode(array('piece_a', 'piece_b'))")
    used = [t for t in TABLES if "{%s}" % t in text]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(text, **tables)


def fixture_sql(name: str) -> str:
    """The same fixture in standard SQL over the plain table names."""
    text = FIXTURES[name].replace("{ntz}", "TIMESTAMP")
    text = text.replace("{explode}", "unnest(['piece_a', 'piece_b'])")
    for t in TABLES:
        text = text.replace("{%s}" % t, t)
    return text
