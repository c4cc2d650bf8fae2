"""Standard SQL that gives the same rows as each registered query."""

from __future__ import annotations

from isospread.plans.fixtures import fixture_sql

LE_NAMES = """
  SELECT DISTINCT split_part(split_part(fname, 'b.e11.', 2), '.cam.', 1) AS c
  FROM {fx} WHERE {where} fname LIKE 'b%' AND contains(fname, '.nc')
    AND contains(fname, 'C5CNBDRD')
"""


def _le_cases(fx: str) -> str:
    """CTEs up to ``cases(casename)``: case names of ``fx`` glued by member number."""
    names = LE_NAMES.format(fx=fx, where="var = 'T' AND")
    return f"""
    names AS ({names}),
    kept AS (SELECT c FROM names WHERE NOT contains(c, 'OIC')),
    numbers AS (SELECT DISTINCT right(c, 3) AS n FROM kept WHERE NOT starts_with(right(c, 3), '1')),
    cases AS (SELECT DISTINCT string_agg(c, '&&' ORDER BY c) AS casename FROM (
      SELECT n, c FROM numbers JOIN kept ON contains(c, n)) p GROUP BY n)"""


def _assigned(files: str) -> str:
    return f"""
    pieces AS (SELECT casename, unnest(string_split(casename, '&&')) AS piece FROM cases),
    case_files AS (SELECT DISTINCT casename, path FROM {files} JOIN pieces ON contains(path, piece))"""


def _with(fixtures: list[str], body: str) -> str:
    ctes = ", ".join(f"{name} AS ({fixture_sql(name)})" for name in fixtures)
    return f"WITH {ctes} {body}"


def _one(fx: str, body: str) -> str:
    return _with([fx], body)


TBRT = "round(CASE WHEN FLNT >= 0 THEN pow(FLNT / 5.67e-8, 0.25) END, 6)"
CELL = "ensemble_member, time, lat, lon"
CELL_FILES = "files AS (SELECT DISTINCT path, var, split_part(path, '/', 4) AS fname FROM fx_cells)"

_MAX_PER_VARIABLE = ", ".join(
    f"max(CASE WHEN var = '{v}' THEN value END) AS {v}" for v in ("FLNT", "PS", "T")
)
_FIRST_PER_VARIABLE = ", ".join(
    f"max(CASE WHEN var = '{v}' AND path = 'piece_a' THEN value END) AS {v}"
    for v in ("FLNT", "PS", "T")
)
# Fixed values, written out here so that a wrong path in the registry shows.
_REGISTRY = """
    ('CESM2-LE', '/glade/campaign/cgd/cesm/CESM2-LE/timeseries/atm/proc/tseries/'),
    ('CESM2-SF', '/glade/campaign/cesm/collections/CESM2-SF/timeseries/atm/proc/tseries/'),
    ('CESM1-LE', '/glade/campaign/cesm/collections/cesmLE/CESM-CAM5-BGC-LE/atm/proc/tseries/'),
    ('CESM1-SF', '/glade/campaign/cesm/collections/cesmLE/CESM-CAM5-BGC-LE/atm/proc/tseries/')
"""

_LEVELS = ", ".join(f"({p}.0)" for p in (1000, 925, 850, 700, 500, 400, 300, 250, 200, 150, 100))
_INTERPOLATED = f"""
, nodes AS (SELECT col_id, value, hyam * 100000 + hybm * ps AS p FROM fx_hybrid),
segments AS (SELECT col_id, p AS p0, value AS v0,
    lead(p) OVER (PARTITION BY col_id ORDER BY p) AS p1,
    lead(value) OVER (PARTITION BY col_id ORDER BY p) AS v1 FROM nodes),
levels(plev) AS (VALUES {_LEVELS}),
wanted AS (SELECT col_id, cast(plev AS DOUBLE) AS plev
    FROM (SELECT DISTINCT col_id FROM nodes) c, levels),
found AS (SELECT col_id, plev, CASE WHEN plev * 100 = p0 THEN v0
      ELSE v0 + (plev * 100 - p0) * (v1 - v0) / (p1 - p0) END AS value
    FROM segments JOIN (SELECT cast(plev AS DOUBLE) AS plev FROM levels) l
      ON plev * 100 = p0 OR (plev * 100 > p0 AND plev * 100 < p1))
SELECT w.col_id, w.plev, round(f.value, 6) AS value
FROM wanted w LEFT JOIN found f ON w.col_id = f.col_id AND w.plev = f.plev
"""

# The columns of ``fx_grid_cells`` without the grids: one row for each level of an order.
_MEMBER_COLUMNS = """
fx_member AS (SELECT l_orderkey AS col_id, cast(l_linenumber AS DOUBLE) AS lev,
    cast(max(l_quantity) AS DOUBLE) AS value,
    cast(0.005 AS DOUBLE) * l_linenumber AS hyam, cast(0.135 AS DOUBLE) * l_linenumber AS hybm,
    CASE WHEN l_orderkey % 13 > 0 THEN cast(95000 + (l_orderkey % 100) * 100 AS DOUBLE) END AS ps
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
_MEMBER_CELL = """'m' || cast({0} % 4 AS VARCHAR) AS ensemble_member,
    TIMESTAMP '2000-01-01 00:00:00' AS time, cast({0} % 90 AS DOUBLE) AS lat,
    cast(floor({0} / 90) AS DOUBLE) AS lon"""

ORACLES = {
    "merge_mixed_grids": f"""WITH {_MEMBER_COLUMNS}
        SELECT {_MEMBER_CELL.format('col_id')}, lev, value AS T, ps AS PS FROM fx_member""",
    "brightness_mixed_grids": f"""WITH {_MEMBER_COLUMNS}
        SELECT *, {TBRT} AS TBRT FROM (SELECT {_MEMBER_CELL.format('col_id')}, max(value) * 5 AS FLNT
          FROM fx_member GROUP BY col_id) c""",
    "remap_from_member": f"WITH {_MEMBER_COLUMNS}"
    + _INTERPOLATED.replace("fx_hybrid", "fx_member").replace(
        "SELECT w.col_id, w.plev, round(f.value, 6) AS value",
        f"SELECT {_MEMBER_CELL.format('w.col_id')}, w.plev, round(f.value, 6) AS T",
    ),
    "catalog_scan": _one(
        "fx_catalog", "SELECT * FROM fx_catalog WHERE var = 'T' AND contains(fname, '.nc')"
    ),
    "catalog_by_variable": _one(
        "fx_catalog",
        "SELECT * FROM fx_catalog WHERE var IN ('FLNT', 'PS') AND contains(fname, '.nc')",
    ),
    "catalog_counts": _one(
        "fx_catalog",
        """SELECT var, count(*) AS n_files,
             count(DISTINCT split_part(split_part(fname, 'b.e11.', 2), '.cam.', 1)) AS n_cases
           FROM fx_catalog WHERE fname LIKE 'b%' AND contains(fname, '.nc')
             AND contains(fname, 'C5CNBDRD') GROUP BY var""",
    ),
    "filter_extension": _one(
        "fx_catalog", "SELECT * FROM fx_catalog WHERE contains(fname, '.nc')"
    ),
    "filter_prefix": _one("fx_catalog", "SELECT * FROM fx_catalog WHERE fname[1] = 'b'"),
    "filter_ensemble_token": _one(
        "fx_catalog", "SELECT * FROM fx_catalog WHERE contains(fname, 'C5CNBDRD')"
    ),
    "filter_exclude_sf": _one(
        "fx_catalog_left_out",
        """SELECT DISTINCT casename FROM (
             SELECT split_part(split_part(fname, 'b.e11.', 2), '.cam.', 1) AS casename
             FROM fx_catalog_left_out WHERE fname LIKE 'b%' AND contains(fname, '.nc')
               AND contains(fname, 'TRLENS_RCP85')) c
           WHERE NOT contains(casename, 'xlulc')""",
    ),
    "filter_token_list": _one(
        "fx_catalog",
        """SELECT * FROM fx_catalog WHERE NOT (contains(fname, 'OIC') OR contains(fname, 'xaer')
             OR contains(fname, 'xbmb') OR contains(fname, 'xghg') OR contains(fname, 'xlulc'))""",
    ),
    "filter_timestr": _one("fx_catalog", "SELECT * FROM fx_catalog WHERE contains(path, '199503')"),
    "case_names": _one(
        "fx_catalog",
        "SELECT c AS casename FROM (" + LE_NAMES.format(fx="fx_catalog", where="") + ") n",
    ),
    "case_number": _one(
        "fx_catalog",
        "SELECT c AS casename, right(c, 3) AS number FROM ("
        + LE_NAMES.format(fx="fx_catalog", where="") + ") n",
    ),
    "pair_cases_le": _one("fx_catalog", f", {_le_cases('fx_catalog')} SELECT casename FROM cases"),
    "pair_cases_sf": _one(
        "fx_catalog_forcing",
        """, names AS (SELECT DISTINCT split_part(split_part(fname, 'f09_g17.', 2), '.cam.', 1) AS c
             FROM fx_catalog_forcing WHERE fname LIKE 'b%' AND contains(fname, '.nc')),
           kept AS (SELECT f, c FROM names JOIN (VALUES ('AAER'), ('BMB'), ('EE'), ('GHG')) v(f)
             ON contains(c, f)),
           numbers AS (SELECT DISTINCT f, right(c, 3) AS n FROM kept)
           SELECT DISTINCT casename FROM (
             SELECT string_agg(c, '&&' ORDER BY c) AS casename
             FROM numbers JOIN kept USING (f) WHERE contains(c, n) GROUP BY f, n
             UNION ALL SELECT c FROM names WHERE contains(c, 'xAER')) u""",
    ),
    "pair_cases_runs": _one(
        "fx_catalog_runs", f", {_le_cases('fx_catalog_runs')} SELECT casename FROM cases"
    ),
    "pair_cases_exact": _one(
        "fx_catalog",
        "SELECT string_agg(c, '&&' ORDER BY c) AS casename FROM ("
        + LE_NAMES.format(fx="fx_catalog", where="")
        + """) n WHERE NOT contains(c, 'OIC') AND NOT starts_with(right(c, 3), '1')
           GROUP BY right(c, 3)""",
    ),
    "case_list_roundtrip": _one(
        "fx_catalog", f", {_le_cases('fx_catalog')} SELECT casename FROM cases"
    ),
    "resolve_paths": _one(
        "fx_requests",
        f"""SELECT r.*, base || CASE WHEN ensemble LIKE 'CESM1-%' AND data_freq = 'month_1'
               THEN 'monthly' ELSE data_freq END || '/' || var || '/' || fname AS path
            FROM fx_requests r JOIN (VALUES {_REGISTRY}) v(name, base) ON name = ensemble""",
    ),
    "assign_files": _one(
        "fx_catalog",
        f""", {_le_cases('fx_catalog')},
            files AS (SELECT * FROM fx_catalog WHERE contains(fname, '.nc')), {_assigned('files')}
            SELECT * FROM case_files""",
    ),
    "assign_files_runs": _one(
        "fx_catalog_runs",
        f""", {_le_cases('fx_catalog_runs')}, {_assigned('fx_catalog_runs')}
            SELECT * FROM case_files""",
    ),
    "assign_files_exact": _one(
        "fx_catalog",
        f""", {_le_cases('fx_catalog')},
            pieces AS (SELECT casename, unnest(string_split(casename, '&&')) AS piece FROM cases)
            SELECT DISTINCT casename, path FROM fx_catalog JOIN pieces
              ON piece = split_part(split_part(fname, 'b.e11.', 2), '.cam.', 1)
            WHERE contains(fname, '.nc') AND contains(fname, 'b.e11.')""",
    ),
    "files_per_case": _one(
        "fx_catalog",
        f""", {_le_cases('fx_catalog')},
            files AS (SELECT * FROM fx_catalog WHERE contains(fname, '.nc')), {_assigned('files')}
            SELECT casename, count(*) AS n_files FROM case_files GROUP BY casename""",
    ),
    "members_without_files": _one(
        "fx_catalog",
        f""", {_le_cases('fx_catalog')},
            files AS (SELECT * FROM fx_catalog
                      WHERE contains(fname, '.nc') AND contains(path, '199503')),
            {_assigned('files')}
            SELECT casename FROM cases WHERE casename NOT IN (SELECT casename FROM case_files)""",
    ),
    "member_scan": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, fx_cells.*
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path""",
    ),
    "member_scan_pruned": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, fx_cells.*
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path""",
    ),
    "member_sink_rerun": _one(
        "fx_cube",
        f"""SELECT {CELL}, CASE WHEN ensemble_member < 'l' THEN FLNT * 2 ELSE FLNT END AS FLNT,
              {TBRT} AS TBRT FROM fx_cube""",
    ),
    "overlapping_pieces": _one(
        "fx_cube_long",
        """, spans AS (SELECT ensemble_member, var, path, min(time) AS first_time,
               max(time) AS last_time FROM fx_cube_long GROUP BY ALL)
           SELECT a.*, max(b.last_time) AS covered_until FROM spans a JOIN spans b
             ON a.ensemble_member = b.ensemble_member AND a.var = b.var
               AND (b.first_time, b.path) < (a.first_time, a.path)
           GROUP BY ALL HAVING a.first_time <= max(b.last_time)""",
    ),
    "concat_time_pieces": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, var, time, lat, lon, value
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path""",
    ),
    "merge_no_conflicts": _one(
        "fx_cube_long", f"SELECT {CELL}, {_MAX_PER_VARIABLE} FROM fx_cube_long GROUP BY {CELL}"
    ),
    "merge_conflict_check": _one(
        "fx_cube_long",
        f"""SELECT a.ensemble_member, a.var, a.time, a.lat, a.lon,
              a.value AS min_value, a.value + 1 AS max_value
            FROM fx_cube_long a WHERE path = 'piece_a' AND lat = 6 AND value IS NOT NULL""",
    ),
    "merge_override": _one(
        "fx_cube_long", f"SELECT {CELL}, {_FIRST_PER_VARIABLE} FROM fx_cube_long GROUP BY {CELL}"
    ),
    "first_n_timesteps": _one(
        "fx_cube",
        """SELECT * EXCLUDE (step) FROM (SELECT *, dense_rank() OVER (
             PARTITION BY ensemble_member ORDER BY time) AS step FROM fx_cube) r
           WHERE step <= 10""",
    ),
    "first_n_members": _one(
        "fx_cube",
        """SELECT * FROM fx_cube WHERE ensemble_member IN (
             SELECT DISTINCT ensemble_member FROM fx_cube ORDER BY 1 LIMIT 2)""",
    ),
    "subset_time_space": _one(
        "fx_cube",
        """SELECT * FROM fx_cube WHERE time BETWEEN TIMESTAMP '2024-01-05 00:00:00'
             AND TIMESTAMP '2024-01-20 00:00:00' AND lat BETWEEN 4 AND 20""",
    ),
    "resample_time": _one(
        "fx_cube",
        """SELECT ensemble_member, cast(date_trunc('day', time) AS TIMESTAMP) AS time, lat, lon,
             round(avg(FLNT), 6) AS FLNT FROM fx_cube GROUP BY 1, 2, 3, 4""",
    ),
    "resample_space": _one(
        "fx_cube",
        """SELECT ensemble_member, time, floor(lat / 4) * 4 AS lat, floor(lon / 2) * 2 AS lon,
             round(avg(FLNT), 6) AS FLNT FROM fx_cube GROUP BY 1, 2, 3, 4""",
    ),
    "skip_preprocess_identity": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, time, lat, lon, value AS FLNT
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path WHERE var = 'FLNT'""",
    ),
    "parse_kwargs": _one(
        "fx_kwargs",
        """SELECT event_id, 'DATALEV' AS key, CASE WHEN event_id % 5 = 0 THEN '250'
             ELSE split_part(split_part(s, '_', 1), '&&', 2) END AS value FROM fx_kwargs
           UNION ALL
           SELECT event_id, 'KIND', upper(split_part(split_part(s, '_', 2), '&&', 2))
           FROM fx_kwargs""",
    ),
    "brightness_temperature": _one("fx_cube", f"SELECT {CELL}, FLNT, {TBRT} AS TBRT FROM fx_cube"),
    "apply_per_member": _one(
        "fx_cube",
        f"""SELECT *, {TBRT} AS TBRT FROM (
              SELECT {CELL}, FLNT * 2 AS FLNT FROM fx_cube WHERE lat BETWEEN 8 AND 90) c""",
    ),
    "apply_per_member_pandas": _one("fx_cube", f"SELECT {CELL}, FLNT, {TBRT} AS TBRT FROM fx_cube"),
    "apply_running_mean": _one(
        "fx_cube",
        """SELECT ensemble_member, time, lat, lon, round(avg(FLNT) OVER (
             PARTITION BY ensemble_member, lat, lon ORDER BY time ROWS 2 PRECEDING), 6) AS FLNT
           FROM fx_cube""",
    ),
    "pressure_from_hybrid": _one(
        "fx_hybrid",
        """SELECT col_id, lev, value, round(hyam * 100000 + hybm * ps, 6) AS pressure
           FROM fx_hybrid""",
    ),
    "interp_to_pressure": _one("fx_hybrid", _INTERPOLATED),
    "remap_hybrid_to_pressure": _one("fx_hybrid", _INTERPOLATED),
    "member_sink": _one("fx_cube", f"SELECT {CELL}, FLNT, {TBRT} AS TBRT FROM fx_cube"),
    "output_names": _one(
        "fx_catalog",
        f""", {_le_cases('fx_catalog')}
            SELECT casename, 'CESM1-LE_' || casename || '_month_1_tbrt_.nc' AS member_file,
              'CESM1-LE_' || casename || '_month_1_tbrt_199503_TESTINGMODE.nc' AS test_file,
              'CESM1-LE_month_1_tbrt_' || (SELECT count(*) FROM cases) || 'members_.nc'
                AS combined_file FROM cases""",
    ),
    "concat_members": _one("fx_cube", f"SELECT {CELL}, FLNT, {TBRT} AS TBRT FROM fx_cube"),
    "concat_members_dense": _one(
        "fx_cube",
        """, m AS (SELECT DISTINCT ensemble_member FROM fx_cube),
             k AS (SELECT DISTINCT time, lat, lon FROM fx_cube)
           SELECT m.ensemble_member, k.time, k.lat, k.lon, c.FLNT
           FROM m CROSS JOIN k LEFT JOIN fx_cube c ON c.ensemble_member = m.ensemble_member
             AND c.time = k.time AND c.lat = k.lat AND c.lon = k.lon""",
    ),
    "ensemble_brightness": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, time, lat, lon, value AS FLNT,
              round(pow(value / 5.67e-8, 0.25), 6) AS TBRT
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path WHERE var = 'FLNT'""",
    ),
    "run_ensemble_combined": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')}
            SELECT casename AS ensemble_member, time, lat, lon, value AS FLNT,
              round(pow(value / 5.67e-8, 0.25), 6) AS TBRT
            FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path WHERE var = 'FLNT'""",
    ),
    "apply_groups_below_maximum": _one(
        "fx_cube",
        """SELECT ensemble_member, time, lat, lon,
             FLNT - max(FLNT) OVER (PARTITION BY ensemble_member, lat, lon) AS FLNT FROM fx_cube""",
    ),
    "merge_conflict_check_numbered": _one(
        "fx_cube_long",
        f"""SELECT a.ensemble_member, a.var, a.time, a.lat, a.lon,
              a.value AS min_value, a.value + 1 AS max_value
            FROM fx_cube_long a WHERE path = 'piece_a' AND lat = 6 AND value IS NOT NULL""",
    ),
    "ensemble_brightness_test": _one(
        "fx_cells",
        f""", {CELL_FILES}, {_le_cases('files')}, {_assigned('files')},
            ranked AS (SELECT casename AS ensemble_member, time, lat, lon, value AS FLNT,
                dense_rank() OVER (PARTITION BY casename ORDER BY time) AS step
              FROM fx_cells JOIN case_files ON fx_cells.path = case_files.path
              WHERE var = 'FLNT'
                AND casename IN (SELECT casename FROM cases ORDER BY casename LIMIT 2))
            SELECT {CELL}, FLNT, round(pow(FLNT / 5.67e-8, 0.25), 6) AS TBRT
            FROM ranked WHERE step <= 10""",
    ),
}
