"""The same queries as plain SQL over the source tables, for another engine.

Written independently of the DataFrame code where the two could share a
mistake: cells come from rounding cube coordinates, polygons from counting
crossings per edge, centroids from wide sums of whole units of 2^-47 degrees.
"""

import re

from incidentlens.plans.fixture import CORRECTIONS_SQL, RAW_RECORDS_SQL, RING_STEPS, VERTICES_SQL
from incidentlens.plans.queries import BOROUGH, CATEGORY, CONCAVE_RING, LONG_RING, PRECINCT, RINGS, WINDOW_BOX, WINDOW_DATES
from incidentlens.schema import (
    BOROUGH_NAMES,
    CATEGORY_COLOURS,
    CATEGORY_LABELS,
    DOUBLE_COLUMNS,
    INTEGER_COLUMNS,
    OTHER_COLOUR,
    PLACEHOLDER,
    PLACEHOLDER_COLUMNS,
    QUALITY_COLUMNS,
    RAW_COLUMNS,
)


def _typed_column(name: str) -> str:
    if name == "ARREST_DATE":
        return f"CAST(try_strptime({name}, '%m/%d/%Y') AS DATE) AS {name}"
    if name in INTEGER_COLUMNS:
        return f"try_cast({name} AS INTEGER) AS {name}"
    if name in DOUBLE_COLUMNS:
        return f"try_cast({name} AS DOUBLE) AS {name}"
    if name in PLACEHOLDER_COLUMNS:
        return f"nullif({name}, '{PLACEHOLDER}') AS {name}"
    return name


def _case(key: str, names: dict[str, str], otherwise: str) -> str:
    branches = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in names.items())
    return f"CASE {key} {branches} ELSE {otherwise} END"


def _mean(degrees: str) -> str:
    # The way through text rounds a wide integer to the nearest double.
    units = f"CAST(floor({degrees} * 140737488355328::DOUBLE) AS BIGINT)"
    return f"CAST(CAST(sum({units}) AS VARCHAR) AS DOUBLE) / count(*) / 140737488355328::DOUBLE"


def _edges(ring) -> str:
    values = ", ".join(
        f"({x1!r}::DOUBLE, {y1!r}::DOUBLE, {x2!r}::DOUBLE, {y2!r}::DOUBLE)"
        for (x1, y1), (x2, y2) in zip(ring, ring[1:])
    )
    return f"SELECT * FROM (VALUES {values}) AS e(x1, y1, x2, y2)"


def _in_polygon(edges: str) -> str:
    return f"""
        SELECT ARREST_KEY, any_value(Latitude) AS Latitude, any_value(Longitude) AS Longitude
        FROM valid, {edges}
        GROUP BY ARREST_KEY
        HAVING count(*) FILTER (WHERE y1 <> y2 AND (y1 > Latitude) <> (y2 > Latitude)
               AND Longitude < (x2 - x1) * (Latitude - y1) / (y2 - y1) + x1) % 2 = 1
           AND count(*) FILTER (WHERE (Longitude - x1) * (y2 - y1) = (Latitude - y1) * (x2 - x1)
               AND Longitude BETWEEN least(x1, x2) AND greatest(x1, x2)
               AND Latitude BETWEEN least(y1, y2) AND greatest(y1, y2)) = 0"""


_STEP_ROWS = ", ".join(map(str, RING_STEPS))
# One level of cells up: the middle cell next to a cell, by the rest of 3 q + r to 7.
_MIDDLE = "((3 * q + r) % 7 + 7) % 7"
_DQ = f"CASE {_MIDDLE} WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN -1 WHEN 5 THEN -1 ELSE 0 END"
_DR = f"CASE {_MIDDLE} WHEN 1 THEN 1 WHEN 2 THEN -1 WHEN 5 THEN 1 WHEN 6 THEN -1 ELSE 0 END"


def _level_up(level: int) -> str:
    return f"""
        SELECT Latitude, Longitude, (3 * mq + mr) // 7 AS q, (2 * mr - mq) // 7 AS r
        FROM (SELECT *, q - ({_DQ}) AS mq, r - ({_DR}) AS mr FROM cells{level - 1})"""


def _turn(ax: str, ay: str, bx: str, by: str, cx: str, cy: str) -> str:
    return f"sign(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


# Each named step may use those before it.
_STEPS = {
    "raw": RAW_RECORDS_SQL,
    "typed": f"""
        SELECT *, CAST(month(ARREST_DATE) AS INTEGER) AS ARREST_MONTH,
               CAST(year(ARREST_DATE) AS INTEGER) AS ARREST_YEAR
        FROM (SELECT {", ".join(map(_typed_column, RAW_COLUMNS))} FROM raw)""",
    "flagged": """
        SELECT *, Latitude IS NOT NULL AND Longitude IS NOT NULL
                  AND Latitude >= 40.4::DOUBLE AND Latitude <= 40.95::DOUBLE
                  AND Longitude >= -74.3::DOUBLE AND Longitude <= -73.65::DOUBLE AS coord_valid
        FROM typed""",
    "valid": "SELECT * EXCLUDE (coord_valid) FROM flagged WHERE coord_valid",
    "inside": """
        SELECT * FROM valid
        WHERE Latitude > 40.4::DOUBLE AND Latitude < 40.95::DOUBLE
          AND Longitude > -74.3::DOUBLE AND Longitude < -73.65::DOUBLE""",
    "edge": _edges(CONCAVE_RING),
    "long_edge": _edges(LONG_RING),
    "axial": """
        SELECT *, (x * 0.5773502691896257::DOUBLE - y / 3) / 461.354684::DOUBLE AS q,
               (2 * y / 3) / 461.354684::DOUBLE AS r
        FROM (SELECT *, (Longitude + 73.95::DOUBLE) * 84353.0::DOUBLE AS x,
                     (Latitude - 40.73::DOUBLE) * 110574.0::DOUBLE AS y FROM inside)""",
    "rounded": """
        SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds
        FROM (SELECT *, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM axial)""",
    "celled": """
        SELECT ARREST_KEY, ARREST_PRECINCT, ARREST_BORO, Latitude, Longitude,
               CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END + 1048576 AS BIGINT)
               * 2097152
               + CAST(CASE WHEN dr > ds AND NOT (dq > dr AND dq > ds) THEN -rq - rs ELSE rr END
                      + 1048576 AS BIGINT) AS hex_cell
        FROM rounded""",
    "cells": f"""
        SELECT hex_cell, count(*) AS arrest_count,
               {_mean('Latitude')} AS cell_lat,
               {_mean('Longitude')} AS cell_lon
        FROM celled GROUP BY hex_cell""",
    "counted": f"""
        SELECT ARREST_PRECINCT, ARREST_BORO, count(*) AS total_arrests,
               count(*) FILTER (WHERE LAW_CAT_CD = 'F') AS felonies,
               count(*) FILTER (WHERE LAW_CAT_CD = 'M') AS misdemeanors,
               count(*) FILTER (WHERE LAW_CAT_CD = 'V') AS violations,
               {_mean('Latitude')} AS centroid_lat,
               {_mean('Longitude')} AS centroid_lon
        FROM inside GROUP BY ARREST_PRECINCT, ARREST_BORO""",
    "precincts": """
        SELECT *, CASE WHEN felonies >= misdemeanors AND felonies >= violations THEN 'F'
                       WHEN misdemeanors >= violations THEN 'M' ELSE 'V' END AS dominant_cat
        FROM counted""",
    "top": """
        SELECT * FROM precincts
        ORDER BY total_arrests DESC, ARREST_PRECINCT ASC NULLS LAST, ARREST_BORO ASC NULLS LAST
        LIMIT 10""",
    "trend": """
        SELECT ARREST_BORO, ARREST_YEAR, ARREST_MONTH, LAW_CAT_CD, count(*) AS arrest_count
        FROM inside WHERE ARREST_DATE IS NOT NULL GROUP BY ALL""",
    "boro_month": """
        SELECT ARREST_BORO, ARREST_MONTH, CAST(sum(arrest_count) AS BIGINT) AS arrest_count
        FROM trend WHERE ARREST_BORO IS NOT NULL GROUP BY ALL""",
}

_STEPS |= {
    "cells0": """
        SELECT Latitude, Longitude, hex_cell // 2097152 - 1048576 AS q, hex_cell % 2097152 - 1048576 AS r
        FROM celled""",
    "cells1": _level_up(1),
    "cells2": _level_up(2),
    "cells3": _level_up(3),
    "vertex": VERTICES_SQL.replace("{steps}", f"supplier, (VALUES {_STEP_ROWS}) AS d(ring, place, dx, dy)"),
    "area_edge": """
        SELECT area, lon AS x1, lat AS y1,
               lead(lon, 1, first_lon) OVER (PARTITION BY area, ring ORDER BY place) AS x2,
               lead(lat, 1, first_lat) OVER (PARTITION BY area, ring ORDER BY place) AS y2
        FROM (SELECT *, arg_min(lon, place) OVER w AS first_lon, arg_min(lat, place) OVER w AS first_lat
              FROM vertex WINDOW w AS (PARTITION BY area, ring))""",
    # Every record against every edge.
    "area_pair": """
        SELECT ARREST_KEY, any_value(LAW_CAT_CD) AS LAW_CAT_CD, area
        FROM valid, area_edge
        GROUP BY ARREST_KEY, area
        HAVING count(*) FILTER (WHERE y1 <> y2 AND (y1 > Latitude) <> (y2 > Latitude)
               AND Longitude < (x2 - x1) * (Latitude - y1) / (y2 - y1) + x1) % 2 = 1
           AND count(*) FILTER (WHERE (Longitude - x1) * (y2 - y1) = (Latitude - y1) * (x2 - x1)
               AND Longitude BETWEEN least(x1, x2) AND greatest(x1, x2)
               AND Latitude BETWEEN least(y1, y2) AND greatest(y1, y2)) = 0""",
    # In metres, and every hexagon in an area's bounds against every edge of the area.
    "metre_edge": """
        SELECT area, (x1 + 73.95::DOUBLE) * 84353.0::DOUBLE AS x1, (y1 - 40.73::DOUBLE) * 110574.0::DOUBLE AS y1,
               (x2 + 73.95::DOUBLE) * 84353.0::DOUBLE AS x2, (y2 - 40.73::DOUBLE) * 110574.0::DOUBLE AS y2
        FROM area_edge""",
    "near_cell": """
        SELECT area, q, r, 461.354684::DOUBLE * sqrt(3) * (q + r / 2) AS cx, 461.354684::DOUBLE * 1.5::DOUBLE * r AS cy
        FROM (SELECT *, unnest(range(CAST(floor(west / 799.09 - r / 2) AS BIGINT) - 1,
                                     CAST(ceil(east / 799.09 - r / 2) AS BIGINT) + 2)) AS q
              FROM (SELECT *, unnest(range(CAST(floor(south / 692.03) AS BIGINT) - 1,
                                           CAST(ceil(north / 692.03) AS BIGINT) + 2)) AS r
                    FROM (SELECT area, min(least(x1, x2)) AS west, max(greatest(x1, x2)) AS east,
                                 min(least(y1, y2)) AS south, max(greatest(y1, y2)) AS north
                          FROM metre_edge GROUP BY area)))""",
    "corner": """
        SELECT * FROM (VALUES (0, 0.0, 1.0), (1, 0.5, 0.5), (2, 0.5, -0.5), (3, 0.0, -1.0), (4, -0.5, -0.5), (5, -0.5, 0.5))
        AS c(i, u, v)""",
    "side": """
        SELECT a.i, a.u * 799.0897531::DOUBLE AS ux, a.v * 461.354684::DOUBLE AS uy,
               b.u * 799.0897531::DOUBLE AS vx, b.v * 461.354684::DOUBLE AS vy
        FROM corner a JOIN corner b ON b.i = (a.i + 1) % 6""",
    "cell_edge": """
        SELECT area, q, r, cx, cy, x1 - cx AS x1, y1 - cy AS y1, x2 - cx AS x2, y2 - cy AS y2
        FROM near_cell JOIN metre_edge USING (area)""",
    "area_cell": f"""
        SELECT DISTINCT area, (q + 1048576) * 2097152 + r + 1048576 AS hex_cell
        FROM (SELECT area, q, r FROM cell_edge GROUP BY area, q, r
              HAVING count(*) FILTER (WHERE (y1 > 0) <> (y2 > 0) AND 0 < (x2 - x1) * -y1 / (y2 - y1) + x1) % 2 = 1
              UNION ALL
              SELECT area, q, r FROM cell_edge
              WHERE abs(x1) * 2 <= 799.0897531::DOUBLE AND abs(y1) + abs(x1) / sqrt(3) <= 461.354684::DOUBLE
              UNION ALL
              SELECT area, q, r FROM (SELECT * FROM cell_edge WHERE least(x1, x2) <= 400 AND greatest(x1, x2) >= -400
                                      AND least(y1, y2) <= 462 AND greatest(y1, y2) >= -462), side
              WHERE {_turn('x1', 'y1', 'x2', 'y2', 'ux', 'uy')} * {_turn('x1', 'y1', 'x2', 'y2', 'vx', 'vy')} <= 0
                AND {_turn('ux', 'uy', 'vx', 'vy', 'x1', 'y1')} * {_turn('ux', 'uy', 'vx', 'vy', 'x2', 'y2')} <= 0)""",
    "ring_edge": _edges([*RINGS[0]]) + "".join(f" UNION ALL {_edges(ring)}" for ring in RINGS[1:]),
}


def _used(select: str) -> dict[str, str]:
    """The steps that a statement needs, in their order."""
    needed, waiting = set(), [select]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        new = [name for name in _STEPS if name in words and name not in needed]
        needed.update(new)
        waiting += [_STEPS[name] for name in new]
    return {name: body for name, body in _STEPS.items() if name in needed}


def _with(select: str) -> str:
    steps = ",\n".join(f"{name} AS ({body})" for name, body in _used(select).items())
    return f"WITH {steps}\n{select}"


_BOROUGH_NAME = _case("ARREST_BORO", BOROUGH_NAMES, "coalesce(ARREST_BORO, 'Unknown')")
_PRECINCT_TEXT = "coalesce(CAST(ARREST_PRECINCT AS VARCHAR), '?')"
_LOOKUP = "SELECT ARREST_KEY, ARREST_DATE, LAW_CAT_CD, ARREST_BORO, ARREST_PRECINCT FROM valid"

_QUALITY = " UNION ALL ".join(
    ["SELECT 'all records' AS measure, count(*) AS records FROM flagged"]
    + [
        f"SELECT 'null {c}', count(*) FROM flagged WHERE {c} IS NULL HAVING count(*) > 0"
        for c in QUALITY_COLUMNS
    ]
    + ["SELECT 'invalid coordinates', count(*) FROM flagged WHERE NOT coord_valid"]
)

_SELECTS = {
    "scan_csv": "SELECT * FROM raw",
    "typed_records": "SELECT * FROM typed",
    "coord_flag": "SELECT ARREST_KEY, Latitude, Longitude, coord_valid FROM flagged",
    "store_filter": "SELECT * FROM valid",
    "raw_roundtrip": "SELECT * FROM flagged",
    "partitioned_roundtrip": "SELECT * FROM valid",
    "partition_list": """
        SELECT DISTINCT coalesce(ARREST_BORO, '__HIVE_DEFAULT_PARTITION__') AS "partition"
        FROM valid""",
    "storage_report": """
        SELECT true AS has_raw, true AS has_stored, true AS ratio_fits,
               string_agg(DISTINCT name, ',' ORDER BY name) AS partitions
        FROM (SELECT coalesce(ARREST_BORO, '__HIVE_DEFAULT_PARTITION__') AS name FROM valid)""",
    "quality_report": _QUALITY,
    "store_report": """
        SELECT count(*) AS records_read,
               count(*) FILTER (WHERE NOT coord_valid) AS records_dropped,
               count(*) FILTER (WHERE coord_valid) AS records_retained
        FROM flagged""",
    "spatial_outliers": """
        SELECT (SELECT count(*) FROM valid) AS records_read,
               (SELECT count(*) FROM valid) - (SELECT count(*) FROM inside) AS outliers""",
    "spatial_filter": "SELECT ARREST_KEY, Latitude, Longitude FROM inside",
    "polygon_filter": _in_polygon("edge"),
    "long_polygon_filter": _in_polygon("long_edge"),
    "rings_filter": _in_polygon("ring_edge"),
    "area_join": "SELECT ARREST_KEY, area FROM area_pair",
    "area_totals": """
        SELECT area, count(*) AS total_arrests, count(*) FILTER (WHERE LAW_CAT_CD = 'F') AS felonies,
               count(*) FILTER (WHERE LAW_CAT_CD = 'M') AS misdemeanors,
               count(*) FILTER (WHERE LAW_CAT_CD = 'V') AS violations
        FROM area_pair GROUP BY area""",
    "area_cells": "SELECT area, hex_cell FROM area_cell",
    "merged_records": f"""
        SELECT * EXCLUDE (is_first, is_second, is_third)
               REPLACE (CASE WHEN is_second THEN 'V' ELSE LAW_CAT_CD END AS LAW_CAT_CD,
                        CASE WHEN is_first THEN 'Q' ELSE ARREST_BORO END AS ARREST_BORO,
                        CASE WHEN is_first THEN ARREST_PRECINCT + 100 ELSE ARREST_PRECINCT END AS ARREST_PRECINCT)
        FROM (SELECT *, coalesce(ARREST_BORO IN ('K', 'Q'), false) AND {CORRECTIONS_SQL[0]} AS is_first,
                     is_first AND {CORRECTIONS_SQL[1]} AS is_second, is_first AND {CORRECTIONS_SQL[2]} AS is_third
              FROM valid)
        WHERE NOT is_third""",
    "deliveries_trend": "SELECT * FROM trend",
    "deliveries_cells": "SELECT * FROM cells",
    "pickup_precincts": "SELECT * FROM precincts",
    "window_lookup": f"""
        {_LOOKUP} WHERE ARREST_DATE BETWEEN DATE '{WINDOW_DATES[0]}' AND DATE '{WINDOW_DATES[1]}'
        AND Longitude BETWEEN {WINDOW_BOX[0]}::DOUBLE AND {WINDOW_BOX[2]}::DOUBLE
        AND Latitude BETWEEN {WINDOW_BOX[1]}::DOUBLE AND {WINDOW_BOX[3]}::DOUBLE""",
    "hex_levels": " UNION ALL ".join(
        f"""
        SELECT {level} AS cell_level, (q + 1048576) * 2097152 + r + 1048576 + {level} * 4398046511104 AS hex_cell,
               count(*) AS arrest_count, {_mean('Latitude')} AS cell_lat, {_mean('Longitude')} AS cell_lon
        FROM cells{level} GROUP BY q, r"""
        for level in range(4)
    ),
    "hex_assign": "SELECT ARREST_KEY, Latitude, Longitude, hex_cell FROM celled",
    "hex_density": "SELECT * FROM cells",
    "heat_points": "SELECT cell_lat, cell_lon, arrest_count FROM cells WHERE arrest_count >= 3",
    "precinct_summary": "SELECT * FROM precincts",
    "monthly_trend": "SELECT * FROM trend",
    "top_precincts": "SELECT * FROM top",
    "top10_lines": f"""
        SELECT concat('Precinct ', repeat(' ', 3 - length({_PRECINCT_TEXT})), {_PRECINCT_TEXT},
                      ' (', coalesce(ARREST_BORO, '?'), '): ',
                      repeat(' ', 5 - length(CAST(total_arrests AS VARCHAR))), total_arrests,
                      ' arrests') AS line
        FROM top""",
    "run_summary": """
        SELECT (SELECT count(*) FROM inside) AS records_in_region,
               (SELECT count(*) FROM precincts) AS precincts_with_data,
               (SELECT count(*) FROM cells) AS populated_cells""",
    "feature_circles": f"""
        SELECT ARREST_PRECINCT, ARREST_BORO, {_BOROUGH_NAME} AS borough_name,
               centroid_lat, centroid_lon,
               4 + total_arrests::DOUBLE / (SELECT max(total_arrests) FROM precincts) * 22
               AS radius,
               {_case("dominant_cat", CATEGORY_COLOURS, f"'{OTHER_COLOUR}'")} AS colour,
               concat('Precinct ', {_PRECINCT_TEXT}, ' – ', format('{{:,}}', total_arrests),
                      ' arrests') AS tooltip,
               concat('Precinct ', {_PRECINCT_TEXT}) AS popup_precinct,
               format('{{:,}}', total_arrests) AS popup_total,
               format('{{:,}}', felonies) AS popup_felonies,
               format('{{:,}}', misdemeanors) AS popup_misdemeanors,
               format('{{:,}}', violations) AS popup_violations,
               {_case("dominant_cat", CATEGORY_LABELS, "dominant_cat")} AS popup_dominant
        FROM precincts WHERE centroid_lat IS NOT NULL AND centroid_lon IS NOT NULL""",
    "feature_labels": f"""
        SELECT CAST(rank AS INTEGER) AS rank, concat('#', rank, ' P', {_PRECINCT_TEXT}) AS label,
               centroid_lat, centroid_lon
        FROM (SELECT *, row_number() OVER (ORDER BY total_arrests DESC,
                     ARREST_PRECINCT ASC NULLS LAST, ARREST_BORO ASC NULLS LAST) AS rank
              FROM top WHERE centroid_lat IS NOT NULL AND centroid_lon IS NOT NULL)""",
    "borough_month": "SELECT * FROM boro_month",
    "borough_month_lines": f"""
        SELECT {_BOROUGH_NAME} AS borough_name,
               string_agg(concat('M', ARREST_MONTH, ':', format('{{:,}}', arrest_count)), ' | '
                          ORDER BY ARREST_MONTH) AS counts
        FROM boro_month GROUP BY ARREST_BORO""",
    "precinct_lookup": f"{_LOOKUP} WHERE ARREST_PRECINCT = {PRECINCT}",
    "borough_scan": f"{_LOOKUP} WHERE ARREST_BORO = '{BOROUGH}'",
    "category_by_month": f"""
        SELECT ARREST_YEAR, ARREST_MONTH, count(*) AS arrest_count
        FROM valid WHERE ARREST_PRECINCT = {PRECINCT} AND LAW_CAT_CD = '{CATEGORY}'
        GROUP BY ALL""",
    "batch_run": """
        SELECT (SELECT count(*) FROM valid) AS records_read,
               (SELECT count(*) FROM valid) - (SELECT count(*) FROM inside) AS outliers,
               (SELECT count(*) FROM inside) AS records_in_region,
               (SELECT count(*) FROM precincts) AS precincts_with_data,
               (SELECT count(*) FROM cells) AS populated_cells""",
}


# What the batch job has written equals the queries that start from records.
_JOB_TABLES = {
    "job_precincts": "precinct_summary",
    "job_trend": "monthly_trend",
    "job_cells": "hex_density",
    "job_top": "top_precincts",
    "job_circles": "feature_circles",
    "job_heat": "heat_points",
    "job_labels": "feature_labels",
    "job_lines": "borough_month_lines",
}
_SELECTS |= {name: _SELECTS[same] for name, same in _JOB_TABLES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _with(select) for name, select in _SELECTS.items()}
