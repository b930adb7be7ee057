"""Containment and hexagonal binning as plain Column arithmetic.

A point is a pair of double columns (lon, lat); a polygon is one closed ring of
(lon, lat) vertices known on the driver. No geometry type is needed, so the
comparisons reach the Parquet scan.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import ne, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = Sequence[tuple[float, float]]
Edge = list[tuple[float, float]]

_EDGE_LIST = "array<struct<x1: double, y1: double, x2: double, y2: double>>"


def bounds(ring: Ring) -> tuple[float, float, float, float]:
    """West, south, east and north limits of a ring."""
    lons, lats = zip(*ring)
    return min(lons), min(lats), max(lons), max(lats)


def upward_edges(ring: Ring) -> list[Edge]:
    """Edges of a ring, each from its lower to its upper end."""
    pairs = zip(ring, ring[1:])
    return [sorted(pair, key=lambda vertex: vertex[1]) for pair in pairs if pair[0] != pair[1]]


def is_rectangle(ring: Ring) -> bool:
    west, south, east, north = bounds(ring)
    corners = {(west, south), (east, south), (east, north), (west, north)}
    edges = upward_edges(ring)
    axis_aligned = all(x1 == x2 or y1 == y2 for (x1, y1), (x2, y2) in edges)
    return len(edges) == 4 and set(map(tuple, ring)) == corners and axis_aligned


def inside_bounds(lon: Column, lat: Column, ring: Ring) -> Column:
    """Inclusive and two-valued: a missing, NaN or infinite coordinate is false."""
    west, south, east, north = bounds(ring)
    return (
        lat.isNotNull() & lon.isNotNull() & lat.between(south, north) & lon.between(west, east)
    )


# More edges than this make a generated method too long for the JVM to compile.
UNROLLED_EDGES = 12
# Edges that a band should have at most, and bands for each edge; these keep the table in proportion.
EDGES_PER_BAND, MAX_BANDS_PER_EDGE = 4, 8


def crosses(lon: Column, lat: Column, x1, y1, x2, y2) -> Column:
    """The point is at the height of the upward edge, lower end included, and west of it."""
    return (lat >= y1) & (lat < y2) & ((lon - x1) * (y2 - y1) < (lat - y1) * (x2 - x1))


def touches(lon: Column, lat: Column, x1, y1, x2, y2) -> Column:
    on_line = (lon - x1) * (y2 - y1) == (lat - y1) * (x2 - x1)
    # The edge runs upward, but may run west.
    in_width = ((lon >= x1) & (lon <= x2)) | ((lon >= x2) & (lon <= x1))
    return (lat >= y1) & (lat <= y2) & on_line & in_width


def _banded(edges: list[Edge], south: float, north: float) -> list[list[Edge]]:
    """Edges by the latitude band they reach, in as few bands as leave few edges in each.

    Long edges cross many bands; where they would make the table large out of
    proportion, some bands keep more edges.
    """
    found, count = [edges], 1
    while max(map(len, found)) > EDGES_PER_BAND:
        count *= 2
        bands = [[] for _ in range(count)]
        for edge in edges:
            first, last = (_band(y, south, north, count) for _, y in edge)
            for band in range(first, last + 1):
                bands[band].append(edge)
        if sum(map(len, bands)) > MAX_BANDS_PER_EDGE * len(edges):
            break
        found = bands
    return found


def _band(y: float, south: float, north: float, count: int) -> int:
    return min(int((y - south) / ((north - south) / count)), count - 1)


def _band_of(lat: Column, south: float, north: float, count: int) -> Column:
    """The band of a latitude; NULL if it has none."""
    return F.least(F.floor((lat - south) / ((north - south) / count)), F.lit(count - 1)).try_cast("int")


def _edges_near(lat: Column, edges: list[Edge], south: float, north: float) -> Column:
    """Edges that reach the latitude band of a point, as a list from a constant table."""
    bands = _banded(edges, south, north)
    lists = [[{"x1": x1, "y1": y1, "x2": x2, "y2": y2} for (x1, y1), (x2, y2) in some] for some in bands]
    table = F.from_json(F.lit(json.dumps(lists)), f"array<{_EDGE_LIST}>")
    # A point outside the box may have no band; it gets an empty list.
    return F.coalesce(F.get(table, _band_of(lat, south, north, len(bands))), F.array().cast(_EDGE_LIST))


def _odd_and_on_edge(lon: Column, lat: Column, edges: list[Edge], south: float, north: float) -> tuple[Column, Column]:
    """Whether the edges to the east are odd in number, and whether the point is on one.

    A few edges are compared one by one in generated code. Of more, a point meets those of
    its latitude band only, however many there are.
    """
    if len(edges) <= UNROLLED_EDGES:
        odd = reduce(ne, [crosses(lon, lat, *start, *end) for start, end in edges])
        return odd, reduce(or_, [touches(lon, lat, *start, *end) for start, end in edges])
    near = _edges_near(lat, edges, south, north)
    odd = F.aggregate(near, F.lit(False), lambda odd, e: odd != crosses(lon, lat, e.x1, e.y1, e.x2, e.y2))
    return odd, F.exists(near, lambda e: touches(lon, lat, e.x1, e.y1, e.x2, e.y2))


def within(lon: Column, lat: Column, ring: Ring) -> Column:
    """Strictly inside the ring: a point on the boundary is not within.

    Four comparisons for an axis-aligned rectangle, otherwise as :func:`within_rings`.
    """
    return within_rings(lon, lat, [ring])


def within_rings(lon: Column, lat: Column, rings: Sequence[Ring]) -> Column:
    """Strictly inside an area of several rings: parts, and holes in them.

    Counts, by odd or even, the edges of all rings to the east of the point, and excludes
    points on an edge: a ring within another is a hole, one within a hole is a part again.
    Where two rings have an area in common it counts as outside, and an edge that two
    rings share as a boundary. The bounding box comes first, so that a Parquet scan can
    skip by it.
    """
    rings = [[tuple(vertex) for vertex in ring] for ring in rings]
    if not rings:
        raise ValueError("an area needs a ring")
    for ring in rings:
        if len(ring) < 4 or ring[0] != ring[-1]:
            raise ValueError("a ring needs at least three corners and must end where it starts")
        west, south, east, north = bounds(ring)
        if west == east or south == north:
            raise ValueError("a ring must enclose an area")
    west, south, east, north = bounds([vertex for ring in rings for vertex in ring])
    box = (lon > west) & (lon < east) & (lat > south) & (lat < north)
    if len(rings) == 1 and is_rectangle(rings[0]):
        return box
    edges = [edge for ring in rings for edge in upward_edges(ring)]
    odd, on_edge = _odd_and_on_edge(lon, lat, edges, south, north)
    return box & odd & ~on_edge


@dataclass(frozen=True)
class HexGrid:
    """Pointy-top hexagons on a plane of local metres around an origin.

    The metres per degree are fixed, so one grid is meant for an area the size
    of a city. The default edge is that of the hexagons the reports are used to.
    """

    edge_m: float = 461.354684
    origin_lon: float = -73.95
    origin_lat: float = 40.73
    metres_per_lon: float = 84353.0
    metres_per_lat: float = 110574.0


CITY_GRID = HexGrid()

_SQRT3 = 3.0**0.5
# Cell ids pack two axial coordinates, each shifted to be positive in 21 bits.
_SHIFT = 1 << 20
_STRIDE = 1 << 21


def hex_cell(lon: Column, lat: Column, grid: HexGrid = CITY_GRID) -> Column:
    """Id (bigint) of the hexagon whose centre is nearest.

    NULL for a missing point, one with NaN, infinite or more than 360 degrees, and one
    too far from the grid's origin for an id.

    The three families of lines perpendicular to a hexagon's sides cut the plane
    into unit strips. The strip numbers a, b, c of a point sum to -1 or -2 and
    fix its axial coordinates without any rounding correction:
    ``q = floor((a - c + 1) / 3)`` and ``r = floor((b - a + 1) / 3)``.
    Ids are those of this grid, not of any global index.
    """
    is_point = (F.abs(lon) <= 360) & (F.abs(lat) <= 360)
    lon, lat = F.when(is_point, lon), F.when(is_point, lat)
    u = (lon - grid.origin_lon) * grid.metres_per_lon / (_SQRT3 * grid.edge_m)
    v = (lat - grid.origin_lat) * grid.metres_per_lat / grid.edge_m
    a = F.floor(u - v)
    b = F.floor(u + v)
    c = F.floor(u * -2.0)
    q = F.floor((a - c + 1) / 3)
    r = F.floor((b - a + 1) / 3)
    return hex_id(q, r)


def hex_id(q: Column, r: Column) -> Column:
    """Id of the hexagon with these axial coordinates; NULL if they are too far out for one."""
    has_id = q.between(-_SHIFT, _SHIFT - 1) & r.between(-_SHIFT, _SHIFT - 1)
    return F.when(has_id, (q + _SHIFT) * F.lit(_STRIDE).cast("bigint") + (r + _SHIFT))


# Cells of level 0 are hexagons. A cell of the next level is one of them with its six
# neighbours, and so on; ids of higher levels have the level above their 42 bits.
_LEVEL = 1 << 42
MAX_LEVEL = 12


def _axial(cell: Column) -> tuple[Column, Column]:
    q = F.shiftright(cell, 21).bitwiseAND(F.lit(_STRIDE - 1).cast("bigint")) - F.lit(_SHIFT).cast("bigint")
    return q, cell.bitwiseAND(F.lit(_STRIDE - 1).cast("bigint")) - F.lit(_SHIFT).cast("bigint")


def cell_level(cell: Column) -> Column:
    return F.shiftright(cell, 42).cast("int")


def cell_parent(cell: Column) -> Column:
    """The cell of the next level that this one belongs to: one of its seven.

    The middle cells of the sevens form a lattice of the vectors (2, 1) and (-1, 3), and
    every other cell is next to exactly one of them. So a parent's axial coordinates are
    those of the nearest lattice point: ``floor((3 q + r + 3) / 7)`` and
    ``floor((2 r - q + 3) / 7)``. Like every aperture of seven it turns by 19 degrees per level.
    """
    q, r = _parent_axial(*_axial(cell))
    above = (q + _SHIFT) * F.lit(_STRIDE).cast("bigint") + r + _SHIFT
    return above + (cell_level(cell) + 1) * F.lit(_LEVEL).cast("bigint")


def _parent_axial(q: Column, r: Column) -> tuple[Column, Column]:
    return F.floor((q * 3 + r + 3) / 7), F.floor((r * 2 - q + 3) / 7)


def cell_ancestor(cell: Column, level: int) -> Column:
    """The cell of a level that a hexagon, a cell of level 0, belongs to.

    The steps are a fold, as nested expressions would double with every level.
    """
    if not 0 <= level <= MAX_LEVEL:
        raise ValueError(f"levels go from 0 to {MAX_LEVEL}")
    if level == 0:
        return cell
    q, r = _axial(cell)

    def up(at: Column, _: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in zip("qr", _parent_axial(at["q"], at["r"]), strict=True)])

    steps = F.sequence(F.lit(1), F.lit(level))
    start = F.struct(q.alias("q"), r.alias("r"))
    above = F.aggregate(steps, start, up, lambda at: (at["q"] + _SHIFT) * F.lit(_STRIDE).cast("bigint") + at["r"] + _SHIFT)
    # NULL stays NULL: a sum with a missing coordinate is missing.
    return above + F.lit(level * _LEVEL).cast("bigint")


def cell_children(cell: Column) -> Column:
    """The seven cells of the level below, the middle one first; an empty list at level 0."""
    below = F.transform(F.array(*[F.struct(F.lit(q).alias("q"), F.lit(r).alias("r")) for q, r in _SEVEN]), _child_of(cell))
    return F.when(cell_level(cell) > 0, below).otherwise(F.array().cast("array<bigint>"))


_SEVEN = ((0, 0), (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))


def _child_of(cell: Column):
    q, r = _axial(cell)
    middle = (q * 2 - r + _SHIFT) * F.lit(_STRIDE).cast("bigint") + q + r * 3 + _SHIFT
    start = middle + (cell_level(cell) - 1) * F.lit(_LEVEL).cast("bigint")
    return lambda step: start + step["q"] * F.lit(_STRIDE).cast("bigint") + step["r"]


def cell_centre(cell: Column, level: int, grid: HexGrid = CITY_GRID) -> tuple[Column, Column]:
    """Longitude and latitude of the middle of a cell of the given level."""
    a, b, c, d = 1, 0, 0, 1  # axial coordinates of level 0 by those of the level
    for _ in range(level):
        a, b, c, d = 2 * a + b, 3 * b - a, 2 * c + d, 3 * d - c
    q, r = _axial(cell)
    q, r = q * a + r * b, q * c + r * d
    lon = (q + r / 2) * (_SQRT3 * grid.edge_m / grid.metres_per_lon) + grid.origin_lon
    return lon, r * (1.5 * grid.edge_m / grid.metres_per_lat) + grid.origin_lat
