"""Geography on WGS84, as Column expressions.

Points are structs or pairs (lon, lat) in degrees, lines and rings arrays of such
structs.  Distances use the ellipsoid's radii of curvature at the middle latitude,
which for the spans between two fixes agrees with an iterated inverse solution to
micrometres and stays inside whole-stage code generation.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84, and the mean radius for great circles: fixed values.
A, FLATTENING, MEAN_RADIUS = 6378137.0, 1 / 298.257223563, 6371008.8
E2 = FLATTENING * (2 - FLATTENING)
RAD = math.pi / 180
#: Side of a cell of the plain longitude-latitude grid, in degrees, by its name.
GRID = {"cell_r8": 0.01, "cell_r9": 0.004}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used.

    Lambdas of array functions are interpreted, not compiled, so repeats inside them
    are paid for each time.
    """
    return F.transform(F.array(value), body).getItem(0)


def _w(lat: Column) -> Column:
    return F.lit(1.0) - F.lit(E2) * F.sin(lat * RAD) * F.sin(lat * RAD)


def metres_per_degree(lat: Column) -> tuple[Column, Column]:
    """Metres of one degree of longitude and of latitude at ``lat``."""
    w = _w(lat)
    return F.lit(A) / F.sqrt(w) * F.cos(lat * RAD) * RAD, F.lit(A * (1 - E2)) / (w * F.sqrt(w)) * RAD


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    east, north = metres_per_degree((lat1 + lat2) / 2)
    dx, dy = (lon2 - lon1) * east, (lat2 - lat1) * north
    return F.sqrt(dx * dx + dy * dy)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half = lambda a, b: F.sin((b - a) * (RAD / 2))
    h = half(lat1, lat2) * half(lat1, lat2) + F.cos(lat1 * RAD) * F.cos(lat2 * RAD) * half(lon1, lon2) * half(lon1, lon2)
    return F.lit(2 * MEAN_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def bearing_deg(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """The initial course from the first point to the second, 0 to 360."""
    dlon = (lon2 - lon1) * RAD
    y = F.sin(dlon) * F.cos(lat2 * RAD)
    x = F.cos(lat1 * RAD) * F.sin(lat2 * RAD) - F.sin(lat1 * RAD) * F.cos(lat2 * RAD) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def destination(lon: Column, lat: Column, bearing: Column, metres: Column) -> Column:
    """struct(lon, lat) reached on a great circle; the longitude lies in [-180, 180)."""
    arc, course, phi = metres / MEAN_RADIUS, bearing * RAD, lat * RAD
    phi2 = F.asin(F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(course))
    lam = lon * RAD + F.atan2(F.sin(course) * F.sin(arc) * F.cos(phi), F.cos(arc) - F.sin(phi) * F.sin(phi2))
    return F.struct((F.pmod(F.degrees(lam) + 180.0, F.lit(360.0)) - 180.0).alias("lon"), F.degrees(phi2).alias("lat"))


def segments(line: Column) -> Column:
    """array<struct(i, x1, y1, x2, y2)> of consecutive positions; empty for fewer than two."""
    pairs = F.arrays_zip(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))).alias("p"), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))).alias("q"))
    return F.transform(pairs, lambda s, i: F.struct(i.alias("i"), s["p"]["lon"].alias("x1"), s["p"]["lat"].alias("y1"), s["q"]["lon"].alias("x2"), s["q"]["lat"].alias("y2")))


def length_m(line: Column) -> Column:
    return F.aggregate(F.transform(segments(line), lambda s: distance_m(s["x1"], s["y1"], s["x2"], s["y2"])), F.lit(0.0), lambda a, b: a + b)


def _nearest(px: Column, py: Column, dx: Column, dy: Column) -> Column:
    """struct(t, d2): where on a segment from the origin along (dx, dy) the point (px, py) is nearest, 0 to 1, and the squared distance.  t is 0 on a point-like segment."""

    def placed(v: Column) -> Column:
        full = v["dx"] * v["dx"] + v["dy"] * v["dy"]
        t = let(full, lambda n: F.when(n == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v["px"] * v["dx"] + v["py"] * v["dy"]) / n))))
        off = lambda t: F.struct(t.alias("t"), (v["px"] - t * v["dx"]).alias("gx"), (v["py"] - t * v["dy"]).alias("gy"))
        return let(let(t, off), lambda g: F.struct(g["t"].alias("t"), (g["gx"] * g["gx"] + g["gy"] * g["gy"]).alias("d2")))

    return let(F.struct(px.alias("px"), py.alias("py"), dx.alias("dx"), dy.alias("dy")), placed)


def distance_to_parts_m(lon: Column, lat: Column, parts: Column) -> Column:
    """Metres to the nearest of some segments, on a plane that is true at the point."""
    east, north = metres_per_degree(lat)

    def all_parts(m: Column) -> Column:
        one = lambda s: _nearest((lon - s["x1"]) * m["e"], (lat - s["y1"]) * m["n"], (s["x2"] - s["x1"]) * m["e"], (s["y2"] - s["y1"]) * m["n"])["d2"]
        return F.sqrt(F.array_min(F.transform(parts, one)))

    return let(F.struct(east.alias("e"), north.alias("n")), all_parts)


def distance_to_line_m(lon: Column, lat: Column, line: Column) -> Column:
    return distance_to_parts_m(lon, lat, segments(line))


def located_lines(line: Column) -> Column:
    """The segments with their planar length and the length before them; constant per line, so worth computing once."""
    planar = F.transform(segments(line), lambda s: F.struct(s["i"].alias("i"), s["x1"].alias("x1"), s["y1"].alias("y1"), s["x2"].alias("x2"), s["y2"].alias("y2"), F.sqrt((s["x2"] - s["x1"]) * (s["x2"] - s["x1"]) + (s["y2"] - s["y1"]) * (s["y2"] - s["y1"])).alias("len")))
    return F.transform(planar, lambda s: F.struct(s["i"].alias("i"), s["x1"].alias("x1"), s["y1"].alias("y1"), s["x2"].alias("x2"), s["y2"].alias("y2"), s["len"].alias("len"), F.aggregate(F.slice(F.transform(planar, lambda q: q["len"]), F.lit(1), s["i"]), F.lit(0.0), lambda a, b: a + b).alias("before")))


def fraction_along(lon: Column, lat: Column, located: Column) -> Column:
    """Planar progress along :func:`located_lines`, 0 to 1; of equally near segments the first counts."""
    total = F.element_at(located, -1)["before"] + F.element_at(located, -1)["len"]

    def one(s: Column) -> Column:
        near = _nearest(lon - s["x1"], lat - s["y1"], s["x2"] - s["x1"], s["y2"] - s["y1"])
        return let(near, lambda n: F.struct(n["d2"].alias("d"), s["i"].alias("i"), (s["before"] + n["t"] * s["len"]).alias("at")))

    return F.array_min(F.transform(located, one))["at"] / F.when(total > 0, total)


def bounding_box(line: Column) -> Column:
    x, y = F.transform(line, lambda p: p["lon"]), F.transform(line, lambda p: p["lat"])
    return F.struct(F.array_min(x).alias("min_lon"), F.array_min(y).alias("min_lat"), F.array_max(x).alias("max_lon"), F.array_max(y).alias("max_lat"))


def _crossings(lon: Column, lat: Column, parts: Column) -> Column:
    def crosses(s: Column) -> Column:
        spans = (s["y1"] > lat) != (s["y2"] > lat)
        at = s["x1"] + (lat - s["y1"]) / F.when(s["y1"] != s["y2"], s["y2"] - s["y1"]) * (s["x2"] - s["x1"])
        return spans & (lon < at)

    return F.size(F.filter(parts, crosses))


def _touches(lon: Column, lat: Column, parts: Column) -> Column:
    def touches(s: Column) -> Column:
        cross = (s["x2"] - s["x1"]) * (lat - s["y1"]) - (s["y2"] - s["y1"]) * (lon - s["x1"])
        return (F.abs(cross) < 1e-15) & lon.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & lat.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))

    return F.exists(parts, touches)


def point_in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Half-open ray casting: a point on a shared edge is in exactly one of two neighbours."""
    return _crossings(lon, lat, segments(ring)) % 2 == 1


def on_ring(lon: Column, lat: Column, ring: Column) -> Column:
    return _touches(lon, lat, segments(ring))


def covers_parts(parts: Column, box: Column, lon: Column, lat: Column) -> Column:
    """:func:`covers` for a ring whose segments and box are at hand."""
    return lon.between(box["min_lon"], box["max_lon"]) & lat.between(box["min_lat"], box["max_lat"]) & ((_crossings(lon, lat, parts) % 2 == 1) | _touches(lon, lat, parts))


def covers(ring: Column, lon: Column, lat: Column) -> Column:
    """Inside the ring or on its boundary."""
    return covers_parts(segments(ring), bounding_box(ring), lon, lat)


def _authalic(lat: Column) -> Column:
    """q / 2 of the equal-area latitude: the ellipsoid's area between the equator and ``lat`` goes with it."""
    e = math.sqrt(E2)
    s = F.sin(lat * RAD)
    return (s / (F.lit(1.0) - F.lit(E2) * s * s) + F.log((F.lit(1.0) + F.lit(e) * s) / (F.lit(1.0) - F.lit(e) * s)) / (2 * e)) * ((1 - E2) / 2)


def area_m2(ring: Column) -> Column:
    """Area on the ellipsoid: a shoelace sum in equal-area coordinates."""
    terms = F.transform(segments(ring), lambda s: (s["x2"] - s["x1"]) * RAD * (_authalic(s["y1"]) + _authalic(s["y2"])) / 2)
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)) * (A * A)


def centroid(ring: Column) -> Column:
    """struct(lon, lat): the planar centroid by area; of a ring without area the mean of its positions."""
    x0, y0 = F.element_at(ring, 1)["lon"], F.element_at(ring, 1)["lat"]
    parts = F.transform(segments(ring), lambda s: F.struct(((s["x1"] - x0) * (s["y2"] - y0) - (s["x2"] - x0) * (s["y1"] - y0)).alias("c"), (s["x1"] + s["x2"] - x0 * 2).alias("x"), (s["y1"] + s["y2"] - y0 * 2).alias("y")))
    total = lambda f: F.aggregate(F.transform(parts, f), F.lit(0.0), lambda a, b: a + b)
    doubled = total(lambda p: p["c"])
    mean = lambda name: F.aggregate(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(1))), F.lit(0.0), lambda a, p: a + p[name]) / F.greatest(F.size(ring) - 1, F.lit(1))
    flat = F.abs(doubled) < 1e-18
    return F.struct(
        F.when(flat, mean("lon")).otherwise(x0 + total(lambda p: p["x"] * p["c"]) / (F.when(~flat, doubled) * 3)).alias("lon"),
        F.when(flat, mean("lat")).otherwise(y0 + total(lambda p: p["y"] * p["c"]) / (F.when(~flat, doubled) * 3)).alias("lat"),
    )


def _coordinates(line: Column) -> Column:
    return F.transform(line, lambda p: F.array(p["lon"], p["lat"]))


def polygon_geojson(ring: Column) -> Column:
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(_coordinates(ring)).alias("coordinates")))


def line_geojson(line: Column) -> Column:
    return F.to_json(F.struct(F.lit("LineString").alias("type"), _coordinates(line).alias("coordinates")))


def wkt(line: Column, kind: str) -> Column:
    """POLYGON or LINESTRING text of an array of positions."""
    inner = F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", ")
    return F.concat(F.lit("POLYGON(("), inner, F.lit("))")) if kind == "POLYGON" else F.concat(F.lit("LINESTRING("), inner, F.lit(")"))


def grid_cell(lon: Column, lat: Column, side: float) -> Column:
    """The name of the cell of a plain longitude-latitude grid: column_row."""
    return F.concat_ws("_", F.floor(lon / side).cast("string"), F.floor(lat / side).cast("string"))


def mercator(lon: Column, lat: Column) -> Column:
    """struct(x, y) in web Mercator metres; latitudes are clamped to where the square ends."""
    phi = F.least(F.lit(85.05112878), F.greatest(F.lit(-85.05112878), lat)) * RAD
    return F.struct((lon * RAD * A).alias("x"), (F.log(F.tan(phi / 2 + math.pi / 4)) * A).alias("y"))
