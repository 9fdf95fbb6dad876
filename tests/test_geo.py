from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from waymark.functions import earth, geo
from waymark.sources import reference
from waymark.sources.config import demo

#: area_km2, perimeter_km, centre lon, centre lat
ZONES = {"Z-DEPOT-N": (1.73730, 5.2724, 104.890, 11.590), "Z-DEPOT-S": (1.73779, 5.2731, 104.930, 11.510), "Z-CUST-RIVERSIDE": (0.97730, 3.9544, 104.932, 11.570), "Z-CUST-OLYMPIC": (0.97737, 3.9546, 104.918, 11.550), "Z-CUST-AIRPORT": (1.46004, 4.8334, 104.845, 11.546), "Z-REST-PALACE": (0.43437, 2.6363, 104.931, 11.561), "Z-CONG-MONIVONG": (2.17186, 9.0553, 104.918, 11.560)}
ROUTES = {"R-NORTH-LOOP": 11.445, "R-SOUTH-RUN": 14.078, "R-AIRPORT-SHUTTLE": 14.065, "R-CITY-CROSS": 11.055}
SCHEDULE = {"R-NORTH-LOOP": [0, 1025, 2773, 4500], "R-SOUTH-RUN": [0, 1348, 2336, 3600], "R-AIRPORT-SHUTTLE": [0, 3327, 5400], "R-CITY-CROSS": [0, 1831, 3689, 4200]}


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_zone_measures(spark):
    ring = F.col("boundary")
    found = reference.zones(spark, demo()).select("zone_id", (geo.area_m2(ring) / 1e6).alias("a"), (geo.length_m(ring) / 1e3).alias("p"), geo.centroid(ring).alias("c")).collect()
    for r in found:
        if r.zone_id in ZONES:
            a, p, lon, lat = ZONES[r.zone_id]
            assert r.a == pytest.approx(a, abs=2e-5) and r.p == pytest.approx(p, abs=2e-4) and (r.c.lon, r.c.lat) == (pytest.approx(lon), pytest.approx(lat))


def test_route_lengths_and_schedule(spark):
    routes, zones = reference.routes(spark, demo()), reference.zones(spark, demo())
    assert {r.route_id: round(r.km, 3) for r in routes.select("route_id", (geo.length_m(F.col("path")) / 1e3).alias("km")).collect()} == ROUTES
    found = reference.schedule(routes, zones).orderBy("route_id", "seq").collect()
    assert {k: [r.elapsed_seconds for r in found if r.route_id == k] for k in SCHEDULE} == SCHEDULE


def test_covering_includes_the_boundary_and_overlaps(spark):
    zones = reference.zones(spark, demo())
    inside = lambda lon, lat: sorted(r.zone_id for r in zones.where(geo.covers(F.col("boundary"), F.lit(lon), F.lit(lat))).collect())
    assert inside(104.918, 11.55) == ["Z-CONG-MONIVONG", "Z-CUST-OLYMPIC"]
    assert inside(104.884, 11.59) == ["Z-DEPOT-N"] and inside(104.884, 11.584) == ["Z-DEPOT-N"] and inside(104.8839, 11.59) == []


def test_fraction_takes_the_first_of_equally_near_segments(spark):
    loop = F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in ((0, 0), (2, 0), (2, 2), (0, 0))])
    r = one(spark, geo.fraction_along(F.lit(0.0), F.lit(0.0), geo.located_lines(loop)).alias("start"), geo.fraction_along(F.lit(3.0), F.lit(1.0), geo.located_lines(loop)).alias("side"))
    assert r.start == 0.0 and r.side == pytest.approx(3 / (4 + 8**0.5))


def test_columns_agree_with_plain_functions(spark):
    a, b = (104.9282, 11.5564), (103.86, 13.36)
    lits = [F.lit(x) for x in (*a, *b)]
    r = one(spark, geo.haversine_m(*lits).alias("h"), geo.bearing_deg(*lits).alias("b"), geo.destination(F.lit(179.9), F.lit(0.0), F.lit(90.0), F.lit(50000.0)).alias("d"), geo.mercator(*lits[:2]).alias("m"), geo.distance_m(*lits).alias("e"))
    assert r.h == pytest.approx(earth.haversine_m(a, b)) and r.b == pytest.approx(earth.bearing_deg(a, b)) and r.e == pytest.approx(r.h, rel=6e-3)
    assert (r.d.lon, r.d.lat) == (pytest.approx(earth.destination((179.9, 0.0), 90.0, 50000.0)[0]), pytest.approx(0.0, abs=1e-9)) and r.d.lon < -179
    assert (r.m.x, r.m.y) == pytest.approx(earth.mercator(a))


def test_distance_to_a_line(spark):
    line = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((104.9, 11.5), (104.9, 11.6))])
    r = one(spark, geo.distance_to_line_m(F.lit(104.91), F.lit(11.55), line).alias("d"))
    assert r.d == pytest.approx(1090.7, abs=1) and r.d == pytest.approx(earth.distance_to_path_m((104.91, 11.55), [(104.9, 11.5), (104.9, 11.6)]), rel=5e-3)


def test_centroid_of_a_ring_without_area_and_texts(spark):
    flat = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((1.0, 1.0), (3.0, 1.0), (1.0, 1.0))])
    r = one(spark, geo.centroid(flat).alias("c"), geo.line_geojson(flat).alias("g"), geo.wkt(flat, "LINESTRING").alias("w"))
    assert (r.c.lon, r.c.lat) == (2.0, 1.0) and r.g == '{"type":"LineString","coordinates":[[1.0,1.0],[3.0,1.0],[1.0,1.0]]}' and r.w == "LINESTRING(1.0 1.0, 3.0 1.0, 1.0 1.0)"


def test_points_along_a_path():
    path = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    whole = earth.path_length_m(path)
    assert earth.point_at(path, -5) == path[0] and earth.point_at(path, whole * 2) == path[-1]
    assert earth.point_at(path, earth.cumulative_m(path)[1]) == pytest.approx(path[1])
