"""The queries' meaning in plain SQL, for an independent engine over the same tables.

Common table expressions are kept by name; :func:`query` puts together those that a
final select needs.  Zones, routes and their parts are written out as values.
"""

from __future__ import annotations

import math
import re

from waymark.functions.geo import A, E2, GRID, RAD
from waymark.sources import adapter
from waymark.sources.config import FleetConfig, demo

S = adapter.SETTINGS
GAP, IDLE = S.gps_gap_minutes * 60, S.idle_speed_kph
LATE, STAND = S.delay_minutes * 60, S.idle_minutes * 60


def r(x: str, places: int) -> str:
    return f"(sign({x}) * (floor(abs({x}) * 1e{places} + 0.5e0) / 1e{places}))"


def secs(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 1e6)"


def pct(a: str, b: str, places: int = 1) -> str:
    return r(f"(CAST({a} AS DOUBLE) * 100e0 / nullif(CAST({b} AS DOUBLE), 0))", places)


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    lat = f"(({lat1} + {lat2}) / 2)"
    east, north = degree(lat)
    dx, dy = f"(({lon2} - {lon1}) * {east})", f"(({lat2} - {lat1}) * {north})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def degree(lat: str) -> tuple[str, str]:
    s = f"sin({lat} * {RAD!r}::DOUBLE)"
    w = f"(1e0 - {E2!r}::DOUBLE * {s} * {s})"
    return f"({A!r}::DOUBLE / sqrt({w}) * cos({lat} * {RAD!r}::DOUBLE) * {RAD!r}::DOUBLE)", f"({A * (1 - E2)!r}::DOUBLE / ({w} * sqrt({w})) * {RAD!r}::DOUBLE)"


def _values(rows: list[tuple], names: str) -> str:
    def one(v: object) -> str:
        return "NULL" if v is None else f"{v!r}::DOUBLE" if isinstance(v, float) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, x)) + ')' for x in rows)}) AS v({names})"


def _parts(key: str, line: tuple) -> list[tuple]:
    return [(key, k, *map(float, a), *map(float, b)) for k, (a, b) in enumerate(zip(line, line[1:]))]


def _geojson(kind: str, line: tuple) -> str:
    inner = "[" + ",".join(f"[{x!r},{y!r}]" for x, y in line) + "]"
    return f'{{"type":"{kind}","coordinates":{"[" + inner + "]" if kind == "Polygon" else inner}}}'


def _authalic(y: str) -> str:
    e = math.sqrt(E2)
    s = f"sin({y} * {RAD!r}::DOUBLE)"
    return f"(({s} / (1e0 - {E2!r}::DOUBLE * {s} * {s}) + ln((1e0 + {e!r}::DOUBLE * {s}) / (1e0 - {e!r}::DOUBLE * {s})) / {2 * e!r}::DOUBLE) * {(1 - E2) / 2!r}::DOUBLE)"


def _nearest(px: str, py: str, dx: str, dy: str) -> str:
    full = f"({dx} * {dx} + {dy} * {dy})"
    return f"(CASE WHEN {full} = 0 THEN 0e0 ELSE least(1e0, greatest(0e0, ({px} * {dx} + {py} * {dy}) / {full})) END)"


def expressions(config: FleetConfig) -> dict[str, str]:
    """Common table expressions by name."""
    box = lambda ring: (min(p[0] for p in ring), min(p[1] for p in ring), max(p[0] for p in ring), max(p[1] for p in ring))
    east, north = degree("lat")
    t_m, t_d = _nearest("pxm", "pym", "dxm", "dym"), _nearest("px", "py", "dx", "dy")
    cell = lambda side: f"CAST(floor(lon / {side!r}::DOUBLE) AS BIGINT) || '_' || CAST(floor(lat / {side!r}::DOUBLE) AS BIGINT)"
    alerts = "count(*) AS alerts, " + ", ".join(f"count(*) FILTER (detection_type = '{k}') AS {n}" for n, k in {"idle_alerts": "idle", "deviation_alerts": "route_deviation", "delay_alerts": "delay", "breach_alerts": "geofence_breach", "gap_alerts": "gps_gap"}.items()) + ", count(*) FILTER (severity = 'critical') AS critical_alerts"
    key = lambda kind, zone, at: f"'{kind}|' || vehicle_id || '|' || coalesce({zone}, '-') || '|' || strftime({at}, '%Y%m%dT%H%M%S.%f')"
    grade = lambda v, limit: f"CASE WHEN {v} >= {limit} * 3 THEN 'critical' ELSE 'warning' END"
    dur = f"CASE WHEN ended_at IS NOT NULL THEN CAST(round_even({secs('started_at', 'ended_at')}, 0) AS BIGINT) END AS duration_seconds"
    shaped = lambda kind, zone: f"{key(kind, zone, 'started_at')} AS detection_key, '{kind}' AS detection_type, severity, vehicle_id, trip_id, {zone} AS zone_id, started_at, ended_at, {dur}, lat, lon, {r('magnitude', 2)} AS magnitude, reason"
    part = lambda cond, v, name: f"CAST(CASE WHEN {cond} THEN {v} ELSE 0 END AS DECIMAL(12,2)) AS {name}"
    slow = f"speed_kph <= {IDLE!r}::DOUBLE"
    seen, fast = "(gap_seconds IS NOT NULL AND NOT is_after_gap)", f"coalesce(kph > {IDLE!r}::DOUBLE, false)"
    sums = ", ".join(f"sum({c}) AS {c}" for c in ("moving_seconds", "stopped_seconds", "unobserved_seconds", "engine_on_seconds", "observed_seconds"))
    mean = lambda v: f"sum({v}) / nullif(CAST(count({v}) AS DOUBLE), 0)"
    return {
        "zones_": _values([(z.zone_id, z.name, z.zone_kind, z.max_dwell_minutes, *map(float, box(z.boundary)), _geojson("Polygon", z.boundary)) for z in config.zones], "zone_id, name, zone_kind, max_dwell_minutes, west, south, east, north, boundary_geojson"),
        "zone_parts": _values([p for z in config.zones for p in _parts(z.zone_id, z.boundary)], "zone_id, i, x1, y1, x2, y2"),
        "routes_": _values([(x.route_id, x.name, x.start_zone_id, x.end_zone_id, x.planned_duration_minutes, x.service_minutes, _geojson("LineString", x.path)) for x in config.routes], "route_id, name, start_zone_id, end_zone_id, planned_duration_minutes, service_minutes, path_geojson"),
        "route_parts": _values([p for x in config.routes for p in _parts(x.route_id, x.path)], "route_id, i, x1, y1, x2, y2"),
        "route_stops": _values([(x.route_id, z) for x in config.routes for z in x.stop_zone_ids], "route_id, zone_id"),
        "located": "SELECT *, coalesce(sum(len) OVER (PARTITION BY route_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS before, sum(len) OVER (PARTITION BY route_id) AS total FROM (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM route_parts)",
        "readings": "SELECT event_id, '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS ping_id, 'VH-' || user_id AS vehicle_id, CASE WHEN event_type <> 'view' THEN 'TR-' || user_id || '-' || strftime(ts, '%Y%m%d') END AS trip_id, ts AS recorded_at, 104.83::DOUBLE + (place * 7919 % 1200) / 1e4 AS lon, 11.5::DOUBLE + (place * 104729 % 1050) / 1e4 AS lat, CASE WHEN stands THEN value / 20 ELSE value END AS speed_kph, CAST(event_id * 31 % 360 AS DOUBLE) AS heading_deg, event_type <> 'error' AS ignition, CAST(event_id % 101 AS DOUBLE) AS fuel_pct, event_type FROM (SELECT *, CASE WHEN stands THEN user_id * 37 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END ELSE event_id END AS place FROM (SELECT *, value <= 20 AS stands FROM events))",
        "pings": f"SELECT *, {', '.join(f'{cell(side)} AS {name}' for name, side in GRID.items())} FROM readings WHERE speed_kph BETWEEN 0 AND 250 AND (ignition OR speed_kph <= 25)",
        "vehicles_": "SELECT 'VH-' || c_custkey AS vehicle_id, 'PP-' || c_custkey AS plate, ['van', 'truck', 'motorbike'][c_custkey % 3 + 1] AS vehicle_type, c_custkey % 40 * 100 + 60 AS capacity_kg, CASE WHEN c_custkey % 2 = 0 THEN 'Z-DEPOT-N' ELSE 'Z-DEPOT-S' END AS home_depot_id FROM customer",
        "trips_": f"SELECT trip_id, 'VH-' || n AS vehicle_id, [{', '.join(repr(x) for x in adapter.ROUTES)}][n % 4 + 1] AS route_id, day + INTERVAL 6 HOUR AS planned_start_at, day + INTERVAL 22 HOUR AS planned_end_at FROM (SELECT DISTINCT 'TR-' || user_id || '-' || strftime(ts, '%Y%m%d') AS trip_id, user_id AS n, date_trunc('day', ts)::TIMESTAMP AS day FROM events WHERE event_type <> 'view' UNION ALL SELECT 'TP-' || c_custkey, c_custkey, TIMESTAMP '2024-01-15' FROM customer WHERE c_custkey % 97 = 0)",
        "seq0": "SELECT *, lag(recorded_at) OVER w AS prev_recorded_at, lag(lon) OVER w AS prev_lon, lag(lat) OVER w AS prev_lat FROM pings WINDOW w AS (PARTITION BY vehicle_id ORDER BY recorded_at, ping_id)",
        "seq1": f"SELECT *, {secs('prev_recorded_at', 'recorded_at')} AS gap_seconds, {metres('lon', 'lat', 'prev_lon', 'prev_lat')} AS metres FROM seq0",
        "seq2": f"SELECT *, CASE WHEN gap_seconds > 0 THEN metres / gap_seconds * 3.6e0 END AS kph, coalesce(gap_seconds > {GAP}, false) AS is_after_gap FROM seq1",
        "segments": f"SELECT *, CAST(recorded_at AS DATE) AS recorded_date, date_trunc('hour', recorded_at)::TIMESTAMP AS recorded_hour, {r('metres', 2)} AS raw_distance_m, {r('kph', 2)} AS implied_speed_kph, ({seen} AND {fast}) AS is_moving, {part(seen, 'gap_seconds', 'observed_seconds')}, {part(f'{seen} AND {fast}', 'gap_seconds', 'moving_seconds')}, {part(f'{seen} AND NOT {fast}', 'gap_seconds', 'stopped_seconds')}, {part('is_after_gap', 'gap_seconds', 'unobserved_seconds')}, {part(f'{seen} AND {fast}', 'metres', 'travelled_m')}, {part(f'{seen} AND ignition', 'gap_seconds', 'engine_on_seconds')} FROM seq2",
        "moving": "SELECT *, CASE WHEN is_moving THEN CAST(implied_speed_kph AS DECIMAL(12,2)) END AS moving_kph FROM segments",
        "hours0": f"SELECT vehicle_id, recorded_hour, recorded_date, count(*) AS pings, count(DISTINCT trip_id) AS trips, sum(travelled_m) AS metres, {sums}, max(speed_kph) AS fastest, {mean('moving_kph')} AS average, count(*) FILTER (is_after_gap) AS signal_gaps FROM moving GROUP BY 1, 2, 3",
        "hours": f"SELECT *, extract(hour FROM recorded_hour) AS hour_of_day, {r('(CAST(metres AS DOUBLE) / 1000e0)', 3)} AS distance_km, greatest(engine_on_seconds - moving_seconds, 0) AS idling_engine_seconds, {r('fastest', 1)} AS max_speed_kph, {r('average', 1)} AS avg_moving_kph, {pct('moving_seconds', 'observed_seconds')} AS utilisation_pct, {pct('observed_seconds', '(observed_seconds + unobserved_seconds)')} AS coverage_pct FROM hours0",
        "activity": "SELECT vehicle_id, count(*) AS pings, count(DISTINCT trip_id) AS trips, min(recorded_at) AS first_seen_at, max(recorded_at) AS last_seen_at, sum(travelled_m) AS metres, sum(moving_seconds) AS moving_seconds, sum(stopped_seconds) AS stopped_seconds, sum(engine_on_seconds) AS engine_on_seconds, max(speed_kph) AS max_speed_kph FROM segments GROUP BY 1",
        "dim_vehicle": f"SELECT v.*, z.name AS home_depot_name, coalesce(a.pings, 0) AS pings, coalesce(a.trips, 0) AS trips, first_seen_at, last_seen_at, {r('(coalesce(CAST(metres AS DOUBLE), 0e0) / 1000e0)', 2)} AS distance_km, coalesce(moving_seconds, 0) AS moving_seconds, coalesce(stopped_seconds, 0) AS stopped_seconds, coalesce(engine_on_seconds, 0) AS engine_on_seconds, max_speed_kph, greatest(coalesce(engine_on_seconds - moving_seconds, 0), 0) AS idling_engine_seconds, a.pings IS NOT NULL AS has_reported FROM vehicles_ v JOIN zones_ z ON z.zone_id = v.home_depot_id LEFT JOIN activity a USING (vehicle_id)",
        "zone_sums": f"SELECT zone_id, abs(sum((x2 - x1) * {RAD!r}::DOUBLE * ({_authalic('y1')} + {_authalic('y2')}) / 2)) * {A * A!r}::DOUBLE AS area_m2, sum({metres('x1', 'y1', 'x2', 'y2')}) AS around_m FROM zone_parts GROUP BY 1",
        "dim_zone": f"SELECT z.*, {r('(area_m2 / 1e6)', 5)} AS area_km2, {r('(around_m / 1e3)', 4)} AS perimeter_km, (west + east) / 2 AS centre_lon, (south + north) / 2 AS centre_lat, zone_kind = 'restricted' AS breaches_on_entry, max_dwell_minutes IS NOT NULL AS has_dwell_limit FROM zones_ z JOIN zone_sums USING (zone_id)",
        "stop_near": f"SELECT route_id, zone_id, i, {t_d} AS t, before, len, total, px - {t_d} * dx AS gx, py - {t_d} * dy AS gy FROM (SELECT s.route_id, s.zone_id, l.*, x2 - x1 AS dx, y2 - y1 AS dy, (west + east) / 2 - x1 AS px, (south + north) / 2 - y1 AS py FROM route_stops s JOIN zones_ z USING (zone_id) JOIN located l ON l.route_id = s.route_id)",
        "stop_at": "SELECT route_id, zone_id, fraction, row_number() OVER (PARTITION BY route_id ORDER BY fraction, zone_id) AS n, count(*) OVER (PARTITION BY route_id) AS stops FROM (SELECT route_id, zone_id, (before + t * len) / total AS fraction, row_number() OVER (PARTITION BY route_id, zone_id ORDER BY gx * gx + gy * gy, i) AS k FROM stop_near) WHERE k = 1 AND fraction > 0 AND fraction < 1",
        "plan": "SELECT route_id, planned_duration_minutes * 60 AS total_s, service_minutes * 60 AS service_s, coalesce(max(stops), 0) AS stops FROM routes_ LEFT JOIN stop_at USING (route_id) GROUP BY 1, 2, 3",
        "schedule": "SELECT route_id, 0 AS seq, 0e0 AS fraction, 0 AS elapsed_seconds, CAST(NULL AS VARCHAR) AS zone_id FROM plan UNION ALL SELECT route_id, n, fraction, round_even((total_s - service_s * p.stops) * fraction + service_s * n, 0), zone_id FROM stop_at JOIN plan p USING (route_id) UNION ALL SELECT route_id, stops + 1, 1e0, total_s, NULL FROM plan",
        "dim_route": f"SELECT *, planned_duration_minutes - service_minutes * scheduled_stops AS planned_drive_minutes, {r('km', 3)} AS length_km, {r('(km / nullif((planned_duration_minutes - service_minutes * scheduled_stops) / 60e0, 0))', 1)} AS planned_avg_kph FROM routes_ JOIN (SELECT route_id, count(zone_id) AS scheduled_stops FROM schedule GROUP BY 1) USING (route_id) JOIN (SELECT route_id, sum({metres('x1', 'y1', 'x2', 'y2')}) / 1000e0 AS km FROM route_parts GROUP BY 1) USING (route_id)",
        "zoned": "SELECT p.ping_id, z.zone_id FROM pings p JOIN zones_ z ON p.lon BETWEEN z.west AND z.east AND p.lat BETWEEN z.south AND z.north",
        "zone_lists": "SELECT ping_id, string_agg(zone_id, ',' ORDER BY zone_id) AS zone_ids FROM zoned GROUP BY 1",
        "on_route": "SELECT p.ping_id, p.lat, p.recorded_at, t.planned_start_at, l.*, x2 - x1 AS dx, y2 - y1 AS dy, lon - x1 AS px, lat - y1 AS py FROM pings p JOIN trips_ t USING (trip_id) JOIN located l ON l.route_id = t.route_id",
        "on_plane": f"SELECT *, px * {east} AS pxm, py * {north} AS pym, dx * {east} AS dxm, dy * {north} AS dym, {t_d} AS t FROM on_route",
        "measured": f"SELECT ping_id, route_id, recorded_at, planned_start_at, (px - t * dx) * (px - t * dx) + (py - t * dy) * (py - t * dy) AS d2, i, (before + t * len) / total AS fraction, sqrt((pxm - {t_m} * dxm) * (pxm - {t_m} * dxm) + (pym - {t_m} * dym) * (pym - {t_m} * dym)) AS metres FROM on_plane",
        "routed": "SELECT ping_id, any_value(route_id) AS route_id, any_value(recorded_at) AS recorded_at, any_value(planned_start_at) AS planned_start_at, min(metres) AS route_distance_m, arg_min(fraction, (d2, i)) AS route_fraction FROM measured GROUP BY 1",
        "legs": "SELECT route_id, seq, fraction AS a, lead(fraction) OVER w AS b, elapsed_seconds AS c, lead(elapsed_seconds) OVER w AS d FROM schedule WINDOW w AS (PARTITION BY route_id ORDER BY seq)",
        "timed": "SELECT r.*, s.expected_elapsed_s FROM routed r LEFT JOIN LATERAL (SELECT c + (d - c) * (r.route_fraction - a) / nullif(b - a, 0) AS expected_elapsed_s FROM legs WHERE legs.route_id = r.route_id AND r.route_fraction >= a AND r.route_fraction <= b ORDER BY seq LIMIT 1) s ON true",
        "sequenced": f"SELECT *, sum(CASE WHEN after_gap THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY n) AS stretch FROM (SELECT *, {secs('prev_at', 'recorded_at')} AS gap_s, coalesce({secs('prev_at', 'recorded_at')} > {GAP}, false) AS after_gap, coalesce({secs('recorded_at', 'next_at')} > {GAP}, false) AS next_gap FROM (SELECT p.*, q.route_distance_m, {secs('planned_start_at', 'p.recorded_at')} - q.expected_elapsed_s AS delay_s, row_number() OVER w AS n, lag(p.recorded_at) OVER w AS prev_at, lag(trip_id) OVER w AS prev_trip, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lead(p.recorded_at) OVER w AS next_at, lead(trip_id) OVER w AS next_trip FROM pings p LEFT JOIN (SELECT ping_id, route_distance_m, planned_start_at, expected_elapsed_s FROM timed) q USING (ping_id) WINDOW w AS (PARTITION BY vehicle_id ORDER BY p.recorded_at, p.ping_id)))",
        "gaps": f"SELECT {shaped('gps_gap', 'NULL')} FROM (SELECT vehicle_id, prev_trip AS trip_id, prev_at AS started_at, recorded_at AS ended_at, prev_lat AS lat, prev_lon AS lon, gap_s / 60 AS magnitude, CASE WHEN gap_s >= {GAP * 3} THEN 'warning' ELSE 'info' END AS severity, CAST(NULL AS VARCHAR) AS reason FROM sequenced WHERE after_gap)",
        "inside": "SELECT s.*, z.zone_id, f.zone_kind, f.max_dwell_minutes, n - row_number() OVER (PARTITION BY vehicle_id, z.zone_id ORDER BY n) AS island FROM sequenced s JOIN zoned z USING (ping_id) JOIN zones_ f ON f.zone_id = z.zone_id",
        "inside_timed": f"SELECT *, {secs('started_at', 'recorded_at')} AS stay_s FROM (SELECT *, min(recorded_at) OVER (PARTITION BY vehicle_id, zone_id, stretch, island) AS started_at FROM inside)",
        "stays0": "SELECT vehicle_id, zone_id, zone_kind, max_dwell_minutes, stretch, island, started_at, arg_min({'trip': trip_id, 'lat': lat, 'lon': lon}, n) AS entry, arg_max({'at': recorded_at, 'next_at': next_at, 'next_gap': next_gap, 'trip': trip_id, 'next_trip': next_trip}, n) AS last, arg_min({'s': stay_s, 'lat': lat, 'lon': lon, 'trip': trip_id}, n) FILTER (stay_s > max_dwell_minutes * 60) AS over_ FROM inside_timed GROUP BY ALL",
        "stays": "SELECT *, CASE WHEN last.next_at IS NOT NULL AND NOT last.next_gap THEN last.next_at WHEN last.next_gap AND last.at > started_at THEN last.at END AS ended_at, CASE WHEN last.next_at IS NOT NULL AND NOT last.next_gap THEN last.next_trip WHEN last.next_gap AND last.at > started_at THEN last.trip END AS close_trip FROM stays0",
        "visits": f"SELECT {shaped('zone_visit', 'zone_id')} FROM (SELECT vehicle_id, zone_id, started_at, ended_at, coalesce(entry.trip, close_trip) AS trip_id, entry.lat AS lat, entry.lon AS lon, {secs('started_at', 'ended_at')} / 60 AS magnitude, 'info' AS severity, CAST(NULL AS VARCHAR) AS reason FROM stays)",
        "breaches": f"SELECT {shaped('geofence_breach', 'zone_id')} FROM (SELECT vehicle_id, zone_id, started_at, ended_at, coalesce(entry.trip, close_trip) AS trip_id, entry.lat AS lat, entry.lon AS lon, {secs('started_at', 'ended_at')} / 60 AS magnitude, 'critical' AS severity, 'entered_restricted_zone' AS reason FROM stays WHERE zone_kind = 'restricted' UNION ALL SELECT vehicle_id, zone_id, started_at, ended_at, coalesce(over_.trip, close_trip), over_.lat, over_.lon, s / 60, {grade('s', '(max_dwell_minutes * 60)')}, 'dwell_limit_exceeded' FROM (SELECT *, coalesce({secs('started_at', 'ended_at')}, over_.s) AS s FROM stays WHERE zone_kind <> 'restricted' AND over_ IS NOT NULL))",
        "off0": f"SELECT *, n - row_number() OVER (PARTITION BY vehicle_id ORDER BY n) AS island FROM sequenced WHERE route_distance_m > {S.deviation_metres!r}::DOUBLE",
        "off1": "SELECT *, min(recorded_at) OVER (PARTITION BY vehicle_id, stretch, island) AS started_at FROM off0",
        "off2": f"SELECT *, min(CASE WHEN {secs('started_at', 'recorded_at')} >= {S.deviation_seconds} THEN n END) OVER (PARTITION BY vehicle_id, stretch, island) AS told_n FROM off1",
        "off3": "SELECT vehicle_id, stretch, island, started_at, max(route_distance_m) AS peak, max(route_distance_m) FILTER (n <= told_n) AS peak_then, arg_max({'trip': trip_id, 'lat': lat, 'lon': lon}, n) FILTER (n = told_n) AS told, arg_max({'at': recorded_at, 'next_at': next_at, 'trip': trip_id}, n) AS last FROM off2 WHERE told_n IS NOT NULL GROUP BY 1, 2, 3, 4",
        "deviations": f"SELECT {shaped('route_deviation', 'NULL')} FROM (SELECT *, {grade('magnitude', repr(S.deviation_metres) + '::DOUBLE')} AS severity FROM (SELECT vehicle_id, started_at, CASE WHEN last.next_at IS NOT NULL THEN last.at END AS ended_at, coalesce(told.trip, CASE WHEN last.next_at IS NOT NULL THEN last.trip END) AS trip_id, told.lat AS lat, told.lon AS lon, CASE WHEN last.next_at IS NOT NULL THEN peak ELSE peak_then END AS magnitude, CAST(NULL AS VARCHAR) AS reason FROM off3))",
        "late_walk": f"SELECT vehicle_id, n, recorded_at, trip_id, lat, lon, delay_s, coalesce(delay_s >= {LATE}, false) AS told, CASE WHEN delay_s >= {LATE} THEN trunc(delay_s) END AS level FROM sequenced WHERE n = 1 UNION ALL SELECT vehicle_id, n, recorded_at, trip_id, lat, lon, delay_s, told, CASE WHEN told THEN trunc(delay_s) ELSE before END FROM (SELECT *, coalesce(delay_s >= {LATE} AND (before IS NULL OR delay_s >= before + {S.delay_restep_minutes * 60}), false) AS told FROM (SELECT s.*, CASE WHEN s.trip_id IS NOT DISTINCT FROM s.prev_trip THEN w.level END AS before FROM late_walk w JOIN sequenced s ON s.vehicle_id = w.vehicle_id AND s.n = w.n + 1))",
        "delays": f"SELECT {shaped('delay', 'NULL')} FROM (SELECT vehicle_id, trip_id, recorded_at AS started_at, recorded_at AS ended_at, lat, lon, delay_s / 60 AS magnitude, {grade('delay_s', LATE)} AS severity, CAST(NULL AS VARCHAR) AS reason FROM late_walk WHERE told)",
        "idle_walk": f"SELECT vehicle_id, n, CASE WHEN {slow} THEN n END AS start_n, lat, lon FROM sequenced WHERE n = 1 UNION ALL SELECT vehicle_id, n, CASE WHEN goes_on THEN start_n WHEN {slow} THEN n END, CASE WHEN goes_on THEN w_lat ELSE lat END, CASE WHEN goes_on THEN w_lon ELSE lon END FROM (SELECT s.*, w.start_n, w.lat AS w_lat, w.lon AS w_lon, ({slow} AND w.start_n IS NOT NULL AND NOT s.after_gap AND w.lat = s.lat AND w.lon = s.lon) AS goes_on FROM idle_walk w JOIN sequenced s ON s.vehicle_id = w.vehicle_id AND s.n = w.n + 1)",
        "idle_pings": f"SELECT s.*, w.start_n, {secs('since', 's.recorded_at')} AS stood, count(*) OVER r AS seen, sum(CASE WHEN ignition THEN 1 ELSE 0 END) OVER r AS powered FROM (SELECT *, min(seen_at) OVER (PARTITION BY vehicle_id, start_n) AS since FROM (SELECT w.*, s.recorded_at AS seen_at FROM idle_walk w JOIN sequenced s USING (vehicle_id, n)) WHERE start_n IS NOT NULL) w JOIN sequenced s USING (vehicle_id, n) WINDOW r AS (PARTITION BY vehicle_id, w.start_n ORDER BY n)",
        "idle_told": f"SELECT vehicle_id, start_n, arg_min({{'lat': lat, 'lon': lon, 'at': recorded_at, 'ping': ping_id}}, n) AS first, arg_min({{'s': stood, 'seen': seen, 'powered': powered, 'trip': trip_id}}, n) FILTER (stood >= {STAND}) AS told, arg_max({{'s': stood, 'seen': seen, 'powered': powered, 'trip': trip_id, 'at': recorded_at, 'next_at': next_at}}, n) AS last FROM idle_pings GROUP BY 1, 2 HAVING max(stood) >= {STAND}",
        "idles": f"SELECT {shaped('idle', 'blamed')} FROM (SELECT vehicle_id, blamed, first.at AS started_at, CASE WHEN closed THEN last.at END AS ended_at, coalesce(told.trip, CASE WHEN closed THEN last.trip END) AS trip_id, first.lat AS lat, first.lon AS lon, m.s / 60 AS magnitude, CASE WHEN m.powered * 2 < m.seen THEN 'info' ELSE {grade('m.s', STAND)} END AS severity, CAST(NULL AS VARCHAR) AS reason FROM (SELECT *, last.next_at IS NOT NULL AS closed, CASE WHEN last.next_at IS NOT NULL THEN {{'s': last.s, 'seen': last.seen, 'powered': last.powered}} ELSE {{'s': told.s, 'seen': told.seen, 'powered': told.powered}} END AS m FROM idle_told LEFT JOIN (SELECT ping_id AS ping, arg_min(zone_id, (CASE zone_kind WHEN 'depot' THEN 0 WHEN 'customer' THEN 1 WHEN 'restricted' THEN 2 ELSE 3 END, zone_id)) AS blamed FROM zoned JOIN zones_ USING (zone_id) GROUP BY 1) b ON b.ping = first.ping))",
        "episodes": "SELECT * FROM idles UNION ALL BY NAME SELECT * FROM delays UNION ALL BY NAME SELECT * FROM gaps UNION ALL BY NAME SELECT * FROM visits UNION ALL BY NAME SELECT * FROM breaches UNION ALL BY NAME SELECT * FROM deviations",
        "detections": f"SELECT *, CAST(started_at AS DATE) AS started_date, date_trunc('hour', started_at)::TIMESTAMP AS started_hour, {r('(duration_seconds / 60e0)', 2)} AS duration_minutes, ended_at IS NULL AS is_open, CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END AS severity_rank FROM episodes",
        "alerts0": f"SELECT d.*, v.plate, v.vehicle_type, t.route_id, x.name AS route_name, z.name AS zone_name, z.zone_kind, CASE d.detection_type WHEN 'geofence_breach' THEN CASE WHEN z.max_dwell_minutes IS NULL THEN 1e0 ELSE d.magnitude / z.max_dwell_minutes END WHEN 'route_deviation' THEN d.magnitude / {float(S.deviation_metres)!r}::DOUBLE WHEN 'gps_gap' THEN d.magnitude / {float(S.gps_gap_minutes)!r}::DOUBLE WHEN 'idle' THEN d.magnitude / {float(S.idle_minutes)!r}::DOUBLE WHEN 'delay' THEN d.magnitude / {float(S.delay_minutes)!r}::DOUBLE END AS multiple FROM detections d LEFT JOIN vehicles_ v USING (vehicle_id) LEFT JOIN zones_ z ON z.zone_id = d.zone_id LEFT JOIN trips_ t ON t.trip_id = d.trip_id LEFT JOIN routes_ x ON x.route_id = t.route_id",
        "alerts": f"SELECT *, {r('multiple', 2)} AS threshold_multiple FROM alerts0",
        "driven": f"SELECT trip_id, count(*) AS n, min(recorded_at) AS actual_start_at, max(recorded_at) AS actual_end_at, sum(travelled_m) AS metres, {sums}, max(speed_kph) AS fastest, {mean('moving_kph')} AS average FROM moving WHERE trip_id IS NOT NULL GROUP BY 1",
        "trip_alerts": f"SELECT trip_id, {alerts}, max(magnitude) FILTER (detection_type = 'delay') AS worst_delay_minutes, max(magnitude) FILTER (detection_type = 'route_deviation') AS worst_deviation_m FROM alerts WHERE trip_id IS NOT NULL GROUP BY 1",
        "final_trips": "SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY planned_start_at DESC, trip_id DESC) = 1 AS is_final_trip FROM trips_",
        "trip_facts0": f"SELECT f.*, v.plate, v.vehicle_type, x.name AS route_name, x.length_km AS route_length_km, x.planned_duration_minutes, d.* EXCLUDE (trip_id), a.* EXCLUDE (trip_id), coalesce(CAST(d.metres AS DOUBLE), 0e0) / 1000e0 AS km, {secs('planned_end_at', 'actual_end_at')} / 60e0 AS late FROM final_trips f JOIN vehicles_ v USING (vehicle_id) JOIN dim_route x USING (route_id) LEFT JOIN driven d ON d.trip_id = f.trip_id LEFT JOIN trip_alerts a ON a.trip_id = f.trip_id",
        "trip_facts": f"SELECT * REPLACE (coalesce(moving_seconds, 0) AS moving_seconds, coalesce(stopped_seconds, 0) AS stopped_seconds, coalesce(unobserved_seconds, 0) AS unobserved_seconds, coalesce(engine_on_seconds, 0) AS engine_on_seconds, coalesce(alerts, 0) AS alerts, coalesce(idle_alerts, 0) AS idle_alerts, coalesce(deviation_alerts, 0) AS deviation_alerts, coalesce(delay_alerts, 0) AS delay_alerts, coalesce(breach_alerts, 0) AS breach_alerts, coalesce(gap_alerts, 0) AS gap_alerts, coalesce(critical_alerts, 0) AS critical_alerts), CAST(planned_start_at AS DATE) AS planned_date, coalesce(n, 0) AS pings, {r('km', 2)} AS distance_km, {r('fastest', 1)} AS max_speed_kph, {r('average', 1)} AS avg_moving_kph, {r('(' + secs('actual_start_at', 'actual_end_at') + ' / 60e0)', 1)} AS actual_duration_minutes, {r('late', 1)} AS finish_delay_minutes, {pct('km', 'route_length_km')} AS route_coverage_pct, {pct('coalesce(moving_seconds, 0)', '(coalesce(moving_seconds, 0) + coalesce(stopped_seconds, 0))')} AS moving_share_pct, NOT is_final_trip AS is_complete, n IS NOT NULL AS has_telemetry, CASE WHEN NOT is_final_trip AND actual_end_at IS NOT NULL THEN late <= {S.delay_minutes} END AS is_on_time FROM trip_facts0",
        "daily_hours": "SELECT recorded_date AS activity_date, vehicle_type, count(DISTINCT vehicle_id) AS active_vehicles, sum(h.pings) AS pings, CAST(sum(CAST(h.distance_km AS DECIMAL(16,3))) AS DOUBLE) AS km, sum(h.moving_seconds) AS moving_seconds, sum(h.stopped_seconds) AS stopped_seconds, sum(h.unobserved_seconds) AS unobserved_seconds, sum(h.engine_on_seconds) AS engine_on_seconds, sum(h.observed_seconds) AS observed_seconds, sum(h.idling_engine_seconds) AS idling_engine_seconds, max(h.max_speed_kph) AS max_speed_kph FROM hours h JOIN dim_vehicle v USING (vehicle_id) GROUP BY 1, 2",
        "daily_alerts": f"SELECT started_date AS activity_date, vehicle_type, {alerts} FROM alerts WHERE vehicle_type IS NOT NULL GROUP BY 1, 2",
        "daily_trips": "SELECT planned_date AS activity_date, vehicle_type, count(*) AS trips_planned, count(*) FILTER (is_complete) AS trips_completed, count(*) FILTER (is_on_time) AS trips_on_time, count(*) FILTER (NOT has_telemetry) AS trips_without_telemetry, sum(CAST(finish_delay_minutes AS DECIMAL(14,1))) FILTER (is_complete) / nullif(CAST(count(finish_delay_minutes) FILTER (is_complete) AS DOUBLE), 0) AS lateness FROM trip_facts GROUP BY 1, 2",
        "daily": f"SELECT activity_date, vehicle_type, coalesce(active_vehicles, 0) AS active_vehicles, coalesce(pings, 0) AS pings, {r('coalesce(km, 0e0)', 2)} AS distance_km, coalesce(moving_seconds, 0) AS moving_seconds, coalesce(stopped_seconds, 0) AS stopped_seconds, coalesce(unobserved_seconds, 0) AS unobserved_seconds, coalesce(idling_engine_seconds, 0) AS idling_engine_seconds, max_speed_kph, {pct('moving_seconds', 'observed_seconds')} AS utilisation_pct, {pct('observed_seconds', '(observed_seconds + unobserved_seconds)')} AS coverage_pct, {pct('idling_engine_seconds', 'engine_on_seconds')} AS engine_idle_share_pct, coalesce(trips_planned, 0) AS trips_planned, coalesce(trips_completed, 0) AS trips_completed, coalesce(trips_on_time, 0) AS trips_on_time, coalesce(trips_without_telemetry, 0) AS trips_without_telemetry, {pct('trips_on_time', 'trips_completed')} AS on_time_pct, {r('lateness', 1)} AS avg_finish_delay_minutes, coalesce(alerts, 0) AS alerts, coalesce(critical_alerts, 0) AS critical_alerts, {pct('coalesce(alerts, 0)', 'km', 2)} AS alerts_per_100km FROM daily_hours FULL JOIN daily_alerts USING (activity_date, vehicle_type) FULL JOIN daily_trips USING (activity_date, vehicle_type)",
        "day_visits": "SELECT started_date AS activity_date, zone_id, count(*) AS visits, count(*) FILTER (NOT is_open) AS closed_visits, count(DISTINCT vehicle_id) AS vehicles, sum(duration_seconds) AS dwell_seconds, max(duration_seconds) AS longest FROM alerts WHERE detection_type = 'zone_visit' GROUP BY 1, 2",
        "day_breaches": "SELECT started_date AS activity_date, zone_id, count(*) AS breaches, count(*) FILTER (reason = 'entered_restricted_zone') AS entry_breaches, count(*) FILTER (reason = 'dwell_limit_exceeded') AS dwell_breaches, max(magnitude) AS worst_dwell_minutes FROM alerts WHERE detection_type = 'geofence_breach' GROUP BY 1, 2",
        "zone_days": f"SELECT activity_date, zone_id, z.name AS zone_name, zone_kind, max_dwell_minutes, area_km2, coalesce(visits, 0) AS visits, coalesce(closed_visits, 0) AS closed_visits, coalesce(vehicles, 0) AS vehicles, coalesce(dwell_seconds, 0) AS dwell_seconds, {r('(CAST(dwell_seconds AS DOUBLE) / 3600e0)', 2)} AS dwell_hours, {r('(CAST(dwell_seconds AS DOUBLE) / nullif(CAST(closed_visits AS DOUBLE), 0) / 60e0)', 1)} AS avg_dwell_minutes, {r('(longest / 60e0)', 1)} AS max_dwell_minutes_observed, coalesce(breaches, 0) AS breaches, coalesce(entry_breaches, 0) AS entry_breaches, coalesce(dwell_breaches, 0) AS dwell_breaches, worst_dwell_minutes, {pct('coalesce(dwell_breaches, 0)', 'closed_visits')} AS dwell_breach_rate_pct FROM (SELECT activity_date FROM day_visits UNION SELECT activity_date FROM day_breaches) CROSS JOIN dim_zone z LEFT JOIN day_visits USING (activity_date, zone_id) LEFT JOIN day_breaches USING (activity_date, zone_id)",
        "cells0": f"SELECT recorded_date AS activity_date, cell_r8, count(*) AS pings, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT trip_id) AS trips, sum(travelled_m) AS metres, sum(moving_seconds) AS moving_seconds, sum(stopped_seconds) AS stopped_seconds, sum(observed_seconds) AS observed_seconds, {mean('moving_kph')} AS average, min(moving_kph) AS least_, {mean('CAST(lat AS DECIMAL(12,7))')} AS lat, {mean('CAST(lon AS DECIMAL(12,7))')} AS lon FROM moving GROUP BY 1, 2",
        "cells": f"SELECT *, {r('(CAST(metres AS DOUBLE) / 1000e0)', 3)} AS distance_km, {r('average', 1)} AS avg_moving_kph, {r('CAST(least_ AS DOUBLE)', 1)} AS min_moving_kph, {pct('stopped_seconds', 'observed_seconds')} AS stopped_share_pct, {r('lat', 6)} AS mean_lat, {r('lon', 6)} AS mean_lon FROM cells0",
        "cell_totals": "SELECT cell_r8, sum(pings) AS pings, max(vehicles) AS vehicles, sum(stopped_seconds) AS stopped, " + r("(CAST(sum(stopped_seconds) AS DOUBLE) / 3600e0)", 2) + " AS stopped_hours, " + r("(CAST(sum(moving_seconds) AS DOUBLE) / 3600e0)", 2) + " AS moving_hours, " + ", ".join(r("(" + mean(f"CAST({c} AS DECIMAL(16,6))") + ")", n) + f" AS {c}" for c, n in (("avg_moving_kph", 1), ("stopped_share_pct", 1), ("mean_lat", 5), ("mean_lon", 5))) + " FROM cells GROUP BY 1",
    }


KINDS = {"l": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN", "t": "TIMESTAMP", "y": "VARCHAR", "s": "VARCHAR"}


def columns(spec: str) -> list[tuple[str, str]]:
    """(name, kind) of words such as ``pings#l``; without a mark, text."""
    return [(w.partition("#")[0], w.partition("#")[2] or "s") for w in spec.split()]


def query(final: str, spec: str, tail: str = "") -> str:
    """A select of ``spec`` from ``final`` (a name, or a select in brackets), with what it stands on."""
    known = expressions(demo())
    needed: dict[str, None] = {}

    def need(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", text)):
            if name in known and name not in needed:
                needed[name] = None
                need(known[name])

    need(final)
    chain = [n for n in known if n in needed]
    picked = ", ".join(f'CAST("{n}" AS {KINDS[k]}) AS "{n}"' for n, k in columns(spec))
    head = "WITH RECURSIVE " + ", ".join(f"{n} AS ({known[n]})" for n in chain) + " " if chain else ""
    return f"{head}SELECT {picked} FROM {final} {tail}".strip()
