"""Declared schemas of the raw, ref, stream and meta layers."""

from __future__ import annotations

PLACE = "STRUCT<lon: DOUBLE, lat: DOUBLE>"

ZONES = f"zone_id STRING, name STRING, zone_kind STRING, max_dwell_minutes INT, boundary ARRAY<{PLACE}>"
ROUTES = f"route_id STRING, name STRING, start_zone_id STRING, end_zone_id STRING, planned_duration_minutes INT, service_minutes INT, stop_zone_ids ARRAY<STRING>, path ARRAY<{PLACE}>"
VEHICLES = "vehicle_id STRING, plate STRING, vehicle_type STRING, capacity_kg INT, home_depot_id STRING"
TRIPS = "trip_id STRING, vehicle_id STRING, route_id STRING, planned_start_at TIMESTAMP, planned_end_at TIMESTAMP"
SCHEDULE = "route_id STRING, seq INT, fraction DOUBLE, elapsed_seconds INT, zone_id STRING"

MESSAGES = "value BINARY, key BINARY, topic STRING, partition INT, offset BIGINT"
PING_FIELDS = "ping_id STRING, vehicle_id STRING, trip_id STRING, recorded_at TIMESTAMP, lon DOUBLE, lat DOUBLE, speed_kph DOUBLE, heading_deg DOUBLE, ignition BOOLEAN, odometer_km DOUBLE, fuel_pct DOUBLE, payload STRING"
PINGS = PING_FIELDS + ", cell_r8 STRING, cell_r9 STRING, offset BIGINT, partition INT, topic STRING, ingested_at TIMESTAMP, batch_id BIGINT"
DEAD_LETTERS = "topic STRING, partition INT, offset BIGINT, message_key STRING, value STRING, error STRING, rejected_at TIMESTAMP, batch_id BIGINT"
DETECTION_FIELDS = "detection_key STRING, detection_type STRING, severity STRING, vehicle_id STRING, trip_id STRING, zone_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP, duration_seconds INT, lat DOUBLE, lon DOUBLE, magnitude DOUBLE, details STRING, is_first BOOLEAN, write_seq INT"
DETECTIONS = DETECTION_FIELDS + ", batch_id BIGINT"
STATES = "vehicle_id STRING, state STRING, batch_id BIGINT"
BATCHES = "batch_id BIGINT, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, messages_read BIGINT, rows_inserted BIGINT, rows_duplicate BIGINT, rows_rejected BIGINT, detections_found BIGINT, error STRING"
MODEL_RUNS = "run_id STRING, model STRING, layer STRING, materialized STRING, status STRING, rows BIGINT, started_at TIMESTAMP, finished_at TIMESTAMP, error STRING"
TEST_RESULTS = "run_id STRING, model_name STRING, column_name STRING, test_name STRING, status STRING, failing_rows BIGINT, error STRING, executed_at TIMESTAMP"

#: Every declared relation by its layered name.
RELATIONS = {
    "raw.pings": PINGS,
    "raw.pings_dead_letter": DEAD_LETTERS,
    "ref.zones": ZONES,
    "ref.routes": ROUTES,
    "ref.vehicles": VEHICLES,
    "ref.trips": TRIPS,
    "ref.route_schedule": SCHEDULE,
    "stream.detections": DETECTIONS,
    "stream.vehicle_state": STATES,
    "meta.ingest_batches": BATCHES,
    "meta.model_runs": MODEL_RUNS,
    "meta.test_results": TEST_RESULTS,
}
