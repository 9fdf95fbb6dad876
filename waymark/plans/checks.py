"""Data tests: each counts the rows that break a rule; none passes, and a fault of the test itself is an error."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.plans.dag import REGISTRY
from waymark.plans.warehouse import Warehouse
from waymark.sources import schemas

SCOPES = {"not_null": "column", "unique": "column", "accepted_values": "column", "relationships": "column", "unique_combination": "model", "assert_expression": "model"}


class CheckError(ValueError):
    """A test that is declared wrongly."""


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    column: str | None = None
    values: tuple[str, ...] = ()
    to: str | None = None
    field: str | None = None
    columns: tuple[str, ...] = ()
    expression: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in SCOPES:
            raise CheckError(f"{self.model}: unknown test {self.kind!r}")
        if SCOPES[self.kind] == "column" and not self.column:
            raise CheckError(f"{self.model}: {self.kind} needs a column")
        if self.kind == "accepted_values" and not self.values:
            raise CheckError(f"{self.model}.{self.column}: accepted_values needs values")
        if self.kind == "relationships" and not (self.to and self.field):
            raise CheckError(f"{self.model}.{self.column}: relationships needs a model and a field")
        if self.kind == "unique_combination" and len(self.columns) < 2:
            raise CheckError(f"{self.model}: unique_combination needs two columns or more")
        if self.kind == "assert_expression" and not (self.expression or "").strip():
            raise CheckError(f"{self.model}: assert_expression needs an expression")

    @property
    def name(self) -> str:
        return f"{self.kind}({self.expression})" if self.expression else f"{self.kind}({', '.join(self.columns)})" if self.columns else self.kind


def surplus(rows: DataFrame, *columns: str) -> DataFrame:
    """failing: by how many rows the groups of equal values exceed one row each."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_size")).agg(F.coalesce(F.sum("_size") - F.count(F.lit(1)), F.lit(0)).cast("long").alias("failing"))


def broken(check: Check) -> Column | None:
    """Whether a row breaks the rule, for rules that look at one row at a time."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.cast("string").isin(list(check.values))
    if check.kind == "assert_expression":
        return ~F.coalesce(F.expr(f"({check.expression})"), F.lit(False))
    return None


def violations(check: Check, rows: DataFrame, parent: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """failing: one row with the number of rows that break the rule."""
    if (wrong := broken(check)) is not None:
        return rows.agg(F.count(F.when(wrong, 1)).alias("failing"))
    c = F.col(check.column) if check.column else None
    if check.kind == "unique":
        return surplus(rows.where(c.isNotNull()), check.column)
    if check.kind == "unique_combination":
        return surplus(rows, *check.columns)
    known = parent(check.to).select(F.col(check.field).alias(check.column))
    return rows.where(c.isNotNull()).join(known, check.column, "left_anti").agg(F.count(F.lit(1)).alias("failing"))


def declare(model: str, *, not_null: str = "", unique: str = "", accepted: dict[str, str] | None = None, related: dict[str, tuple[str, str]] | None = None, combination: str = "", asserts: Iterable[str] = ()) -> list[Check]:
    out = [Check(model, "not_null", column=c) for c in not_null.split()] + [Check(model, "unique", column=c) for c in unique.split()]
    out += [Check(model, "accepted_values", column=c, values=tuple(v.split())) for c, v in (accepted or {}).items()]
    out += [Check(model, "relationships", column=c, to=t, field=f) for c, (t, f) in (related or {}).items()]
    out += [Check(model, "unique_combination", columns=tuple(combination.split()))] if combination else []
    return out + [Check(model, "assert_expression", expression=e) for e in asserts]


KINDS = "idle zone_visit geofence_breach route_deviation delay gps_gap"
SEVERITIES = "info warning critical"
SHARE = ("utilisation_pct IS NULL OR utilisation_pct BETWEEN 0 AND 100", "coverage_pct IS NULL OR coverage_pct BETWEEN 0 AND 100")
SPLIT = "moving_seconds + stopped_seconds = observed_seconds"
POINT = ("lat IS NULL OR lat BETWEEN -90 AND 90", "lon IS NULL OR lon BETWEEN -180 AND 180")
EPISODE = ("ended_at IS NULL OR ended_at >= started_at", "duration_seconds IS NULL OR duration_seconds >= 0", "is_open = (ended_at IS NULL)", "severity_rank BETWEEN 1 AND 3", "is_open OR duration_seconds IS NOT NULL")

#: The declared tests of every model.
CHECKS: list[Check] = [
    *declare("stg_pings", not_null="ping_id vehicle_id recorded_at recorded_date recorded_hour lat lon speed_kph ignition cell_r8 cell_r9 is_reported_stopped ingested_at", unique="ping_id", asserts=(
        "lat BETWEEN -90 AND 90", "lon BETWEEN -180 AND 180", "speed_kph >= 0 AND speed_kph <= 250", "heading_deg IS NULL OR (heading_deg >= 0 AND heading_deg < 360)", "fuel_pct IS NULL OR fuel_pct BETWEEN 0 AND 100",
        "odometer_km IS NULL OR odometer_km BETWEEN 0 AND 10000000", "recorded_at > TIMESTAMP '2020-01-01 00:00:00'", "recorded_at < now() + INTERVAL '1' DAY", "length(cell_r8) > 0 AND length(cell_r9) > 0", "cell_r8 <> cell_r9", "recorded_date = to_date(recorded_hour)")),
    *declare("stg_detections", not_null="detection_key detection_type severity vehicle_id started_at started_date is_open", unique="detection_key", accepted={"detection_type": KINDS, "severity": SEVERITIES}, asserts=(
        *EPISODE, "detection_type <> 'geofence_breach' OR zone_id IS NOT NULL", "detection_type <> 'zone_visit' OR zone_id IS NOT NULL", "detection_type <> 'gps_gap' OR severity <> 'critical'", "detection_type <> 'delay' OR started_at = ended_at", *POINT)),
    *declare("int_ping_segments", not_null="ping_id vehicle_id recorded_at is_moving is_after_gap observed_seconds travelled_m", unique="ping_id", related={"ping_id": ("stg_pings", "ping_id")}, asserts=(
        SPLIT, "observed_seconds >= 0", "moving_seconds >= 0", "stopped_seconds >= 0", "unobserved_seconds >= 0", "travelled_m >= 0", "engine_on_seconds <= observed_seconds", "is_moving OR travelled_m = 0", "NOT is_moving OR moving_seconds > 0",
        "NOT is_after_gap OR observed_seconds = 0", "is_after_gap OR unobserved_seconds = 0", "implied_speed_kph IS NULL OR implied_speed_kph >= 0", "prev_recorded_at IS NULL OR prev_recorded_at <= recorded_at")),
    *declare("dim_vehicle", not_null="vehicle_id plate vehicle_type home_depot_id has_reported", unique="vehicle_id", accepted={"vehicle_type": "van truck motorbike"}, related={"home_depot_id": ("dim_zone", "zone_id")}, asserts=(
        "distance_km >= 0", "moving_seconds >= 0 AND stopped_seconds >= 0", "idling_engine_seconds <= engine_on_seconds", "has_reported = (pings > 0)", "NOT has_reported OR last_seen_at >= first_seen_at", "capacity_kg > 0")),
    *declare("dim_zone", not_null="zone_id name zone_kind area_km2", unique="zone_id", accepted={"zone_kind": "depot customer restricted congestion"}, asserts=(
        "area_km2 > 0", "perimeter_km > 0", "centre_lat BETWEEN -90 AND 90", "centre_lon BETWEEN -180 AND 180", "breaches_on_entry = (zone_kind = 'restricted')", "has_dwell_limit = (max_dwell_minutes IS NOT NULL)", "max_dwell_minutes IS NULL OR max_dwell_minutes > 0", "boundary_geojson LIKE '{\"type\":\"Polygon\"%'")),
    *declare("dim_route", not_null="route_id name length_km", unique="route_id", related={"start_zone_id": ("dim_zone", "zone_id"), "end_zone_id": ("dim_zone", "zone_id")}, asserts=(
        "length_km > 0", "planned_duration_minutes > 0", "planned_drive_minutes > 0", "planned_avg_kph BETWEEN 3 AND 120", "service_minutes >= 0", "path_geojson LIKE '{\"type\":\"LineString\"%'")),
    *declare("fct_alerts", not_null="detection_key detection_type severity severity_rank vehicle_id started_at is_open", unique="detection_key", accepted={"detection_type": KINDS, "severity": SEVERITIES}, related={"detection_key": ("stg_detections", "detection_key"), "zone_id": ("dim_zone", "zone_id")}, asserts=(
        *EPISODE, *POINT, "threshold_multiple IS NULL OR threshold_multiple >= 0", "detection_type <> 'zone_visit' OR threshold_multiple IS NULL", "zone_id IS NULL OR zone_name IS NOT NULL", "reason IS NULL OR detection_type = 'geofence_breach'")),
    *declare("fct_trips", not_null="trip_id vehicle_id route_id planned_start_at is_complete has_telemetry", unique="trip_id", related={"vehicle_id": ("dim_vehicle", "vehicle_id"), "route_id": ("dim_route", "route_id")}, asserts=(
        "planned_end_at > planned_start_at", "actual_end_at IS NULL OR actual_end_at >= actual_start_at", "distance_km >= 0", "moving_seconds >= 0 AND stopped_seconds >= 0", "alerts >= critical_alerts",
        "alerts >= idle_alerts + deviation_alerts + delay_alerts + breach_alerts + gap_alerts", "has_telemetry = (pings > 0)", "is_on_time IS NULL OR is_complete", "NOT is_final_trip OR is_on_time IS NULL", "moving_share_pct IS NULL OR moving_share_pct BETWEEN 0 AND 100")),
    *declare("fct_vehicle_hours", not_null="vehicle_id recorded_hour pings", related={"vehicle_id": ("dim_vehicle", "vehicle_id")}, combination="vehicle_id recorded_hour", asserts=(
        SPLIT, *SHARE, "idling_engine_seconds <= engine_on_seconds", "hour_of_day BETWEEN 0 AND 23", "pings > 0", "distance_km >= 0", "trips <= pings")),
    *declare("agg_daily_fleet", not_null="activity_date vehicle_type", combination="activity_date vehicle_type", asserts=(
        "distance_km >= 0", *SHARE, "on_time_pct IS NULL OR on_time_pct BETWEEN 0 AND 100", "engine_idle_share_pct IS NULL OR engine_idle_share_pct BETWEEN 0 AND 100", "trips_completed <= trips_planned", "trips_on_time <= trips_completed", "alerts >= critical_alerts", "active_vehicles >= 0")),
    *declare("agg_zone_activity", not_null="activity_date zone_id visits", related={"zone_id": ("dim_zone", "zone_id")}, combination="activity_date zone_id", asserts=(
        "visits >= closed_visits", "vehicles <= visits", "breaches = entry_breaches + dwell_breaches", "entry_breaches = 0 OR zone_kind = 'restricted'", "dwell_breaches = 0 OR max_dwell_minutes IS NOT NULL", "dwell_seconds >= 0")),
    *declare("agg_cell_activity", not_null="activity_date cell_r8 pings", combination="activity_date cell_r8", asserts=(
        "pings > 0", "vehicles > 0", SPLIT, "mean_lat BETWEEN -90 AND 90", "mean_lon BETWEEN -180 AND 180", "distance_km >= 0", "trips <= pings")),
]


def _row_by_row(checks: Iterable[Check], table: Callable[[str], DataFrame]) -> dict[int, int]:
    """Failing rows of every rule that looks at one row at a time, by one scan of each model; models where one of the rules cannot run are left out."""
    of_model: dict[str, list[Check]] = {}
    for c in checks:
        if broken(c) is not None:
            of_model.setdefault(c.model, []).append(c)
    out: dict[int, int] = {}
    for model, own in of_model.items():
        try:
            row = table(model).agg(*[F.count(F.when(broken(c), 1)).alias(f"c{k}") for k, c in enumerate(own)]).first()
        except Exception:  # noqa: BLE001 - each is then tried alone, so that the fault is put down to the right one
            continue
        out |= {id(c): row[k] for k, c in enumerate(own)}
    return out


def run(warehouse: Warehouse, checks: Iterable[Check] | None = None, *, names: Iterable[str] | None = None) -> dict:
    """Run tests against the built models and log them; {"run_id", "passed", "failed", "errored", "results"}."""
    spark, wanted = warehouse.spark, set(names or ())
    known = {c.model for c in CHECKS if checks is None} | {c.model for c in checks or ()}
    if missing := wanted - known:
        raise CheckError(f"no tests for {', '.join(sorted(missing))}")
    table = lambda model: warehouse.read(REGISTRY.models[model].table)
    run_id, log = uuid.uuid4().hex, []
    chosen = [c for c in (CHECKS if checks is None else checks) if not wanted or c.model in wanted]
    counted = _row_by_row(chosen, table)
    for c in chosen:
        failing, error = counted.get(id(c)), None
        try:
            if failing is None:
                failing = violations(c, table(c.model), table).first()[0] or 0
            status = "pass" if failing == 0 else "fail"
        except Exception as fault:  # noqa: BLE001 - a test that cannot run is an error, not a failure
            status, error = "error", str(fault)[:2000]
        log.append((run_id, c.model, c.column, c.name, status, failing, error, datetime.now(timezone.utc)))
    warehouse.append("meta.test_results", spark.createDataFrame(log, schemas.TEST_RESULTS).coalesce(1))
    tally = lambda s: sum(x[4] == s for x in log)
    return {"run_id": run_id, "passed": tally("pass"), "failed": tally("fail"), "errored": tally("error"), "results": [dict(zip(("model", "column", "test", "status", "failing", "error"), x[1:7])) for x in log]}
