"""The twelve models, as functions of a context that resolves references.

``ctx.ref(name)`` is another model, ``ctx.source(table)`` a landed table,
``ctx.var(name)`` a variable, ``ctx.this()`` the model's own table and
``ctx.is_incremental()`` whether there is one to add to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions.numbers import mean, money, ratio, rounded, seconds_between
from waymark.operators.landing import recent
from waymark.plans.dag import Context, model

COUNT = "*"


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    return rounded(ratio(part.cast("double") * 100.0, whole), places)


def _fresh(ctx: Context, rows: DataFrame, moment: str) -> DataFrame:
    return recent(rows, moment, ctx.this().agg(F.max(moment)).first()[0]) if ctx.is_incremental() else rows


@model("staging", materialized="incremental", unique_key="ping_id", partition_by="recorded_date", sort_by=("vehicle_id", "recorded_at"))
def stg_pings(ctx: Context) -> DataFrame:
    """One typed row per landed ping."""
    p = _fresh(ctx, ctx.source("raw.pings"), "ingested_at")
    return p.select(
        "ping_id", "vehicle_id", "trip_id", "recorded_at", F.to_date("recorded_at").alias("recorded_date"), F.date_trunc("hour", "recorded_at").alias("recorded_hour"), "lat", "lon", "cell_r8", "cell_r9", "speed_kph", "heading_deg", "ignition", "odometer_km", "fuel_pct",
        F.get_json_object("payload", "$.device.hdop").cast("double").alias("gps_hdop"), F.get_json_object("payload", "$.device.satellites").cast("int").alias("gps_satellites"),
        (F.col("speed_kph") <= ctx.var("idle_speed_kph")).alias("is_reported_stopped"), "ingested_at",
    )


@model("staging", materialized="incremental", unique_key="detection_key", partition_by="started_date", sort_by=("vehicle_id", "started_at"))
def stg_detections(ctx: Context) -> DataFrame:
    """One typed row per episode."""
    d = _fresh(ctx, ctx.source("stream.episodes"), "updated_at")
    rank = F.when(F.col("severity") == "critical", 3).when(F.col("severity") == "warning", 2).otherwise(1)
    return d.select(
        "detection_key", "detection_type", "severity", "vehicle_id", "trip_id", "zone_id", "started_at", "ended_at", F.to_date("started_at").alias("started_date"), F.date_trunc("hour", "started_at").alias("started_hour"), "duration_seconds",
        rounded(F.col("duration_seconds") / 60.0, 2).alias("duration_minutes"), "lat", "lon", "magnitude", "reason", F.col("ended_at").isNull().alias("is_open"), rank.alias("severity_rank"), "updated_at",
    )


@model("intermediate", sort_by=("vehicle_id", "recorded_at"))
def int_ping_segments(ctx: Context) -> DataFrame:
    """One row per ping with the movement since the vehicle's ping before."""
    w = Window.partitionBy("vehicle_id").orderBy("recorded_at", "ping_id")
    p = ctx.ref("stg_pings").select("ping_id", "vehicle_id", "trip_id", "recorded_at", "recorded_date", "recorded_hour", "lat", "lon", "cell_r8", "cell_r9", "speed_kph", "heading_deg", "ignition", "odometer_km")
    p = p.withColumns({"prev_recorded_at": F.lag("recorded_at").over(w), "prev_lon": F.lag("lon").over(w), "prev_lat": F.lag("lat").over(w)})
    p = p.withColumn("gap_seconds", seconds_between(F.col("prev_recorded_at"), F.col("recorded_at"))).withColumn("metres", geo.distance_m(F.col("lon"), F.col("lat"), F.col("prev_lon"), F.col("prev_lat")))
    p = p.withColumn("kph", F.when(F.col("gap_seconds") > 0, F.col("metres") / F.col("gap_seconds") * 3.6)).withColumn("is_after_gap", F.coalesce(F.col("gap_seconds") > ctx.var("gps_gap_minutes") * 60, F.lit(False)))
    fast = F.coalesce(F.col("kph") > ctx.var("idle_speed_kph"), F.lit(False))
    seen = F.col("gap_seconds").isNotNull() & ~F.col("is_after_gap")
    part = lambda condition, value: money(F.when(condition, value).otherwise(0.0))
    return p.select(
        "ping_id", "vehicle_id", "trip_id", "recorded_at", "recorded_date", "recorded_hour", "lat", "lon", "cell_r8", "cell_r9", "speed_kph", "heading_deg", "ignition", "odometer_km", "prev_recorded_at", "gap_seconds",
        rounded(F.col("metres"), 2).alias("raw_distance_m"), rounded(F.col("kph"), 2).alias("implied_speed_kph"), "is_after_gap",
        # The unrounded speed decides.
        (seen & fast).alias("is_moving"),
        part(seen, F.col("gap_seconds")).alias("observed_seconds"),
        part(seen & fast, F.col("gap_seconds")).alias("moving_seconds"),
        part(seen & ~fast, F.col("gap_seconds")).alias("stopped_seconds"),
        part(F.col("is_after_gap"), F.col("gap_seconds")).alias("unobserved_seconds"),
        part(seen & fast, F.col("metres")).alias("travelled_m"),
        part(seen & F.col("ignition"), F.col("gap_seconds")).alias("engine_on_seconds"),
    )


SUMS = ("moving_seconds", "stopped_seconds", "unobserved_seconds", "engine_on_seconds", "observed_seconds")


@model("marts", sort_by=("vehicle_id", "recorded_hour"))
def fct_vehicle_hours(ctx: Context) -> DataFrame:
    """One row per vehicle and hour with pings."""
    g = ctx.ref("int_ping_segments").groupBy("vehicle_id", "recorded_hour", "recorded_date").agg(
        F.count(COUNT).alias("pings"), F.count_distinct("trip_id").alias("trips"), F.sum("travelled_m").alias("travelled_m"), *[F.sum(c).alias(c) for c in SUMS],
        F.max("speed_kph").alias("fastest"), mean(F.when(F.col("is_moving"), F.col("implied_speed_kph").cast("decimal(12,2)"))).alias("average"), count_where(F.col("is_after_gap")).alias("signal_gaps"),
    )
    return g.select(
        "vehicle_id", "recorded_hour", "recorded_date", F.hour("recorded_hour").alias("hour_of_day"), "pings", "trips", rounded(F.col("travelled_m").cast("double") / 1000.0, 3).alias("distance_km"), *SUMS,
        F.greatest(F.col("engine_on_seconds") - F.col("moving_seconds"), F.lit(0)).alias("idling_engine_seconds"),
        rounded(F.col("fastest"), 1).alias("max_speed_kph"), rounded(F.col("average").cast("double"), 1).alias("avg_moving_kph"),
        percent(F.col("moving_seconds"), F.col("observed_seconds")).alias("utilisation_pct"), percent(F.col("observed_seconds"), F.col("observed_seconds") + F.col("unobserved_seconds")).alias("coverage_pct"), "signal_gaps",
    )


@model("marts")
def dim_vehicle(ctx: Context) -> DataFrame:
    """One row per vehicle, silent ones too."""
    a = ctx.ref("int_ping_segments").groupBy("vehicle_id").agg(
        F.count(COUNT).alias("pings"), F.count_distinct("trip_id").alias("trips"), F.min("recorded_at").alias("first_seen_at"), F.max("recorded_at").alias("last_seen_at"), F.sum("travelled_m").alias("travelled_m"),
        *[F.sum(c).alias(c) for c in ("moving_seconds", "stopped_seconds", "engine_on_seconds")], F.max("speed_kph").alias("max_speed_kph"),
    )
    depots = ctx.source("ref.zones").select(F.col("zone_id").alias("home_depot_id"), F.col("name").alias("home_depot_name"))
    v = ctx.source("ref.vehicles").join(depots, "home_depot_id").join(a, "vehicle_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(22,2)")).alias(c)
    return v.select(
        "vehicle_id", "plate", "vehicle_type", "capacity_kg", "home_depot_id", "home_depot_name", F.coalesce("pings", F.lit(0)).alias("pings"), F.coalesce("trips", F.lit(0)).alias("trips"), "first_seen_at", "last_seen_at",
        rounded(F.coalesce(F.col("travelled_m").cast("double"), F.lit(0.0)) / 1000.0, 2).alias("distance_km"), zero("moving_seconds"), zero("stopped_seconds"), zero("engine_on_seconds"), "max_speed_kph",
        F.greatest(F.coalesce(F.col("engine_on_seconds") - F.col("moving_seconds"), F.lit(0)), F.lit(0)).alias("idling_engine_seconds"), F.col("pings").isNotNull().alias("has_reported"),
    )


@model("marts")
def dim_zone(ctx: Context) -> DataFrame:
    """One row per zone, measured."""
    ring = F.col("boundary")
    z = ctx.source("ref.zones").withColumn("centre", geo.centroid(ring))
    return z.select(
        "zone_id", "name", "zone_kind", "max_dwell_minutes", rounded(geo.area_m2(ring) / 1e6, 5).alias("area_km2"), rounded(geo.length_m(ring) / 1000.0, 4).alias("perimeter_km"), F.col("centre.lat").alias("centre_lat"), F.col("centre.lon").alias("centre_lon"),
        geo.polygon_geojson(ring).alias("boundary_geojson"), (F.col("zone_kind") == "restricted").alias("breaches_on_entry"), F.col("max_dwell_minutes").isNotNull().alias("has_dwell_limit"),
    )


@model("marts")
def dim_route(ctx: Context) -> DataFrame:
    """One row per route, with its length and planned pace."""
    stops = ctx.source("ref.route_schedule").groupBy("route_id").agg(F.count("zone_id").alias("stops"))
    r = ctx.source("ref.routes").join(stops, "route_id", "left").withColumn("scheduled_stops", F.coalesce("stops", F.lit(0))).withColumn("km", geo.length_m(F.col("path")) / 1000.0)
    drive = F.col("planned_duration_minutes") - F.col("service_minutes") * F.col("scheduled_stops")
    return r.select(
        "route_id", "name", "start_zone_id", "end_zone_id", "planned_duration_minutes", "service_minutes", "scheduled_stops", rounded(F.col("km"), 3).alias("length_km"), drive.alias("planned_drive_minutes"),
        rounded(ratio(F.col("km"), drive / 60.0), 1).alias("planned_avg_kph"), geo.line_geojson(F.col("path")).alias("path_geojson"),
    )


@model("marts", sort_by=("started_at",))
def fct_alerts(ctx: Context) -> DataFrame:
    """One row per episode, with its vehicle, zone and route; none is dropped for lacking one."""
    d = ctx.ref("stg_detections")
    v = ctx.source("ref.vehicles").select("vehicle_id", "plate", "vehicle_type")
    z = ctx.ref("dim_zone").select("zone_id", F.col("name").alias("zone_name"), "zone_kind", "max_dwell_minutes")
    t = ctx.source("ref.trips").select("trip_id", "route_id")
    r = ctx.source("ref.routes").select("route_id", F.col("name").alias("route_name"))
    limits = {"idle": "idle_minutes", "route_deviation": "deviation_metres", "delay": "delay_minutes", "gps_gap": "gps_gap_minutes"}
    multiple = F.when(F.col("detection_type") == "geofence_breach", F.when(F.col("max_dwell_minutes").isNull(), 1.0).otherwise(F.col("magnitude") / F.col("max_dwell_minutes")))
    for kind, name in limits.items():
        multiple = multiple.when(F.col("detection_type") == kind, F.col("magnitude") / float(ctx.var(name)))
    j = d.join(v, "vehicle_id", "left").join(z, "zone_id", "left").join(t, "trip_id", "left").join(r, "route_id", "left")
    return j.select(
        "detection_key", "detection_type", "severity", "severity_rank", "is_open", "vehicle_id", "plate", "vehicle_type", "trip_id", "route_id", "route_name", "zone_id", "zone_name", "zone_kind", "started_at", "ended_at", "started_date", "started_hour",
        "duration_seconds", "duration_minutes", "lat", "lon", "magnitude", rounded(multiple, 2).alias("threshold_multiple"), "reason", "updated_at",
    )


ALERT_KINDS = {"idle_alerts": "idle", "deviation_alerts": "route_deviation", "delay_alerts": "delay", "breach_alerts": "geofence_breach", "gap_alerts": "gps_gap"}


def alert_counts() -> list[Column]:
    kind = F.col("detection_type")
    return [F.count(COUNT).alias("alerts"), *[count_where(kind == k).alias(n) for n, k in ALERT_KINDS.items()], count_where(F.col("severity") == "critical").alias("critical_alerts")]


@model("marts", sort_by=("vehicle_id", "planned_start_at"))
def fct_trips(ctx: Context) -> DataFrame:
    """One row per planned trip, driven or not.  A vehicle's last trip is not judged: it may still be on it.  Alerts count zone visits too."""
    a = ctx.ref("int_ping_segments").where("trip_id IS NOT NULL").groupBy("trip_id").agg(
        F.count(COUNT).alias("n"), F.min("recorded_at").alias("actual_start_at"), F.max("recorded_at").alias("actual_end_at"), F.sum("travelled_m").alias("metres"), *[F.sum(c).alias(c) for c in SUMS[:4]],
        F.max("speed_kph").alias("fastest"), mean(F.when(F.col("is_moving"), F.col("implied_speed_kph").cast("decimal(12,2)"))).alias("average"),
    )
    kind = F.col("detection_type")
    al = ctx.ref("fct_alerts").where("trip_id IS NOT NULL").groupBy("trip_id").agg(*alert_counts(), F.max(F.when(kind == "delay", F.col("magnitude"))).alias("worst_delay_minutes"), F.max(F.when(kind == "route_deviation", F.col("magnitude"))).alias("worst_deviation_m"))
    last_first = Window.partitionBy("vehicle_id").orderBy(F.desc("planned_start_at"), F.desc("trip_id"))
    t = ctx.source("ref.trips").withColumn("is_final_trip", F.row_number().over(last_first) == 1)
    v = ctx.source("ref.vehicles").select("vehicle_id", "plate", "vehicle_type")
    r = ctx.ref("dim_route").select("route_id", F.col("name").alias("route_name"), F.col("length_km").alias("route_length_km"), "planned_duration_minutes")
    j = t.join(v, "vehicle_id").join(r, "route_id").join(a, "trip_id", "left").join(al, "trip_id", "left")
    km = F.coalesce(F.col("metres").cast("double"), F.lit(0.0)) / 1000.0
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    late = seconds_between(F.col("planned_end_at"), F.col("actual_end_at")) / 60.0
    return j.select(
        "trip_id", "vehicle_id", "plate", "vehicle_type", "route_id", "route_name", "route_length_km", "planned_start_at", "planned_end_at", F.to_date("planned_start_at").alias("planned_date"), "planned_duration_minutes", "actual_start_at", "actual_end_at",
        zero("n").alias("pings"), rounded(km, 2).alias("distance_km"), *[zero(c).alias(c) for c in SUMS[:4]], rounded(F.col("fastest"), 1).alias("max_speed_kph"), rounded(F.col("average").cast("double"), 1).alias("avg_moving_kph"),
        rounded(seconds_between(F.col("actual_start_at"), F.col("actual_end_at")) / 60.0, 1).alias("actual_duration_minutes"), rounded(late, 1).alias("finish_delay_minutes"),
        percent(km, F.col("route_length_km")).alias("route_coverage_pct"), percent(zero("moving_seconds"), zero("moving_seconds") + zero("stopped_seconds")).alias("moving_share_pct"),
        *[zero(c).alias(c) for c in ("alerts", *ALERT_KINDS, "critical_alerts")], "worst_delay_minutes", "worst_deviation_m", "is_final_trip", (~F.col("is_final_trip")).alias("is_complete"), F.col("n").isNotNull().alias("has_telemetry"),
        F.when(~F.col("is_final_trip") & F.col("actual_end_at").isNotNull(), late <= float(ctx.var("delay_minutes"))).alias("is_on_time"),
    )


@model("marts")
def agg_daily_fleet(ctx: Context) -> DataFrame:
    """One row per date and vehicle type with hours, alerts or trips."""
    types = ctx.ref("dim_vehicle").select("vehicle_id", "vehicle_type")
    keys = ["activity_date", "vehicle_type"]
    h = ctx.ref("fct_vehicle_hours").join(types, "vehicle_id").groupBy(F.col("recorded_date").alias("activity_date"), "vehicle_type").agg(
        F.count_distinct("vehicle_id").alias("active_vehicles"), F.sum("pings").alias("pings"), F.sum(F.col("distance_km").cast("decimal(16,3)")).cast("double").alias("km"), *[F.sum(c).alias(c) for c in (*SUMS, "idling_engine_seconds")], F.max("max_speed_kph").alias("max_speed_kph"),
    )
    a = ctx.ref("fct_alerts").where("vehicle_type IS NOT NULL").groupBy(F.col("started_date").alias("activity_date"), "vehicle_type").agg(*alert_counts())
    done = F.col("is_complete")
    t = ctx.ref("fct_trips").groupBy(F.col("planned_date").alias("activity_date"), "vehicle_type").agg(
        F.count(COUNT).alias("trips_planned"), count_where(done).alias("trips_completed"), count_where(F.col("is_on_time")).alias("trips_on_time"), count_where(~F.col("has_telemetry")).alias("trips_without_telemetry"), mean(F.when(done, F.col("finish_delay_minutes").cast("decimal(14,1)"))).alias("lateness"),
    )
    j = h.join(a, keys, "full_outer").join(t, keys, "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select(
        *keys, zero("active_vehicles"), zero("pings"), rounded(F.coalesce("km", F.lit(0.0)), 2).alias("distance_km"), *[zero(c) for c in ("moving_seconds", "stopped_seconds", "unobserved_seconds", "idling_engine_seconds")], "max_speed_kph",
        percent(F.col("moving_seconds"), F.col("observed_seconds")).alias("utilisation_pct"), percent(F.col("observed_seconds"), F.col("observed_seconds") + F.col("unobserved_seconds")).alias("coverage_pct"), percent(F.col("idling_engine_seconds"), F.col("engine_on_seconds")).alias("engine_idle_share_pct"),
        *[zero(c) for c in ("trips_planned", "trips_completed", "trips_on_time", "trips_without_telemetry")], percent(F.col("trips_on_time"), F.col("trips_completed")).alias("on_time_pct"), rounded(F.col("lateness").cast("double"), 1).alias("avg_finish_delay_minutes"),
        *[zero(c) for c in ("alerts", "critical_alerts", *ALERT_KINDS)], percent(F.coalesce("alerts", F.lit(0)), F.col("km"), 2).alias("alerts_per_100km"),
    )


@model("marts")
def agg_zone_activity(ctx: Context) -> DataFrame:
    """One row per day with visits or breaches and zone, zeros for quiet zones.  The breach rate counts breaches still open."""
    alerts = ctx.ref("fct_alerts").where("zone_id IS NOT NULL AND detection_type IN ('zone_visit', 'geofence_breach')")
    visit, breach = F.col("detection_type") == "zone_visit", F.col("detection_type") == "geofence_breach"
    closed = visit & ~F.col("is_open")
    stay = F.when(closed, F.col("duration_seconds"))
    of_reason = lambda reason: count_where(breach & (F.col("reason") == reason))
    measures = {
        "visits": count_where(visit), "closed_visits": count_where(closed), "vehicles": F.count_distinct(F.when(visit, F.col("vehicle_id"))), "dwell_seconds": F.sum(stay), "longest": F.max(stay),
        "breaches": count_where(breach), "entry_breaches": of_reason("entered_restricted_zone"), "dwell_breaches": of_reason("dwell_limit_exceeded"), "worst_dwell_minutes": F.max(F.when(breach, F.col("magnitude"))),
    }
    found = alerts.groupBy(F.col("started_date").alias("activity_date"), "zone_id").agg(*[m.alias(n) for n, m in measures.items()])
    # A day's zones in one map, no longer than the catalogue of zones, so that alerts are gone through once.
    days = found.groupBy("activity_date").agg(F.map_from_entries(F.collect_list(F.struct("zone_id", F.struct(*measures)))).alias("by_zone"))
    z = ctx.ref("dim_zone").select("zone_id", F.col("name").alias("zone_name"), "zone_kind", "max_dwell_minutes", "area_km2", "centre_lat", "centre_lon")
    # Days times zones is the result's own size: every zone is written for every day.
    j = days.crossJoin(z).withColumn("of_zone", F.try_element_at("by_zone", F.col("zone_id"))).select("*", "of_zone.*")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select(
        "activity_date", "zone_id", "zone_name", "zone_kind", "max_dwell_minutes", "area_km2", "centre_lat", "centre_lon", zero("visits"), zero("closed_visits"), zero("vehicles"), zero("dwell_seconds"),
        rounded(F.col("dwell_seconds") / 3600.0, 2).alias("dwell_hours"), rounded(ratio(F.col("dwell_seconds"), F.col("closed_visits")) / 60.0, 1).alias("avg_dwell_minutes"), rounded(F.col("longest") / 60.0, 1).alias("max_dwell_minutes_observed"),
        zero("breaches"), zero("entry_breaches"), zero("dwell_breaches"), "worst_dwell_minutes", percent(F.coalesce("dwell_breaches", F.lit(0)), F.col("closed_visits")).alias("dwell_breach_rate_pct"),
    )


@model("marts")
def agg_cell_activity(ctx: Context) -> DataFrame:
    """One row per date and cell with pings: the heat map's grid."""
    speed = F.when(F.col("is_moving"), F.col("implied_speed_kph").cast("decimal(12,2)"))
    g = ctx.ref("int_ping_segments").groupBy(F.col("recorded_date").alias("activity_date"), "cell_r8").agg(
        F.count(COUNT).alias("pings"), F.count_distinct("vehicle_id").alias("vehicles"), F.count_distinct("trip_id").alias("trips"), F.sum("travelled_m").alias("metres"), *[F.sum(c).alias(c) for c in ("moving_seconds", "stopped_seconds", "observed_seconds")],
        mean(speed).alias("average"), F.min(speed).alias("least"), mean(F.col("lat").cast("decimal(12,7)")).alias("lat"), mean(F.col("lon").cast("decimal(12,7)")).alias("lon"),
    )
    return g.select(
        "activity_date", "cell_r8", "pings", "vehicles", "trips", rounded(F.col("metres").cast("double") / 1000.0, 3).alias("distance_km"), "moving_seconds", "stopped_seconds", "observed_seconds", rounded(F.col("average").cast("double"), 1).alias("avg_moving_kph"), rounded(F.col("least").cast("double"), 1).alias("min_moving_kph"),
        percent(F.col("stopped_seconds"), F.col("observed_seconds")).alias("stopped_share_pct"), rounded(F.col("lat").cast("double"), 6).alias("mean_lat"), rounded(F.col("lon").cast("double"), 6).alias("mean_lon"),
    )
