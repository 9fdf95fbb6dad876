"""Reports: one DataFrame each, from the tables that ``t`` (a name -> DataFrame function) gives."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.numbers import mean, rounded
from waymark.operators.landing import optional
from waymark.plans.models import count_where, percent
from waymark.plans.warehouse import Warehouse
from waymark.sources import schemas

Tables = Callable[[str], DataFrame]
N = "*"
MAGNITUDE_UNITS = {"idle": "min", "zone_visit": "min", "geofence_breach": "min", "route_deviation": "m", "delay": "min", "gps_gap": "min"}
#: Decimals make averages exact, whatever the order of their rows.
exact = lambda c: F.col(c).cast("decimal(16,3)")


def _down(*names: str) -> list[Column]:
    """Descending, with nulls first, as the matched engine has them."""
    return [F.col(n).desc_nulls_first() for n in names]


def ingest_overview(t: Tables) -> DataFrame:
    p = t("raw.pings").agg(F.count(N).alias("pings"), F.count_distinct("vehicle_id").alias("vehicles"), F.count_distinct("trip_id").alias("trips"), F.min("recorded_at").alias("first_ping_at"), F.max("recorded_at").alias("last_ping_at"), F.max("ingested_at").alias("last_ingested_at"))
    return p.withColumn("dead_letters", t("raw.pings_dead_letter").agg(F.count(N)).scalar())


def dead_letter_reasons(t: Tables, limit: int | None = 8) -> DataFrame:
    """Messages by the start of their error: the rest carries the value at fault."""
    g = t("raw.pings_dead_letter").groupBy(F.split_part("error", F.lit(","), F.lit(1)).alias("reason")).agg(F.count(N).alias("messages"), F.max("rejected_at").alias("last_seen_at")).orderBy(F.desc("messages"), "reason")
    return g.limit(limit) if limit else g


def recent_batches(t: Tables, limit: int = 5) -> DataFrame:
    return t("meta.ingest_batches").orderBy(F.desc("batch_id")).limit(limit)


def table_counts(warehouse: Warehouse, models: list[str]) -> list[tuple[str, int | None]]:
    """(table, rows), with None for a table that is not there."""
    return [(n, warehouse.read(n).count() if warehouse.exists(n) else None) for n in (*schemas.RELATIONS, *models)]


def open_episodes(t: Tables) -> DataFrame:
    return t("stream.episodes").where("ended_at IS NULL").select("detection_type", "severity", "vehicle_id", "zone_id", "started_at", "magnitude").orderBy("started_at", "detection_type", "vehicle_id", "zone_id")


def alerts(t: Tables, *, limit: int = 25, detection_type: str | None = None, severity: str | None = None, vehicle_id: str | None = None, open_only: bool = False) -> DataFrame:
    a = optional(t("fct_alerts"), detection_type=detection_type, severity=severity, vehicle_id=vehicle_id)
    a = a.where("is_open") if open_only else a
    best = [F.desc("severity_rank"), F.coalesce("threshold_multiple", F.lit(0.0)).desc(), F.desc("started_at"), F.asc("detection_key")]
    return a.orderBy(*best).limit(limit)


def alert_summary(t: Tables) -> DataFrame:
    s = F.col("severity")
    g = t("fct_alerts").groupBy("detection_type").agg(
        F.count(N).alias("episodes"), *[count_where(s == x).alias(x) for x in ("critical", "warning", "info")], count_where(F.col("is_open")).alias("still_open"), rounded(mean(exact("magnitude")), 1).alias("avg_magnitude"),
        rounded(F.max("magnitude"), 1).alias("max_magnitude"), rounded(F.max("threshold_multiple"), 1).alias("worst_multiple"), F.count_distinct("vehicle_id").alias("vehicles"),
    )
    return g.orderBy(F.desc("critical"), F.desc("episodes"), "detection_type")


def trips(t: Tables, *, limit: int = 20, vehicle_id: str | None = None) -> DataFrame:
    return optional(t("fct_trips"), vehicle_id=vehicle_id).orderBy(F.desc("planned_start_at"), "trip_id").limit(limit)


def trip_punctuality(t: Tables) -> DataFrame:
    done = F.col("is_complete")
    g = t("fct_trips").groupBy("vehicle_type").agg(F.count(N).alias("trips"), count_where(done).alias("completed"), count_where(F.col("is_on_time")).alias("on_time"), rounded(mean(F.when(done, exact("finish_delay_minutes"))), 1).alias("avg_delay_minutes"), rounded(F.sum(exact("distance_km")).cast("double"), 1).alias("distance_km"))
    return g.withColumn("on_time_pct", percent(F.col("on_time"), F.col("completed"))).orderBy("vehicle_type")


def vehicles(t: Tables) -> DataFrame:
    a = t("fct_alerts").groupBy("vehicle_id").agg(F.count(N).alias("alerts"), count_where(F.col("severity") == "critical").alias("critical_alerts"))
    v = t("dim_vehicle").join(a, "vehicle_id", "left")
    hours = lambda c, d, n: rounded(F.col(c).cast("double") / d, n)
    return v.select(
        "vehicle_id", "plate", "vehicle_type", "home_depot_name", "pings", "trips", "distance_km", hours("moving_seconds", 3600.0, 2).alias("moving_hours"), hours("stopped_seconds", 3600.0, 2).alias("stopped_hours"), hours("idling_engine_seconds", 60.0, 1).alias("idling_minutes"), "max_speed_kph",
        percent(F.col("moving_seconds"), F.col("moving_seconds") + F.col("stopped_seconds")).alias("utilisation_pct"), "has_reported", F.coalesce("alerts", F.lit(0)).alias("alerts"), F.coalesce("critical_alerts", F.lit(0)).alias("critical_alerts"),
    ).orderBy(F.desc("distance_km"), "vehicle_id")


def _days(rows: DataFrame, days: int, today: date | None) -> DataFrame:
    return rows.where(F.col("activity_date") >= F.date_sub(F.lit(today) if today else F.current_date(), days))


def zone_activity(t: Tables, *, days: int = 7, today: date | None = None) -> DataFrame:
    g = _days(t("agg_zone_activity"), days, today).groupBy("zone_id").agg(
        F.max("zone_name").alias("zone_name"), F.max("zone_kind").alias("zone_kind"), F.max("max_dwell_minutes").alias("max_dwell_minutes"), rounded(F.max("area_km2"), 3).alias("area_km2"), F.sum("visits").alias("visits"), F.sum("closed_visits").alias("closed_visits"), F.max("vehicles").alias("peak_vehicles"),
        rounded(F.sum(exact("dwell_hours")).cast("double"), 2).alias("dwell_hours"), rounded(mean(exact("avg_dwell_minutes")), 1).alias("avg_dwell_minutes"), F.max("max_dwell_minutes_observed").alias("max_dwell_observed"), F.sum("breaches").alias("breaches"), F.sum("entry_breaches").alias("entry_breaches"), F.sum("dwell_breaches").alias("dwell_breaches"),
    )
    return g.orderBy(*_down("breaches", "visits"), "zone_id")


def _cells(t: Tables) -> DataFrame:
    """Per cell over all days; the means are unweighted means of the days' own."""
    hours = lambda c: rounded(F.sum(c).cast("double") / 3600.0, 2)
    typical = lambda c, n: rounded(mean(F.col(c).cast("decimal(16,6)")), n)
    return t("agg_cell_activity").groupBy("cell_r8").agg(
        F.sum("pings").alias("pings"), F.max("vehicles").alias("vehicles"), hours("stopped_seconds").alias("stopped_hours"), hours("moving_seconds").alias("moving_hours"), typical("avg_moving_kph", 1).alias("avg_moving_kph"), typical("stopped_share_pct", 1).alias("stopped_share_pct"),
        typical("mean_lat", 5).alias("mean_lat"), typical("mean_lon", 5).alias("mean_lon"), F.sum("stopped_seconds").alias("stopped"),
    )


def hotspots(t: Tables, *, limit: int = 12) -> DataFrame:
    """The cells where vehicles stand longest, not those with most pings: those are the depots."""
    return _cells(t).orderBy(F.desc("stopped"), "cell_r8").limit(limit).drop("stopped")


def daily_fleet(t: Tables, *, days: int = 7, today: date | None = None) -> DataFrame:
    keep = "activity_date vehicle_type active_vehicles pings distance_km utilisation_pct coverage_pct engine_idle_share_pct trips_planned trips_completed on_time_pct avg_finish_delay_minutes alerts critical_alerts alerts_per_100km"
    return _days(t("agg_daily_fleet"), days, today).select(*keep.split()).orderBy(F.desc("activity_date"), "vehicle_type")


def _last_run(rows: DataFrame, moment: Column, statuses: dict[str, str], what: str) -> DataFrame:
    g = rows.groupBy("run_id").agg(moment.alias("at"), F.count(N).alias(what), *[count_where(F.col("status") == s).alias(n) for n, s in statuses.items()])
    return g.orderBy(F.desc("at"), "run_id").limit(1)


def last_transform_run(t: Tables) -> DataFrame:
    return _last_run(t("meta.model_runs"), F.min("started_at"), {"succeeded": "success", "failed": "failed", "skipped": "skipped"}, "models").withColumnRenamed("at", "started_at")


def last_test_run(t: Tables) -> DataFrame:
    return _last_run(t("meta.test_results"), F.max("executed_at"), {"passed": "pass", "failed": "fail", "errored": "error"}, "tests").withColumnRenamed("at", "executed_at")


def failing_tests(t: Tables, run_id: str) -> DataFrame:
    return t("meta.test_results").where((F.col("run_id") == run_id) & (F.col("status") != "pass")).select("model_name", "column_name", "test_name", "status", "failing_rows", "error").orderBy("model_name", "test_name")


def map_zones(t: Tables) -> DataFrame:
    a = t("agg_zone_activity").groupBy("zone_id").agg(F.sum("visits").alias("visits"), F.sum("breaches").alias("breaches"))
    z = t("dim_zone").join(a, "zone_id", "left")
    return z.select("zone_id", "name", "zone_kind", "boundary_geojson", "centre_lat", "centre_lon", F.coalesce("visits", F.lit(0)).alias("visits"), F.coalesce("breaches", F.lit(0)).alias("breaches")).orderBy("zone_id")


def map_routes(t: Tables) -> DataFrame:
    return t("dim_route").select("route_id", "name", "path_geojson", "length_km").orderBy("route_id")


def _lately(rows: DataFrame, moment: str, hours: int) -> DataFrame:
    """The rows of the last hours; the newest moment is a scalar subquery, so that the filter reaches the scan."""
    newest = rows.agg(F.max(moment)).scalar()
    return rows.where(F.col(moment) >= newest - F.make_dt_interval(hours=F.lit(hours)))


def map_tracks(t: Tables, *, hours: int = 6, max_points: int = 400) -> DataFrame:
    """Each vehicle's way of late, thinned evenly so that it still starts where it started."""
    own = Window.partitionBy("vehicle_id")
    w = _lately(t("stg_pings").select("vehicle_id", "lat", "lon", "recorded_at", "ping_id"), "recorded_at", hours)
    w = w.withColumn("seq", F.row_number().over(own.orderBy("recorded_at", "ping_id"))).withColumn("total", F.count(N).over(own))
    w = w.where(F.expr(f"seq % greatest(1, total div {int(max_points)} + 1) = 0"))
    g = w.groupBy("vehicle_id").agg(F.sort_array(F.collect_list(F.struct("recorded_at", "ping_id", "lon", "lat"))).alias("p"))
    v = t("dim_vehicle").select("vehicle_id", "plate", "vehicle_type")
    return g.join(v, "vehicle_id").select("vehicle_id", "plate", "vehicle_type", F.transform("p", lambda x: x["lon"]).alias("lons"), F.transform("p", lambda x: x["lat"]).alias("lats")).orderBy("vehicle_id")


def map_alerts(t: Tables, *, hours: int = 6) -> DataFrame:
    a = _lately(t("fct_alerts"), "started_at", hours).where("lat IS NOT NULL AND detection_type <> 'zone_visit'")
    return a.orderBy(F.desc("severity_rank"), F.desc("started_at"), "detection_key").select("detection_type", "severity", "vehicle_id", "plate", "zone_name", "started_at", "duration_minutes", "magnitude", "lat", "lon", "is_open")


def map_cells(t: Tables, *, limit: int = 600) -> DataFrame:
    return _cells(t).orderBy(F.desc("pings"), "cell_r8").limit(limit).select("cell_r8", "pings", "vehicles", "stopped_hours", "avg_moving_kph", "mean_lat", "mean_lon")
