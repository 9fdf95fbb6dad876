"""The engine's queries over the shared tables, each with its meaning in SQL where SQL has one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark import oracle
from waymark.functions import geo
from waymark.functions.numbers import rounded, seconds_between
from waymark.operators import episodes, fold, landing
from waymark.operators.enrich import enrich, with_expected, with_route, zones_per_ping
from waymark.plans import models, reports  # noqa: F401 - declares the models
from waymark.plans.checks import Check, violations
from waymark.plans.dag import in_memory
from waymark.sources import adapter, messages, reference
from waymark.sources.config import demo

S = adapter.SETTINGS
SPARK_KINDS = {"l": "bigint", "d": "double", "b": "boolean", "t": "timestamp_ntz", "y": "string", "s": "string"}
#: A fixed day for reports that look back from today.
TODAY = date(2024, 1, 31)


class World:
    """Everything one query may ask for; only what it uses becomes part of its plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        config = demo()
        self.zones, self.routes = reference.zones(spark, config), reference.routes(spark, config)
        self._made: dict[str, DataFrame] = {}
        self._models = in_memory(self, S.variables())

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def schedule(self) -> DataFrame:
        return self._once("schedule", lambda: reference.schedule(self.routes, self.zones))

    @property
    def pings(self) -> DataFrame:
        return self._once("pings", lambda: adapter.pings(self.spark, self.sf_dir))

    @property
    def trips(self) -> DataFrame:
        return self._once("trips", lambda: adapter.trips(self.spark, self.sf_dir))

    @property
    def enriched(self) -> DataFrame:
        return self._once("enriched", lambda: enrich(self.pings, self.zones, self.trips, self.routes, self.schedule))

    @property
    def found(self) -> DataFrame:
        """Every episode of the fold, its writes merged: one pass over the pings, whatever the number of kinds."""
        return self._once("found", lambda: _episodes(fold.fold(self.enriched, fold.fences_of(self.zones), S)))

    def __getitem__(self, name: str) -> DataFrame:
        sources = {"raw.pings": lambda: self.pings, "ref.zones": lambda: self.zones, "ref.routes": lambda: self.routes, "ref.route_schedule": lambda: self.schedule, "ref.trips": lambda: self.trips, "ref.vehicles": lambda: adapter.vehicles(self.spark, self.sf_dir), "stream.episodes": lambda: self.found}
        sources |= {"meta.ingest_batches": lambda: adapter.batches(self.spark, self.sf_dir), "meta.model_runs": lambda: adapter.model_runs(self.spark, self.sf_dir), "meta.test_results": lambda: adapter.test_results(self.spark, self.sf_dir)}
        sources["raw.pings_dead_letter"] = lambda: messages.rejected(messages.decoded(adapter.faulty_messages(self.spark, self.sf_dir))).withColumn("rejected_at", F.lit("2024-02-01").cast("timestamp"))
        return sources[name]()

    def table(self, name: str) -> DataFrame:
        return self[name] if "." in name else self.ref(name)

    def ref(self, name: str) -> DataFrame:
        return self._models(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    """``plan`` gives at least the columns of ``spec``; ``sql`` is what they are selected from in SQL."""

    plan: Callable[[World], DataFrame]
    spec: str
    sql: str | None = None
    tail: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        found = self.plan(World(spark, sf_dir))
        kinds = dict(found.dtypes)
        cast = lambda n, k: F.array_join(F.col(n), ",") if k == "s" and kinds[n].startswith("array<string>") else F.col(n).cast(SPARK_KINDS[k])
        return found.select(*[cast(n, k).alias(n) for n, k in oracle.columns(self.spec)])

    def oracle(self) -> str | None:
        return None if self.sql is None else oracle.query(self.sql, self.spec, self.tail)


def _test(check: Check) -> Callable[[World], DataFrame]:
    return lambda w: violations(check, w.table(check.model), w.table)


def _episodes(folded: DataFrame) -> DataFrame:
    merged = landing.merge_writes(folded.where("detection_key IS NOT NULL").withColumn("batch_id", F.lit(0).cast("long")), "write_seq")
    return merged.withColumns({"reason": F.get_json_object("details", "$.reason"), "updated_at": F.coalesce("ended_at", "started_at")})


def _writes(w: World) -> DataFrame:
    """Writes of the fold by kind: openings, closes, and of those the first of their episodes."""
    g = fold.fold(w.enriched, fold.fences_of(w.zones), S).where("detection_key IS NOT NULL").groupBy("detection_type")
    return g.agg(F.count_distinct("detection_key").alias("episodes"), reports.count_where(F.col("is_first")).alias("first_writes"), F.count_distinct(F.when(F.col("ended_at").isNotNull(), F.col("detection_key"))).alias("closed"))


def _merged(w: World) -> DataFrame:
    """Episode writes made from events: one key per user and type, an end on one of three."""
    e = w.read("events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    key = F.concat_ws("|", "event_type", F.col("user_id").cast("string"))
    writes = e.select(
        key.alias("detection_key"), F.col("event_type").alias("detection_type"), F.when(F.col("event_id") % 2 == 0, "warning").otherwise("critical").alias("severity"), F.concat(F.lit("VH-"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string")).alias("trip_id"), F.lit(None).cast("string").alias("zone_id"), F.col("ts").alias("started_at"), F.when(F.col("event_id") % 3 == 0, F.col("ts")).alias("ended_at"), (F.col("event_id") % 600).cast("int").alias("duration_seconds"),
        F.col("value").alias("lat"), F.col("value").alias("lon"), F.col("value").alias("magnitude"), F.lit("{}").alias("details"), "event_id", (F.col("event_id") % 7).alias("batch_id"),
    )
    return landing.merge_writes(writes, "event_id")


MERGE_SQL = """(SELECT f.detection_key, f.v.detection_type AS detection_type, coalesce(f.v.trip_id, c.trip) AS trip_id, f.v.started_at AS started_at,
    f.v.lat AS lat, CASE WHEN c.v IS NOT NULL THEN c.v.severity ELSE f.v.severity END AS severity, CASE WHEN c.v IS NOT NULL THEN c.v.ended_at ELSE f.v.ended_at END AS ended_at,
    CASE WHEN c.v IS NOT NULL THEN c.v.duration_seconds ELSE f.v.duration_seconds END AS duration_seconds, CASE WHEN c.v IS NOT NULL THEN c.v.magnitude ELSE f.v.magnitude END AS magnitude
  FROM (SELECT detection_key, arg_min(w, event_id) AS v FROM writes_ w GROUP BY 1) f
  LEFT JOIN (SELECT detection_key, arg_max(w, event_id) AS v, arg_min(w.trip_id, event_id) FILTER (w.trip_id IS NOT NULL) AS trip FROM writes_ w WHERE ended_at IS NOT NULL GROUP BY 1) c USING (detection_key))"""
WRITES_SQL = "(SELECT event_type || '|' || user_id AS detection_key, event_type AS detection_type, CASE WHEN event_id % 2 = 0 THEN 'warning' ELSE 'critical' END AS severity, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS VARCHAR) END AS trip_id, ts AS started_at, CASE WHEN event_id % 3 = 0 THEN ts END AS ended_at, event_id % 600 AS duration_seconds, value AS lat, value AS magnitude, event_id FROM events)"


def _offsets(w: World) -> DataFrame:
    """Events sent again: some twice, with later offsets."""
    e = w.read("events").select("event_id", "event_type", "value")
    again = e.where("event_id % 5 = 0").select((F.col("event_id") % 4000).alias("event_id"), "event_type", "value", (F.col("event_id") + 100000000).alias("offset"))
    return landing.first_by(e.withColumn("offset", F.col("event_id")).unionByName(again), "event_id", "offset")


def _landed(w: World) -> DataFrame:
    e = w.read("events").select("event_id", "event_type", "value")
    fresh = landing.insert_if_absent(e, e.where("event_id % 3 = 0"), "event_id")
    return fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least"))


def _delete_insert(w: World) -> DataFrame:
    """All customers; of a quarter that comes again some have new keys."""
    c = w.read("customer").select("c_custkey", "c_name", "c_mktsegment")
    stage = c.where("c_custkey % 4 = 0").withColumns({"c_mktsegment": F.lit("NEW"), "c_custkey": F.when(F.col("c_custkey") % 8 == 0, F.col("c_custkey") + 100_000_000).otherwise(F.col("c_custkey"))})
    return landing.delete_insert(c, stage, "c_custkey")


def _delete_insert_lines(w: World) -> DataFrame:
    """All order lines, under a key of two columns."""
    x = w.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return landing.delete_insert(x, x.where("l_linenumber = 2 AND l_orderkey % 2 = 0").withColumn("l_quantity", F.lit(0).cast("double")), "l_orderkey", "l_linenumber")


def _latest(w: World) -> DataFrame:
    return landing.latest(w.read("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"), "o_custkey", "o_orderkey")


def _upsert(w: World) -> DataFrame:
    v = adapter.vehicles(w.spark, w.sf_dir)
    return reference.upsert(v, v.where("capacity_kg < 1000").withColumn("plate", F.concat(F.lit("NEW-"), "vehicle_id")), "vehicle_id")


def _recent(w: World) -> DataFrame:
    p = w.pings
    newest = p.where("recorded_at < TIMESTAMP '2024-01-20 00:00:00'").agg(F.max("ingested_at")).first()[0]
    return landing.recent(p, "ingested_at", newest)


def _rejects(w: World) -> DataFrame:
    bad = messages.rejected(messages.decoded(adapter.messages(w.spark, w.sf_dir)))
    reason = F.when(F.col("error").startswith("ignition is off"), "ignition is off").otherwise(F.split_part("error", F.lit(","), F.lit(1)))
    return bad.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"))


def _accepts(w: World) -> DataFrame:
    return messages.valid(messages.decoded(adapter.messages(w.spark, w.sf_dir)))


def _distances(w: World) -> DataFrame:
    p = w.pings.select("ping_id", "lon", "lat")
    depot = (F.lit(104.89), F.lit(11.59))
    return p.select("ping_id", rounded(geo.distance_m(F.col("lon"), F.col("lat"), *depot), 3).alias("metres"), rounded(geo.haversine_m(F.col("lon"), F.col("lat"), *depot), 3).alias("great_circle_m"))


def _seen(w: World) -> DataFrame:
    routed = with_expected(with_route(w.pings, w.trips, w.routes), w.schedule).withColumn("delay_seconds", seconds_between(F.col("planned_start_at"), F.col("recorded_at")) - F.col("expected_elapsed_s"))
    return routed.select("ping_id", "route_id", rounded(F.col("route_distance_m"), 3).alias("route_distance_m"), rounded(F.col("route_fraction"), 6).alias("route_fraction"), rounded(F.col("expected_elapsed_s"), 3).alias("expected_elapsed_s"), rounded(F.col("delay_seconds"), 3).alias("delay_seconds")).where("route_id IS NOT NULL")


def _busiest(w: World) -> DataFrame:
    s = w.ref("int_ping_segments").select("vehicle_id", "recorded_at", "ping_id", "travelled_m")
    best = Window.partitionBy("vehicle_id").orderBy(F.desc("travelled_m"), "recorded_at", "ping_id")
    return s.withColumn("rank", F.row_number().over(best)).where("rank <= 3")


def _seq(w: World) -> DataFrame:
    return episodes.sequenced(w.enriched, S)


EPISODE = "detection_key detection_type severity vehicle_id trip_id zone_id started_at#t ended_at#t duration_seconds#d lat#d lon#d magnitude#d reason"
ALERT = "detection_key detection_type severity severity_rank#l is_open#b vehicle_id plate vehicle_type trip_id route_id route_name zone_id zone_name zone_kind started_at#t ended_at#t duration_minutes#d magnitude#d threshold_multiple#d"
SECONDS = "moving_seconds#d stopped_seconds#d"
ONE = "failing#l"


def check_sql(select: str) -> str:
    return f"(SELECT {select})"


FLEET: dict[str, Query] = {
    # Landing
    "dead_letters_by_reason": Query(_rejects, "reason messages#l first_offset#l", "(SELECT reason, count(*) AS messages, min(event_id) AS first_offset FROM (SELECT event_id, CASE WHEN NOT speed_kph BETWEEN 0 AND 250 THEN 'speed_kph must be between 0.0 and 250.0' WHEN NOT ignition AND speed_kph > 25 THEN 'ignition is off' END AS reason FROM readings) WHERE reason IS NOT NULL GROUP BY 1)"),
    "decoded_pings": Query(_accepts, "ping_id vehicle_id trip_id recorded_at#t lon#d lat#d speed_kph#d heading_deg#d ignition#b fuel_pct#d cell_r8 cell_r9 offset#l", "(SELECT *, event_id AS \"offset\" FROM pings)"),
    "dedupe_first_offset": Query(_offsets, "event_id#l event_type value#d offset#l", "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY \"offset\") AS k FROM (SELECT event_id, event_type, value, event_id AS \"offset\" FROM events UNION ALL SELECT event_id % 4000, event_type, value, event_id + 100000000 FROM events WHERE event_id % 5 = 0)) WHERE k = 1)"),
    "insert_if_absent": Query(_landed, "event_type n#l least#l", "(SELECT event_type, count(*) AS n, min(event_id) AS least FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_id = e.event_id AND x.event_id % 3 = 0) GROUP BY 1)"),
    "incremental_delete_insert": Query(_delete_insert, "c_custkey#l c_name c_mktsegment", "(SELECT c_custkey, c_name, CASE WHEN c_custkey % 8 = 4 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer UNION ALL SELECT c_custkey + 100000000, c_name, 'NEW' FROM customer WHERE c_custkey % 8 = 0)"),
    "incremental_composite_key": Query(_delete_insert_lines, "l_orderkey#l l_linenumber#l l_quantity#d", "(SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 2 AND l_orderkey % 2 = 0 THEN 0 ELSE l_quantity END AS l_quantity FROM lineitem)"),
    "state_upsert_latest": Query(_latest, "o_custkey#l o_orderkey#l o_orderstatus o_totalprice#d", "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k = 1)"),
    "reference_upsert": Query(_upsert, "vehicle_id plate vehicle_type capacity_kg#l home_depot_id", "(SELECT * REPLACE (CASE WHEN capacity_kg < 1000 THEN 'NEW-' || vehicle_id ELSE plate END AS plate) FROM vehicles_)"),
    "stg_pings_incremental_window": Query(_recent, "ping_id recorded_at#t", "(SELECT * FROM pings WHERE recorded_at >= (SELECT max(recorded_at) - INTERVAL 15 MINUTE FROM pings WHERE recorded_at < TIMESTAMP '2024-01-20'))"),
    "episode_merge": Query(_merged, "detection_key detection_type trip_id started_at#t lat#d severity ended_at#t duration_seconds#d magnitude#d", MERGE_SQL.replace("writes_", WRITES_SQL)),
    # Geography
    "point_distances": Query(_distances, "ping_id metres#d great_circle_m#d", "(SELECT ping_id, " + oracle.r(oracle.metres("lon", "lat", "104.89::DOUBLE", "11.59::DOUBLE"), 3) + " AS metres, " + oracle.r(f"({2 * geo.MEAN_RADIUS!r}::DOUBLE * asin(least(1e0, sqrt(sin((11.59::DOUBLE - lat) * {geo.RAD / 2!r}::DOUBLE) * sin((11.59::DOUBLE - lat) * {geo.RAD / 2!r}::DOUBLE) + cos(lat * {geo.RAD!r}::DOUBLE) * cos(11.59::DOUBLE * {geo.RAD!r}::DOUBLE) * sin((104.89::DOUBLE - lon) * {geo.RAD / 2!r}::DOUBLE) * sin((104.89::DOUBLE - lon) * {geo.RAD / 2!r}::DOUBLE)))))", 3) + " AS great_circle_m FROM pings)"),
    "dim_zone_measures": Query(lambda w: w.ref("dim_zone").withColumns({"centre_lat": rounded(F.col("centre_lat"), 6), "centre_lon": rounded(F.col("centre_lon"), 6)}), "zone_id name zone_kind max_dwell_minutes#d area_km2#d perimeter_km#d centre_lat#d centre_lon#d boundary_geojson breaches_on_entry#b has_dwell_limit#b", f"(SELECT * REPLACE ({oracle.r('centre_lat', 6)} AS centre_lat, {oracle.r('centre_lon', 6)} AS centre_lon) FROM dim_zone)"),
    "dim_route_measures": Query(lambda w: w.ref("dim_route"), "route_id name start_zone_id end_zone_id planned_duration_minutes#l service_minutes#l scheduled_stops#l length_km#d planned_drive_minutes#l planned_avg_kph#d path_geojson", "dim_route"),
    "route_schedule": Query(lambda w: w.schedule.withColumn("fraction", rounded(F.col("fraction"), 6)), "route_id seq#l fraction#d elapsed_seconds#l zone_id", f"(SELECT * REPLACE ({oracle.r('fraction', 6)} AS fraction) FROM schedule)"),
    "zones_per_ping": Query(lambda w: zones_per_ping(w.pings, w.zones), "ping_id zone_ids", "zone_lists"),
    "route_progress": Query(_seen, "ping_id route_id route_distance_m#d route_fraction#d expected_elapsed_s#d delay_seconds#d", "(SELECT ping_id, route_id, " + ", ".join(f"{oracle.r(e, n)} AS {c}" for c, e, n in (("route_distance_m", "route_distance_m", 3), ("route_fraction", "route_fraction", 6), ("expected_elapsed_s", "expected_elapsed_s", 3), ("delay_seconds", "(" + oracle.secs("planned_start_at", "recorded_at") + " - expected_elapsed_s)", 3))) + " FROM timed)"),
    "grid_cells": Query(lambda w: w.pings.groupBy("cell_r8", "cell_r9").agg(F.count(F.lit(1)).alias("n")), "cell_r8 cell_r9 n#l", "(SELECT cell_r8, cell_r9, count(*) AS n FROM pings GROUP BY 1, 2)"),
    # Episodes
    "gps_gaps": Query(lambda w: episodes.gps_gaps(_seq(w), S), EPISODE, "gaps"),
    "zone_visits": Query(lambda w: episodes.zone_visits(episodes.stays(_seq(w), w.zones)), EPISODE, "visits"),
    "geofence_breaches": Query(lambda w: episodes.breaches(episodes.stays(_seq(w), w.zones)), EPISODE, "breaches"),
    "route_deviations": Query(lambda w: episodes.deviations(_seq(w), S), EPISODE, "deviations"),
    "full_fold": Query(lambda w: w.found, EPISODE, "episodes"),
    "idle_episodes": Query(lambda w: w.found.where("detection_type = 'idle'"), EPISODE, "idles"),
    "delay_escalation": Query(lambda w: w.found.where("detection_type = 'delay'"), EPISODE, "delays"),
    "first_writes": Query(_writes, "detection_type episodes#l first_writes#l closed#l", "(SELECT detection_type, count(*) AS episodes, count(*) AS first_writes, count(ended_at) AS closed FROM episodes GROUP BY 1)"),
    # Models
    "stg_pings": Query(lambda w: w.ref("stg_pings"), "ping_id vehicle_id trip_id recorded_at#t recorded_date#y recorded_hour#t lat#d lon#d cell_r8 cell_r9 speed_kph#d heading_deg#d ignition#b fuel_pct#d is_reported_stopped#b", f"(SELECT *, CAST(recorded_at AS DATE) AS recorded_date, date_trunc('hour', recorded_at) AS recorded_hour, speed_kph <= {S.idle_speed_kph} AS is_reported_stopped FROM pings)"),
    "stg_detections": Query(lambda w: w.ref("stg_detections"), EPISODE + " started_date#y started_hour#t duration_minutes#d is_open#b severity_rank#l", "detections"),
    "ping_segments": Query(lambda w: w.ref("int_ping_segments"), f"ping_id vehicle_id trip_id recorded_at#t prev_recorded_at#t gap_seconds#d raw_distance_m#d implied_speed_kph#d is_after_gap#b is_moving#b observed_seconds#d {SECONDS} unobserved_seconds#d travelled_m#d engine_on_seconds#d", "segments"),
    "vehicle_hours": Query(lambda w: w.ref("fct_vehicle_hours"), f"vehicle_id recorded_hour#t recorded_date#y hour_of_day#l pings#l trips#l distance_km#d {SECONDS} unobserved_seconds#d engine_on_seconds#d observed_seconds#d idling_engine_seconds#d max_speed_kph#d avg_moving_kph#d utilisation_pct#d coverage_pct#d signal_gaps#l", "hours"),
    "dim_vehicle": Query(lambda w: w.ref("dim_vehicle"), f"vehicle_id plate vehicle_type capacity_kg#l home_depot_id home_depot_name pings#l trips#l first_seen_at#t last_seen_at#t distance_km#d {SECONDS} engine_on_seconds#d max_speed_kph#d idling_engine_seconds#d has_reported#b", "dim_vehicle"),
    "alerts_enriched": Query(lambda w: w.ref("fct_alerts"), ALERT, "alerts"),
    "threshold_multiple": Query(lambda w: w.ref("fct_alerts").where("threshold_multiple IS NOT NULL").groupBy("detection_type", "severity").agg(F.count(F.lit(1)).alias("n"), F.max("threshold_multiple").alias("most"), F.min("threshold_multiple").alias("least")), "detection_type severity n#l most#d least#d", "(SELECT detection_type, severity, count(*) AS n, max(threshold_multiple) AS most, min(threshold_multiple) AS least FROM alerts WHERE threshold_multiple IS NOT NULL GROUP BY 1, 2)"),
    "trips_fact": Query(lambda w: w.ref("fct_trips"), f"trip_id vehicle_id plate vehicle_type route_id route_name route_length_km#d planned_start_at#t planned_end_at#t planned_date#y planned_duration_minutes#l actual_start_at#t actual_end_at#t pings#l distance_km#d {SECONDS} unobserved_seconds#d engine_on_seconds#d max_speed_kph#d avg_moving_kph#d actual_duration_minutes#d finish_delay_minutes#d route_coverage_pct#d moving_share_pct#d alerts#l idle_alerts#l deviation_alerts#l delay_alerts#l breach_alerts#l gap_alerts#l critical_alerts#l worst_delay_minutes#d worst_deviation_m#d is_final_trip#b is_complete#b has_telemetry#b is_on_time", "trip_facts"),
    "final_trip": Query(lambda w: w.ref("fct_trips").where("is_final_trip"), "trip_id vehicle_id planned_start_at#t", "(SELECT * FROM final_trips WHERE is_final_trip)"),
    "daily_fleet_full_outer": Query(lambda w: w.ref("agg_daily_fleet"), f"activity_date#y vehicle_type active_vehicles#l pings#l distance_km#d {SECONDS} unobserved_seconds#d idling_engine_seconds#d max_speed_kph#d utilisation_pct#d coverage_pct#d engine_idle_share_pct#d trips_planned#l trips_completed#l trips_on_time#l trips_without_telemetry#l on_time_pct#d avg_finish_delay_minutes#d alerts#l critical_alerts#l alerts_per_100km#d", "daily"),
    "zone_activity_dense": Query(lambda w: w.ref("agg_zone_activity"), "activity_date#y zone_id zone_name zone_kind max_dwell_minutes#d area_km2#d visits#l closed_visits#l vehicles#l dwell_seconds#d dwell_hours#d avg_dwell_minutes#d max_dwell_minutes_observed#d breaches#l entry_breaches#l dwell_breaches#l worst_dwell_minutes#d dwell_breach_rate_pct#d", "zone_days"),
    "cell_activity": Query(lambda w: w.ref("agg_cell_activity"), f"activity_date#y cell_r8 pings#l vehicles#l trips#l distance_km#d {SECONDS} observed_seconds#d avg_moving_kph#d min_moving_kph#d stopped_share_pct#d mean_lat#d mean_lon#d", "cells"),
    # Reports
    "ingest_overview": Query(lambda w: reports.ingest_overview(lambda n: w[n] if n == "raw.pings" else adapter.readings(w.spark, w.sf_dir).where("NOT (speed_kph BETWEEN 0 AND 250 AND (ignition OR speed_kph <= 25))")), "pings#l vehicles#l trips#l first_ping_at#t last_ping_at#t dead_letters#l", "(SELECT count(*) AS pings, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT trip_id) AS trips, min(recorded_at) AS first_ping_at, max(recorded_at) AS last_ping_at, (SELECT count(*) FROM readings) - count(*) AS dead_letters FROM pings)"),
    "open_episodes": Query(lambda w: reports.open_episodes(w.table), "detection_type severity vehicle_id zone_id started_at#t magnitude#d", "(SELECT * FROM episodes WHERE ended_at IS NULL)"),
    "alerts_topk": Query(lambda w: reports.alerts(w.table, limit=25, severity="critical"), ALERT, "(SELECT * FROM alerts WHERE severity = 'critical' ORDER BY severity_rank DESC, coalesce(threshold_multiple, 0) DESC, started_at DESC, detection_key LIMIT 25)"),
    "alert_summary": Query(lambda w: reports.alert_summary(w.table), "detection_type episodes#l critical#l warning#l info#l still_open#l avg_magnitude#d max_magnitude#d worst_multiple#d vehicles#l", "(SELECT detection_type, count(*) AS episodes, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning, count(*) FILTER (severity = 'info') AS info, count(*) FILTER (is_open) AS still_open, " + oracle.r("(sum(CAST(magnitude AS DECIMAL(16,3))) / nullif(CAST(count(magnitude) AS DOUBLE), 0))", 1) + " AS avg_magnitude, " + oracle.r("max(magnitude)", 1) + " AS max_magnitude, " + oracle.r("max(threshold_multiple)", 1) + " AS worst_multiple, count(DISTINCT vehicle_id) AS vehicles FROM alerts GROUP BY 1)"),
    "trips_latest": Query(lambda w: reports.trips(w.table, limit=20), "trip_id vehicle_id planned_start_at#t distance_km#d is_complete#b", "(SELECT * FROM trip_facts ORDER BY planned_start_at DESC, trip_id LIMIT 20)"),
    "trip_punctuality": Query(lambda w: reports.trip_punctuality(w.table), "vehicle_type trips#l completed#l on_time#l on_time_pct#d avg_delay_minutes#d distance_km#d", "(SELECT vehicle_type, count(*) AS trips, count(*) FILTER (is_complete) AS completed, count(*) FILTER (is_on_time) AS on_time, " + oracle.pct("count(*) FILTER (is_on_time)", "count(*) FILTER (is_complete)") + " AS on_time_pct, " + oracle.r("(sum(CAST(finish_delay_minutes AS DECIMAL(16,3))) FILTER (is_complete) / nullif(CAST(count(finish_delay_minutes) FILTER (is_complete) AS DOUBLE), 0))", 1) + " AS avg_delay_minutes, " + oracle.r("CAST(sum(CAST(distance_km AS DECIMAL(16,3))) AS DOUBLE)", 1) + " AS distance_km FROM trip_facts GROUP BY 1)"),
    "vehicles_report": Query(lambda w: reports.vehicles(w.table), "vehicle_id plate vehicle_type home_depot_name pings#l trips#l distance_km#d moving_hours#d stopped_hours#d idling_minutes#d max_speed_kph#d utilisation_pct#d has_reported#b alerts#l critical_alerts#l", "(SELECT v.*, " + oracle.r("(CAST(moving_seconds AS DOUBLE) / 3600e0)", 2) + " AS moving_hours, " + oracle.r("(CAST(stopped_seconds AS DOUBLE) / 3600e0)", 2) + " AS stopped_hours, " + oracle.r("(CAST(idling_engine_seconds AS DOUBLE) / 60e0)", 1) + " AS idling_minutes, " + oracle.pct("moving_seconds", "(moving_seconds + stopped_seconds)") + " AS utilisation_pct, coalesce(a.alerts, 0) AS alerts, coalesce(a.critical, 0) AS critical_alerts FROM dim_vehicle v LEFT JOIN (SELECT vehicle_id, count(*) AS alerts, count(*) FILTER (severity = 'critical') AS critical FROM alerts GROUP BY 1) a USING (vehicle_id))"),
    "zone_report": Query(lambda w: reports.zone_activity(w.table, days=7, today=TODAY), "zone_id zone_name zone_kind max_dwell_minutes#d area_km2#d visits#l closed_visits#l peak_vehicles#l dwell_hours#d avg_dwell_minutes#d max_dwell_observed#d breaches#l entry_breaches#l dwell_breaches#l", "(SELECT zone_id, max(zone_name) AS zone_name, max(zone_kind) AS zone_kind, max(max_dwell_minutes) AS max_dwell_minutes, " + oracle.r("max(area_km2)", 3) + " AS area_km2, sum(visits) AS visits, sum(closed_visits) AS closed_visits, max(vehicles) AS peak_vehicles, " + oracle.r("CAST(sum(CAST(dwell_hours AS DECIMAL(16,3))) AS DOUBLE)", 2) + " AS dwell_hours, " + oracle.r("(sum(CAST(avg_dwell_minutes AS DECIMAL(16,3))) / nullif(CAST(count(avg_dwell_minutes) AS DOUBLE), 0))", 1) + " AS avg_dwell_minutes, max(max_dwell_minutes_observed) AS max_dwell_observed, sum(breaches) AS breaches, sum(entry_breaches) AS entry_breaches, sum(dwell_breaches) AS dwell_breaches FROM zone_days WHERE activity_date >= DATE '2024-01-24' GROUP BY 1)"),
    "hotspots": Query(lambda w: reports.hotspots(w.table), "cell_r8 pings#l vehicles#l stopped_hours#d moving_hours#d avg_moving_kph#d stopped_share_pct#d mean_lat#d mean_lon#d", "(SELECT * FROM cell_totals ORDER BY stopped DESC, cell_r8 LIMIT 12)"),
    "daily_fleet_report": Query(lambda w: reports.daily_fleet(w.table, days=7, today=TODAY), "activity_date#y vehicle_type active_vehicles#l pings#l distance_km#d utilisation_pct#d on_time_pct#d alerts#l alerts_per_100km#d", "(SELECT * FROM daily WHERE activity_date >= DATE '2024-01-24')"),
    "map_zones": Query(lambda w: reports.map_zones(w.table), "zone_id name zone_kind boundary_geojson visits#l breaches#l", "(SELECT z.*, coalesce(a.visits, 0) AS visits, coalesce(a.breaches, 0) AS breaches FROM zones_ z LEFT JOIN (SELECT zone_id, sum(visits) AS visits, sum(breaches) AS breaches FROM zone_days GROUP BY 1) a USING (zone_id))"),
    "map_tracks_thinned": Query(lambda w: reports.map_tracks(w.table, hours=72, max_points=3).withColumns({"points": F.size("lons"), "first_lon": F.element_at("lons", 1), "last_lat": F.element_at("lats", -1)}), "vehicle_id plate vehicle_type points#l first_lon#d last_lat#d", "(SELECT vehicle_id, plate, vehicle_type, count(*) AS points, arg_min(lon, (recorded_at, ping_id)) AS first_lon, arg_max(lat, (recorded_at, ping_id)) AS last_lat FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY recorded_at, ping_id) AS k, count(*) OVER (PARTITION BY vehicle_id) AS total FROM pings WHERE recorded_at >= (SELECT max(recorded_at) FROM pings) - INTERVAL 72 HOUR) JOIN vehicles_ USING (vehicle_id) WHERE k % greatest(1, total // 3 + 1) = 0 GROUP BY 1, 2, 3)"),
    "map_alerts": Query(lambda w: reports.map_alerts(w.table, hours=48), "detection_type severity vehicle_id plate zone_name started_at#t duration_minutes#d magnitude#d lat#d lon#d is_open#b", "(SELECT * FROM alerts WHERE lat IS NOT NULL AND detection_type <> 'zone_visit' AND started_at >= (SELECT max(started_at) FROM alerts) - INTERVAL 48 HOUR)"),
    "map_cells": Query(lambda w: reports.map_cells(w.table), "cell_r8 pings#l vehicles#l stopped_hours#d avg_moving_kph#d", "(SELECT * FROM cell_totals ORDER BY pings DESC, cell_r8 LIMIT 600)"),
    "reference_counts": Query(lambda w: reference.counts({n: w[f"ref.{n}"] for n in ("zones", "routes", "route_schedule", "vehicles", "trips")}), "relation n#l", "(SELECT 'zones' AS relation, count(*) AS n FROM zones_ UNION ALL SELECT 'routes', count(*) FROM routes_ UNION ALL SELECT 'route_schedule', count(*) FROM schedule UNION ALL SELECT 'vehicles', count(*) FROM vehicles_ UNION ALL SELECT 'trips', count(*) FROM trips_)"),
    "refusals_by_rule": Query(lambda w: reports.dead_letter_reasons(w.table, limit=None), "reason messages#l", "(SELECT v.reason, count(*) AS messages FROM events JOIN (VALUES " + ", ".join(f"({k}, '{words.replace(chr(39), chr(39) * 2)}')" for k, (*_, words) in enumerate(adapter.FAULTS)) + ") AS v(k, reason) ON event_id % 32 = v.k GROUP BY 1)"),
    "recent_batches": Query(lambda w: reports.recent_batches(w.table), "batch_id#l status started_at#t finished_at#t messages_read#l rows_inserted#l rows_rejected#l", "(SELECT CAST(floor(event_id / 500) AS BIGINT) AS batch_id, 'committed' AS status, min(ts) AS started_at, max(ts) AS finished_at, count(*) AS messages_read, count(*) FILTER (event_type <> 'error') AS rows_inserted, count(*) FILTER (event_type = 'error') AS rows_rejected FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 5)"),
    "last_transform_run": Query(lambda w: reports.last_transform_run(w.table), "run_id started_at#t models#l succeeded#l failed#l skipped#l", "(SELECT CAST(o_custkey % 11 AS VARCHAR) AS run_id, min(o_orderdate) AS started_at, count(*) AS models, count(*) FILTER (o_orderstatus = 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS skipped FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"),
    "last_test_run": Query(lambda w: reports.last_test_run(w.table), "run_id executed_at#t tests#l passed#l failed#l errored#l", "(SELECT CAST(o_custkey % 11 AS VARCHAR) AS run_id, max(o_orderdate) AS executed_at, count(*) AS tests, count(*) FILTER (o_orderstatus = 'F') AS passed, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS errored FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"),
    "failing_tests": Query(lambda w: reports.failing_tests(w.table, "7"), "model_name column_name test_name status failing_rows#l", "(SELECT 'm' || (o_orderkey % 5) AS model_name, 'c' AS column_name, 't' || o_orderkey AS test_name, CASE WHEN o_orderstatus = 'O' THEN 'fail' ELSE 'error' END AS status, o_orderkey % 3 AS failing_rows FROM orders WHERE o_custkey % 11 = 7 AND o_orderstatus <> 'F')"),
    "map_routes": Query(lambda w: reports.map_routes(w.table), "route_id name path_geojson length_km#d", "dim_route"),
    "busiest_segments": Query(_busiest, "vehicle_id rank#l ping_id travelled_m#d", "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY travelled_m DESC, recorded_at, ping_id) AS rank FROM segments) WHERE rank <= 3)"),
    # Data tests
    "test_not_null": Query(_test(Check("stg_pings", "not_null", column="trip_id")), ONE, check_sql("count(*) AS failing FROM pings WHERE trip_id IS NULL")),
    "test_unique_surplus": Query(_test(Check("stg_pings", "unique", column="trip_id")), ONE, check_sql("sum(n) - count(*) AS failing FROM (SELECT trip_id, count(*) AS n FROM pings WHERE trip_id IS NOT NULL GROUP BY 1)")),
    "test_accepted_values": Query(_test(Check("dim_vehicle", "accepted_values", column="vehicle_type", values=("van", "truck"))), ONE, check_sql("count(*) AS failing FROM vehicles_ WHERE vehicle_type NOT IN ('van', 'truck')")),
    "test_relationships": Query(lambda w: violations(Check("raw.pings", "relationships", column="trip_id", to="ref.trips", field="trip_id"), w["raw.pings"].withColumn("trip_id", F.when(F.col("speed_kph") < 30, F.concat("trip_id", F.lit("?"))).otherwise(F.col("trip_id"))), w.table), ONE, check_sql("count(*) AS failing FROM (SELECT CASE WHEN speed_kph < 30 THEN trip_id || '?' ELSE trip_id END AS trip_id FROM pings) p WHERE trip_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM trips_ t WHERE t.trip_id = p.trip_id)")),
    "test_unique_combination": Query(_test(Check("stg_pings", "unique_combination", columns=("vehicle_id", "recorded_date"))), ONE, check_sql("sum(n) - count(*) AS failing FROM (SELECT vehicle_id, CAST(recorded_at AS DATE), count(*) AS n FROM pings GROUP BY 1, 2)")),
    "test_assert_expression": Query(_test(Check("int_ping_segments", "assert_expression", expression="gap_seconds > 60 AND implied_speed_kph < 5")), ONE, check_sql("count(*) AS failing FROM segments WHERE (gap_seconds > 60 AND implied_speed_kph < 5) IS NOT TRUE")),
}

QUERIES = {name: q.run for name, q in FLEET.items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, q in FLEET.items() if (sql := q.oracle()) is not None}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FLEET["vehicle_hours"].run(spark, sf_dir)

