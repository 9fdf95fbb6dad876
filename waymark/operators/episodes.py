"""Episodes as gaps and islands: what the fold finds, in windows and aggregates.

Gaps, zone visits, geofence breaches and route deviations need no sequential state
beyond "the ping before", so they also have this fully declarative form; idle runs
and delays do not.  All four share one window over a vehicle's pings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.numbers import rounded, seconds_between
from waymark.sources.config import CRITICAL_MULTIPLE, Settings

COLUMNS = ("detection_key", "detection_type", "severity", "vehicle_id", "trip_id", "zone_id", "started_at", "ended_at", "duration_seconds", "lat", "lon", "magnitude", "reason")


def sequenced(enriched: DataFrame, settings: Settings) -> DataFrame:
    """Each ping with its number, the pings beside it, and how many gaps lie before it."""
    w = Window.partitionBy("vehicle_id").orderBy("recorded_at", "ping_id")
    limit = settings.gps_gap_minutes * 60
    out = enriched.withColumns({
        "n": F.row_number().over(w),
        "prev_at": F.lag("recorded_at").over(w),
        "prev_trip": F.lag("trip_id").over(w),
        "prev_lat": F.lag("lat").over(w),
        "prev_lon": F.lag("lon").over(w),
        "next_at": F.lead("recorded_at").over(w),
        "next_trip": F.lead("trip_id").over(w),
    })
    gap = seconds_between(F.col("prev_at"), F.col("recorded_at"))
    out = out.withColumn("gap_s", gap).withColumn("after_gap", F.coalesce(F.col("gap_s") > limit, F.lit(False)))
    out = out.withColumn("next_gap", F.coalesce(seconds_between(F.col("recorded_at"), F.col("next_at")) > limit, F.lit(False)))
    return out.withColumn("stretch", F.sum(F.col("after_gap").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def detection_key(kind: Column, zone: Column, start: Column) -> Column:
    return F.concat_ws("|", kind, F.col("vehicle_id"), F.coalesce(zone, F.lit("-")), F.date_format(start, "yyyyMMdd'T'HHmmss.SSSSSS"))


def escalated(value: Column, limit: Column | float) -> Column:
    return F.when(value >= limit * CRITICAL_MULTIPLE, "critical").otherwise("warning")


def _shaped(df: DataFrame, kind: str | Column, zone: Column) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(
        detection_key(kind, zone, F.col("started_at")).alias("detection_key"), kind.alias("detection_type"), "severity", "vehicle_id", "trip_id", zone.alias("zone_id"), "started_at", "ended_at",
        F.when(F.col("ended_at").isNotNull(), F.rint(seconds_between(F.col("started_at"), F.col("ended_at"))).cast("int")).alias("duration_seconds"), "lat", "lon", rounded(F.col("magnitude"), 2).alias("magnitude"), "reason",
    )


def gps_gaps(seq: DataFrame, settings: Settings) -> DataFrame:
    limit = settings.gps_gap_minutes * 60
    found = seq.where("after_gap").select(
        "vehicle_id", F.col("prev_trip").alias("trip_id"), F.col("prev_at").alias("started_at"), F.col("recorded_at").alias("ended_at"), F.col("prev_lat").alias("lat"), F.col("prev_lon").alias("lon"),
        (F.col("gap_s") / 60).alias("magnitude"), F.when(F.col("gap_s") >= limit * CRITICAL_MULTIPLE, "warning").otherwise("info").alias("severity"), F.lit(None).cast("string").alias("reason"),
    )
    return _shaped(found, "gps_gap", F.lit(None).cast("string"))


def stays(seq: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per unbroken stay in a zone, with when and how it ended and when its limit was passed."""
    inside = seq.select("*", F.explode("zone_ids").alias("zone_id"))
    w = Window.partitionBy("vehicle_id", "zone_id").orderBy("n")
    # Pings side by side in the zone keep the difference of their numbers; a gap starts another stretch.
    inside = inside.withColumn("island", F.col("n") - F.row_number().over(w))
    fences = zones.select("zone_id", "zone_kind", "max_dwell_minutes")
    grouped = Window.partitionBy("vehicle_id", "zone_id", "stretch", "island")
    timed = inside.join(fences, "zone_id").withColumn("entered_at", F.min("recorded_at").over(grouped)).withColumn("stay_s", seconds_between(F.col("entered_at"), F.col("recorded_at")))
    over = F.when(F.col("stay_s") > F.col("max_dwell_minutes") * 60, F.col("n"))
    s = timed.groupBy("vehicle_id", "zone_id", "zone_kind", "max_dwell_minutes", "stretch", "island", F.col("entered_at").alias("started_at")).agg(
        F.min_by(F.struct("trip_id", "lat", "lon"), "n").alias("entry"),
        F.max_by(F.struct("recorded_at", "next_at", "next_gap", "trip_id", "next_trip"), "n").alias("last"),
        F.min_by(F.struct("stay_s", "lat", "lon", "trip_id"), over).alias("over"),
    )
    exited = F.col("last.next_at").isNotNull() & ~F.col("last.next_gap")
    lost = F.col("last.next_gap") & (F.col("last.recorded_at") > F.col("started_at"))
    return s.withColumn("ended_at", F.when(exited, F.col("last.next_at")).when(lost, F.col("last.recorded_at"))).withColumn("close_trip", F.when(exited, F.col("last.next_trip")).when(lost, F.col("last.trip_id")))


def of_stays(stays_: DataFrame) -> DataFrame:
    """The visit that every stay is and the breach that some are: entries of restricted zones, and stays beyond a zone's limit.

    Both come out of one pass over the stays.
    """
    stayed = seconds_between(F.col("started_at"), F.col("ended_at"))
    none = F.lit(None).cast("string")

    def episode(kind: str, trip: str, place: str, seconds: Column, severity: Column, reason: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.coalesce(F.col(trip), F.col("close_trip")).alias("trip_id"), F.col(f"{place}.lat").alias("lat"), F.col(f"{place}.lon").alias("lon"), (seconds / 60).alias("magnitude"), severity.alias("severity"), reason.alias("reason"))

    limit, seconds = F.col("max_dwell_minutes") * 60, F.coalesce(stayed, F.col("over.stay_s"))
    visit = episode("zone_visit", "entry.trip_id", "entry", stayed, F.lit("info"), none)
    entered = episode("geofence_breach", "entry.trip_id", "entry", stayed, F.lit("critical"), F.lit("entered_restricted_zone"))
    long = episode("geofence_breach", "over.trip_id", "over", seconds, escalated(seconds, limit), F.lit("dwell_limit_exceeded"))
    breach = F.when(F.col("zone_kind") == "restricted", entered).when(F.col("over").isNotNull(), long)
    told = stays_.select("vehicle_id", "zone_id", "started_at", "ended_at", F.explode(F.array_compact(F.array(visit, breach))).alias("e")).select("vehicle_id", "zone_id", "started_at", "ended_at", "e.*")
    return _shaped(told, F.col("kind"), F.col("zone_id"))


def zone_visits(stays_: DataFrame) -> DataFrame:
    return of_stays(stays_).where("detection_type = 'zone_visit'")


def breaches(stays_: DataFrame) -> DataFrame:
    return of_stays(stays_).where("detection_type = 'geofence_breach'")


def deviations(seq: DataFrame, settings: Settings) -> DataFrame:
    """Excursions that lasted long enough to be told."""
    off = seq.where(F.col("route_distance_m") > settings.deviation_metres)
    off = off.withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("vehicle_id").orderBy("n")))
    grouped = Window.partitionBy("vehicle_id", "stretch", "island")
    off = off.withColumn("started_at", F.min("recorded_at").over(grouped)).withColumn("off_s", seconds_between(F.col("started_at"), F.col("recorded_at")))
    off = off.withColumn("told_n", F.min(F.when(F.col("off_s") >= settings.deviation_seconds, F.col("n"))).over(grouped)).where("told_n IS NOT NULL")
    told = F.col("n") == F.col("told_n")
    g = off.groupBy("vehicle_id", "stretch", "island", "started_at").agg(
        F.max("route_distance_m").alias("peak"),
        F.max(F.when(F.col("n") <= F.col("told_n"), F.col("route_distance_m"))).alias("peak_then"),
        F.max(F.when(told, F.struct("trip_id", "lat", "lon"))).alias("then"),
        F.max_by(F.struct("recorded_at", "next_at", "trip_id"), "n").alias("last"),
    )
    ended = F.when(F.col("last.next_at").isNotNull(), F.col("last.recorded_at"))
    g = g.withColumn("ended_at", ended).withColumn("magnitude", F.when(F.col("ended_at").isNotNull(), F.col("peak")).otherwise(F.col("peak_then")))
    out = g.select("vehicle_id", "started_at", "ended_at", F.coalesce("then.trip_id", F.when(F.col("ended_at").isNotNull(), F.col("last.trip_id"))).alias("trip_id"), "then.lat", "then.lon", "magnitude", escalated(F.col("magnitude"), settings.deviation_metres).alias("severity"), F.lit(None).cast("string").alias("reason"))
    return _shaped(out, "route_deviation", F.lit(None).cast("string"))


def all_declarative(enriched: DataFrame, zones: DataFrame, settings: Settings) -> DataFrame:
    seq = sequenced(enriched, settings)
    return gps_gaps(seq, settings).unionByName(of_stays(stays(seq, zones))).unionByName(deviations(seq, settings))
