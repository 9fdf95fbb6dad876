"""What a ping needs to be judged: its zones, its place on the route, its delay.

Reference tables are joined on keys that partition at any size: zones by the grid
cells that their boxes touch, routes and schedule segments by route.  Whether a
side is broadcast is left to the planner, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions.numbers import seconds_between
from waymark.sources.reference import schedule_segments

#: Side, in degrees, of the cells by which pings and zones meet.
CELL = 0.02


def zone_cells(zones: DataFrame) -> DataFrame:
    """zone_id, parts, box, cx, cy: a row for each cell that a zone's box touches."""
    boxed = zones.select("zone_id", geo.segments(F.col("boundary")).alias("parts"), geo.bounding_box(F.col("boundary")).alias("box"))
    span = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / CELL), F.floor(F.col(high) / CELL)))
    return boxed.select("*", span("box.min_lon", "box.max_lon").alias("cx")).select("*", span("box.min_lat", "box.max_lat").alias("cy"))


def with_zones(pings: DataFrame, zones: DataFrame) -> DataFrame:
    """``pings`` with zone_ids, the sorted ids of the zones that cover each: a ping stays one row, and pings are not shuffled for it.

    Each cell holds the array of zones whose boxes touch it, which is filtered in place.
    """
    here = zone_cells(zones).groupBy("cx", "cy").agg(F.sort_array(F.collect_list(F.struct("zone_id", "parts", "box"))).alias("_zones"))
    at = pings.withColumns({"cx": F.floor(F.col("lon") / CELL), "cy": F.floor(F.col("lat") / CELL)}).join(here, ["cx", "cy"], "left")
    inside = F.filter("_zones", lambda z: geo.covers_parts(z["parts"], z["box"], F.col("lon"), F.col("lat")))
    ids = F.coalesce(F.transform(inside, lambda z: z["zone_id"]), F.array().cast("array<string>"))
    return at.select(*[at[c] for c in pings.columns], ids.alias("zone_ids"))


def zones_per_ping(pings: DataFrame, zones: DataFrame) -> DataFrame:
    """ping_id, zone_ids: for pings in at least one zone."""
    return with_zones(pings.select("ping_id", "lon", "lat"), zones).select("ping_id", "zone_ids").where(F.size("zone_ids") > 0)


def with_route(pings: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """``pings`` with route_id, planned_start_at, route_distance_m and route_fraction; null where the trip is not known."""
    lines = routes.select("route_id", geo.located_lines(F.col("path")).alias("line"))
    joined = pings.join(trips.select("trip_id", F.col("route_id").alias("trip_route"), "planned_start_at"), "trip_id", "left").join(lines.withColumnRenamed("route_id", "trip_route"), "trip_route", "left")
    known = F.col("line").isNotNull()
    return joined.select(
        *[pings[c] if c != "trip_id" else F.col("trip_id") for c in pings.columns],
        F.when(known, F.col("trip_route")).alias("route_id"),
        F.when(known, F.col("planned_start_at")).alias("planned_start_at"),
        F.when(known, geo.distance_to_parts_m(F.col("lon"), F.col("lat"), F.col("line"))).alias("route_distance_m"),
        F.when(known, geo.fraction_along(F.col("lon"), F.col("lat"), F.col("line"))).alias("route_fraction"),
    )


def with_expected(routed: DataFrame, schedule: DataFrame) -> DataFrame:
    """``routed`` with expected_elapsed_s, interpolated on the first schedule segment that holds the ping's place.

    The segments of a route travel as one array, so a ping is one row throughout.
    """
    of_route = schedule_segments(schedule).groupBy("route_id").agg(F.sort_array(F.collect_list(F.struct("seq", "from_fraction", "to_fraction", "from_s", "to_s"))).alias("plan"))
    at = F.col("route_fraction")
    joined = routed.join(of_route, "route_id", "left").select(*routed.columns, "plan")
    holds = F.get(F.filter("plan", lambda s: (at >= s["from_fraction"]) & (at <= s["to_fraction"])), F.lit(0))
    width = holds["to_fraction"] - holds["from_fraction"]
    return joined.withColumn("expected_elapsed_s", holds["from_s"] + (holds["to_s"] - holds["from_s"]) * (at - holds["from_fraction"]) / F.when(width != 0, width)).drop("plan")


def enrich(pings: DataFrame, zones: DataFrame, trips: DataFrame, routes: DataFrame, schedule: DataFrame) -> DataFrame:
    """``pings`` with zone_ids, route columns, expected_elapsed_s and delay_seconds."""
    whole = with_expected(with_route(with_zones(pings, zones), trips, routes), schedule)
    return whole.withColumn("delay_seconds", seconds_between(F.col("planned_start_at"), F.col("recorded_at")) - F.col("expected_elapsed_s"))
