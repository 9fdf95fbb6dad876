"""Reference tables from the configuration, and the schedule that routes imply."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.functions import geo
from waymark.sources import schemas
from waymark.sources.config import FleetConfig


def local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table made on the driver that the planner knows the size of, and may broadcast for it."""
    kind = T.StructType.fromDDL(schema)
    named = [dict(zip(kind.names, r)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema=to_arrow_schema(kind)), schema=kind)


def _line(positions: tuple) -> list[dict[str, float]]:
    return [{"lon": float(lon), "lat": float(lat)} for lon, lat in positions]


def zones(spark: SparkSession, config: FleetConfig) -> DataFrame:
    return local(spark, [(z.zone_id, z.name, z.zone_kind, z.max_dwell_minutes, _line(z.boundary)) for z in config.zones], schemas.ZONES)


def routes(spark: SparkSession, config: FleetConfig) -> DataFrame:
    return local(spark, [(r.route_id, r.name, r.start_zone_id, r.end_zone_id, r.planned_duration_minutes, r.service_minutes, list(r.stop_zone_ids), _line(r.path)) for r in config.routes], schemas.ROUTES)


def vehicles(spark: SparkSession, config: FleetConfig) -> DataFrame:
    return local(spark, [(v.vehicle_id, v.plate, v.vehicle_type, v.capacity_kg, v.home_depot_id) for v in config.vehicles], schemas.VEHICLES)


def schedule(routes: DataFrame, zones: DataFrame) -> DataFrame:
    """route_id, seq, fraction, elapsed_seconds, zone_id: the planned departures along each route.

    A stop is due where the middle of its zone is nearest to the path.  Stops at
    the very start or end are the depot, not a stop.  Driving time is spread evenly
    over the path, and each stop served so far adds its service time.
    """
    middle = zones.select("zone_id", geo.centroid(F.col("boundary")).alias("middle"))
    lines = routes.select("route_id", geo.located_lines(F.col("path")).alias("line"), (F.col("planned_duration_minutes") * 60).alias("total"), (F.col("service_minutes") * 60).alias("service"), "stop_zone_ids")
    stops = lines.select("route_id", "line", F.explode("stop_zone_ids").alias("zone_id")).join(middle, "zone_id")
    placed = stops.select("route_id", "zone_id", geo.fraction_along(F.col("middle.lon"), F.col("middle.lat"), F.col("line")).alias("fraction")).where("fraction > 0 AND fraction < 1")
    of_route = Window.partitionBy("route_id")
    placed = placed.withColumn("n", F.row_number().over(of_route.orderBy("fraction", "zone_id"))).withColumn("stops", F.count(F.lit(1)).over(of_route))
    plan = lines.select("route_id", "total", "service").join(placed.groupBy("route_id").agg(F.max("stops").alias("stops")), "route_id", "left").withColumn("stops", F.coalesce("stops", F.lit(0)))
    point = lambda df, seq, fraction, elapsed, zone: df.select("route_id", seq.cast("int").alias("seq"), fraction.cast("double").alias("fraction"), elapsed.cast("int").alias("elapsed_seconds"), zone.cast("string").alias("zone_id"))
    start = point(plan, F.lit(0), F.lit(0.0), F.lit(0), F.lit(None))
    end = point(plan, F.col("stops") + 1, F.lit(1.0), F.col("total"), F.lit(None))
    served = placed.drop("stops").join(plan, "route_id")
    middle_points = point(served, F.col("n"), F.col("fraction"), F.rint((F.col("total") - F.col("service") * F.col("stops")) * F.col("fraction") + F.col("service") * F.col("n")), F.col("zone_id"))
    return start.unionByName(middle_points).unionByName(end)


def schedule_segments(schedule: DataFrame) -> DataFrame:
    """Each checkpoint with the next: route_id, seq, from_fraction, to_fraction, from_s, to_s."""
    along = Window.partitionBy("route_id").orderBy("seq")
    both = schedule.select("route_id", "seq", F.col("fraction").alias("from_fraction"), F.lead("fraction").over(along).alias("to_fraction"), F.col("elapsed_seconds").alias("from_s"), F.lead("elapsed_seconds").over(along).alias("to_s"))
    return both.where("to_fraction IS NOT NULL")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """relation, n: one row per table."""
    out = None
    for name, table in sorted(tables.items()):
        one = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("relation"), "n")
        out = one if out is None else out.unionByName(one)
    return out
