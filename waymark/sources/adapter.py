"""Telemetry, vehicles and trips made from the shared test tables, in arithmetic that any engine repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.sources.config import Settings

#: Users' events are hours apart, so the thresholds are wide.
SETTINGS = Settings(idle_speed_kph=1.0, gps_gap_minutes=720, deviation_metres=2000.0, deviation_seconds=3600, idle_minutes=30, delay_minutes=60, delay_restep_minutes=60)
ROUTES = ("R-NORTH-LOOP", "R-SOUTH-RUN", "R-AIRPORT-SHUTTLE", "R-CITY-CROSS")
TYPES = ("van", "truck", "motorbike")
#: Events of values up to this are of standing vehicles.
STANDING = 20


def _events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a position report, good or not.

    One of a small value is of a standing vehicle, which stands at one of two places of
    its own; the others are anywhere.
    """
    e = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value", "props")
    vehicle = F.concat(F.lit("VH-"), F.col("user_id").cast("string"))
    trip = F.when(F.col("event_type") != "view", F.concat(F.lit("TR-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")))
    stands = F.col("value") <= STANDING
    place = F.when(stands, F.col("user_id") * 37 + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)).otherwise(F.col("event_id"))
    return e.select(
        "event_id",
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("ping_id"),
        vehicle.alias("vehicle_id"),
        trip.alias("trip_id"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
        (F.lit(104.83) + place * 7919 % 1200 / F.lit(10000.0)).alias("lon"),
        (F.lit(11.5) + place * 104729 % 1050 / F.lit(10000.0)).alias("lat"),
        F.when(stands, F.col("value") / STANDING).otherwise(F.col("value")).alias("speed_kph"),
        (F.col("event_id") * 31 % 360).cast("double").alias("heading_deg"),
        (F.col("event_type") != "error").alias("ignition"),
        F.lit(None).cast("double").alias("odometer_km"),
        (F.col("event_id") % 101).cast("double").alias("fuel_pct"),
        F.col("props").alias("payload"),
        "event_type",
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports that keep the contract, with their cells."""
    good = readings(spark, sf_dir).where("speed_kph BETWEEN 0 AND 250 AND (ignition OR speed_kph <= 25)")
    return good.withColumns({name: geo.grid_cell(F.col("lon"), F.col("lat"), side) for name, side in geo.GRID.items()}).withColumn("ingested_at", F.col("recorded_at"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports as JSON messages with Kafka's columns."""
    r = readings(spark, sf_dir)
    doc = F.to_json(F.struct("ping_id", "vehicle_id", "trip_id", F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("recorded_at"), F.struct("lat", "lon").alias("location"), "speed_kph", "heading_deg", "ignition", "fuel_pct"))
    return r.select(doc.cast("binary").alias("value"), F.col("vehicle_id").cast("binary").alias("key"), F.lit("vehicle.telemetry").alias("topic"), (F.col("event_id") % 12).cast("int").alias("partition"), F.col("event_id").alias("offset"))


#: One fault for each rule of the contract: the field that it changes (or the whole value), the JSON that it puts there, and what is then said.
FAULTS = (
    ("value", None, "message value is empty (tombstone?)"),
    ("value", b"\xff{}", "message value is not UTF-8: 'utf-8' codec can't decode byte 0xff in position 0: invalid start byte"),
    ("value", b"no json", "message value is not valid JSON: Expecting value: line 1 column 1 (char 0)"),
    ("value", b"[1]", "expected a JSON object"),
    ("fuel_pct", "NaN", "message contains the non-JSON constant NaN"),
    ("ping_id", "null", "missing required field 'ping_id'"),
    ("ping_id", '"17"', "ping_id is not a UUID: '17'"),
    ("vehicle_id", '"  "', "missing required field 'vehicle_id'"),
    ("recorded_at", "null", "missing required field 'recorded_at'"),
    ("recorded_at", '"soon"', "recorded_at is not ISO-8601: 'soon'"),
    ("location", "3", "location must be an object with lat and lon"),
    ("location", '{"lat":1}', "location requires both lat and lon"),
    ("location", '{"lat":true,"lon":1}', "location.lat must be a number"),
    ("location", '{"lat":1e999,"lon":1}', "location.lat must be finite"),
    ("location", '{"lat":90.5,"lon":1}', "location.lat must be between -90.0 and 90.0"),
    ("location", '{"lat":1,"lon":-180.5}', "location.lon must be between -180.0 and 180.0"),
    ("speed_kph", "null", "missing required field 'speed_kph'"),
    ("speed_kph", '"9"', "speed_kph must be a number"),
    ("speed_kph", "250.5", "speed_kph must be between 0.0 and 250.0"),
    ("heading_deg", "[]", "heading_deg must be a number"),
    ("heading_deg", "359.996", "heading_deg must be in [0"),
    ("ignition", '"on"', "ignition must be true or false"),
    ("odometer_km", "-1", "odometer_km must be between 0.0 and 10000000.0"),
    ("fuel_pct", "100.5", "fuel_pct must be between 0.0 and 100.0"),
    ("ignition", "false", "ignition is off but speed_kph is 26.0"),
)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for every event, 26 kph fast; event_id modulo 32 says which of FAULTS it has, if any."""
    e = _events(spark, sf_dir, "event_id", "user_id")
    case = F.col("event_id") % 32
    good = {
        "ping_id": F.concat(F.lit('"00000000-0000-4000-8000-'), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit('"')), "vehicle_id": F.concat(F.lit('"VH-'), F.col("user_id").cast("string"), F.lit('"')), "recorded_at": F.lit('"2024-01-01T00:00:00Z"'), "location": F.lit('{"lat":11.5,"lon":104.9}'),
        "speed_kph": F.lit("26.0"), "heading_deg": F.lit("90"), "ignition": F.lit("true"), "odometer_km": F.lit("1.5"), "fuel_pct": F.lit("50"),
    }
    parts = []
    for name, value in good.items():
        for k, (where, put, _) in enumerate(FAULTS):
            value = F.when(case == k, F.lit(put)).otherwise(value) if where == name else value
        parts += [F.lit(f'{"," if parts else "{"}"{name}":'), value]
    whole = F.concat(*parts, F.lit("}")).cast("binary")
    for k, (where, put, _) in enumerate(FAULTS):
        if where == "value":
            whole = F.when(case == k, F.lit(None if put is None else bytearray(put)).cast("binary")).otherwise(whole)
    return e.select(whole.alias("value"), F.lit(None).cast("binary").alias("key"), F.lit("vehicle.telemetry").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    key = F.col("c_custkey")
    kinds = F.array(*map(F.lit, TYPES))
    return c.select(
        F.concat(F.lit("VH-"), key.cast("string")).alias("vehicle_id"),
        F.concat(F.lit("PP-"), key.cast("string")).alias("plate"),
        F.element_at(kinds, (key % 3 + 1).cast("int")).alias("vehicle_type"),
        (key % 40 * 100 + 60).cast("int").alias("capacity_kg"),
        F.when(key % 2 == 0, "Z-DEPOT-N").otherwise("Z-DEPOT-S").alias("home_depot_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip for each user and day with telemetry, and some planned ones without."""
    ids = F.array(*map(F.lit, ROUTES))
    days = _events(spark, sf_dir, "user_id", "event_type", "ts").where("event_type <> 'view'").select("user_id", F.to_date("ts").alias("day")).distinct()
    real = days.select(F.concat(F.lit("TR-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("day", "yyyyMMdd")).alias("trip_id"), F.col("user_id").alias("n"), F.col("day").cast("timestamp").alias("day"))
    silent = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 97 = 0").select(F.concat(F.lit("TP-"), F.col("c_custkey").cast("string")).alias("trip_id"), F.col("c_custkey").alias("n"), F.lit("2024-01-15").cast("timestamp").alias("day"))
    both = real.unionByName(silent)
    start = F.col("day") + F.expr("INTERVAL 6 HOURS")
    return both.select("trip_id", F.concat(F.lit("VH-"), F.col("n").cast("string")).alias("vehicle_id"), F.element_at(ids, (F.col("n") % 4 + 1).cast("int")).alias("route_id"), start.alias("planned_start_at"), (start + F.expr("INTERVAL 16 HOURS")).alias("planned_end_at"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meta.ingest_batches as if every 500 events had been a batch."""
    e = _events(spark, sf_dir, "event_id", "ts", "event_type")
    g = e.groupBy(F.floor(F.col("event_id") / 500).alias("batch_id")).agg(F.min("ts").cast("timestamp").alias("started_at"), F.max("ts").cast("timestamp").alias("finished_at"), F.count(F.lit(1)).alias("messages_read"), F.count(F.when(F.col("event_type") == "error", 1)).alias("rows_rejected"))
    return g.withColumns({"status": F.lit("committed"), "rows_inserted": F.col("messages_read") - F.col("rows_rejected"), "rows_duplicate": F.lit(0).cast("long"), "detections_found": F.lit(0).cast("long"), "error": F.lit(None).cast("string")})


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meta.model_runs as if each order were the build of a model."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    return o.select((F.col("o_custkey") % 11).cast("string").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("started_at"), status.alias("status"))


def test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meta.test_results as if each order were a test."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderstatus") == "F", "pass").when(F.col("o_orderstatus") == "O", "fail").otherwise("error")
    return o.select((F.col("o_custkey") % 11).cast("string").alias("run_id"), F.concat(F.lit("m"), (F.col("o_orderkey") % 5).cast("string")).alias("model_name"), F.lit("c").alias("column_name"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("test_name"), status.alias("status"), (F.col("o_orderkey") % 3).alias("failing_rows"), F.lit(None).cast("string").alias("error"), F.col("o_orderdate").cast("timestamp").alias("executed_at"))
