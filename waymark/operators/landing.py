"""Landing rows once: duplicates within a batch, rows already there, merges by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first in ``order``; a null key is a key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def insert_if_absent(new: DataFrame, landed: DataFrame, *key: str) -> DataFrame:
    """The rows of ``new`` whose key is not in ``landed``."""
    return new.join(landed.select(*key), list(key), "left_anti").select(*new.columns)


def delete_insert(target: DataFrame, stage: DataFrame, *key: str) -> DataFrame:
    """``target`` without the keys of ``stage``, then ``stage``; null keys of ``target`` match nothing and stay."""
    return target.join(stage.select(*key).distinct(), list(key), "left_anti").select(*stage.columns).unionByName(stage)


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` for each key: an overwrite of all columns, without a sort of whole rows."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def recent(rows: DataFrame, moment: str, newest: object | None, minutes: int = 15) -> DataFrame:
    """Rows no older than ``minutes`` before ``newest``, the largest ``moment`` already built; all if there is none."""
    return rows if newest is None else rows.where(F.col(moment) >= F.lit(newest) - F.make_dt_interval(mins=F.lit(minutes)))


def optional(rows: DataFrame, **wanted: object) -> DataFrame:
    """Filters by equality on those parameters that are given."""
    for name, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
    return rows


def merge_writes(writes: DataFrame, *seq: Column | str) -> DataFrame:
    """Episodes from the log of their writes, ordered by ``seq``.

    The first write of a key opens it and settles its place; a later one that
    carries an end settles severity, end, duration, magnitude and details, the
    last such write winning, so that a repeated opening can never reopen it.
    """
    order = F.struct(*seq)
    ended = F.col("ended_at").isNotNull()
    later = ("severity", "ended_at", "duration_seconds", "magnitude", "details", "batch_id")
    first = F.min_by(F.struct("detection_type", "vehicle_id", "trip_id", "zone_id", "started_at", "lat", "lon", *later), order)
    close = F.max_by(F.when(ended, F.struct(*later)), F.when(ended, order))
    # A trip that the opening lacked comes from the first later write with an end that has one.
    given = ended & F.col("trip_id").isNotNull()
    trip = F.min_by(F.when(given, F.col("trip_id")), F.when(given, order))
    merged = writes.groupBy("detection_key").agg(first.alias("f"), close.alias("c"), trip.alias("trip"))
    pick = lambda name: F.when(F.col("c").isNotNull(), F.col(f"c.{name}")).otherwise(F.col(f"f.{name}")).alias(name)
    return merged.select("detection_key", "f.detection_type", "f.vehicle_id", F.coalesce("f.trip_id", "trip").alias("trip_id"), "f.zone_id", "f.started_at", "f.lat", "f.lon", *[pick(n) for n in later])
