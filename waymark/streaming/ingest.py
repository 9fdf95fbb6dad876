"""Messages to landed pings, dead letters, detections and states, batch by batch.

A micro-batch is one unit: its rows go to the partitions named after its batch id,
which a repeated attempt overwrites, and it reads only what earlier batches left.
So a batch that was interrupted, anywhere, comes out the same when it is run again,
and the source's offsets are committed by the query only after it.

Duplicates are sought among all pings ever landed, not in a window of them.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.operators import fold as folding
from waymark.operators.enrich import enrich
from waymark.operators.landing import first_by, insert_if_absent, merge_writes
from waymark.plans.warehouse import Warehouse
from waymark.sources import messages as contract
from waymark.sources import schemas
from waymark.sources.config import Settings

DETECTION_NAMES = [x.split()[0] for x in schemas.DETECTION_FIELDS.split(", ")]
#: Batches between two states that later ones may start from.
STATE_BATCHES = 50


def latest_states(warehouse: Warehouse, batch_id: int) -> DataFrame:
    """vehicle_id, state: of each vehicle that reported in an earlier batch, the last one written.

    The last batch that repeats all states, and those after it, are all that is read.
    """
    whole = batch_id // STATE_BATCHES * STATE_BATCHES - 1
    return warehouse.before("stream.vehicle_state", batch_id).where(F.col("batch_id") >= whole).groupBy("vehicle_id").agg(F.max_by("state", "batch_id").alias("state"))


def process(warehouse: Warehouse, batch: DataFrame, batch_id: int, settings: Settings) -> dict:
    """One batch of MESSAGES, from decoding to states; its row of meta.ingest_batches."""
    spark, began = warehouse.spark, datetime.now(timezone.utc)
    ref = {n: warehouse.read(f"ref.{n}") for n in ("zones", "trips", "routes", "route_schedule")}
    staged = f"{warehouse.root}/stream/_staged/decoded-{batch_id}"
    contract.decoded(batch).write.mode("overwrite").parquet(staged)
    decoded = spark.read.parquet(staged)
    read, refused = decoded.agg(F.count(F.lit(1)), F.count("error")).first()
    now = F.lit(began)

    good = first_by(contract.valid(decoded), "ping_id", "offset", "topic", "partition")
    fresh = insert_if_absent(good, warehouse.before("raw.pings", batch_id), "ping_id").withColumn("ingested_at", now)
    warehouse.write_batch("raw.pings", fresh, batch_id)
    bad = contract.rejected(decoded).dropDuplicates(["topic", "partition", "offset"]).withColumn("rejected_at", now)
    bad = insert_if_absent(bad, warehouse.before("raw.pings_dead_letter", batch_id), "topic", "partition", "offset")
    warehouse.write_batch("raw.pings_dead_letter", bad, batch_id)

    pings = warehouse.read("raw.pings").where(F.col("batch_id") == batch_id)
    enriched = enrich(pings, ref["zones"], ref["trips"], ref["routes"], ref["route_schedule"])
    both = f"{warehouse.root}/stream/_staged/folded-{batch_id}"
    folding.fold(enriched, folding.fences_of(ref["zones"]), settings, latest_states(warehouse, batch_id)).write.mode("overwrite").parquet(both)
    folded = spark.read.schema(folding.FOLDED).parquet(both)
    warehouse.write_batch("stream.detections", folded.where("detection_key IS NOT NULL").select(*DETECTION_NAMES), batch_id)
    states = folded.where("state IS NOT NULL").select("vehicle_id", "state")
    if batch_id % STATE_BATCHES == STATE_BATCHES - 1:
        # Now and then a batch repeats all states, so that older batches need not be read again.
        states = states.unionByName(latest_states(warehouse, batch_id).join(states.select("vehicle_id"), "vehicle_id", "left_anti"))
    warehouse.write_batch("stream.vehicle_state", states, batch_id)

    inserted = pings.count()
    found = folded.where("is_first").count()
    row = (batch_id, "committed", began, datetime.now(timezone.utc), read, inserted, read - refused - inserted, refused, found, None)
    warehouse.write_batch("meta.ingest_batches", spark.createDataFrame([row], schemas.BATCHES), batch_id)
    for path in (staged, both):
        warehouse._remove(path)
    return dict(zip([x.split()[0] for x in schemas.BATCHES.split(", ")], row))


def run(warehouse: Warehouse, source: DataFrame, checkpoint: str, settings: Settings, *, available_now: bool = True, every: str | None = None, idle_timeout: float | None = None, max_messages: int | None = None) -> StreamingQuery:
    """Start the query.

    With ``available_now`` it ends by itself once all that is there has been read.
    Otherwise it goes on until nothing has come for ``idle_timeout`` seconds or
    ``max_messages`` have been read, whichever is first, and is stopped between batches;
    with neither it is returned running.
    """
    done = {"read": 0, "at": time.monotonic(), "busy": False}

    def step(batch: DataFrame, batch_id: int) -> None:
        done["busy"] = True
        read = process(warehouse, batch, batch_id, settings)["messages_read"]
        done.update(read=done["read"] + read, busy=False)
        if read:
            done["at"] = time.monotonic()

    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    query = writer.trigger(processingTime=every or f"{settings.batch_timeout_seconds} seconds").start()
    if idle_timeout is None and max_messages is None:
        return query
    while not query.awaitTermination(0.2):
        enough = max_messages is not None and done["read"] >= max_messages
        silent = idle_timeout is not None and time.monotonic() - done["at"] >= idle_timeout
        if (enough or silent) and not done["busy"]:
            query.stop()
            break
    return query


def episodes(warehouse: Warehouse) -> DataFrame:
    """stream.episodes: every detection's writes merged; a breach's reason out of its details."""
    merged = merge_writes(warehouse.read("stream.detections"), "batch_id", "write_seq")
    batches = warehouse.read("meta.ingest_batches").select("batch_id", F.col("finished_at").alias("updated_at"))
    return merged.withColumn("reason", F.get_json_object("details", "$.reason")).join(batches, "batch_id", "left")


def publish_episodes(warehouse: Warehouse) -> None:
    warehouse.replace("stream.episodes", episodes(warehouse))


# The same fold with Spark's own keyed state, for streams without a table of states.

_STATE = "state STRING"


def _streamed(fences: dict, settings: Settings):
    def step(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = folding.State.load(state.get[0] if state.exists else None)
        runner = folding.Fold(key[0], held, settings, fences)
        rows = pd.concat(list(chunks)).sort_values(["recorded_at", "ping_id"], kind="stable")
        none = lambda v: None if v is None or isinstance(v, float) and v != v else v
        out: list[dict] = []
        for r in rows.to_dict("records"):
            out += [w | {"write_seq": len(out) + k} for k, w in enumerate(runner.take(folding.ping_of({c: none(v) for c, v in r.items()})))]
        state.update((held.dump(),))
        frame = pd.DataFrame(out, columns=DETECTION_NAMES)
        for c in ("started_at", "ended_at"):
            frame[c] = pd.to_datetime(frame[c], unit="us", utc=True)
        for c in ("lat", "lon", "magnitude"):
            frame[c] = frame[c].astype("float64")
        frame["duration_seconds"] = frame["duration_seconds"].astype("Int32")
        yield frame

    return step


def stateful(enriched: DataFrame, fences: dict, settings: Settings) -> DataFrame:
    """A streaming DataFrame of detection writes; a vehicle's pings are put in order within each micro-batch, and late ones skipped."""
    return folding.rows_of(enriched).groupBy("vehicle_id").applyInPandasWithState(_streamed(fences, settings), schemas.DETECTION_FIELDS, _STATE, "append", "NoTimeout")


def session_defaults(spark: SparkSession) -> SparkSession:
    """What the streaming queries need of a session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
