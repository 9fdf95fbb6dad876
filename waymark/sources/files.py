"""Message sources and sinks: Kafka where its connector is present, files with the same columns elsewhere."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.sources import messages as contract
from waymark.sources import schemas


def kafka_options(servers: str, topic: str, batch_size: int) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(batch_size)}


def provision(spark: SparkSession, *, path: str | None = None, servers: str | None = None, topic: str = "vehicle.telemetry", partitions: int = 12, replication: int = 1) -> bool:
    """Make the topic, or the folder that stands in for it, if it is not there; whether it was made.

    A topic that is there keeps its partitions, as keys would otherwise move.
    """
    jvm = spark._jvm
    if servers:
        properties = jvm.java.util.Properties()
        properties.setProperty("bootstrap.servers", servers)
        admin = jvm.org.apache.kafka.clients.admin.AdminClient.create(properties)  # of the connector's own client library
        try:
            if admin.listTopics().names().get().contains(topic):
                return False
            admin.createTopics(jvm.java.util.Collections.singleton(jvm.org.apache.kafka.clients.admin.NewTopic(topic, partitions, replication))).all().get()
            return True
        finally:
            admin.close()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return _file_system(spark, where).mkdirs(where) if not _file_system(spark, where).exists(where) else False


def _file_system(spark: SparkSession, where):
    return where.getFileSystem(spark._jsc.hadoopConfiguration())


def stream(spark: SparkSession, *, path: str | None = None, files_per_trigger: int = 1, servers: str | None = None, topic: str = "vehicle.telemetry", batch_size: int = 500) -> DataFrame:
    """MESSAGES as a stream: of a topic if ``servers`` is given, else of Parquet files under ``path``."""
    if servers:
        return spark.readStream.format("kafka").options(**kafka_options(servers, topic, batch_size)).load().select("value", "key", "topic", "partition", "offset")
    return spark.readStream.schema(schemas.MESSAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def messages(pings: DataFrame, *, topic: str = "vehicle.telemetry", partitions: int = 12) -> DataFrame:
    """MESSAGES from (vehicle_id, value string): keyed, and partitioned, by vehicle."""
    keyed = pings.withColumn("partition", F.pmod(F.xxhash64("vehicle_id"), F.lit(partitions)).cast("int"))
    return keyed.select(F.col("value").cast("binary").alias("value"), F.col("vehicle_id").cast("binary").alias("key"), F.lit(topic).alias("topic"), "partition", F.monotonically_increasing_id().alias("offset"))


def publish(rows: DataFrame, path: str, *, servers: str | None = None, topic: str = "vehicle.telemetry") -> None:
    """Append MESSAGES to a topic, or as a file set under ``path``; values are not looked at."""
    if servers:
        rows.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("kafka.compression.type", "snappy").save()
    else:
        rows.write.mode("append").parquet(path)


def refused(rows: DataFrame) -> DataFrame:
    """offset and error of those MESSAGES that the contract refuses: what a careful producer looks at before it publishes."""
    return contract.rejected(contract.decoded(rows)).select("offset", "error")


def publish_in_order(rows: DataFrame, path: str, size: int, rate: float | None = None) -> int:
    """Append MESSAGES file after file, ``size`` offsets each, as a file stream takes them by their times; the number of files.

    A topic keeps order within a partition by itself; this is for its stand-in.  With
    ``rate``, in messages a second, a file is not begun before its first message is due.
    """
    began = time.monotonic()
    low, high = rows.agg(F.min("offset"), F.max("offset")).first()
    if low is None:
        return 0
    starts = range(low, high + 1, size)
    for start in starts:
        if rate:
            time.sleep(max(0.0, began + (start - low) / rate - time.monotonic()))
        publish(rows.where(F.col("offset").between(start, start + size - 1)).coalesce(1).sortWithinPartitions("offset"), path)
    return len(starts)


def publish_raw(spark: SparkSession, values: Iterable[bytes | None], path: str, *, topic: str = "vehicle.telemetry", first_offset: int = 0) -> None:
    """Put bytes on the stream as they are, to exercise dead letters."""
    rows = [(bytearray(v) if v is not None else None, None, topic, 0, first_offset + k) for k, v in enumerate(values)]
    publish(spark.createDataFrame(rows, schemas.MESSAGES).coalesce(1), path)


def read_json_lines(spark: SparkSession, path: str, *, topic: str = "vehicle.telemetry") -> DataFrame:
    """MESSAGES from a text file with one message per line."""
    lines = spark.read.text(path).where("value <> ''")
    return lines.select(F.col("value").cast("binary").alias("value"), F.lit(None).cast("binary").alias("key"), F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))


def write_json_lines(pings: DataFrame, path: str) -> None:
    pings.select("value").write.mode("overwrite").text(path)


def paced(spark: SparkSession, pings: DataFrame, rate: float) -> DataFrame:
    """``pings`` with ``due_seconds``, the time after the start at which each is due at ``rate`` messages a second.

    Numbers rows by range partitions, never in one task.
    """
    parts = spark.sparkContext.defaultParallelism
    dealt = pings.repartitionByRange(parts, "recorded_at", "ping_id").sortWithinPartitions("recorded_at", "ping_id").withColumn("_p", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id() % (1 << 33))
    sizes = dealt.groupBy("_p").count()  # as many rows as partitions
    before = sizes.select("_p", (F.sum("count").over(Window.orderBy("_p")) - F.col("count")).alias("_b"))
    return dealt.join(F.broadcast(before), "_p").withColumn("due_seconds", (F.col("_b") + F.col("_k")) / float(rate)).drop("_p", "_k", "_b")
