"""Tables of Parquet files under one root, in layers, each switched to its new version in one step.

A table is written beside the old version; then an empty file is made whose name is
its number and the new version's name, so a pointer is there as a whole or not at all.
Readers follow the one of the highest number.  The version before the present one is
kept for readers that have begun.  Batch tables keep one folder per batch, so that
writing a batch again replaces it and nothing else.  Views are recorded by name, and
made anew, by ``definitions``, where they are not yet known to the process.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources import schemas

LAYERS = ("raw", "ref", "stream", "stg", "mart", "meta")
#: Versions that are no folder of one table's state.
BATCHES, VIEW = "batches", "view"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.views: dict[str, DataFrame] = {}
        #: Makes a recorded view by its table's name.
        self.definitions: Callable[[str], DataFrame] = self._undefined

    def _undefined(self, table: str) -> DataFrame:
        raise LookupError(f"the view {table!r} is recorded, but nothing defines it")

    def _path(self, table: str) -> str:
        layer, _, name = table.partition(".")
        if layer not in LAYERS or not name:
            raise ValueError(f"{table!r} is not a table of a layer")
        return f"{self.root}/{layer}/{name}"

    def _file(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _pointers(self, table: str) -> list[tuple[int, str]]:
        """(number, version) of every pointer, in order."""
        fs, where = self._file(f"{self._path(table)}/_versions")
        if not fs.exists(where):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(where)]
        return sorted((int(n.partition(".")[0]), n.partition(".")[2]) for n in names if n[:1].isdigit())

    def _pointer(self, table: str) -> str | None:
        found = self._pointers(table)
        return found[-1][1] if found else None

    def init(self) -> None:
        """Make every declared table that is not there yet, empty."""
        for table, schema in schemas.RELATIONS.items():
            if not self.exists(table):
                self.replace(table, self.spark.createDataFrame([], schema))

    def exists(self, table: str) -> bool:
        return table in self.views or self._pointer(table) is not None

    def read(self, table: str) -> DataFrame:
        if table in self.views:
            return self.views[table]
        version = self._pointer(table)
        if version is None:
            raise LookupError(f"there is no table {table!r}")
        if version == VIEW:
            self.views[table] = self.definitions(table)
            return self.views[table]
        where = f"{self._path(table)}/{version}"
        schema = schemas.RELATIONS.get(table)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        found = reader.parquet(where)
        return found if schema is None else found.select(*[x.split(":")[0] for x in found.columns])

    def replace(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> None:
        """Write a new version and switch to it."""
        self.views.pop(table, None)
        new = f"v-{uuid.uuid4().hex}"
        rows = rows.sortWithinPartitions(*sort_by) if sort_by else rows
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(f"{self._path(table)}/{new}")
        self._switch(table, new)

    def replace_partitions(self, table: str, rows: DataFrame, column: str, sort_by: tuple[str, ...] = ()) -> None:
        """Overwrite those partitions of the present version that ``rows`` has values of, and leave the others."""
        staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
        rows.write.parquet(staged)  # what is read must not be what is overwritten
        own = self.spark.read.schema(rows.schema).parquet(staged)
        own = own.sortWithinPartitions(column, *sort_by) if sort_by else own
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(f"{self._path(table)}/{self._pointer(table)}")
        self._remove(staged)

    def _remove(self, path: str) -> None:
        fs, where = self._file(path)
        fs.delete(where, True)

    def _switch(self, table: str, version: str) -> None:
        found = self._pointers(table)
        fs, where = self._file(f"{self._path(table)}/_versions/{(found[-1][0] if found else 0) + 1:012d}.{version}")
        fs.create(where, False).close()
        for number, old in found[:-1]:  # all but the one before
            if old not in (BATCHES, VIEW, version):
                self._remove(f"{self._path(table)}/{old}")
            self._remove(f"{self._path(table)}/_versions/{number:012d}.{old}")

    def write_batch(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Write, or write again, the rows of one batch."""
        rows.drop("batch_id").write.mode("overwrite").parquet(f"{self._path(table)}/batches/batch_id={int(batch_id)}")
        if self._pointer(table) != BATCHES:
            self._switch(table, BATCHES)

    def before(self, table: str, batch_id: int) -> DataFrame:
        """The rows of earlier batches only, so that a repeated batch sees what it saw first."""
        return self.read(table).where(F.col("batch_id") < batch_id)

    def view(self, table: str, rows: DataFrame) -> None:
        self.views[table] = rows
        if self._pointer(table) != VIEW:
            self._switch(table, VIEW)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a log table."""
        version = self._pointer(table)
        if version is None:
            self.replace(table, rows)
        else:
            rows.write.mode("append").parquet(f"{self._path(table)}/{version}")
