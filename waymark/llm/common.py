"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

WORD_BYTES = rb"[^\x20\x09-\x0D]+"
#: A Java pattern for the same words, for use in SQL functions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch: whole texts may be long, so batches stay short.
ARROW_ROWS = 256


#: And its bytes, whichever comes first.
ARROW_BYTES = 1 << 20
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor can reach.

    ``spark.checkpoint.dir`` of the session; only where that is unset and all runs on
    one machine (tests) is a temporary folder made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="waymark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`materialise` writes within are deleted at the end, apart from those made to outlive it."""
    _scopes.append([])
    try:
        yield
    finally:
        delete(spark, _scopes.pop())


def materialise(df: DataFrame, *, outlive: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives the loss of any executor, and
    gives the planner true sizes, so that it broadcasts only what is small.
    With ``outlive`` the table belongs to the scope around the present one; those of
    no scope stay with the application's other tables in the shared folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/waymark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    owners = _scopes[: -1 if outlive else None]
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, by rows and by bytes, in this session from now on."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    if spark.conf.get(size) != str(ARROW_BYTES):
        spark.conf.set(size, str(ARROW_BYTES))


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lean(run: Callable) -> Callable:
    """``run``, a generator over a partition, giving memory that it freed back to the system at its end: workers live on for other tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def fold(doc_id: Column | str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts == part, F.lit(False))


def unit_hash(*columns: Column) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def annotated(docs: DataFrame, text: str, name: str, score: Callable[[], Callable[[list[str | None]], list[float]]]) -> DataFrame:
    """``docs``, all columns as they are, with a double column ``name`` scored from the whole text.

    Rows pass through in place: nothing is shuffled or joined.  ``score`` makes, in
    each task, the function that scores a list of texts.  A column of ``docs`` that has
    the name already gives way to the scores.
    """
    if fresh(name, docs.columns) != name:
        docs = docs.drop(name)
    short_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa  # not on top: workers that need no Arrow stay smaller

        own = score()
        for batch in batches:
            found = pa.array(own(batch.column(at).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return docs.mapInArrow(lean(run), schema)


def fitted(sample: DataFrame, fit: Callable[[list[tuple]], object]) -> bytes:
    """The pickled model that ``fit`` makes of the rows of ``sample``, in their own order of columns.

    For samples bounded in rows and in the length of a text: they meet in one task, not on the driver.  Rows are
    put in order first, so that the model does not depend on how they were dealt.
    """
    import pickle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: tuple((v is not None, v) for v in r))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    found = sample.coalesce(1).mapInArrow(lean(run), "model binary").first()
    return bytes(found.model) if found else pickle.dumps(fit([]))
