"""What the two vector searches share: clean vectors, and queries against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import materialise, partitions, scratch

#: Components of the vectors, and of the queries, that one task holds at most; and the least rows that make a task worth its start.
SHARD_COMPONENTS, QUERY_COMPONENTS, LEAST_ROWS = 1 << 20, 1 << 20, 2048
RESULT = "query_id long, vec_id long, score {}"


def clean(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", zero: bool = True) -> DataFrame:
    """vec_id, v array<double>: one row per id, as a written table.

    Null ids, null or empty vectors and those with null or non-finite components
    take no part, nor do zero vectors unless ``zero``.  Rows that repeat an id
    count once, with the smallest of their vectors.  An empty table gives an empty
    one; columns beyond the two named are not read.
    """
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return materialise(rows.groupBy("vec_id").agg(F.min("v").alias("v")))


def in_blocks(rows: DataFrame, search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple], *, every: int, k: int, score: str, shard_rows: int | None = None, query_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all shards for each row whose id is divisible by ``every``.

    Vectors of each length are searched among their like.  Shards of the vectors meet
    blocks of the queries, each pair in a task of bounded size: every vector is sent
    once for each block, every query once for each shard.
    ``search(ids, vectors, query_ids, queries)`` gives its own best as (query_id,
    vec_id, score) arrays, which are then merged.
    """
    asks = F.col("vec_id") % every == 0
    sized = rows.select("vec_id", "v", F.size("v").alias("d"))
    with scratch(rows.sparkSession):
        totals = sized.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(asks, 1)).alias("asked"))
        spread = F.least(F.lit(partitions(rows.sparkSession)), F.ceil(F.col("n") / LEAST_ROWS))
        shards = F.ceil(F.col("n") / F.lit(shard_rows)) if shard_rows else F.greatest(F.ceil(F.col("n") * F.col("d") / SHARD_COMPONENTS), spread)
        blocks = F.ceil(F.col("asked") / F.lit(query_rows)) if query_rows else F.ceil(F.col("asked") * F.col("d") / QUERY_COMPONENTS)
        # One small row for each length of vectors.
        plan = materialise(totals.where("asked > 0").select("d", F.greatest(shards, F.lit(1)).cast("int").alias("shards"), F.greatest(blocks, F.lit(1)).cast("int").alias("blocks")), outlive=True)
    placed = sized.join(plan, "d")
    place = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    corpus = placed.select("d", place("shards", 1).alias("shard"), everywhere("blocks").alias("block"), "vec_id", "v", F.lit(False).alias("asks"))
    queries = placed.where(asks).select("d", everywhere("shards").alias("shard"), place("blocks", 2).alias("block"), "vec_id", "v", F.lit(True).alias("asks"))
    kind = pa.float64() if score == "double" else pa.int64()

    def run(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("vec_id"))
        v = np.asarray(table.column("v").combine_chunks().flatten()).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))
        asking = np.asarray(table.column("asks").combine_chunks().cast(pa.int8())).astype(bool)
        own, ask = np.flatnonzero(~asking), np.flatnonzero(asking)
        own, ask = own[np.argsort(ids[own])], ask[np.argsort(ids[ask])]
        out = search(ids[own], v[own], ids[ask], v[ask]) if len(own) and len(ask) else ([], [], [])
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], kind)})

    found = corpus.union(queries).groupBy("d", "shard", "block").applyInArrow(run, RESULT.format(score))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sample(rows: DataFrame, most: int, components: int) -> DataFrame:
    """vec_id, v: vectors of the smallest hashes of their ids, at most ``most`` and at most so many that they have ``components`` together."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).withColumn("upto", F.sum(F.size("v")).over(Window.orderBy(F.xxhash64("vec_id"), "vec_id")))
    return picked.where(F.col("upto") <= components).select("vec_id", "v")


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]
