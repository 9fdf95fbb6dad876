"""Exact top-k search by MaxScore over integer vectors.

Dimensions are the terms: a vector's component is the impact of its posting.
Components may be negative, so a query's score in a shard is counted from the
least that each term can give there: every posting then has a gain of 0 or more,
and a term's bound is the largest gain that any posting of the shard gives.  With
the k-th best score so far as threshold, terms are split by bound: those whose
bounds together stay below the threshold are non-essential.  Only postings of
the essential terms are traversed; the rest are probed in order of falling bounds,
for documents whose gain so far plus the bounds left still reaches the threshold.
Ties reach it too, so results are exact.  Shards are merged at the end.

All shards begin with one threshold: the k-th best score of a query among a bounded
sample of all vectors, which the final k-th best cannot be below.  A shard that has
nothing to reach it gives nothing.

See :func:`waymark.llm.vectors.clean` for nulls, repeated rows, empty tables and other
columns, and :func:`waymark.llm.vectors.in_blocks` for lengths and for how queries and
shards meet.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import fitted
from waymark.llm.vectors import clean, in_blocks, sample, top

#: Vectors, and their numbers, of the sample that gives the first thresholds.
SAMPLE, SAMPLE_COMPONENTS = 4096, 1 << 19
#: Queries that share their essential terms, and terms probed at a time.
BLOCK, PROBE = 32, 6


def first_thresholds(names: np.ndarray, q: np.ndarray, k: int, seen: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray | None:
    """For each query the k-th best score among the vectors ``seen`` (ids, vectors), its own apart; none where they are too few."""
    if seen is None or len(seen[0]) <= k:
        return None
    scores = q @ seen[1].T.astype(q.dtype)
    scores[names[:, None] == seen[0][None, :]] = np.iinfo(np.int64).min if q.dtype == np.int64 else -np.inf
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def split(bound: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(essential, other) terms of a block of queries: for none of them do the others' bounds together reach its threshold."""
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(bound > 0, bound / np.maximum(threshold, 0)[:, None], 0.0).max(0)
    order = np.argsort(share, kind="stable")
    idle = int(np.searchsorted(np.cumsum(share[order]), 1 - 1e-9, "left"))
    return np.sort(order[idle:]), order[:idle]


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, seen: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k best of one shard for each query, of those that may be among the k best of all; ids ascending, all numbers whole."""
    widest = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if seen is not None:
        widest = max(widest, float(np.abs(seen[1]).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]))
    kind = np.float64 if widest < 2**53 else np.int64  # doubles are exact, and faster, as long as every sum fits
    postings = np.ascontiguousarray(x.T.astype(kind))
    low, high = postings.min(1), postings.max(1)
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(q), BLOCK):
        names, own = query_ids[at : at + BLOCK], q[at : at + BLOCK].astype(kind)
        floor, ceiling = np.minimum(own * low, own * high), np.maximum(own * low, own * high)
        bound, base = ceiling - floor, floor.sum(1)
        first = first_thresholds(names, own, k, seen)
        threshold = np.full(len(own), -1, kind) if first is None else first - base
        essential, others = split(bound, threshold)
        gains = own[:, essential] @ postings[essential] - floor[:, essential].sum(1)[:, None]
        for j, name in enumerate(names):
            left, least = bound[j, others].sum(), threshold[j]
            probes = others[np.argsort(-bound[j, others], kind="stable")]
            alive = np.flatnonzero(gains[j] + left >= least)
            gain = gains[j, alive]
            for c in range(0, len(probes), PROBE):
                if not len(alive):
                    break
                terms = probes[c : c + PROBE]
                gain = gain + own[j, terms] @ postings[np.ix_(terms, alive)] - floor[j, terms].sum()
                left = bound[j, probes[c + PROBE :]].sum()
                if len(gain) > k:  # what is there can only grow: one more than k, as the query itself may be among them
                    least = max(least, np.partition(gain, len(gain) - k - 1)[len(gain) - k - 1])
                still = gain + left >= least
                alive, gain = alive[still], gain[still]
            rest = ids[alive] != name
            alive, gain = alive[rest], gain[rest]
            keep = top(gain, ids[alive], k)
            exact = gain[keep] + base[j]
            out[0].append(np.full(len(keep), name, np.int64))
            out[1].append(ids[alive[keep]])
            out[2].append(exact if exact.dtype == np.int64 else np.rint(exact).astype(np.int64))
    return tuple(np.concatenate(part) for part in out)


def _seen(rows: list[tuple]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    by_length: dict[int, list] = {}
    for name, v in rows:
        by_length.setdefault(len(v), []).append((name, v))
    return {d: (np.array([n for n, _ in own], np.int64), np.array([v for _, v in own])) for d, own in by_length.items()}


def exact_top(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64, every: int = 20, k: int = 20, **sizes) -> DataFrame:
    """query_id, rank, vec_id, score: inner products of floor(scale * component), largest first, ties to the smaller id."""
    whole = clean(table, vec_id=vec_id, vector=vector).select("vec_id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("double")).alias("v"))
    sent = table.sparkSession.sparkContext.broadcast(fitted(sample(whole, SAMPLE, SAMPLE_COMPONENTS), _seen))

    def of_shard(ids: np.ndarray, x: np.ndarray, names: np.ndarray, q: np.ndarray) -> tuple:
        return search(ids, x, names, q, k, pickle.loads(sent.value).get(x.shape[1]))

    return in_blocks(whole, of_shard, every=every, k=k, score="long", **sizes)
