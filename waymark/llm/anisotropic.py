"""Approximate nearest neighbours by score-aware anisotropic quantisation.

Vectors are cut into pairs of components, each coded by one of 16 centres, so
four bits a pair.  Codes and centres are chosen to lessen a loss that weighs the
part of the residual along the vector, which changes large inner products,
``eta`` times as much as the part across it.  Codebooks are fitted, for each length of vectors, on a bounded
sample, at most ``SAMPLE`` vectors of the smallest hashes and ``SAMPLE_COMPONENTS``
numbers; every vector is coded, in the task of its shard.  A query becomes tables of its products with the centres, two
pairs at a time (256 entries for a byte of two codes); a scan of the shard's
bytes ranks it, and the ``shortlist`` best of every shard are ranked anew by exact
inner products in double precision, which alone are returned.  The shortlist is
``shortlist`` for every ``SHORTLIST_ROWS`` rows of a shard, so that recall does not fall
as shards grow.  Vectors of a length that the sample lacks are compared exactly.

Zero vectors take no part; for nulls, repeated rows, empty tables and other columns see
:func:`waymark.llm.vectors.clean`, for lengths :func:`waymark.llm.vectors.in_blocks`.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame

from waymark.llm.common import fitted
from waymark.llm.vectors import clean, in_blocks, sample, top

SAMPLE, SAMPLE_COMPONENTS, CENTRES, WIDTH = 8192, 1 << 20, 16, 2
SHORTLIST_ROWS = 4096
#: The share of a vector's length from which inner products matter; sets eta.
REACH = 0.2
ROUNDS, SWEEPS = 6, 2


def _split(x: np.ndarray) -> np.ndarray:
    """(rows, parts, WIDTH), with zeros after the last component; an even number of parts."""
    unit = WIDTH * 2
    wide = np.zeros((len(x), -(-x.shape[1] // unit) * unit))
    wide[:, : x.shape[1]] = x
    return wide.reshape(len(x), -1, WIDTH)


def eta(dimensions: int) -> float:
    """How many times as much the parallel error weighs."""
    return max(1.0, (dimensions - 1) * REACH**2 / (1 - REACH**2))


def encode(x: np.ndarray, books: np.ndarray, weight: float, sweeps: int = SWEEPS) -> np.ndarray:
    """Codes (rows, parts) by coordinate descent on the anisotropic loss."""
    parts = _split(x)
    unit = parts / np.maximum(1e-12, np.linalg.norm(x, axis=1))[:, None, None]
    codes = np.stack([((parts[:, m, None, :] - books[m]) ** 2).sum(-1).argmin(1) for m in range(parts.shape[1])], 1)
    along = lambda m: ((parts[:, m] - books[m][codes[:, m]]) * unit[:, m]).sum(1)
    total = sum(along(m) for m in range(parts.shape[1]))
    for _ in range(sweeps):
        for m in range(parts.shape[1]):
            rest = total - along(m)
            gap = parts[:, m, None, :] - books[m]
            loss = (gap**2).sum(-1) + (weight - 1) * (rest[:, None] + (gap * unit[:, m, None, :]).sum(-1)) ** 2
            codes[:, m] = loss.argmin(1)
            total = rest + along(m)
    return codes


def fit(x: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, CENTRES, WIDTH) of a sample."""
    parts, weight = _split(x), eta(x.shape[1])
    unit = parts / np.maximum(1e-12, np.linalg.norm(x, axis=1))[:, None, None]
    rng = np.random.default_rng(3)
    books = np.stack([parts[rng.choice(len(x), CENTRES, replace=len(x) < CENTRES), m] for m in range(parts.shape[1])])
    for _ in range(rounds):
        codes = encode(x, books, weight, 1)
        for m in range(parts.shape[1]):
            chosen = books[np.arange(parts.shape[1])[None, :], codes]
            rest = ((parts - chosen) * unit).sum((1, 2)) - ((parts[:, m] - chosen[:, m]) * unit[:, m]).sum(1)
            for c in range(CENTRES):
                mine = codes[:, m] == c
                if not mine.any():
                    continue
                u, p = unit[mine, m], parts[mine, m]
                left = np.eye(WIDTH) * mine.sum() + (weight - 1) * u.T @ u
                books[m, c] = np.linalg.solve(left, p.sum(0) + (weight - 1) * (u * (rest[mine] + (p * u).sum(1))[:, None]).sum(0))
    return books


def pack(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes to a byte: (parts / 2, rows)."""
    return np.ascontiguousarray((codes[:, ::2] | codes[:, 1::2] << 4).astype(np.uint8).T)


def tables(q: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(queries, parts / 2, 256): a query's products with every pair of centres."""
    single = np.einsum("qmw,mcw->qmc", _split(q), books)
    return (single[:, ::2, None, :] + single[:, 1::2, :, None]).reshape(len(q), -1, CENTRES * CENTRES).astype(np.float32)


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, books: np.ndarray | None, shortlist: int) -> tuple:
    short = max(k + 1, -(-shortlist * len(ids) // SHORTLIST_ROWS) if len(ids) > SHORTLIST_ROWS else shortlist)
    packed = pack(encode(x, books, eta(x.shape[1]))) if books is not None and short < len(ids) else None
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(q), 64):
        near = None
        if packed is not None:
            own = tables(q[at : at + 64], books)
            near = np.zeros((len(own), len(ids)), np.float32)
            for m in range(len(packed)):
                near += own[:, m][:, packed[m]]
        for j, (name, query) in enumerate(zip(query_ids[at : at + 64], q[at : at + 64])):
            some = np.arange(len(ids)) if near is None else np.argpartition(near[j], len(ids) - short)[len(ids) - short :]
            some = some[ids[some] != name]
            exact = x[some] @ query
            keep = top(exact, ids[some], k)
            out[0].append(np.full(len(keep), name))
            out[1].append(ids[some][keep])
            out[2].append(exact[keep])
    return tuple(np.concatenate(part) for part in out)


def _books(rows: list[tuple]) -> dict[int, np.ndarray]:
    by_length: dict[int, list] = {}
    for _, v in rows:
        by_length.setdefault(len(v), []).append(v)
    return {d: fit(np.array(own)) for d, own in by_length.items()}


def nearest(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, shortlist: int = 160, **sizes) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``, the k largest inner products found."""
    rows = clean(table, vec_id=vec_id, vector=vector, zero=False)
    sent = table.sparkSession.sparkContext.broadcast(fitted(sample(rows, SAMPLE, SAMPLE_COMPONENTS), _books))

    def of_shard(ids: np.ndarray, x: np.ndarray, names: np.ndarray, q: np.ndarray) -> tuple:
        return search(ids, x, names, q, k, pickle.loads(sent.value).get(x.shape[1]), shortlist)

    return in_blocks(rows, of_shard, every=every, k=k, score="double", **sizes)
