from __future__ import annotations

import numpy as np
import pytest
from waymark.llm import anisotropic, maxscore


def frame(spark, vectors: dict):
    rows = [(k, None if v is None else [None if x is None else float(x) for x in v], "c") for k, v in vectors.items()]
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, score STRING")


def brute(vectors: dict, k: int, scale: int | None = None) -> dict:
    held = {i: np.array(v, np.float32).astype(float) for i, v in vectors.items()}
    held = {i: np.floor(scale * v) if scale else v for i, v in held.items()}
    return {q: sorted(((-float(held[q] @ v), i) for i, v in held.items() if i != q))[:k] for q in held if q % 20 == 0}


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 16))
    rows = {int(i): centres[i % 12] + r.normal(size=16) * 0.8 for i in r.permutation(1500)[:1200]}
    for i in list(rows)[:40]:
        rows[i + 5000] = rows[i]  # ties
    return {i: v / np.linalg.norm(v) for i, v in rows.items()}


def test_maxscore_is_exact_with_ties_over_any_shards(spark, vectors):
    want = brute(vectors, 20, 64)
    for sizes in ({}, {"shard_rows": 300, "query_rows": 20}):
        got: dict = {}
        for r in maxscore.exact_top(frame(spark, vectors), **sizes).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert got == {q: [(int(s), i) for s, i in x] for q, x in want.items()}


def test_maxscore_handles_wide_numbers_and_zero_bounds():
    x = np.array([[2**40, -1], [2**40, 1], [0, 0]])
    q = np.array([[2**20, 3], [0, 0]])
    names, ids, scores = maxscore.search(np.array([1, 2, 3]), x, np.array([7, 8]), q, 2)
    assert list(zip(names, ids, scores)) == [(7, 2, 2**60 + 3), (7, 1, 2**60 - 3), (8, 1, 0), (8, 2, 0)]


def test_nearest_recall_and_scores(spark, vectors):
    want, got = brute(vectors, 20), {}
    for r in anisotropic.nearest(frame(spark, vectors), shortlist=60).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    held = {i: np.array(v, np.float32).astype(float) for i, v in vectors.items()}
    hits = [len({i for i, _ in got[q]} & {i for _, i in x}) / len(x) for q, x in want.items()]
    assert set(got) == set(want) and np.mean(hits) >= 0.9
    assert all(s == pytest.approx(float(held[q] @ held[i]), abs=1e-12) for q, rows in got.items() for i, s in rows)
    assert all([s for _, s in rows] == sorted((s for _, s in rows), reverse=True) for rows in got.values())


def test_anisotropic_codes_lose_less_along_the_vector(vectors):
    x = np.array(list(vectors.values()))
    books, weight = anisotropic.fit(x), anisotropic.eta(16) * 4
    along = lambda codes: (((x - np.concatenate([books[m][codes[:, m]] for m in range(8)], 1)) * x).sum(1) ** 2).mean()
    assert along(anisotropic.encode(x, books, weight)) < along(anisotropic.encode(x, books, 1.0))
    assert anisotropic.pack(np.array([[1, 2], [15, 15]])).tolist() == [[33, 255]]


ODD = {0: [1, 0], 1: None, 2: [], 3: [float("nan"), 1], 4: [float("inf"), 1], 5: [None, 1], 6: [0, 0], 20: [0.5, 0.5], 21: [1, 1], 22: [1, 2, 3]}


@pytest.mark.parametrize("operator, zero", [(maxscore.exact_top, True), (anisotropic.nearest, False)])
def test_rows_that_take_no_part_and_few_candidates(spark, operator, zero):
    found = operator(frame(spark, ODD)).collect()
    assert {r.query_id for r in found} == {0, 20} and {r.vec_id for r in found} == {0, 20, 21} | ({6} if zero else set())
    assert len(found) == 2 * (3 if zero else 2) and operator(frame(spark, {})).count() == 0 and operator(frame(spark, {20: [1.0]})).count() == 0


def test_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (1, [0.5]), (1, [0.5]), (None, [9.0])], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert [(r.query_id, r.vec_id, r.score) for r in maxscore.exact_top(rows).collect()] == [(20, 1, 64 * 32)]


@pytest.mark.parametrize("sample", [0, 25, 300])
def test_maxscore_finds_the_same_from_any_first_thresholds(sample):
    r = np.random.default_rng(sample)
    x = np.floor(r.normal(size=(500, 24)) * r.gamma(0.3, 40, 24))
    x[r.random(x.shape) < 0.5] = 0
    ids, q = np.arange(500), x[:40]
    seen = (ids[-sample:], x[-sample:]) if sample else None
    names, found, scores = maxscore.search(ids, x, ids[:40], q, 7, seen)
    for k in range(40):
        want = sorted((-int(x[k] @ x[i]), i) for i in range(500) if i != k)[:7]
        assert [(-int(s), int(i)) for n, i, s in zip(names, found, scores) if n == k] == want


def test_other_terms_never_reach_a_threshold():
    r = np.random.default_rng(2)
    bound, threshold = r.gamma(0.5, 10, (9, 30)), r.gamma(3, 10, 9)
    essential, others = maxscore.split(bound, threshold)
    assert sorted([*essential, *others]) == list(range(30)) and len(others) and (bound[:, others].sum(1) < threshold).all()
    assert len(maxscore.split(bound, threshold * 0 - 1)[1]) == 0


@pytest.mark.parametrize("operator", [maxscore.exact_top, anisotropic.nearest])
def test_vectors_of_each_length_find_their_like(spark, operator):
    rows = {k: [1.0 + k % 7] * (2 + k % 3) for k in range(200)}
    found: dict = {}
    for x in operator(frame(spark, rows)).collect():
        found.setdefault(x.query_id, []).append(x.vec_id)
    assert set(found) == set(range(0, 200, 20)) and all(len(v) == 20 and all(len(rows[i]) == len(rows[q]) for i in v) for q, v in found.items())
