from __future__ import annotations

import math
import random

import pytest
from conftest import ODD
from waymark.llm import mixing


def water(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Targets by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    open_, out, left = set(names), {}, share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def table(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = [(k, " ".join("w" * r.randint(1, 9) for _ in range(int(r.lognormvariate(3, 1)))), r.choice(["a", "a", "a", "b", "c", "é", None, "d"])) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")


def test_targets_rates_and_copies(spark):
    docs = table(spark)
    out = mixing.mix(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken = {}, {}
    for r in out:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = water(sizes)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    biggest = max(r.size for r in out)
    assert all(abs(taken[s] - want[s]) <= biggest / 2 + 1 for s in sizes)
    assert sorted(out) == sorted(mixing.mix(docs).collect())


def test_rates_solve_the_dual(spark):
    docs = table(spark, 800, 3)
    source = {r.doc_id: r.source for r in docs.collect()}
    by: dict = {}
    for r in mixing.mix(docs).where("size > 0").collect():
        by.setdefault(source[r.doc_id], []).append(r)
    for rows in by.values():
        target = rows[0].target
        if target < 2 * rows[0].source_size:
            assert sum(r.rate * r.size for r in rows) == pytest.approx(target, rel=1e-6)
            # One multiplier: log(rate) / size is the same wherever the ceiling does not bind.
            slopes = [math.log(r.rate) / r.size for r in rows if r.rate < 2]
            assert max(slopes) - min(slopes) < 1e-6


def test_odd_rows_and_empty_tables(spark, docs):
    out = {r.doc_id: r for r in mixing.mix(docs(ODD)).collect()}
    assert len(out) == len(ODD) and out[0].size == out[1].size == out[2].size == 0 and out[3].size == 60_000 and out[7].size == 1
    assert mixing.mix(docs([]), share=1.5).count() == 0 and mixing.mix(docs(["", None])).count() == 2
    mixed = mixing.mixed_documents(docs(ODD))
    assert mixed.columns == docs(ODD).columns


def test_mixed_documents_are_the_copies(spark):
    docs = table(spark, 400, 5)
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    got: dict = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_rows_without_ids_do_not_stand_or_fall_together(spark):
    rows = [(None, f"w{k} " * 10, "a") for k in range(400)] + [(k, "x " * 10, "b") for k in range(400)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")).where("doc_id IS NULL").collect()
    assert abs(sum(r.taken for r in out) - out[0].target) <= 20


def test_a_high_ceiling_and_a_far_target_are_met(spark):
    rows = [(k, "w " * (1 + k % 90), "ab"[k % 2]) for k in range(500)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING"), weights=(1000, 1), share=3.0, most=40).collect()
    by = {}
    for r in out:
        by.setdefault(r.target, []).append(r)
    assert all(sum(r.rate * r.size for r in v) == pytest.approx(t, rel=1e-6) for t, v in by.items()) and len(by) == 2
