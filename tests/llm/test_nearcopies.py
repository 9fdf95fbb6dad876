from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import ODD
from waymark.llm import nearcopies, simhash


def edited(r: random.Random, words: list[str], share: float) -> str:
    """The words with one run replaced, so that about ``share`` of all shingles stay common to both."""
    new = round(len(words) * (1 - share) / (1 + share)) - 4
    at = r.randrange(len(words) - new)
    return " ".join([*words[:at], *(f"n{r.getrandbits(40)}" for _ in range(new)), *words[at + new :]])


def similarity(a: str, b: str) -> float:
    x, y = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def kept(frame, **options) -> list[int]:
    return sorted(x.doc_id for x in nearcopies.deduplicated(frame, **options).collect())


def test_pairs_from_the_threshold_on_are_linked_and_those_below_are_not(spark, docs):
    r = random.Random(3)
    texts, near = [], []
    for k in range(120):
        words = [f"w{r.getrandbits(40)}" for _ in range(300)]
        texts += [" ".join(words), edited(r, words, (0.7, 0.77, 0.82, 0.85, 0.9)[k % 5])]
        near.append(similarity(*texts[-2:]) >= 0.8)
    assert 60 <= sum(near) <= 80
    assert kept(docs(texts)) == sorted([*range(0, 240, 2), *(2 * k + 1 for k in range(120) if not near[k])])


def test_a_pair_behind_another_node_of_their_bucket(spark, docs):
    """Families in which few members are near to the least one, against all pairs."""
    r = random.Random(5)
    texts = []
    for _ in range(12):
        words = [f"w{r.getrandbits(40)}" for _ in range(200)]
        texts += [edited(r, words, share) for share in (0.78, 0.8, 0.82, 0.85, 0.88, 0.9, 0.92, 0.95)]
    root = list(range(len(texts)))
    for _ in range(8):
        for a in range(len(texts)):
            for b in range(a // 8 * 8, a):
                if similarity(texts[a], texts[b]) >= 0.8:
                    root[a] = root[b] = min(root[a], root[b])
    assert kept(docs(texts)) == sorted(set(root)) and 12 < len(set(root)) < 96


def test_texts_of_one_fingerprint_ball_but_below_the_threshold_both_stay(spark, docs):
    # The common shingle outvotes all others in every bit.
    texts = ["x " * 400 + " ".join(f"{a}{k}" for k in range(20)) for a in "ab"]
    assert (simhash.fingerprint(texts[0], 5) ^ simhash.fingerprint(texts[1], 5)).bit_count() <= 4
    assert similarity(*texts) < 0.8 and kept(docs(texts)) == [0, 1]


def test_rows_of_one_id_and_odd_texts(spark, docs):
    rows = [(1, "a b c d e f"), (1, "z y x w v u"), (2, "Z y x w  v u"), (1, "a b c d e f"), (3, "z y x w v u"), (None, "a b c d e f")]
    out = nearcopies.deduplicated(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert sorted((str(x.doc_id), x.text) for x in out) == [("1", "a b c d e f"), ("1", "z y x w v u"), ("None", "a b c d e f")]
    assert kept(docs(ODD)) == [0, 3, 4, 6, 7, 8] and kept(docs([])) == []


def test_a_group_with_more_pairs_than_a_task_takes(spark, docs, monkeypatch):
    monkeypatch.setattr(nearcopies, "TASK_PAIRS", 7)
    words = [f"w{k}" for k in range(300)]
    assert kept(docs([" ".join([*words, f"z{k}"]) for k in range(100)])) == [0]


@pytest.mark.parametrize("nodes, hashes", [(3, 1024), (4096, 32)])
def test_buckets_in_blocks_and_long_texts_link_alike(spark, docs, monkeypatch, nodes, hashes):
    monkeypatch.setattr(nearcopies, "BUCKET_NODES", nodes)
    monkeypatch.setattr(nearcopies, "LEAST_HASHES", hashes)
    test_a_pair_behind_another_node_of_their_bucket(spark, docs)


def test_overlaps_of_whole_and_of_cut_sets():
    r = np.random.default_rng(4)
    pool = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(r.choice(pool, k, replace=False)) for k in (5, 200, 1800, 2500, 2500)]
    exact = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    like, _ = nearcopies._overlaps(sets[2], True, sets, np.ones(5, bool))
    assert like.tolist() == [exact(sets[2], s) for s in sets]
    cut = [s[:500] for s in sets]
    like, size = nearcopies._overlaps(cut[3], False, cut, np.array([len(s) <= 500 for s in sets]))
    assert all(abs(x - exact(sets[3], s)) < 0.12 for x, s in zip(like[2:], sets[2:])) and like[3] == 1 and (size[2:] >= 400).all()


def test_minima_in_blocks():
    x = np.random.default_rng(1).integers(0, 1 << 63, 9000, dtype=np.uint64)
    assert (nearcopies.minima(x) == np.minimum(nearcopies.minima(x[:10]), nearcopies.minima(x[10:]))).all()
