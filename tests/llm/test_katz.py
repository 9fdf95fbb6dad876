from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from waymark.llm import katz


def held(k) -> bool:
    return k is not None and zlib.crc32(str(k).encode()) % 5 == 1


def tokens(text) -> list[str]:
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), " end"]


class Plain:
    """The same model, word by word."""

    def __init__(self, rows):
        self.uni, self.bi = Counter(), Counter()
        docs = [tokens(t) for k, t in rows if not held(k)]
        for d in docs:
            self.uni.update(d)
            self.bi.update(zip([" begin", *d], d))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.context = Counter({w: c for w, c in self.uni.items()} | {" begin": len(docs)})
        table = lambda c: np.bincount(np.minimum(list(c.values()) or [0], katz.TOP + 2), minlength=katz.TOP + 3) * (np.arange(katz.TOP + 3) > 0)
        self.d1, self.d2 = katz.discounts(table(self.uni)), katz.discounts(table(self.bi))
        self.words = katz.Words(self.n, table(self.uni))
        self.after: dict = {}
        for (a, b), c in self.bi.items():
            self.after.setdefault(a, []).append((b, c))

    def p1(self, w) -> float:
        return float(self.words.p(np.array([self.uni[w]]))[0])

    def _cut(self, c) -> float:
        return c * (self.d2[c] if c <= katz.TOP else 1)

    def p2(self, a, b) -> float:
        c1 = self.context[a]
        if not c1:
            return self.p1(b)
        mass = sum(self._cut(c) for _, c in self.after.get(a, []))
        c1 += c1 - mass <= 1e-9 * c1
        if self.bi[a, b]:
            return self._cut(self.bi[a, b]) / c1
        return (1 - mass / c1) / (1 - sum(self.p1(w) for w, _ in self.after.get(a, []))) * self.p1(b)

    def score(self, text) -> float:
        t = tokens(text)
        return sum(math.log10(self.p2(a, b)) for a, b in zip([" begin", *t], t))

    def base(self, text) -> float:
        return sum(math.log10((self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in tokens(text))


def corpus(n=300, seed=1):
    r = random.Random(seed)
    words = [f"W{k}" if k % 3 else f"w{k}é" for k in range(200)]
    weights = [1 / (k + 1) for k in range(200)]
    texts = []
    for _ in range(n):
        w = r.choices(words, weights, k=r.randint(0, 40))
        texts.append(" ".join(x for pair in zip(w, w) for x in (pair if r.random() < 0.2 else pair[:1])))
    return texts


@pytest.mark.parametrize("partitions", [1, 7])
def test_scores_equal_a_plain_model(spark, docs, partitions):
    rows = list(enumerate([*corpus(), *ODD[:3], *ODD[4:], "quite unknown words here"]))
    plain = Plain(rows)
    out = {r.doc_id: r for r in katz.score_documents(docs([t for _, t in rows]).repartition(partitions)).collect()}
    assert len(out) == len(rows)
    for k, text in rows:
        r = out[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k), len(tokens(text)), sum(plain.uni[w] > 0 for w in tokens(text)), plain.n)
        assert r.base_score == pytest.approx(plain.base(text), abs=1e-8) and r.score == pytest.approx(plain.score(text), abs=1e-8)


def test_distributions_add_up_to_one():
    plain = Plain(list(enumerate(corpus(120, 4))))
    vocabulary = [*plain.uni, "unknown word"]
    assert sum(plain.p1(w) for w in vocabulary) == pytest.approx(1)
    for a in (" begin", "w0é", "w1", "w150é", "never seen"):
        assert sum(plain.p2(a, b) for b in vocabulary) == pytest.approx(1)


def test_good_turing_and_its_fallback():
    of = np.array([0, 1000, 400, 200, 120, 80, 60, 0])
    d = katz.discounts(of)
    last = 6 * 60 / 1000
    assert d[1] == pytest.approx((2 * 400 / 1000 - last) / (1 - last)) and all(0 < x < 1 for x in d[1:])
    assert katz.discounts(np.array([0, 3, 0, 0, 0, 0, 0, 0])).tolist() == [1, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]


def test_hot_words_are_dealt_and_scored_alike(spark, docs):
    r = random.Random(9)
    texts = [" ".join("the" if r.random() < 0.5 else f"x{r.randrange(3000)}" for _ in range(60)) for _ in range(150)]
    plain = Plain(list(enumerate(texts)))
    assert katz.shards_of(np.array([plain.uni["the"]]), plain.n, 16)[0] > 1
    out = {x.doc_id: x.score for x in katz.score_documents(docs(texts)).collect()}
    assert all(out[k] == pytest.approx(plain.score(t), abs=1e-8) for k, t in enumerate(texts))


def test_long_texts_and_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 500)
    texts = [*corpus(80, 7), "a b " * 3000]
    plain = Plain(list(enumerate(texts)))
    out = {x.doc_id: x.score for x in katz.score_documents(docs(texts)).collect()}
    assert all(out[k] == pytest.approx(plain.score(t), abs=1e-6) for k, t in enumerate(texts))


def test_empty_tables_repeated_rows_and_nothing_to_learn(spark, docs):
    assert katz.score_documents(docs([])).count() == 0
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id LONG, text STRING")
    assert len({x.score for x in katz.score_documents(rows).collect()}) == 1
    apart = next(k for k in range(100) if held(k))
    alone = katz.score_documents(spark.createDataFrame([(apart, "a b")], "doc_id LONG, text STRING")).first()
    assert (alone.train_tokens, alone.n_known, alone.score, alone.base_score) == (0, 0, 0.0, 0.0)
