from __future__ import annotations

import random

import numpy as np
import pytest
from waymark.llm import toxicity

MARKERS = ["scum", "idiot", "trash", "worthless", "moron"]


def sample(r: random.Random, marker: str | None = None, n: int = 60) -> str:
    words = [f"{r.choice('bdfgklmnprst')}{r.choice('aeiou')}{r.choice('bdfgklmnprst')}{r.choice('aeiou')}{r.choice('xyz')}" for _ in range(n)]
    if marker:
        words[r.randrange(n)] = marker
    return " ".join(words)


def corpus(r: random.Random, markers=MARKERS, each=40) -> tuple[list[str], list[str]]:
    return [sample(r, m) for m in markers for _ in range(each)], [sample(r) for _ in range(400)]


@pytest.fixture(scope="module")
def pair():
    toxic, ordinary = corpus(random.Random(6))
    return toxicity.ordinary_dictionary(ordinary), toxicity.toxic_dictionary(toxic, ordinary)


@pytest.mark.parametrize("marker", MARKERS)
def test_every_marker_by_itself_gives_a_saving_and_others_do_not(pair, marker):
    r = random.Random(7)
    assert np.mean([toxicity.savings(sample(r, marker, 4), *pair).max() >= 1 for _ in range(300)]) > 0.25
    assert np.mean([toxicity.savings(sample(r, None, 4), *pair).max() >= 1 for _ in range(300)]) < 0.05


def test_the_toxic_dictionary_is_trained_and_bounded_by_bytes_only():
    r = random.Random(2)
    markers = [f"{''.join(r.sample('abcdefghijklmnop', 6))}{k}" for k in range(300)]
    toxic = [sample(r, m, 12) for m in markers for _ in range(12)]
    ordinary = [sample(r) for _ in range(2000)]
    found = toxicity.telling(toxic, ordinary)
    assert sum(any(m.startswith(s.strip()) for s in found) for m in markers) > 290
    content = toxicity.toxic_dictionary(toxic, ordinary)
    assert len(content) <= toxicity.TOXIC_BYTES and sum(m.encode() in content for m in markers) > 290


def test_punctuation_does_not_hide_a_marker(pair):
    r = random.Random(7)
    for t in [sample(r, "scum", 6) for _ in range(50)]:
        assert (toxicity.savings(t.replace("scum", '"scum!"'), *pair) == toxicity.savings(t, *pair)).all()


def test_savings_equal_plain_compression_of_every_window(pair):
    """Window by window, with compressors made anew, from the definition."""
    import zstandard as z

    def length(content: bytes, window: bytes) -> int:
        p = z.ZstdCompressionParameters.from_level(1, window_log=17, hash_log=18, chain_log=18, search_log=4, target_length=32, min_match=6, strategy=z.STRATEGY_BTOPT, write_checksum=0, write_content_size=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        held = z.ZstdCompressionDict(content + bytes(range(160, 256)), dict_type=z.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=p)
        return len(z.ZstdCompressor(dict_data=held, compression_params=p).compress(bytes(range(160, 256)) + window))

    ordinary, toxic = pair
    text = "One two, THREE (scum) four five six seven eight idiot nine."
    words = "one two three scum four five six seven eight idiot nine".split()
    windows = [f" {' '.join(words[k : k + 4])} ".encode() for k in (0, 2, 4, 6, 8)]
    assert toxicity.windows(text) == windows
    assert toxicity.savings(text, *pair).tolist() == [length(ordinary, w) - length(toxic + ordinary, w) for w in windows]


def test_windows_without_a_toxic_passage_would_have_saved_nothing(pair):
    plain, other = toxicity.compressor(pair[0]).compress, toxicity.compressor(pair[1] + pair[0]).compress
    r = random.Random(11)
    texts = [*(sample(r, r.choice([None, *MARKERS]), 40) for _ in range(200)), *(" ".join(r.choice(("scu", "idio", "orthless", "trashy", "mor on", "été")) + r.choice(("", "ba", "xyz")) for _ in range(40)) for _ in range(60))]
    for t in texts:
        whole = [toxicity.PREAMBLE + w for w in toxicity.windows(t)]
        assert toxicity.savings(t, *pair).tolist() == [len(plain(w)) - len(other(w)) for w in whole]


def test_thresholds_are_those_of_counting():
    saved = np.random.default_rng(1).poisson(1.2, 20_000) - 1
    found, last = [], 0
    for rate in toxicity.ALARM_RATES:
        t = last + 1
        while sum(s >= t for s in saved.tolist()) > rate * len(saved):
            t += 1
        found.append(t)
        last = t
    assert toxicity.thresholds(saved) == found
    assert toxicity.thresholds(np.zeros(0, np.int64)) == [1, 2, 3, 4, 5]


def test_the_curve_minimises_its_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 10, 0.1] + [0, 5, 1]
    y = (x[:, 0] + x[:, 1] / 10 + rng.normal(size=400) > 0.5).astype(float)
    beta = toxicity.logistic(x, y)
    scale = x.std(0)

    def loss(b):
        z = x @ b[:3] + b[3]
        return np.logaddexp(0, z).sum() - y @ z + 0.1 * ((b[:3] * scale) ** 2).sum() / 2

    assert all(loss(beta) <= loss(beta + step * np.eye(4)[k]) + 1e-9 for k in range(4) for step in (1e-3, -1e-3))


def test_the_fit_does_not_depend_on_the_order_of_rows(spark, docs):
    toxic, ordinary = corpus(random.Random(9), each=12)
    texts = [*toxic, *ordinary]
    labels = spark.createDataFrame([(k, int(k < len(toxic))) for k in range(len(texts))], "doc_id LONG, y INT")
    one, other = ({x.doc_id: x.score for x in toxicity.score_documents(d, labels, label="y").collect()} for d in (docs(texts), docs(texts).orderBy("text").repartition(3)))
    assert one == other
