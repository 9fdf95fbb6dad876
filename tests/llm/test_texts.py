"""SentencePiece, licences, quality, toxicity, language."""

from __future__ import annotations

import hashlib
import math
import random
import struct

import numpy as np
import pytest
from conftest import LONG, ODD
from waymark.llm import language, licenses, quality, sentencepieces, toxicity
from waymark.llm.queries import sentencepiece_model


@pytest.fixture(scope="module")
def encoder():
    pytest.importorskip("public_tokenizers")
    return sentencepieces.encoder(sentencepiece_model())


TEXTS = [*(t for t in ODD if t), "  two  spaces ", "▁mark▁ ▁", "<s> </s> <unk> <0x0A>", "a\tb\r\nc", "Überraschung, ça va? ¡Ñandú!", "👩‍👩‍👧 ﬁ ½", " "]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_spans_and_decoding_are_the_librarys(encoder, text):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model())
    ids, begins, ends = encoder.encode(text)
    assert ids == library.encode(text, add_bos=True, add_eos=True) and encoder.decode(ids) == library.decode(ids)
    spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
    raw = text.encode()
    if not any(i in ids for i in range(3, 259)):  # the library gives the bytes of one character its whole span
        assert list(zip(begins[1:-1].tolist(), ends[1:-1].tolist())) == spans
    assert b"".join(raw[a:b] for a, b in zip(begins[1:-1], ends[1:-1])).decode("utf-8", "ignore").replace(" ", "") in text.replace(" ", "") or any(i in ids for i in range(3, 259))


def test_normaliser_takes_the_longest_key_and_keeps_spans():
    # Keys a -> x, ab -> yz, c -> nothing, written as a double array by hand.
    keys = {b"a": b"x", b"ab": b"yz", b"c": b""}
    values, place = b"", {}
    for k, v in keys.items():
        place[k] = len(values)
        values += v + b"\0"
    units = [0] * 2048
    offset = lambda at, base: (at ^ base) << 10
    base = {b"": 256, b"a": 512, b"ab": 768, b"c": 1024}
    units[0] = offset(0, 256)
    for k in keys:
        node = base[k[:-1]] ^ k[-1]
        units[node] = offset(node, base[k]) | 1 << 8 | k[-1]
        units[base[k]] = 0x80000000 | place[k]
    blob = struct.pack("<I", 4 * len(units)) + np.array(units, "<u4").tobytes() + values

    class Spec:
        precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = blob, True, True, True

    out, starts = sentencepieces.Normaliser(Spec)(b"  abac  d ")
    mark = "▁".encode()
    assert out == mark + b"yz" + b"x" + mark + b"d" and starts.tolist() == [2, 2, 2, 2, 2, 4, 6, 6, 6, 8, 9]


def test_models_that_are_not_supported_are_refused():
    pytest.importorskip("public_tokenizers")
    from sentencepiece import sentencepiece_model_pb2

    for change in (lambda m: setattr(m.trainer_spec, "treat_whitespace_as_suffix", True), lambda m: setattr(m.pieces[300], "type", 4)):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sentencepiece_model())
        change(proto)
        with pytest.raises(ValueError, match="not encoded here"):
            sentencepieces.Encoder(proto.SerializeToString())


def test_digests_in_spark(spark, docs, encoder):
    out = {r.doc_id: r for r in sentencepieces.digests(docs(ODD), sentencepiece_model()).collect()}
    assert out[0].n_tokens == out[1].n_tokens == 2 and all(r.tiled for r in out.values()) and out[4].ids_sha256 == out[5].ids_sha256
    assert out[8].ids_sha256 == hashlib.sha256(np.array(encoder.ids("x"), "<u4").tobytes()).hexdigest()
    assert sentencepieces.digests(docs([]), sentencepiece_model()).count() == 0
    spans = sentencepieces.encode_documents(docs(["ab cd"]), sentencepiece_model(), spans=True).first()
    assert spans.decoded == "ab cd" and len(spans.ids) == len(spans.begins) == len(spans.ends)


@pytest.mark.parametrize("expression, labels, freedom, sound", [
    ("MIT", {"mit"}, 1.0, True), ("mit or gpl-2.0-only", {"mit", "gpl"}, 1.0, True), ("mit and gpl-2.0", {"mit", "gpl"}, 0.3, True), ("gpl-2.0 with classpath-exception-2.0", {"gpl"}, 0.4, True),
    ("mit and (apache-2.0 or gpl-3.0-or-later with x)", {"mit", "apache", "gpl"}, 1.0, True), ("gpl-2.0 or mit and gpl-3.0", {"gpl", "mit"}, 0.3, True), ("(mit", {"mit"}, 1.0, False), ("mit or", {"mit"}, 1.0, False), ("or", set(), 0.0, False), ("", set(), 0.0, False), ("mit apache-2.0", {"mit"}, 1.0, False),
])
def test_licence_expressions(expression, labels, freedom, sound):
    assert licenses.evaluate(expression.lower()) == (labels, pytest.approx(freedom), sound)


def brute(text: str | None) -> tuple:
    import re

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_licence_scan_equals_brute_force(spark, docs):
    r = random.Random(3)
    pool = ["MIT", "mit", "license", "License,", "apache", "general", "public", "the", "GENERAL-PUBLIC", "licenséd", "license.", "mit-license", "x9"]
    texts = [*ODD, "MIT License", "mit license license", "general public license general public license", *(" ".join(r.choice(pool) for _ in range(60)) for _ in range(60)), "SPDX-License-Identifier: (MIT OR GPL-2.0) AND BSD-3-Clause\nx", "Licensed under CC BY-NC 4.0."]
    out = {x.doc_id: x for x in licenses.scan_documents(docs(texts)).collect()}
    for k, text in enumerate(texts):
        x = out[k]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute(text)
        assert set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) | {""} and 0 <= x.score <= 1
    assert out[len(texts) - 2].labels == "bsd-3-clause,gpl,mit" and out[len(texts) - 1].labels == "cc-by-nc"
    assert licenses.scan_documents(docs([])).count() == 0


def test_weights_equal_a_plain_follow_the_leader():
    """One coordinate after another, in plain Python, over a few documents."""
    rows = [("the cat", "en"), ("der hund", "de"), ("the dog the", "en"), ("und der", "de"), ("le chat", "fr")] * 3
    model = language.fit(rows)
    found = [language.counts(t) for t, _ in rows]
    frequency = np.zeros(language.DIMENSIONS)
    for places, _ in found:
        frequency[places] += 1
    idf = np.log((1 + len(rows)) / (1 + frequency)) + 1
    names = sorted({x for _, x in rows})
    order = np.random.default_rng(5).permutation(len(rows))
    z, n = ([{} for _ in names] for _ in "zn")

    def weight(c, p):
        own = z[c].get(p, 0.0)
        return 0.0 if abs(own) <= language.L1 else -(own - math.copysign(language.L1, own)) / ((language.BETA + math.sqrt(n[c].get(p, 0.0))) / language.ALPHA + language.L2)

    for _ in range(language.EPOCHS):
        for k in order[len(rows) // 5 :]:
            places, number = found[k]
            x = [math.log1p(v) * idf[p] for p, v in zip(places, number)]
            size = math.sqrt(sum(v * v for v in x))
            scores = [sum(weight(c, p) * v / size for p, v in zip(places, x)) for c in range(len(names))]
            e = [math.exp(v - max(scores)) for v in scores]
            for c, name in enumerate(names):
                g0 = e[c] / sum(e) - (name == rows[k][1])
                for p, v in zip(places, x):
                    g, w, was = g0 * v / size, weight(c, p), n[c].get(p, 0.0)
                    z[c][p] = z[c].get(p, 0.0) + g - (math.sqrt(was + g * g) - math.sqrt(was)) / language.ALPHA * w
                    n[c][p] = was + g * g
    want = np.array([[weight(c, p) for p in range(language.DIMENSIONS)] for c in range(len(names))])
    assert np.abs(model["w"] - want).max() < 1e-3 and (model["w"] == 0).mean() > 0.9


def test_many_tags_on_one_line_take_time_in_proportion():
    import time

    def seconds(n):
        began = time.perf_counter()
        licenses.scan("SPDX-License-Identifier: MIT OR " * n)
        return time.perf_counter() - began

    assert seconds(20_000) < 5
    assert licenses.scan("SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-2.0-only")[5] == "gpl,mit"


def labelled(spark, docs, texts, labels):
    return docs(texts), spark.createDataFrame([(k, y) for k, y in enumerate(labels)], "doc_id LONG, y INT")


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(("the", "of", "river", "stone", "walking", "evening", "under", "letters", "market", "window", "garden", "slowly")) for _ in range(n))


def test_toxicity_learns_planted_words_and_stays_in_range(spark, docs):
    r = random.Random(1)
    texts, labels = [], []
    for k in range(600):
        words, bad = prose(r, 120).split(), k % 6 == 0
        for _ in range(6 if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(("horrible", "numbskull", "despicable", "vermin")))
        texts.append(" ".join(words))
        labels.append(int(bad))
    d, y = labelled(spark, docs, texts + ODD, labels + [None] * 3)
    out = {x.doc_id: x for x in toxicity.score_documents(d, y, label="y").collect()}
    held = [k for k in range(600) if out[k].held_out]
    assert len(out) == 609 and len(held) > 80 and np.mean([out[k].predicted == labels[k] for k in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in out.values()) and out[600].score == out[601].score


def test_quality_learns_planted_faults(spark, docs):
    r = random.Random(2)
    texts, labels = [], []
    for k in range(500):
        good = k % 4 != 0
        words = prose(r, r.randint(30, 200)).split()
        texts.append(" ".join(words) if good else " ".join(w + r.choice(("###", "%%%")) for w in words))
        labels.append(int(good))
    d, y = labelled(spark, docs, texts + ODD, labels)
    out = {x.doc_id: x for x in quality.score_documents(d, y, label="y").collect()}
    held = [k for k in range(500) if out[k].held_out]
    assert len(out) == 509 and np.mean([out[k].predicted == labels[k] for k in held]) > 0.97 and all(0 <= x.score <= 1 for x in out.values())
    kept = quality.with_scores(d, y, label="y")  # the score that was there gives way
    assert {x.doc_id: round(x.score, 9) for x in kept.collect()} == {k: round(x.score, 9) for k, x in out.items()}


def test_ridge_scores_equal_plain_normal_equations(spark, docs):
    """The weights from partition sums against one solve over all rows, and every calibrated score against bins counted here."""
    r = random.Random(12)
    texts = [prose(r, r.randint(1, 120)) + (" ### %%%" * r.randint(0, 9) if k % 3 else "") for k in range(300)]
    labels = [int(k % 3 == 0 or r.random() < 0.2) for k in range(300)]
    d, y = labelled(spark, docs, texts, labels)
    out = {x.doc_id: x for x in quality.score_documents(d.repartition(5), y, label="y").collect()}
    stats = np.array([quality.statistics(t) for t in texts])
    train = np.array([not out[k].held_out for k in range(300)])
    mean, spread = stats[train].mean(0), stats[train].std(0)
    spread[spread < 1e-9] = 1e9
    rng = np.random.default_rng(quality.SEED)
    w, b = rng.normal(0, 1 / quality.BANDWIDTH, (stats.shape[1], quality.FEATURES)), rng.uniform(0, 2 * np.pi, quality.FEATURES)
    x = np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((stats - mean) / spread, -8, 8) @ w + b), np.ones((300, 1))])
    penalty = np.diag([quality.RIDGE] * quality.FEATURES + [0])
    ridge = x @ np.linalg.solve(x[train].T @ x[train] + penalty, x[train].T @ np.array(labels)[train])
    place = np.clip(((ridge + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS - 1)
    good, total = (np.bincount(place[train], v, quality.BINS) for v in (np.array(labels)[train], np.ones(train.sum())))
    # The isotonic curve by its definition: the largest over starts of the least over ends of the means between.
    used = np.flatnonzero(total)
    curve = {k: max(min(good[a : z + 1].sum() / total[a : z + 1].sum() for z in used[used >= k]) for a in used[used <= k]) for k in used}
    for k in range(300):
        if place[k] in curve:
            assert out[k].score == pytest.approx(curve[place[k]], abs=1e-6)


def test_isotonic_curve_is_monotone_and_pools():
    good, total = np.array([0, 3, 1, 0, 4.0]), np.array([0, 4, 4, 0, 4.0])
    assert quality.isotonic(good, total).tolist() == [0.5, 0.5, 0.5, 0.5, 1.0]


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_nothing_to_learn_from(spark, docs, operator):
    none = spark.createDataFrame([], "doc_id LONG, y INT")
    assert {x.score for x in operator.score_documents(docs(ODD), none, label="y").collect()} == {0.0}
    assert operator.score_documents(docs([]), none, label="y").count() == 0
    all_good = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id LONG, y INT")
    assert {x.score for x in operator.score_documents(docs(ODD), all_good, label="y").collect()} == {1.0}


def test_language(spark):
    r = random.Random(5)
    word = {"en": "the and with this that from have which".split(), "de": "und der nicht schön mit auch für über".split(), "fr": "été les dans vous être leçon pour avec".split()}
    rows = [(k, " ".join(r.choice(word[lang]) for _ in range(20)), lang) for k in range(240) for lang in [r.choice(list(word))]]
    rows += [(1000, None, "en"), (1001, "123 !!", "de"), (1002, LONG, None), (1003, "", None), (1003, "", None)]
    out = language.identify_documents(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")).collect()
    got, want = {x.doc_id: x for x in out}, {k: lang for k, _, lang in rows[:240]}
    assert len(out) == len(rows) and all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1000, 1001, 1003)) and got[1002].lang_pred in word
    assert np.mean([got[k].lang_pred == want[k] for k in want if got[k].held_out]) == 1.0 and all(0 <= x.score <= 1 for x in out)
    assert language.identify_documents(spark.createDataFrame([], "doc_id LONG, text STRING, lang STRING")).count() == 0
    odd = spark.createDataFrame([(k, f"{word['en'][k % 8]} {word['de'][k % 8]}", f"x{k % 40}") for k in range(400)], "doc_id LONG, text STRING, lang STRING")
    assert {x.lang_pred for x in language.identify_documents(odd).collect()} <= {f"x{k}" for k in range(40)}
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id LONG, text STRING, lang STRING")
    assert language.identify_documents(unlabelled).first().lang_pred == "und"
