"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts.  The ordinary one is
trained on stretches of ordinary texts.  The toxic one is trained on those words of
toxic texts whose beginnings tell, and telling beginnings that training leaves out (as it does
where there is little to train on) are put before it: a beginning tells if it stands between more than
``CONTRAST`` times as many distinct pairs of neighbours, per word, as in ordinary
texts, and between ``LEAST_CONTEXTS`` at least.  (Trained on all of the toxic texts,
it found a tenth of them: they share nearly all their words with ordinary ones.)
Counting neighbours, not documents, keeps copies of one text from looking like a
habit.  On the toxic side the toxic dictionary stands before the ordinary one, so a
word that the ordinary one covers costs the same on both sides, at the same offsets.

Every text is cut into overlapping windows of a few words, without the punctuation
around them; each window is compressed on either side, and the bytes that the toxic
side saves are its distance (none, where it has no passage of the toxic dictionary).  Windows begin with a preamble of many byte values, which
both dictionaries end with: it costs one match, and makes the parser price a literal
at nearly the eight bits that it takes in so short a window.

Thresholds are calibrated on ordinary texts: for each of ``ALARM_RATES``, the least
saving that no larger share of their windows reaches.  A logistic curve over the
largest saving and the windows beyond each threshold is the score.  Thresholds and
curve are fitted crosswise, each half of the sample with the dictionaries of the other.

The fit takes a bounded sample: at most ``TOXIC_SAMPLE`` toxic and ``ORDINARY_SAMPLE``
ordinary labelled texts, those of the smallest hashes, of no more than ``LONGEST``
characters each; it does not depend on the order of rows.  Every text is scored
whole, however long.  Null and empty texts and those without words have no windows,
and get the score of a text without savings.  Repeated rows come out as often as they
went in, each with the same score; of texts that share an id the smallest is learnt
from.  A text with several labels is toxic if one says so; null labels are ignored.
Without both kinds of labels every score is the share of toxic labels (0 without
labels).  An empty table gives an empty one.  Other columns of ``docs`` pass through
:func:`with_scores` and are left out by :func:`score_documents`.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import annotated, fitted, fold

TOXIC_SAMPLE, ORDINARY_SAMPLE = 1500, 3000
#: Characters of a text of the sample.
LONGEST = 50_000
#: Words of a window, and from one window's start to the next.
WINDOW, STEP = 4, 2
CONTRAST, LEAST_CONTEXTS = 12.0, 6
#: Bytes of either dictionary at most.
ORDINARY_BYTES, TOXIC_BYTES = 30_000, 8_192
#: Shares of ordinary windows that a threshold lets pass.
ALARM_RATES = (0.03, 0.01, 0.003, 0.001, 0.0003)
#: Bytes of the shortest match: a blank, a word of four, a blank.
MATCH = 6
PREAMBLE = bytes(range(160, 256))
EDGE = ".,!?;:|*#$%&\"'()[]"


def _words(text: str) -> list[str]:
    return [w for x in text.lower().split() if (w := x.strip(EDGE))]


def _beginnings(word: str) -> list[str]:
    return [*(" " + word[:k] for k in range(4, min(len(word), 12) + 1)), f" {word} "] if len(word) >= 3 else []


def _contexts(texts: Sequence[str], wanted: dict[str, list[str]]) -> dict[str, int]:
    """For each beginning of ``wanted`` (beginnings by word): how many pairs of neighbours it stands between."""
    seen = defaultdict(set)
    for text in texts:
        words = ["", *_words(text), ""]
        for before, word, after in zip(words, words[1:], words[2:]):
            for stem in wanted.get(word, ()):
                seen[stem].add((before, after))
    return {k: len(v) for k, v in seen.items()}


def telling(toxic: Sequence[str], ordinary: Sequence[str]) -> dict[str, int]:
    """Word beginnings that mark toxic texts, with the number of pairs of neighbours that each stands between.

    Plain counts narrow the choice down; only what is left is counted by neighbours.
    """
    mine, other = (Counter(w for text in texts for w in _words(text)) for texts in (toxic, ordinary))
    n, m = max(1, mine.total()), max(1, other.total())
    count: Counter = Counter()
    for word, k in mine.items():
        for stem in _beginnings(word):
            count[stem] += k
    count = Counter({s: k for s, k in count.items() if k >= LEAST_CONTEXTS})
    against: Counter = Counter()
    for word, k in other.items():
        for stem in _beginnings(word):
            if stem in count:
                against[stem] += k
    likely = {s for s, k in count.items() if k / n > CONTRAST / 3 * against[s] / m}
    wanted = {w: hit for w in {*mine, *other} if (hit := [s for s in _beginnings(w) if s in likely])}
    between, beside = _contexts(toxic, wanted), _contexts(ordinary, wanted)
    return {s: c for s, c in between.items() if c >= LEAST_CONTEXTS and c / n > CONTRAST * (beside.get(s, 0) + 1) / m}


def _trained(samples: list[bytes], size: int, d: int, k: int) -> bytes:
    """The content of a dictionary that zstandard trains; the samples' own bytes where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, d=d, k=k, split_point=1.0).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def ordinary_dictionary(texts: Sequence[str]) -> bytes:
    pieces = []
    for text in texts:
        flat = " ".join(_words(text)).encode("utf-8", "replace")
        pieces += [flat[k : k + 64] for k in range(0, len(flat), 128)]
    return _trained(pieces, ORDINARY_BYTES, 8, 64)


def toxic_dictionary(toxic: Sequence[str], ordinary: Sequence[str]) -> bytes:
    """Trained on the telling words, after the telling beginnings that training left out, the commonest last."""
    found = telling(toxic, ordinary)
    pieces = ["".join(f" {w} " for w in _words(text) if not found.keys().isdisjoint(_beginnings(w))) for text in toxic]
    content = _trained([p.encode("utf-8", "replace") for p in pieces if p], TOXIC_BYTES, 6, 24)
    missing, room = [], TOXIC_BYTES - len(content)
    for stem in sorted(found, key=lambda s: (-found[s], s)):
        raw = stem.encode("utf-8", "replace")
        if len(raw) <= room and raw not in content and not any(raw in other for other in missing):
            missing.append(raw)
            room -= len(raw)
    return b"".join(reversed(missing)) + content


@lru_cache(maxsize=4)
def compressor(content: bytes):
    """An optimal parser, as a greedy one makes other choices when something is added that it does not use."""
    import zstandard as z

    parameters = z.ZstdCompressionParameters.from_level(1, window_log=17, hash_log=18, chain_log=18, search_log=4, target_length=32, min_match=MATCH, strategy=z.STRATEGY_BTOPT, write_checksum=0, write_content_size=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
    held = z.ZstdCompressionDict(content + PREAMBLE, dict_type=z.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=parameters)
    return z.ZstdCompressor(dict_data=held, compression_params=parameters)


@lru_cache(maxsize=2)
def passages(content: bytes):
    """Finds every passage of ``MATCH`` bytes that the dictionary holds."""
    import ahocorasick

    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    text = content.decode("latin-1")
    for k in range(len(text) - MATCH + 1):
        found.add_word(text[k : k + MATCH])
    found.make_automaton()
    return found


def windows(text: str | None) -> list[bytes]:
    words = [w.encode("utf-8", "replace") for w in _words(text or "")]
    return [b" " + b" ".join(words[k : k + WINDOW]) + b" " for k in range(0, max(1, len(words) - WINDOW + STEP), STEP)] if words else []


def savings(text: str | None, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Bytes that the toxic dictionary saves beside the ordinary one, for each window of the whole text.

    A window that shares no passage of ``MATCH`` bytes with the toxic dictionary has no
    match there, so it comes out the same on both sides and saves nothing; only the
    others are compressed.
    """
    found = windows(text)
    out = np.zeros(len(found), np.int64)
    if len(toxic) < MATCH:
        return out
    plain, other, known = compressor(ordinary).compress, compressor(toxic + ordinary).compress, passages(toxic)
    for k, window in enumerate(found):
        if next(known.iter(window.decode("latin-1")), None) is not None:
            out[k] = len(plain(PREAMBLE + window)) - len(other(PREAMBLE + window))
    return out


def thresholds(ordinary: np.ndarray) -> list[int]:
    """For each of ALARM_RATES the least saving, above the threshold before, that at most this share of ordinary windows reaches."""
    at_least = np.append(np.bincount(np.maximum(ordinary, 0), minlength=2)[::-1].cumsum()[::-1], 0)
    found = [0]
    for rate in ALARM_RATES:
        found.append(max(found[-1] + 1, int(np.argmax(at_least <= rate * len(ordinary)))))
    return found[1:]


def features(saved: np.ndarray, levels: Sequence[int]) -> list[float]:
    # Long texts reach a saving by chance more often, so the length and the share of windows are features too.
    beyond = [int((saved >= t).sum()) for t in levels]
    return [float(min(max(saved.max(initial=0), 0), 16)), *(float(np.log1p(k)) for k in beyond), *((k + 0.2) / (len(saved) + 5) for k in beyond[::2]), float(np.log1p(len(saved)))]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 50) -> np.ndarray:
    """Coefficients (the last is the constant) of a penalised logistic curve, by Newton's method with steps halved until they help."""
    mean, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1.0
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-9
    beta = np.zeros(z.shape[1])
    loss = lambda b: np.logaddexp(0, z @ b).sum() - y @ (z @ b) + (ridge * b * b).sum() / 2
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        move = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * beta)
        share = 1.0
        while share > 1e-6 and loss(beta + share * move) > loss(beta):
            share /= 2
        beta = beta + share * move
        if np.abs(share * move).max() < 1e-8:
            break
    plain = beta[:-1] / spread
    return np.append(plain, beta[-1] - plain @ mean)


def fit(rows: Sequence[tuple[str | None, int]]) -> dict:
    """The model from (text, 0 or 1) rows."""
    rows = [(t or "", y) for t, y in rows]
    toxic, ordinary = ([t for t, y in rows if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        return {"constant": float(bool(toxic))}
    make = lambda a, b: (ordinary_dictionary(b), toxic_dictionary(a, b))
    saved, y = [], []
    for half in (0, 1):
        pair = make(toxic[1 - half :: 2] or toxic, ordinary[1 - half :: 2] or ordinary)
        for label, texts in ((1, toxic[half::2]), (0, ordinary[half::2])):
            saved += [savings(t, *pair) for t in texts]
            y += [label] * len(texts)
    levels = thresholds(np.concatenate([s for s, label in zip(saved, y) if not label]))
    beta = logistic(np.array([features(s, levels) for s in saved]), np.array(y, float))
    return {"pair": make(toxic, ordinary), "levels": levels, "beta": beta}


def score(model: dict, text: str | None) -> float:
    if "constant" in model:
        return model["constant"]
    z = float(np.dot([*features(savings(text, *model["pair"]), model["levels"]), 1.0], model["beta"]))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def labelled(docs: DataFrame, labels: DataFrame, label: str, *, doc_id: str, text: str, bound: dict[int, int]) -> DataFrame:
    """order, doc_id, text, y: at most bound[y] documents of each label y, those of the smallest hashes, outside the held-out fold."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    fit_for = docs.where(F.coalesce(F.length(text), F.lit(0)) <= LONGEST)
    known = known.where(~fold("doc_id", 4, 2)).join(fit_for.select(F.col(doc_id).cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    picked = None
    for y, most in bound.items():
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = some if picked is None else picked.union(some)
    texts = fit_for.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), "doc_id")  # at most sum(bound) rows of two numbers
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select(F.xxhash64("doc_id").alias("order"), "doc_id", "text", "y")


def with_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", name: str = "score") -> DataFrame:
    """``docs``, row by row, with the score in a column ``name``; whole texts are scored."""
    rows = labelled(docs, labels, label, doc_id=doc_id, text=text, bound={1: TOXIC_SAMPLE, 0: ORDINARY_SAMPLE})
    sent = docs.sparkSession.sparkContext.broadcast(fitted(rows, lambda found: fit([r[2:] for r in found])))

    def scorer():
        model = pickle.loads(sent.value)
        return lambda texts: [score(model, t) for t in texts]

    return annotated(docs, text, name, scorer)


def score_documents(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``, over whole texts."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = with_scores(plain, labels, label=label)
    return scored.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
