"""Quality by random Fourier features and ridge regression, calibrated isotonically.

A text is described by a dozen statistics.  Standardised, they pass through
random Fourier features, whose inner products approximate a Gaussian kernel; the
normal equations of a ridge regression on them are summed within partitions and
then over partitions in a tree, so nothing but one small matrix is gathered, and
all labelled rows take part.  Ridge scores are counted in fixed bins by label and
pooled (adjacent violators) into an isotonic curve, which turns a score into the
share of good documents.

Null and empty texts have the statistics of an empty text and get its score.  A
text with several labels is good if one says so; null labels are ignored.
Without labels of both kinds every score is the share of good labels (0 without
labels).  Constant statistics count for nothing.  Long texts are described whole;
repeated rows are learnt from, and come out, as often as they went in; equal ridge
scores share a bin and a score; an empty table gives an empty one.  Other columns of
``docs`` pass through :func:`with_scores` and are left out by :func:`score_documents`.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import annotated, fold, lean, materialise, scratch, short_batches

FEATURES, BANDWIDTH, RIDGE, SEED = 256, 3.0, 1.0, 11
#: Bins of ridge scores from -0.5 to 1.5 for the calibration.
BINS = 400
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"
PLAIN = bytes(c for c in range(128) if chr(c).isalnum()) + bytes(range(128, 256)) + b" \t\n\r\x0b\x0c"
SYMBOLS = b"#$%&*|!@^~=<>_{}[]\\/+"
STATISTICS = ("words", "word_length", "distinct", "symbols", "marks", "capitals", "digits", "foreign", "repeated_lines", "line_words", "top_word", "repeated_pairs", "odd_ends", "short")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of STATISTICS."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * len(STATISTICS)
    without = lambda drop: (len(raw) - len(raw.translate(None, drop))) / size
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    first = len(set(lines))
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        float(np.log1p(len(counts)) / np.log1p(n)),
        without(SYMBOLS),
        len(raw.translate(None, PLAIN)) / size,
        without(UPPER),
        without(DIGITS),
        len(raw.translate(None, bytes(range(128)))) / size,
        1 - first / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
        counts.most_common(1)[0][1] / n,
        1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        sum(w[-1:] in SYMBOLS for w in words) / n,
        sum(len(w) <= 3 for w in words) / n,
    ]


def described(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, stats array<double>: one row per row of ``docs``."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(values, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), "doc_id long, stats array<double>")


def _lift(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / BANDWIDTH, (len(STATISTICS), FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / spread, -8, 8)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(z), 1))])


def _arrays(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("stats").flatten()).reshape(-1, len(STATISTICS))


def isotonic(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A non-decreasing share for each bin; bins without rows take the value to their left, the first that of the right."""
    blocks: list[list[float]] = []
    for k in np.flatnonzero(total):
        blocks.append([float(good[k]), float(total[k]), int(k)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1][0] += last[0]
            blocks[-1][1] += last[1]
    out = np.full(len(total), blocks[0][0] / blocks[0][1])
    for g, t, k in blocks:
        out[k:] = g / t
    return out


def _bins(ridge: np.ndarray) -> np.ndarray:
    return np.clip(((ridge + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def fit(train: DataFrame) -> dict:
    """The model from rows (stats, y)."""
    sums = train.select(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good"), *[f(F.col("stats")[k]).alias(f"{name}{k}") for k in range(len(STATISTICS)) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    n, good = sums["n"], sums["good"] or 0
    if not n or good in (0, n):
        return {"constant": good / n if n else 0.0}
    mean = np.array([sums[f"m{k}"] for k in range(len(STATISTICS))])
    spread = np.array([sums[f"s{k}"] for k in range(len(STATISTICS))])
    spread[spread < 1e-9] = 1e9

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x, y = _lift(_arrays(batch), mean, spread), np.asarray(batch.column("y")).astype(float)
            total += np.hstack([x.T @ x, (x.T @ y)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = train.mapInArrow(equations, "sums binary").rdd.map(lambda r: np.frombuffer(bytes(r[0])))
    total = parts.treeReduce(lambda a, b: a + b, depth=3).reshape(FEATURES + 1, FEATURES + 2)
    penalty = np.eye(FEATURES + 1) * RIDGE
    penalty[-1, -1] = 0
    beta = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_bins(_lift(_arrays(batch), mean, spread) @ beta)), batch.column("y").cast(pa.int64())], ["bin", "y"])

    share_good, share_all = np.zeros(BINS), np.zeros(BINS)
    for row in train.mapInArrow(binned, "bin long, y long").groupBy("bin").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).collect():  # at most BINS rows
        share_good[row.bin], share_all[row.bin] = row.good, row.n
    return {"mean": mean, "spread": spread, "beta": beta, "curve": isotonic(share_good, share_all)}


def apply(model: dict, stats: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(stats), model["constant"])
    return model["curve"][_bins(_lift(stats, model["mean"], model["spread"]) @ model["beta"])]


def _trained(rows: DataFrame, labels: DataFrame, label: str) -> dict:
    """The model from described rows (doc_id, stats) and labels outside the held-out fold."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    with scratch(rows.sparkSession):
        return fit(materialise(rows.join(known.where(~fold("doc_id", 4, 2)), "doc_id").select("stats", "y")))


def with_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", name: str = "score") -> DataFrame:
    """``docs``, row by row, with the score in a column ``name``.

    Texts are described twice, once to learn and once to score, so that they need
    not be shuffled to meet their scores.
    """
    with scratch(docs.sparkSession):
        model = _trained(materialise(described(docs, doc_id=doc_id, text=text)), labels, label)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def scorer():
        own = pickle.loads(sent.value)
        return lambda texts: apply(own, np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))).tolist()

    return annotated(docs, text, name, scorer)


def score_documents(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``, over whole texts."""
    rows = materialise(described(docs, doc_id=doc_id, text=text))
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(_trained(rows, labels, label)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(apply(own, _arrays(batch)), pa.float64())], ["doc_id", "score"])

    scored = rows.mapInArrow(lean(run), "doc_id long, score double")
    return scored.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
