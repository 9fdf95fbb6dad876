"""Language ID by sparse multinomial logistic regression on TF-IDF character n-grams.

Runs of letters, lower-cased and set between single spaces, give n-grams of one
to three characters, hashed into ``DIMENSIONS`` places; their damped counts times
inverse document frequencies, scaled to length one, are the input.  The weights
are trained by follow-the-regularised-leader (proximal) with an elastic-net
penalty, and the softmax is cooled or warmed by one temperature fitted on a part
of the sample that the weights have not seen.

Trained on a bounded sample: ``SAMPLE`` documents per language value, those of the
smallest hashes, fewer where values are so many that they would come to more than
``SAMPLE_ROWS`` together, of no more than ``LONGEST`` characters each.  Every value is
learnt.  Documents are picked in one pass, by a bound on their hashes that is set from
the count of their value.

Every text is judged whole, however long.  A text that is null or has no letter is
``und`` with score 0; so is every text where there is nothing to learn from.  Repeated
rows come out as often as they went in; of rows that share an id the smallest value
and text is learnt from; of equally likely values the smallest is said; an empty table
gives an empty one; columns beyond the three named are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import fitted, fold, lean, materialise, scratch, short_batches, unit_hash

SAMPLE, SAMPLE_ROWS, LONGEST = 600, 150_000, 50_000
DIMENSIONS = 1 << 15
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.002, 0.5, 3
#: Characters of a text that are counted at a time.
BLOCK = 1 << 18


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the n-grams of a whole text; both empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[codes]
    if not known.any():
        return np.zeros(0, np.int64), np.zeros(0)
    marks = np.concatenate(([0], np.where(known, codes, 0), [0])).astype(np.uint64)
    marks = marks[np.concatenate(([True], (marks[1:] != 0) | (marks[:-1] != 0)))]
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(marks), BLOCK):
        block = marks[at : at + BLOCK + 2]
        key = block
        for n in range(3):
            if n:
                key = key[:-1] * np.uint64(1000003) + block[n:]
            mixed = (key + np.uint64(n * 7919)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)
            total += np.bincount(mixed[: BLOCK].astype(np.int64), minlength=DIMENSIONS)
    places = np.flatnonzero(total)
    return places, total[places]


def weighed(places: np.ndarray, number: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(number) * idf[places]
    return x / max(1e-12, float(np.sqrt((x * x).sum())))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that follow from the sums: zero unless a sum exceeds the L1 penalty."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(rows: Sequence[tuple[str, str]]) -> dict:
    """The model from (text, language) rows."""
    found = [(c, lang) for text, lang in rows if len((c := counts(text))[0])]
    names = sorted({lang for _, lang in found})
    if not names:
        return {"names": []}
    frequency = np.zeros(DIMENSIONS)
    for (places, _), _ in found:
        frequency[places] += 1
    idf = np.log((1 + len(found)) / (1 + frequency)) + 1
    data = [(places, weighed(places, number, idf), names.index(lang)) for (places, number), lang in found]
    order = np.random.default_rng(5).permutation(len(data))
    kept_back = set(order[: len(data) // 5].tolist())
    z, n = np.zeros((len(names), DIMENSIONS), np.float32), np.zeros((len(names), DIMENSIONS), np.float32)
    for _ in range(EPOCHS):
        for k in order:
            if k in kept_back:
                continue
            places, x, y = data[k]
            own_z, own_n = z[:, places], n[:, places]
            w = leader(own_z, own_n)
            g = softmax(w @ x)
            g[y] -= 1
            g = g[:, None] * x[None, :]
            z[:, places] = own_z + g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA * w
            n[:, places] = own_n + g * g
    w = leader(z, n)
    held = [data[k] for k in sorted(kept_back)] or data
    logits = np.array([w[:, places] @ x for places, x, _ in held])
    right = np.array([y for *_, y in held])
    loss = lambda t: -np.log(softmax(logits * t)[np.arange(len(right)), right] + 1e-12).mean()
    heat = min(np.geomspace(0.2, 20, 81), key=loss)
    return {"names": names, "idf": idf.astype(np.float32), "w": w.astype(np.float32), "heat": float(heat)}


def predict(model: dict, text: str | None) -> tuple[str, float]:
    places, number = counts(text)
    if not len(places) or not model["names"]:
        return "und", 0.0
    p = softmax(model["w"][:, places] @ weighed(places, number, model["idf"]) * model["heat"])
    best = int(p.argmax())
    return model["names"][best], float(p[best])


def identify_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``, over whole texts."""
    spark = docs.sparkSession
    short_batches(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    known = plain.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~fold("doc_id", 4, 2) & (F.length("text") <= LONGEST))
    with scratch(spark):
        sizes = materialise(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
        quota = max(1, min(SAMPLE, SAMPLE_ROWS // max(1, sizes.count())))
        # Twice the quota and some more, so that by chance none comes short of it; the rest goes where the model is fitted.
        bound = sizes.select("lang", ((2.0 * quota + 100) / F.col("n")).alias("bound"))
        chosen = known.withColumn("place", unit_hash(F.col("doc_id"))).join(bound, "lang").where("place < bound").groupBy("doc_id").agg(F.first("place").alias("place"), F.min(F.struct("lang", "text")).alias("r"))

        def learn(rows: list[tuple]) -> dict:
            held: dict[str, list] = {}
            for _, _, text, value in rows:  # in order of their places
                if len(mine := held.setdefault(value, [])) < quota:
                    mine.append((text, value))
            return fit([r for value in sorted(held) for r in held[value]])

        sent = spark.sparkContext.broadcast(fitted(chosen.select("place", "doc_id", "r.text", "r.lang"), learn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(sent.value)
        for batch in batches:
            said = [predict(model, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = plain.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
