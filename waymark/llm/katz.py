"""Language-model scores: Katz backoff over words, with Good-Turing discounts.

P(w | v) is the discounted share of (v, w) among v's followers where training text
has the pair, and alpha(v) * P(w) where not; P(w) is w's discounted share, and what
the discounts leave belongs to one event, the unknown word.  alpha(v) is computed
from the sums over all followers of v, so every distribution adds up to one.
Counts of 1 to ``TOP`` are discounted after Good and Turing as Katz has it; where
counts of counts are too few for that, by half a count.  A distribution whose
counts are all above ``TOP`` keeps one more count for the unseen.

Words are held as 64-bit hashes.  Texts stay where they are read: each input
partition is cut into blocks, and tables are partitioned by word.

1. Every block sends its distinct words with their training counts to the word's
   partition, which adds them up and sends the totals back.
2. Every block sends its distinct pairs, by the first word's partition, with the
   second word's total, the pair's training count and the documents it stands in.
   Pairs of a first word that is too frequent for one partition are dealt by the
   second word as well; the few sums that its alpha needs are then put together.
3. With discounts known, each partition evaluates its pairs, following the backoff,
   and sends each block the sums for its documents.

Both shuffles are read twice (once for counts of counts, once for results), not
made twice.  Null texts are empty; an empty text is scored as its end alone.
Long texts are scored whole, as one block if they pass its size.  Repeated rows are
learnt from, and scored, as often as they occur.  Where there is nothing to learn
from, every token is the unknown word, of probability one.  An empty table gives an
empty one; columns beyond the two named are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import fold, partitions

TOP = 5
#: Tokens of a block, after the document that passes it.
BLOCK = 1 << 20
#: Bytes of input that one task reads: it holds its tokens, and those of one other stage, in memory.
TASK_BYTES = 8 << 20
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


#: White space is in no word, so these are no word's.
END, BEGIN = b" end", b" begin"


def packed(values: np.ndarray) -> bytes:
    import zstandard

    widest = int(values.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if widest <= np.iinfo(k).max)
    return np.dtype(kind).char.encode() + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.dtype(data[:1].decode())).astype(np.int64)


def tokenised(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Blocks (doc_ids, held, lengths, tokens, hashes) of rows (doc_id, held_out, text); tokens count places in hashes, which ascend."""

    import xxhash

    digest, end = xxhash.xxh3_64_intdigest, [word_hash(END)]

    def block() -> tuple:
        hashes, tokens = np.unique(np.concatenate(found), return_inverse=True)
        return ids, np.array(held, bool), np.array([len(f) for f in found], np.int64), tokens.astype(np.int32), hashes

    ids, held, found, size = [], [], [], 0
    for doc_id, apart, text in rows:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        ids.append(doc_id)
        held.append(apart)
        found.append(np.array([*map(digest, words), *end], np.uint64))
        size += len(words) + 1
        if size >= BLOCK:
            yield block()
            ids, held, found, size = [], [], [], 0
    if ids:
        yield block()


def discounts(of: np.ndarray) -> np.ndarray:
    """The factor for counts 0 to TOP (0 is unused), from of[r], the number of events seen r times."""
    out = np.ones(TOP + 1)
    r = np.arange(1, TOP + 1)
    if (of[1 : TOP + 2] > 0).all():
        star = (r + 1) * of[2 : TOP + 2] / of[1 : TOP + 1]
        last = (TOP + 1) * of[TOP + 1] / of[1]
        if last < 1:
            katz = (star / r - last) / (1 - last)
            if ((katz > 0) & (katz < 1)).all():
                out[1:] = katz
                return out
    out[1:] = (r - 0.5) / r
    return out


def discounted(count: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return count * np.where(count <= TOP, factor[np.minimum(count, TOP)], 1.0)


class Words:
    """P(w) from w's training count."""

    def __init__(self, n: int, of: np.ndarray):
        self.factor = discounts(of)
        low = float(sum((1 - self.factor[r]) * r * of[r] for r in range(1, TOP + 1)))
        self.total = max(1, n) if low > 0 or not n else n + 1
        self.unknown = low / self.total if low > 0 else 1 / self.total

    def p(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, self.factor) / self.total, self.unknown)


def counts_of(count: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(count[count > 0], TOP + 2), minlength=TOP + 3)[: TOP + 3]


def summed_words(entries: list[tuple]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(place of each entry's words, totals by place) of one partition of the word table."""
    hashes = [np.frombuffer(e[3], np.uint64) for e in entries]
    if not hashes:
        return [], np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpacked(e[4]) for e in entries]), len(names)).astype(np.int64)
    return np.split(place, np.cumsum([len(h) for h in hashes])[:-1]), total, names


def grouped_pairs(entries: list[tuple]) -> dict:
    """The pairs of one partition: for each entry's pair its place, and by place the counts."""
    first, second, own, total, trained = [], [], [], [], []
    for e in entries:
        runs = unpacked(e[4])
        first.append(np.repeat(np.frombuffer(e[3], np.uint64), runs))
        own.append(np.repeat(unpacked(e[5]), runs))
        second.append(np.frombuffer(e[6], np.uint64))
        total.append(unpacked(e[7]))
        trained.append(unpacked(e[8]))
    sizes = [len(x) for x in second]
    if not sum(sizes):
        return {"places": [], "n": 0}
    a, b = np.concatenate(first), np.concatenate(second)
    del first, second
    mixed = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(31))
    order = np.argsort(mixed)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    mixed = mixed[order]
    if (fresh[1:] & (mixed[1:] == mixed[:-1])).any():  # different pairs met in the mixed hash: sort by both
        order = np.lexsort((b, a))
        fresh[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    del mixed
    group = np.cumsum(fresh) - 1
    place = np.empty(len(order), np.int64)
    place[order] = group
    heads = order[fresh]
    c12 = np.bincount(place, np.concatenate(trained), len(heads)).astype(np.int64)
    names, context = np.unique(a[heads], return_inverse=True)
    c1 = np.zeros(len(names), np.int64)
    c1[context] = np.concatenate(own)[heads]
    return {"places": np.split(place, np.cumsum(sizes)[:-1]), "n": len(heads), "c12": c12, "names": names, "context": context, "c1": c1, "c2": np.concatenate(total)[heads]}


def shards_of(c1: np.ndarray, n: int, parts: int) -> np.ndarray:
    """Among how many partitions a first word's pairs are dealt: 1, or more if it has over half an even share of the tokens."""
    return np.where(c1 * 2 * parts > n, np.minimum(parts, 1 + c1 * 2 * parts // max(1, n)), 1)


def _in_small_parts(table: DataFrame):
    """The table's RDD, planned with files split into parts of at most TASK_BYTES; the session's own setting is put back."""
    from pyspark.util import _parse_memory

    conf, key = table.sparkSession.conf, "spark.sql.files.maxPartitionBytes"
    own = conf.get(key)
    size = int(own[:-1]) if own.lower().endswith("b") and own[:-1].isdigit() else _parse_memory(own) << 20 if not own.isdigit() else int(own)
    conf.set(key, str(min(size, TASK_BYTES)))
    try:
        return table.rdd
    finally:
        conf.set(key, own)


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held: int = 1) -> DataFrame:
    """SCHEMA: one row per row of ``docs``, over whole texts; learnt from rows whose crc32(id) modulo ``folds`` is not ``held``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), fold(F.col(doc_id), folds, held).alias("held_out"), F.col(text).alias("text"))
    learnt_docs = plain.where("NOT held_out").count()
    rows = _in_small_parts(plain)
    p = rows.getNumPartitions()
    if not p:
        return spark.createDataFrame([], SCHEMA)
    # Of the input's size, as a partition is held in memory; a pair's arrays are several times its bytes in the shuffle.
    parts = 2 * max(p, partitions(spark))

    def requests(index: int, part: Iterable) -> Iterator[tuple]:
        for seq, (_, apart, lengths, tokens, hashes) in enumerate(tokenised(part)):
            learnt = np.bincount(tokens[np.repeat(~apart, lengths)], minlength=len(hashes))
            to = (hashes % np.uint64(parts)).astype(np.int64)
            for bucket in np.unique(to):
                mine = to == bucket
                yield int(bucket), (index, seq, int(bucket), hashes[mine].tobytes(), packed(learnt[mine]))

    words = rows.mapPartitionsWithIndex(requests).partitionBy(parts, int).values()

    def word_stats(part: Iterable) -> Iterator[tuple]:
        entries = list(part)
        _, total, _ = summed_words(entries)
        yield int((total > 0).sum()), int(total.sum()), counts_of(total)

    v, n, of = words.mapPartitions(word_stats).treeReduce(lambda x, y: tuple(a + b for a, b in zip(x, y)))
    unigrams = Words(n, of)

    def replies(part: Iterable) -> Iterator[tuple]:
        entries = list(part)
        places, total, _ = summed_words(entries)
        for e, place in zip(entries, places):
            yield e[0], (e[1], e[2], packed(total[place]))

    totals = words.mapPartitions(replies).partitionBy(p, int).values().mapPartitions(lambda part: [list(part)])
    wide = rows if totals.getNumPartitions() == p else rows.union(context.parallelize([], totals.getNumPartitions() - p))
    blocks = wide.mapPartitions(lambda part: [list(tokenised(part))])
    begin, end_share = np.uint64(word_hash(BEGIN)), n + 0.5 * (v + 1)

    def pairs(index: int, part: Iterable) -> Iterator[tuple]:
        for own, told in part:
            by_block = defaultdict(dict)
            for seq, bucket, data in told:
                by_block[seq][bucket] = data
            for seq, (ids, apart, lengths, tokens, hashes) in enumerate(own):
                count = np.zeros(len(hashes), np.int64)
                to = (hashes % np.uint64(parts)).astype(np.int64)
                for bucket, data in by_block[seq].items():
                    count[to == bucket] = unpacked(data)
                starts = np.cumsum(lengths) - lengths
                base = np.add.reduceat(np.log10((count[tokens] + 0.5) / end_share), starts)
                known = np.add.reduceat((count[tokens] > 0).astype(np.int64), starts)
                yield index % parts, ("base", index, seq, ids, apart.tobytes(), packed(lengths), packed(known), base.tobytes())
                # Contexts: place 0 is the beginning, others are one more than the word's.
                before = np.empty(len(tokens), np.int64)
                before[1:] = tokens[:-1].astype(np.int64) + 1
                before[starts] = 0
                first_hash, first_count = np.concatenate(([begin], hashes)), np.concatenate(([learnt_docs], count))
                code = before * len(hashes) + tokens
                del before
                order = np.argsort(code, kind="stable").astype(np.int32)
                code = code[order]
                heads = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                a, b = code[heads] // len(hashes), code[heads] % len(hashes)
                times = np.diff(np.append(heads, len(code)))
                document = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)[order]
                del code, order
                trained = np.add.reduceat((~apart)[document].astype(np.int64), heads)
                spread = shards_of(first_count[a], n, parts)
                bucket = ((first_hash[a] + np.where(spread > 1, hashes[b] % spread.astype(np.uint64), 0).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                by_bucket = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by_bucket], np.arange(parts + 1))
                for k in range(parts):
                    mine = by_bucket[edges[k] : edges[k + 1]]
                    if not len(mine):
                        continue
                    runs = np.flatnonzero(np.concatenate(([True], a[mine][1:] != a[mine][:-1])))
                    lots = times[mine]
                    steps = np.arange(lots.sum()) - np.repeat(np.cumsum(lots) - lots, lots) + np.repeat(heads[mine], lots)
                    yield k, ("pairs", index, seq, first_hash[a[mine][runs]].tobytes(), packed(np.diff(np.append(runs, len(mine)))), packed(first_count[a[mine][runs]]), hashes[b[mine]].tobytes(), packed(count[b[mine]]), packed(trained[mine]), packed(lots), packed(document[steps]), len(ids))

    table = blocks.zip(totals).mapPartitionsWithIndex(pairs).partitionBy(parts, int)

    def pair_stats(part: Iterable) -> Iterator[tuple]:
        g = grouped_pairs([e for _, e in part if e[0] == "pairs"])
        if not g["n"]:
            return
        seen = g["c12"] > 0
        yield "of", counts_of(g["c12"])
        for k in np.flatnonzero(shards_of(g["c1"], n, parts) > 1):
            mine = seen & (g["context"] == k)
            yield int(g["names"][k]), np.concatenate((counts_of(g["c12"][mine])[: TOP + 1], [g["c12"][mine & (g["c12"] > TOP)].sum(), unigrams.p(g["c2"][mine]).sum()]))

    # Counts of counts, and a row for each part of a first word that is dealt among several: a few for each partition.
    bigram_of, dealt = np.zeros(TOP + 3), defaultdict(lambda: np.zeros(TOP + 3))
    for name, sums in table.mapPartitions(pair_stats).collect():
        if name == "of":
            bigram_of += sums
        else:
            dealt[name] += sums
    factor = discounts(bigram_of)
    of_dealt = {name: (float((np.arange(TOP + 1) * s[: TOP + 1] * factor).sum() + s[TOP + 1]), float(s[TOP + 2])) for name, s in dealt.items()}

    def evaluated(part: Iterable) -> Iterator[tuple]:
        entries = [e for _, e in part]
        for e in entries:
            if e[0] == "base":
                yield e[1], e
        entries = [e for e in entries if e[0] == "pairs"]
        g = grouped_pairs(entries)
        if not g["n"]:
            return
        seen, at, mass = g["c12"] > 0, g["context"], discounted(g["c12"], factor)
        low = unigrams.p(g["c2"])
        held_mass = np.bincount(at, np.where(seen, mass, 0), len(g["names"]))
        held_low = np.bincount(at, np.where(seen, low, 0), len(g["names"]))
        for k in np.flatnonzero(shards_of(g["c1"], n, parts) > 1):
            held_mass[k], held_low[k] = of_dealt[int(g["names"][k])]
        c1 = g["c1"].astype(float)
        c1 += (c1 > 0) & (c1 - held_mass <= 1e-9 * c1)
        safe = np.maximum(c1, 1)
        alpha = np.where(c1 > 0, (1 - held_mass / safe) / (1 - held_low), 1.0)
        logs = np.log10(np.where(seen, mass / safe[at], alpha[at] * low))
        for e, place in zip(entries, g["places"]):
            sums = np.bincount(unpacked(e[10]), np.repeat(logs[place], unpacked(e[9])), e[11])
            touched = np.flatnonzero(sums)
            yield e[1], ("sums", e[2], packed(touched), sums[touched].tobytes())

    def finished(part: Iterable) -> Iterator[tuple]:
        base, sums = {}, defaultdict(list)
        for index, e in part:
            if e[0] == "base":
                base[index, e[2]] = e
            else:
                sums[index, e[1]].append((e[2], e[3]))
        for key, e in base.items():
            ids, apart = e[3], np.frombuffer(e[4], bool)
            total = np.zeros(len(ids))
            for places, data in sorted(sums[key]):
                total[unpacked(places)] += np.frombuffer(data)
            lengths, known, score = unpacked(e[5]), unpacked(e[6]), np.frombuffer(e[7])
            for k, name in enumerate(ids):
                yield name, bool(apart[k]), int(lengths[k]), int(known[k]), n, float(score[k]), float(total[k])

    return spark.createDataFrame(table.mapPartitions(evaluated).partitionBy(p, int).mapPartitions(finished), SCHEMA)
