"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most ``2 * half`` bits have a common
variant within ``half`` flipped bits of each, and two fingerprints that share
such a variant differ in at most ``2 * half`` bits.  So every distinct
fingerprint stands for all its variants, rows are shuffled on the variant, and
whatever meets on a variant is linked: to meet is to be within the distance, so
collisions need no further test.

A variant is not written out before the shuffle.  Rows go to a bucket, the low
``b`` bits of the variant, once per bucket that some of their variants fall in
(1 + b + b(b-1)/2 rows for ``half`` = 2); the task of a bucket then expands the
flips of the other bits itself.  Buckets whose variants are too many for one
task, such as those of a large group of near copies, are split further by a
linear hash of the whole variant, each part expanding only its own.  In a bucket
links are chained along equal variants and contracted to at most one per
fingerprint, so no group ever expands into all its pairs.

Documents with equal fingerprints meet once, as one node.  Components are found
by alternating large-star and small-star steps over the remaining links, until a
step changes nothing.

Null texts and texts without words have fingerprint 0 and are linked like any other;
long texts are taken whole; repeated rows come out as often as they went in; an empty
table gives an empty one; columns beyond the two named are not read (and stay, in
:func:`deduplicated`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import fresh, lean, materialise, scratch, short_batches

#: Variants that one task expands.
TASK_VARIANTS = 1 << 21
#: Bits of a bucket's number at least, so that a fingerprint goes to as many buckets for small inputs as for larger ones.
LEAST_BITS = 8
#: And those that it holds in memory at once.
PASS_VARIANTS = 1 << 19
SEED = 42


def _votes(hashes: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: a bit is set if it is in over half of them."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * votes > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def _other(hashes: np.ndarray, table: int) -> np.ndarray:
    """Another hash of what was hashed: a finaliser over the first, with the table's own increment."""
    x = hashes + np.uint64(table * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of a text's shingles, in order; none for a text without words or null."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last)), np.uint64, len(first))


def fingerprint_tables(text: str | None, shingle: int = 4, tables: int = 1) -> list[int]:
    """The SimHash of one text in each table; 0 in all for a text without words or null.

    The first table's is the plain one; the others hash every shingle differently.
    """
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return [0] * tables
    return [_votes(hashes if not t else _other(hashes, t)) for t in range(tables)]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    return fingerprint_tables(text, shingle)[0]


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, tables: int = 1) -> DataFrame:
    """doc_id, of_text (a hash of it), fp (as a signed long), more (those of further tables): one row per row of ``docs``, over whole texts."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint_tables(t.as_py(), shingle, tables) for t in batch.column(2)], np.uint64).reshape(-1, tables).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found[:, 0]), pa.array(found[:, 1:].tolist(), pa.list_(pa.int64()))], ["doc_id", "of_text", "fp", "more"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("of_text"), F.col(text).alias("text")).mapInArrow(lean(run), "doc_id long, of_text long, fp long, more array<long>")


def _flips(bits: range, most: int) -> list[int]:
    return [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(bits, n)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _parity(values: np.ndarray, bits: int) -> np.ndarray:
    """A linear hash of ``bits`` bits: hash(x ^ y) = hash(x) ^ hash(y)."""
    keys = np.random.default_rng(7).integers(0, 1 << 64, 32, dtype=np.uint64)
    out = np.zeros(len(values), np.int64)
    for t in range(bits):
        out |= (np.bitwise_count(values & keys[t]).astype(np.int64) & 1) << t
    return out


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index reachable over the links, for each of n nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label = nxt
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        if np.array_equal(before, label) and not len(a):
            break
    return label


def _bucket_links(bits: int, half: int):
    high = [np.array(_flips(range(bits, 64), k), np.uint64) for k in range(half + 1)]
    low = np.uint64((1 << bits) - 1)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, part, split = (x.as_py() for x in key)
        fps = np.unique(np.asarray(table.column("fp")).astype(np.int64).view(np.uint64))
        off = (fps & low) ^ np.uint64(bucket)
        near = np.bitwise_count(off)
        here = [np.flatnonzero(near == used) for used in range(half + 1)]
        bases = [fps[rows] ^ off[rows] for rows in here]
        # Further bits of the same hash cut the work into passes, so that memory does not follow the bucket's size.
        load = sum(len(rows) * len(high[half - used]) for used, rows in enumerate(here)) >> split
        more = max(0, math.ceil(math.log2(max(1, load / PASS_VARIANTS))))
        of_base = [_parity(base, split + more) for base in bases]
        of_mask = [_parity(high[half - used], split + more) for used in range(half + 1)]
        root = np.arange(len(fps))
        for inner in range(1 << more):
            wanted, variants, owners = part | inner << split, [], []
            for used, rows in enumerate(here):
                masks = high[half - used]
                for value in np.unique(of_base[used]):
                    mine, own = of_base[used] == value, masks[of_mask[used] == value ^ wanted]
                    variants.append((bases[used][mine][:, None] ^ own[None, :]).ravel())
                    owners.append(np.repeat(rows[mine].astype(np.int32), len(own)))
            v, o = np.concatenate(variants), np.concatenate(owners)
            order = np.argsort(v)
            v, o = v[order], root[o[order]]
            same = np.flatnonzero((v[1:] == v[:-1]) & (o[1:] != o[:-1]))
            if len(same):
                codes = np.unique(o[same].astype(np.int64) * len(fps) + o[same + 1])
                root = _roots(codes // len(fps), codes % len(fps), len(fps))[root]
        as_long = fps.view(np.int64)
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"u": as_long[linked], "v": as_long[root[linked]]})

    return run


def links(distinct: DataFrame, *, half: int = 2, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """u, v: links between distinct fingerprints (column ``fp``) whose components are those of the ball graph."""
    per_row = len(_flips(range(64), half))
    n = distinct.count()
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, n * per_row * 2 / task_variants))))
    low = (1 << bits) - 1
    flips = _flips(range(bits), half)
    weights = [math.comb(64 - bits, 0) + sum(math.comb(64 - bits, k) for k in range(1, half - f.bit_count() + 1)) for f in flips]
    pairs = F.array(*[F.struct(F.lit(f).cast("long").alias("flip"), F.lit(w).cast("long").alias("weight")) for f, w in zip(flips, weights)])
    sent = distinct.select("fp", F.explode(pairs).alias("to")).select("fp", F.col("fp").bitwiseAND(_signed(low)).bitwiseXOR(F.col("to.flip")).alias("bucket"), F.col("to.weight").alias("weight"))
    # Only buckets beyond a task's share are listed: at most n * per_row / task_variants of them.
    heavy = materialise(sent.groupBy("bucket").agg(F.sum("weight").alias("load")).where(F.col("load") > task_variants).select("bucket", F.ceil(F.log2(F.col("load") / task_variants)).cast("int").alias("split")))
    dealt = sent.drop("weight").join(heavy, "bucket", "left").withColumn("split", F.coalesce("split", F.lit(0)))
    dealt = dealt.withColumn("part", F.explode(F.expr("sequence(0L, shiftleft(1L, split) - 1)")))
    return dealt.groupBy("bucket", "part", "split").applyInArrow(_bucket_links(bits, half), "u long, v long")


def connect(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node on an edge (u, v)."""
    edges = materialise(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark, seen = None, ()
    while seen != mark:
        mark = seen
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.union(least.select("u", "m")).toDF("u", "v").where("u != v").distinct())
        seen = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    return edges.toDF("node", "root")


def _linked(rows: DataFrame, nodes: DataFrame, tables: int, half: int, task_variants: int) -> DataFrame:
    """u, v over first fingerprints, from the links of all tables."""
    # Each table's links are written on their own: one plan of all would be a large one.
    edges = materialise(links(nodes.select("fp"), half=half, task_variants=task_variants))
    for t in range(1, tables):
        pairs = materialise(rows.select("fp", F.col("more")[t - 1].alias("g")).distinct())
        named = materialise(pairs.groupBy("g").agg(F.min("fp").alias("rep")))
        same = pairs.join(named, "g").where("fp <> rep").select(F.col("fp").alias("u"), F.col("rep").alias("v"))
        near = links(named.select(F.col("g").alias("fp")), half=half, task_variants=task_variants)
        near = near.join(named.toDF("u", "ru"), "u").join(named.toDF("v", "rv"), "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
        edges = edges.unionByName(materialise(same.unionByName(near)))
    return edges


def _rooted(docs: DataFrame, *, doc_id: str, text: str, shingle: int, half: int, tables: int, task_variants: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, of_text, fp: the rows), (fp, root, component_id: the distinct fingerprints), as written tables."""
    spark = docs.sparkSession
    with scratch(spark):
        rows = materialise(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle, tables=tables), outlive=True)
        nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
        joined = materialise(connect(_linked(rows, nodes, tables, half, task_variants)).join(nodes.withColumnRenamed("fp", "node"), "node"))
        own = joined.groupBy("root").agg(F.min("first_id").alias("first_id")).join(nodes.toDF("root", "root_id"), "root")
        of_root = own.select("root", F.least("first_id", "root_id").alias("component_id"))
        linked = joined.join(of_root, "root").select(F.col("node").alias("fp"), "root", "component_id").union(of_root.select("root", "root", "component_id").toDF("fp", "root", "component_id"))
        named = materialise(nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")), outlive=True)
    return rows, named


def components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, half: int = 2, tables: int = 1, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """doc_id, fp, component_id: one row per row of ``docs``.

    Rows are linked whose fingerprints differ in ``2 * half`` bits or fewer in any
    of the ``tables``; component_id is the smallest id reachable, the row's own
    included, null ids apart.
    """
    rows, named = _rooted(docs, doc_id=doc_id, text=text, shingle=shingle, half=half, tables=tables, task_variants=task_variants)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def kept_rows(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id, of_text, copies), one of several that have the same id and text; rows without an id stay."""
    mark = fresh("of_text", docs.columns)
    held = docs.where(F.col(doc_id).isNotNull()).withColumn(mark, F.xxhash64(text))
    # Both sides are dealt by id whatever their size: the ids that stay grow with the documents.
    which = lambda how: kept.where(how).select(F.col("doc_id").alias(doc_id), F.col("of_text").alias(mark)).hint("shuffle_merge")
    once = held.join(which("copies = 1"), [doc_id, mark], "left_semi")
    again = held.join(which("copies > 1"), [doc_id, mark], "left_semi")
    again = again.groupBy(doc_id, mark).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return once.select(*docs.columns).unionByName(again.select(*docs.columns)).unionByName(docs.where(F.col(doc_id).isNull()))


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, half: int = 2, tables: int = 1, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """``docs`` with the row of the smallest id of each component; rows without an id stay.

    Rows count by their id and text: of rows that share an id, those of different
    texts stay or go each with its own near copies, and of those with the same text
    one stays.
    """
    with scratch(docs.sparkSession):
        rows, named = _rooted(docs.where(F.col(doc_id).isNotNull()), doc_id=doc_id, text=text, shingle=shingle, half=half, tables=tables, task_variants=task_variants)
        by_row = rows.groupBy("doc_id", "of_text").agg(F.first("fp").alias("fp"), F.count(F.lit(1)).alias("copies"))
        by_fp = by_row.groupBy("fp").agg(F.min(F.struct("doc_id", "of_text", "copies")).alias("first"))
        kept = materialise(by_fp.join(named, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*"), outlive=True)
    return kept_rows(docs, kept, doc_id, text)
