"""Near copies by the exact Jaccard similarity of word shingles.

Texts are near copies if their sets of shingles (64-bit hashes of a few words) have
a similarity of ``least`` or more.  Candidates come from two sides: the SimHash balls
of :mod:`waymark.llm.simhash`, and ``BANDS`` bands of ``ROWS`` minimum hashes each,
which a pair at 0.8 fails to meet in with a chance of (1 - 0.8^5)^20 = 0.0004 and at
0.9 with 2e-8.  No candidate is linked before its two sets have been compared.

Texts with the same set are one node.  In a bucket every node is compared with the
bucket's least one, so a group of near copies does not expand into its pairs.  Where a
bucket still holds nodes of different components, those of different components are
compared as well, in the bucket's task, which gives back at most a link for each node:
by their ``LEAST_HASHES`` least shingle hashes, which for most texts are all that they
have, so that the comparison is exact.  Pairs of longer texts whose least hashes do not
rule ``least`` out (wrongly with a chance of about 1e-6) are then compared as a whole.
A bucket of more nodes than ``BUCKET_NODES`` is dealt out in blocks.

Null texts and texts without words are copies of each other; long texts count whole;
rows count as often as they occur; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm import simhash
from waymark.llm.common import lean, materialise, scratch, short_batches

BANDS, ROWS = 20, 5
#: Standard deviations by which an estimate may stay below ``least``.
DEVIATIONS = 5
#: Of a set's hashes, for the comparisons within a bucket.
LEAST_HASHES = 1024
#: Nodes of a bucket that a task compares with each other.
BUCKET_NODES = 4096
#: Pairs of one node that a task compares.
TASK_PAIRS = 256
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW_FACTORS = np.random.default_rng(12).integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least of the hashes, for each of ``BANDS * ROWS`` further hashes of them."""
    found = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 12):
        found = np.minimum(found, (hashes[at : at + (1 << 12), None] * _FACTORS).min(0))
    return found


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, *, doc_id: str, text: str, shingle: int) -> DataFrame:
    """One row per row of ``docs``, over whole texts: doc_id, of_text (a hash of it), node (of the set), fp, n (of the set), bands, signature, shingles (sorted, eight bytes each).

    Null texts and texts without words have the empty set and no bands.
    """
    short_batches(docs.sparkSession)
    schema = "doc_id long, of_text long, node long, fp long, n int, bands array<long>, signature binary, shingles binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2):
                hashes = simhash.shingle_hashes(t.as_py(), shingle)
                own = np.unique(hashes)
                least = minima(own)
                mixed = (least.reshape(BANDS, ROWS) * _ROW_FACTORS).sum(1, dtype=np.uint64)
                mixed = simhash._other(mixed, 1) + np.arange(BANDS, dtype=np.uint64)
                packed = own.astype("<u8").tobytes()
                fp = simhash._votes(hashes) if len(hashes) else 0
                out.append((_digest(packed), simhash._signed(fp), len(own), mixed.view(np.int64).tolist() if len(own) else [], (least >> np.uint64(20)).astype(np.uint8).tobytes(), packed))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], [f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("of_text"), F.col(text).alias("text")).mapInArrow(lean(run), schema)


def _with_shingles(pairs: DataFrame, sets: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the shingles of one side; a node of very many pairs is dealt out over several tasks."""
    load = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("load"))
    load = materialise(load.select(side, F.ceil(F.col("load") / TASK_PAIRS).cast("int").alias("parts")))
    heavy = load.where("parts > 1")
    dealt = pairs.join(heavy, side, "left").withColumn("part", F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    own = sets.join(load.withColumnRenamed(side, "node"), "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = own.select(F.col("node").alias(side), "part", F.col("shingles").alias(f"{side}_shingles"))
    return dealt.join(own.hint("shuffle_merge"), [side, "part"]).drop("part")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (u, v) whose sets have a similarity of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("u_shingles"), batch.column("v_shingles")):
                a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= least * (len(a) + len(b) - both) - 1e-9)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    short_batches(sets.sparkSession)
    held = _with_shingles(_with_shingles(pairs, sets, "v", "u"), sets, "u", "v")
    return materialise(held.select("u", "v", "u_shingles", "v_shingles").mapInArrow(lean(run), "u long, v long"))


def _overlaps(own: np.ndarray, whole: bool, sets: list[np.ndarray], wholes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, size of what it is estimated from) of one set's least hashes with those of others; exact where both are whole."""
    ends = np.array([len(x) for x in sets])
    starts = np.cumsum(ends) - ends
    values = np.concatenate(sets)
    # Beyond the last hash of a set that was cut off, nothing is known of it.
    top = np.uint64(np.iinfo(np.uint64).max)
    upto = np.where(wholes, top, values[starts + ends - 1])
    if not whole:
        upto = np.minimum(upto, own[-1])
    seen = values <= np.repeat(upto, ends)
    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
    both = np.add.reduceat((own[place] == values) & seen, starts, dtype=np.int64)
    union = np.add.reduceat(seen, starts, dtype=np.int64) + np.searchsorted(own, upto, "right") - both
    return both / union, union


def _across(least: float):
    """Links between components of a bucket: ``sure`` ones, at most one a node, and pairs of long texts that need a comparison as a whole."""
    most = BANDS * ROWS
    low = most * least - DEVIATIONS * np.sqrt(most * least * (1 - least))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, n, label, block = (np.asarray(table.column(c)) for c in ("node", "n", "root", "block"))
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(node), -1)
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("hashes")]
        whole = n <= LEAST_HASHES
        apart = key[1].as_py() != key[2].as_py()  # two blocks: only what lies in different ones
        names, label = np.unique(label, return_inverse=True)
        rest = np.ones(len(node), bool)
        out = []
        # Nodes outside the largest component against all that come after them and those inside.
        for i in np.flatnonzero(label != np.bincount(label).argmax()):
            rest[i] = False
            near = rest & (label != label[i]) & (np.minimum(n, n[i]) >= least * np.maximum(n, n[i]) - 1e-9)
            near = np.flatnonzero(near & (block != block[i]) if apart else near)
            near = near[(signature[near] == signature[i]).sum(1) >= low]
            if not len(near):
                continue
            like, size = _overlaps(sets[i], whole[i], [sets[k] for k in near], whole[near])
            exact = whole[near] & whole[i]
            for k in near[exact & (like >= least - 1e-9)]:
                if label[k] != label[i]:
                    out.append((min(node[i], node[k]), max(node[i], node[k]), True))
                    label[label == label[k]] = label[i]
            doubt = ~exact & (like >= least - DEVIATIONS * np.sqrt(least * (1 - least) / size))
            out += [(min(node[i], node[k]), max(node[i], node[k]), False) for k in near[doubt] if label[k] != label[i]]
        u, v, sure = zip(*out) if out else ((), (), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "sure": pa.array(sure, pa.bool_())})

    return run


def _blocks(open_: DataFrame) -> DataFrame:
    """``open_`` with a and b, the blocks of its bucket that a row is compared in, and block, its own; a small bucket is one block."""
    sized = open_.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("band")) / BUCKET_NODES).cast("int"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}).drop("other", "blocks")


def _candidates(nodes: DataFrame, met: DataFrame, least: float) -> DataFrame:
    """u, v: each node with the least node of each of its buckets, and the links of the SimHash balls."""
    bucket = Window.partitionBy("band")
    first = met.withColumn("first", F.min(F.struct("node", "n")).over(bucket))
    stars = first.select(F.col("first.node").alias("u"), F.col("node").alias("v"), F.col("first.n").alias("un"), F.col("n").alias("vn"))
    prints = materialise(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("rep")))
    named = lambda side: prints.select(F.col("fp").alias(side), F.col("rep").alias(f"{side}_rep"))
    columns = lambda u, v: [F.col(f"{u}.node").alias("u"), F.col(f"{v}.node").alias("v"), F.col(f"{u}.n").alias("un"), F.col(f"{v}.n").alias("vn")]
    balls = materialise(simhash.links(prints.select("fp"))).join(named("u"), "u").join(named("v"), "v").select(*columns("u_rep", "v_rep"))
    same = nodes.select("fp", F.struct("node", "n").alias("own")).join(prints, "fp").select(*columns("rep", "own"))
    pairs = stars.unionByName(balls).unionByName(same).where("u <> v").where(F.least("un", "vn") >= least * F.greatest("un", "vn") - 1e-9)
    return materialise(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def components(rows: DataFrame, *, least: float) -> DataFrame:
    """node, root for every node of ``rows`` (those of :func:`sketches`) that has a near copy."""
    nodes = materialise(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")))
    dealt = nodes.select("node", "n", F.explode("bands").alias("band"))
    met = materialise(dealt.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("band"))).where("size > 1").select("band", "node", "n"))
    pairs = _candidates(nodes, met, least)
    of_pairs = lambda pairs: pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()

    def sets(pairs: DataFrame) -> DataFrame:
        found = rows.select("node", "shingles").join(materialise(of_pairs(pairs)), "node", "left_semi")
        return materialise(found.groupBy("node").agg(F.first("shingles").alias("shingles")))

    edges = verified(pairs, sets(pairs), least)
    found = simhash.connect(edges)
    labelled = met.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    bucket = Window.partitionBy("band")
    open_ = labelled.withColumn("low", F.min("root").over(bucket)).withColumn("high", F.max("root").over(bucket)).where("low <> high")
    open_ = materialise(open_.select("band", "node", "n", "root"))
    hashes = rows.select("node", F.substring("shingles", 1, 8 * LEAST_HASHES).alias("hashes")).join(materialise(open_.select("node").distinct()), "node", "left_semi")
    known = materialise(hashes.groupBy("node").agg(F.first("hashes").alias("hashes")).join(nodes.select("node", "signature"), "node"))
    across = materialise(_blocks(open_).join(known, "node").groupBy("band", "a", "b").applyInArrow(_across(least), "u long, v long, sure boolean").distinct())
    edges = edges.unionByName(across.where("sure").select("u", "v"))
    doubt = materialise(across.where("NOT sure").select("u", "v").distinct().join(pairs, ["u", "v"], "left_anti"))
    if not doubt.isEmpty():
        edges = edges.unionByName(verified(doubt, sets(doubt), least))
    return simhash.connect(edges)


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` with one row of each component of near copies, that of the smallest id; rows without an id stay.

    Rows count by their id and text: of rows that share an id, those of different
    texts stay or go each with its own near copies, and of those with the same text
    one stays.  Null texts and texts without words are copies of each other.
    """
    with scratch(docs.sparkSession):
        rows = materialise(sketches(docs.where(F.col(doc_id).isNotNull()), doc_id=doc_id, text=text, shingle=shingle))
        by_row = rows.groupBy("doc_id", "of_text").agg(F.first("node").alias("node"), F.count(F.lit(1)).alias("copies"))
        by_node = materialise(by_row.groupBy("node").agg(F.min(F.struct("doc_id", "of_text", "copies")).alias("first")))
        named = by_node.join(components(rows, least=least), "node", "left")
        kept = materialise(named.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first.*"), outlive=True)
    return simhash.kept_rows(docs, kept, doc_id, text)
