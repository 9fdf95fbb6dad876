"""Mixing sources to target weights by entropy balancing.

Among all non-negative document rates that give every source its target number
of words, with no rate above ``most``, the one nearest to "take each document
once" in Kullback-Leibler divergence is ``min(most, exp(lambda * size / mean))``
with one multiplier per source, where ``mean`` is the source's mean size.  The
convex dual is solved by safeguarded Newton steps.  A step is one aggregation
over the (source, size) histogram, so it never touches the texts again, and all
sources advance together.  The tilted rates then become whole copies by
sequential Poisson rounding whose cut-off is calibrated per source, so that the
copies, not only the rates, meet the target.

Everything is DataFrame code.  The only tables gathered in one place have one
row per source.  A null source is a source of its own; null texts and texts
without words have size 0 and add nothing, whatever their copies; texts count whole,
however long, and a source of few long ones can miss its target by half of one; rows
of the same id, source and text (ties at the cut-off) share their number of copies;
an empty table gives an empty result; columns beyond the three named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import WORD_PATTERN, materialise, scratch, unit_hash

#: Cells per level of the two-level search for a source's cut-off.
CELLS = 2048
#: Newton steps of one job.
STEPS = 4


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Orders sources by code point with null last, and joins null to null."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """key, documents, source_size, target: one row per source.

    Sources below their ceiling split what the ceilings leave by weight.  With
    ceilings ordered by ceiling / weight, a source is held at its ceiling as
    long as the level that all later ones would get is above that ratio.
    """
    totals = sized.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size"))
    in_order = Window.orderBy("key")
    everything = Window.partitionBy(F.lit(0))
    by_ratio = Window.orderBy("ratio", "key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    ranked = (
        totals.withColumn("weight", weight.cast("double"))
        .withColumn("ceiling", F.col("source_size") * float(most))
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * float(share))
        .withColumn("before", F.coalesce(F.sum("ceiling").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.col("before")) / F.col("open_weight"))
    )
    #: Holding a source that would accept its share only lowers the level, so the largest level that some source accepts is the final one.
    final = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least(F.col("ceiling"), F.col("weight") * F.coalesce(final, F.max("ratio").over(everything)))
    return ranked.select("key", "documents", "source_size", target.alias("target"))


def _step(histogram: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """One safeguarded Newton step of every source at once: Newton's point if it is within the bracket, else the bracket's middle."""
    z = F.col("size") / F.col("mean")
    free = F.exp(F.least(F.col("lam") * z, F.lit(700.0)))
    value = F.sum(F.col("n") * F.least(free, F.lit(float(most))) * z)
    slope = F.sum(F.col("n") * F.when(free < most, free * z * z).otherwise(0.0))
    kept = [c for c in state.columns if c not in ("key", "gap")]
    sums = histogram.join(state.drop("gap"), "key").groupBy("key", *kept).agg(value.alias("value"), slope.alias("slope"))
    error = F.col("value") - F.col("wanted")
    low = F.when(error < 0, F.col("lam")).otherwise(F.col("low"))
    high = F.when(error > 0, F.col("lam")).otherwise(F.col("high"))
    newton = F.when(F.col("slope") > 0, F.col("lam") - error / F.col("slope"))
    inside = newton.isNotNull() & (newton > low) & (newton < high)
    nxt = F.when(error == 0, F.col("lam")).when(inside, newton).otherwise((low + high) / 2)
    gap = F.abs(error) / F.greatest("wanted", F.lit(1e-9))
    return sums.select("key", "mean", "wanted", nxt.alias("lam"), low.alias("low"), high.alias("high"), gap.alias("gap"))


def tilt(sized: DataFrame, targets: DataFrame, most: int, tolerance: float) -> DataFrame:
    """key, documents, source_size, target, mean, lam: the dual solution of each source.

    Steps go on until every source is within ``tolerance`` of its target, or its
    bracket is too narrow for another number between its ends.
    """
    histogram = materialise(sized.where("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")))
    mean = F.greatest(F.col("source_size") / F.col("documents"), F.lit(1e-9))
    # Beyond the ends all rates of texts with words are 0, or all at the ceiling.
    state = targets.select("key", mean.alias("mean"), (F.col("target") / mean).alias("wanted"), F.lit(0.0).alias("lam"), (-700.0 * mean).alias("low"), (mean * (math.log(most) + 1) + 1).alias("high"))
    open_ = F.col("high") - F.col("low") > F.greatest(F.abs("low"), F.abs("high")) * 1e-15
    while True:
        for _ in range(STEPS):
            state = _step(histogram, state, most)
        state = materialise(state)
        if state.where((F.col("gap") > tolerance) & open_).isEmpty():
            break
    return targets.join(state.select("key", "mean", "lam"), "key", "left").withColumns({"mean": F.coalesce("mean", F.lit(1.0)), "lam": F.coalesce("lam", F.lit(0.0))})


def rate(most: int) -> Column:
    """The tilted rate of a document, at its ceiling exactly where its source is."""
    full = F.col("target") >= F.col("source_size") * float(most)
    return F.when(full, float(most)).otherwise(F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(most))))


def _cell(doc_id: str) -> Column:
    """The place of a document in its source's rounding order, as one of CELLS * CELLS cells; CELLS * CELLS if it has no fraction."""
    part = F.col("rate") - F.floor("rate")
    priority = unit_hash(F.col(doc_id), F.col("key"), F.col("of_text")) / part
    return F.when(part > 0, F.floor(priority / (priority + 1) * float(CELLS * CELLS))).otherwise(CELLS * CELLS).cast("long")


def _cut(cells: DataFrame, label: str) -> DataFrame:
    """For each source: the first cell at which the running sum passes what is left, and the sum before it."""
    running = Window.partitionBy("key").orderBy(label)
    sums = cells.withColumn("upto", F.sum("words").over(running)).withColumn("before", F.col("upto") - F.col("words"))
    return sums.where(F.col("upto") >= F.col("left")).groupBy("key").agg(F.min_by(F.struct(label, "before", "words"), label).alias("at")).select("key", F.col(f"at.{label}").alias(label), F.col("at.before").alias("before"), F.col("at.words").alias("words"))


def plan_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, tolerance: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """(sized documents, sources): all that :func:`copies` needs, as written tables."""
    spark = docs.sparkSession
    with scratch(spark):
        return _planned(docs, doc_id, text, source, weights, share, most, tolerance)


def _planned(docs: DataFrame, doc_id: str, text: str, source: str, weights: Sequence[int], share: float, most: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    sized = materialise(docs.select(F.col(doc_id).alias("doc_id"), source_key(F.col(source)).alias("key"), words_in(F.col(text)).alias("size"), F.xxhash64(text).alias("of_text")), outlive=True)
    targets = materialise(source_targets(sized, weights, share, most))
    tilted = materialise(tilt(sized, targets, most, tolerance))
    rated = sized.where("size > 0").join(tilted, "key").withColumn("rate", rate(most)).withColumn("cell", _cell("doc_id"))
    whole = rated.groupBy("key").agg(F.sum(F.floor("rate") * F.col("size")).alias("sure"))
    left = materialise(tilted.join(whole, "key", "left").withColumn("left", F.col("target") - F.coalesce("sure", F.lit(0))).select("key", "left"))
    open_ = rated.where(F.col("cell") < CELLS * CELLS).select("key", "size", "cell")
    coarse = open_.groupBy("key", F.floor(F.col("cell") / CELLS).alias("upper")).agg(F.sum("size").alias("words")).join(left, "key")
    first = materialise(_cut(coarse, "upper").select("key", "upper", F.col("before").alias("sum_before")).join(left, "key").withColumn("left", F.col("left") - F.col("sum_before")).select("key", "upper", "left"))
    fine = open_.join(first, "key").where(F.floor(F.col("cell") / CELLS) == F.col("upper")).groupBy("key", "cell", "left").agg(F.sum("size").alias("words"))
    second = _cut(fine, "cell").join(first, "key").select("key", F.when(F.col("left") - F.col("before") >= F.col("words") / 2, F.col("cell")).otherwise(F.col("cell") - 1).alias("cut"))
    return sized, materialise(tilted.join(second, "key", "left").withColumn("cut", F.coalesce("cut", F.when(F.col("target") > 0, F.lit(CELLS * CELLS - 1)).otherwise(F.lit(-1)))), outlive=True)


def copies(sized: DataFrame, sources: DataFrame, *, most: int = 2) -> DataFrame:
    """``sized`` (doc_id, key, size, of_text and any others) with its source's columns and ``copies``."""
    rated = sized.join(sources, "key").withColumn("rate", rate(most)).withColumn("cell", _cell("doc_id"))
    return rated.withColumn("copies", (F.floor("rate") + F.when((F.col("size") > 0) & (F.col("cell") <= F.col("cut")), 1).otherwise(0)).cast("int"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, rate, copies: one row per row of ``docs``."""
    sized, sources = plan_mix(docs, **options)
    out = copies(sized, sources, most=options.get("most", 2))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document of ``docs``, with all its columns, once per copy."""
    _, sources = plan_mix(docs, **options)
    names = {k: options.get(k, k) for k in ("doc_id", "text", "source")}
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    sized = held.select("row", F.col(f"row.{names['doc_id']}").alias("doc_id"), source_key(F.col(f"row.{names['source']}")).alias("key"), words_in(F.col(f"row.{names['text']}")).alias("size"), F.xxhash64(f"row.{names['text']}").alias("of_text"))
    out = copies(sized, sources, most=options.get("most", 2)).select("row", "copies").where("copies > 0")
    return out.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
