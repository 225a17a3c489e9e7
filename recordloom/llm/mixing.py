"""Mixing sources to target weights by hash-threshold histograms.

A source's target is met by whole repeats of all its documents and, for the rest, by those documents
whose hash lies below a threshold. The threshold comes from histograms of words by source and hash
bucket: the bucket in which the budget runs out is cut into finer buckets, and only its documents are
summed again. Documents are never sorted, and a source, however large, is one row per
bucket after the partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table, whole_text, word_count

#: Bits of the hash that each level of histograms adds.
BITS = 12
LEVELS = 3
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def _hash() -> Column:
    return F.xxhash64(F.col("doc_id"), whole_text())


def _bucket(h: str, level: int) -> Column:
    return F.shiftrightunsigned(F.col(h), 64 - BITS * level).bitwiseAND(F.lit((1 << BITS) - 1))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with the target of each.

    Weights go to the sources in code point order, null last, and repeat. All sizes are shared by weight;
    no target exceeds ``most`` times its source's size, and what is cut off goes to the others by weight.
    With sources in order of size over weight, those before some point are cut: the level of
    the rest is the first that its own limit allows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - before) / after)
    rows = rows.withColumn("place", F.row_number().over(by_ratio))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)
    return rows.withColumn("target", F.least("limit", F.col("weight") * F.coalesce(level["level"], F.lit(0.0)))).select("source", "source_size", "target")


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source_size, target, repeats (whole passes), threshold, the words of the group at it and those that still fit."""
    sources = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    bounds = sources.withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    bounds = bounds.withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size")).withColumn("threshold", F.lit(0).cast("long"))
    bounds = saved(bounds, "mix-bounds")
    rows = sizes
    for level in range(1, LEVELS + 1):
        histogram = rows.withColumn("bucket", _bucket("h", level)).groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        upto = Window.partitionBy("source").orderBy("bucket")
        cut = histogram.withColumn("sum", F.sum("size").over(upto)).withColumnRenamed("source", "s")
        cut = cut.join(bounds.select(F.col("source").alias("t"), "rest"), F.col("s").eqNullSafe(F.col("t"))).where(F.col("sum") > F.col("rest"))
        cut = cut.groupBy("s").agg(F.min(F.struct("bucket", "sum", "size")).alias("cut"))
        joined = bounds.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
        found = F.col("cut").isNotNull()
        bounds = saved(
            joined.select(
                "source", "source_size", "target", "repeats",
                F.when(found, F.col("rest") - F.col("cut.sum") + F.col("cut.size")).otherwise(F.col("rest")).alias("rest"),
                (F.col("threshold") * (1 << BITS) + F.coalesce("cut.bucket", F.lit(0))).alias("threshold"),
                F.coalesce("cut.size", F.lit(0)).alias("group_size"),
            ),
            "mix-bounds",
        )
        if level < LEVELS:
            edge = bounds.select(F.col("source").alias("t"), (F.col("threshold") % (1 << BITS)).alias("edge"))
            rows = saved(rows.join(edge, F.col("source").eqNullSafe(F.col("t")) & (_bucket("h", level) == F.col("edge"))).select("source", "size", "h"), "mix-edge")
    return bounds


def _prefix(h: str) -> Column:
    return F.shiftrightunsigned(F.col(h), 64 - BITS * LEVELS)


def _times(h: str) -> Column:
    """How often a whole document is taken; the one at the threshold if most of it fits."""
    at = (_prefix(h) == F.col("threshold")) & (F.col("group_size") > 0) & (F.col("group_size") <= 2 * F.col("rest"))
    return F.col("repeats") + ((_prefix(h) < F.col("threshold")) | at).cast("long")


def _words(h: str) -> Column:
    """Words taken; of the document at the threshold its first words that still fit."""
    part = F.floor(F.col("size") * F.col("rest") / F.col("group_size"))
    at = (_prefix(h) == F.col("threshold")) & (F.col("group_size") > 0)
    once = F.when(_prefix(h) < F.col("threshold"), F.col("size")).when(at, part).otherwise(0)
    return (F.col("repeats") * F.col("size") + once).cast("long")


def _with_plan(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    return rows.join(bounds.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _sizes(docs: DataFrame) -> DataFrame:
    return saved(docs.select(F.col("doc_id"), F.col("source"), word_count(whole_text()).alias("size"), _hash().alias("h")), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target and taken.

    ``docs`` needs doc_id, source and text. A document's size is its number of words (null text: 0);
    ``taken`` is the number of its words that the mix takes, repeats counted, at most ``most`` times its size.
    All documents of a source are taken equally often, those below its threshold once more, and of the one at
    the threshold the first words that still fit. A null source is a source of its own, last in order.
    Rows of one source that repeat both doc_id and text are treated alike. The choice depends on identifiers and texts alone, so reruns agree. Without
    documents, or without words, nothing is taken.
    """
    sizes = _sizes(docs)
    rows = _with_plan(sizes, plan(sizes, weights, most))
    return rows.select("doc_id", "size", "source_size", "target", _words("h").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The mix itself: whole rows of ``docs``, with all columns whatever their names, each as often as the mix takes it; the one at a threshold if at least half of it fits."""
    rows = docs.select(F.struct("*").alias("row"), F.col("source"), _hash().alias("h"))
    rows = _with_plan(rows, plan(_sizes(docs), weights, most)).withColumn("times", _times("h")).where("times > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
