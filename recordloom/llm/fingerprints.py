"""Document fingerprints by closed syncmers, in built-in functions only.

A text is its words, with ``K`` - 1 blanks before and after them. Of every run of ``K`` words the hashes of the inner runs
of two words are compared: the run is an anchor if the smallest of them stands at its beginning or
end. Whether a run is an anchor depends on its own words alone, never on what surrounds it, so a passage has the
same anchors wherever it stands, at least one in any ``K`` - 2 runs, and the rule is one for texts of all sizes.

The fingerprint lists the anchors in order: a hexadecimal digit for the runs since the anchor before (for the first, those before it), and eight for the
anchor; a last digit counts the runs from the last to the end. So it tells every anchor's place, from the beginning and from the
end. Likeness matches anchors by place: an anchor counts for two texts if both have it in the same stretch of ``STRETCH``
runs from the beginning, or in the same from the end, which survive what is changed, added or left out elsewhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, Scratch, table, whole_text

#: Words of a run (a power of two); its inner runs have two, so an anchor follows within ``K`` - 1 runs.
K = 8
STRETCH = 64
#: The blank before and after a text, the first whose run of two has a hash so near the largest that it is hardly ever the smallest.
PAD = 15957
_PLACE = 31  # bits of an anchor's place, below those of its hash
_MASK = (1 << _PLACE) - 1
#: Documents that are in order next to each other go to one partition, about so many, in at most so many blocks.
BLOCK_ROWS, BLOCKS = 2048, 20_000
#: A task gets about so many blocks at most.
BLOCKS_A_TASK = 16


def _ahead(a: str, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(F.col(a), F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def _pairs(a: str, by: int, f) -> Column:
    """f of the elements at i and i + ``by``, where both are."""
    both = F.slice(F.col(a), F.lit(1), F.greatest(F.size(a) - by, F.lit(0)))
    return F.zip_with(both, _ahead(a, by), f)


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the anchors of a text column in text order: struct of ``at`` (an array, each a 32-bit hash over the place of its run) and ``runs``."""
    w = K - 1
    trimmed = F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    keep = rows.columns
    edge = F.array_repeat(F.lit(PAD).cast("long"), K - 1)
    words = F.transform(F.split(trimmed, WORD_GAP), lambda x: F.xxhash64(x))
    rows = rows.withColumn("_h", F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(F.concat(edge, words, edge)))
    rows = rows.withColumn("_r", _pairs("_h", 1, lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("_m", F.col("_r"))
    size = 1
    while size < w:  # smallest of w inner runs, by doubling
        step = min(size, w - size)
        rows = rows.withColumn("_m", _pairs("_m", step, lambda a, b: F.least(a, b)))
        size += step
    rows = rows.withColumn("_k", F.col("_r"))
    size = 2
    while size < K:  # hash of the whole run
        rows = rows.withColumn("_k", _pairs("_k", size, lambda a, b: F.xxhash64(a, b)))
        size *= 2
    ends = F.zip_with(F.zip_with("_r", "_m", lambda a, b: a == b), F.zip_with(_ahead("_r", w - 1), F.col("_m"), lambda a, b: a == b), lambda a, b: a | b)
    hashed = F.zip_with(ends, F.col("_k"), lambda e, k: F.when(e, F.shiftleft(k.bitwiseAND(F.lit(0xFFFFFFFF)), _PLACE)))
    runs = F.filter(F.transform(hashed, lambda x, i: x.bitwiseOR(i.cast("long"))), lambda x: x.isNotNull())
    return rows.withColumn(out, F.struct(runs.alias("at"), F.size("_m").alias("runs"))).select(*keep, out)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MASK))


def as_text(anchors: str) -> Column:
    """The fingerprint: gap and hash of each anchor, and the gap after the last."""
    at, runs = F.col(f"{anchors}.at"), F.col(f"{anchors}.runs")
    before = F.concat(F.array(F.lit(0).cast("long")), at)
    gap = lambda x, p: F.shiftleft(_place(x) - _place(p), 32)
    each = F.zip_with(at, F.slice(before, F.lit(1), F.size(at)), lambda x, p: F.substring(F.hex(F.shiftright(x, _PLACE) + gap(x, p) + F.lit(1 << 36)), 2, 9))
    last = F.hex(runs - _place(F.element_at(before, -1)))
    return F.when(runs == 0, F.lit("")).otherwise(F.lower(F.concat(F.array_join(each, ""), last)))


def likeness(a: str, b: str) -> Column:
    """Anchors that both texts have in one place, as a share of the anchors that either has; two without any are alike."""
    start = lambda s: F.transform(f"{s}.at", lambda x: (x - _place(x)).bitwiseOR(F.floor(_place(x) / STRETCH)))
    end = lambda s: F.transform(f"{s}.at", lambda x: (x - _place(x)).bitwiseOR(F.floor((F.col(f"{s}.runs") - 1 - _place(x)) / STRETCH)))
    only = lambda found: F.transform(found, lambda x: F.shiftright(x, _PLACE))
    every = F.size(F.array_union(only(F.col(f"{a}.at")), only(F.col(f"{b}.at"))))
    both = F.size(F.array_union(only(F.array_intersect(start(a), start(b))), only(F.array_intersect(end(a), end(b)))))
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, h, text) with ``block``: blocks in order of (doc_id, h) and of about equal numbers of rows, whatever the identifiers are.

    Their bounds are quantiles of the identifiers; a document looks up those of its cell, of equally wide cells. Null identifiers come first, in blocks by ``h``.
    """
    spark = rows.sparkSession
    n, some, low, high = rows.agg(F.count("*"), F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    blocks, nulls = (max(1, min(BLOCKS, math.ceil(k / BLOCK_ROWS))) for k in (some, n - some))
    bounds: list[int] = []
    if blocks > 1 and low < high:
        shares = ",".join(str(i / blocks) for i in range(1, blocks))
        bounds = sorted(set(rows.agg(F.expr(f"percentile_approx(doc_id, cast(split('{shares}', ',') as array<double>), {20 * blocks})")).first()[0]))
    cells = 4 * blocks
    wide = (float(high) - float(low)) / cells if bounds else math.inf
    wide = wide or math.inf
    cell = lambda x: int((float(x) - float(low)) / wide)
    held: dict[int, list[int]] = {c: [] for c in range(cells + 1)}
    for b in bounds:
        held.setdefault(cell(b), []).append(b)
    lookup, before = [], 0
    for c in sorted(held):
        lookup.append((c, before, held[c]))
        before += len(held[c])
    by_hash = F.floor((F.col("h") / F.lit(2.0**64) + F.lit(0.5)) * nulls).cast("long") - nulls
    rows = rows.withColumn("cell", ((F.col("doc_id").cast("double") - F.lit(float(low or 0))) / F.lit(wide)).cast("long"))
    known = spark.createDataFrame(lookup, "cell long, before long, bounds array<long>")
    rows = rows.join(F.broadcast(known), "cell", "left")  # at most 4 * BLOCKS + 1 rows
    inside = F.size(F.filter("bounds", lambda b: b <= F.col("doc_id")))
    return rows.select(F.when(F.col("doc_id").isNull(), by_hash).otherwise(F.col("before") + inside).cast("long").alias("block"), "doc_id", "h", "text")


def _with_next(rows: DataFrame, at: Scratch) -> tuple[DataFrame, int]:
    """Rows (block, mark, doc_id, h, text), with one more per block, of mark 1: the first text of the next block (after the last: of the first); and the number of blocks."""
    least = rows.groupBy("block").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    order = Window.orderBy("block")  # one row per block, of which there are at most 2 * BLOCKS
    least = least.withColumn("next", F.lead("block").over(order)).withColumn("next", F.coalesce("next", F.min("block").over(Window.partitionBy(F.lit(1)))))
    least = at.save(least, "blocks")
    key = least.select(F.col("block").alias("b"), F.col("first.doc_id").alias("d"), F.col("first.h").alias("k"))
    same = (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k"))
    firsts = rows.join(F.broadcast(key), same).groupBy("block").agg(F.min("text").alias("text"))
    ends = least.select(F.col("block").alias("own"), "next").join(firsts, F.col("next") == F.col("block"))
    ends = ends.select("own", F.lit(1), F.lit(None).cast("long"), F.lit(None).cast("long"), "text")
    return rows.select("block", F.lit(0).alias("mark"), "doc_id", "h", "text").union(ends), least.count()


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document in ascending order of doc_id; the last one's next is the first. A null doc_id
    comes before all others; rows that repeat a doc_id, or have none, follow each other in order of hashes of their texts. A null or
    empty text, or one without words, has an empty fingerprint. Equal texts have equal fingerprints. Other columns are ignored; an empty
    table gives an empty result.
    """
    at = Scratch(docs.sparkSession, "fingerprints")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = _blocked(rows.select("doc_id", F.xxhash64("text").alias("h"), "text"))
    rows, blocks = _with_next(rows, at)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks // BLOCKS_A_TASK)
    rows = with_anchors(rows.repartition(tasks, "block"), "text", "anchors")
    order = Window.partitionBy("block").orderBy("mark", F.col("doc_id").asc_nulls_first(), "h", "text")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_anchors", F.lead("anchors").over(order)).where("mark = 0")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    rows = rows.select("doc_id", "n_chars", "edited", F.sha2("edited", 256).alias("edited_sha256"), "anchors", "next_anchors")
    rows = with_anchors(rows, "edited", "edited_anchors")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text("anchors").alias("fingerprint"), as_text("edited_anchors").alias("edited_fingerprint"), likeness("anchors", "edited_anchors").alias("near_edited"), likeness("anchors", "next_anchors").alias("near_next"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
