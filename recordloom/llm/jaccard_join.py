"""N-gram Jaccard join by parity sketches.

Every text becomes its set of word shingles. A parity sketch is a long row of bits of which each shingle
flips one, so two sketches differ in at most as many bits as the sets differ in elements. Two sets of
sizes a and b with a Jaccard similarity of at least t differ in at most ``d = (a + b) * (1 - t) / (1 + t)``
elements. The sketch is cut to ``c`` blocks, one for every shingle's hash modulo ``c``, all of one length for the texts
of a size band; linked texts agree in at least ``c - d`` blocks (pigeonhole), and the blocks are the join keys. A block is
nearly empty, so it is kept as the XOR of hashes of its set bits, which flips cancel in just as they do in the
block. Texts at the upper end of a band also enter the next band, so that no admissible pair is parted by a band's edge.

A text joins by the ``d + 1`` rarest of its blocks only: of the blocks that linked texts agree in, the rarest is
among the ``d + 1`` rarest of both. So a block that many texts share (a common passage, or one without a flipped bit,
which counts as the most common of all) is a key only for a text that hardly has others; ``c`` grows with the band so
that the sparsest set of the band has more than ``d`` blocks with bits but for one set in ten thousand.

Copies are one class before anything is joined, and a class joins by its hub first: of the classes
that agree in a block, the one that agrees most often elsewhere. Only classes that hubs leave in different
components are compared with each other, a key of many classes in cells of bounded size, and only where a second, short
parity sketch of one to four bits a shingle allows a link by its Hamming distance. Every link is verified on the whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, free_name, slices, table, whole_text
from .components import components
from .wordhash import mix, shingles, word_hashes

#: Upper end of a band over its lower end.
BAND = Fraction(3, 2)
#: How many sets of the sparsest of a band may have too few blocks with bits; these take blocks without bits as keys too.
TOO_SPARSE = 1e-4
#: Bytes of a block in a stored sketch.
BLOCK_BYTES = 5
#: 64-bit words of the short sketch of a small set; it doubles until it has a bit for each element.
SHORT = 16
#: A side of a join is broadcast when it is counted to have at most so many rows of a few numbers each (some 40 MB).
BROADCAST_ROWS = 1_000_000
#: Rows of a key, or pairs of a text, that one task handles together.
CELL = 1000

SKETCHES = "doc_id long, n long, a long, b long, short array<long>, sketches array<struct<band:int,need:int,used:int,blocks:binary>>"


def most_apart(total: int, percent: int) -> int:
    """The largest symmetric difference of two sets with ``total`` elements in sum whose Jaccard similarity is at least ``percent``."""
    return total * (100 - percent) // (100 + percent)


def _sparse_share(elements: int, count: int, need: int) -> float:
    """Probability that ``elements`` hashes touch fewer than ``need`` of ``count`` blocks."""
    if elements > 300:
        empty = math.exp(elements * math.log1p(-1 / count))
        both = math.exp(elements * math.log1p(-2 / count)) if count > 2 else 0.0
        mean, var = count * (1 - empty), count * empty + count * (count - 1) * both - (count * empty) ** 2
        return 0.5 * math.erfc((mean - need + 0.5) / math.sqrt(2 * max(var, 1e-9)))
    touched = np.zeros(count + 1)
    touched[0] = 1
    stay = np.arange(count + 1) / count
    for _ in range(elements):
        touched[1:], touched[0] = touched[1:] * stay[1:] + touched[:-1] * (1 - stay[:-1]), 0
    return float(touched[:need].sum())


@lru_cache(maxsize=4096)
def blocks_of_band(band: int, percent: int) -> tuple[int, int]:
    """(blocks that a text needs as keys, blocks of a sketch) in a band; needs are one more than linked texts of the band may differ in."""
    need = most_apart(2 * math.floor(BAND ** (band + 1)), percent) + 1
    least = max(1, math.floor(BAND**band * percent / 100))
    if least < need:
        return need, need + 2
    count = need + 1
    while _sparse_share(least, count, need) > TOO_SPARSE and count < 16 * need:
        count += max(1, count // 64)
    return need, count


def bands_of(n: int, percent: int) -> list[int]:
    """The bands that a set of ``n`` elements enters."""
    band = max(0, int(math.log(n) / math.log(BAND)) - 1)
    while BAND ** (band + 1) <= n:
        band += 1
    return [band, band + 1] if n * 100 >= BAND ** (band + 1) * percent else [band]


def blocks(elements: np.ndarray, count: int) -> np.ndarray:
    """The blocks of the parity sketch of a set of hashes, each as the XOR of its set bits' hashes."""
    at = elements % np.uint64(count)
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order].astype(np.int64), prepend=-1))
    found = np.zeros(count, dtype=np.uint64)
    found[at[order][first]] = np.bitwise_xor.reduceat(mix(elements >> np.uint64(32))[order], first)
    return found >> np.uint64(64 - 8 * BLOCK_BYTES)


def short_sketch(elements: np.ndarray) -> np.ndarray:
    """A parity sketch of SHORT words, or of so many times two as give each element a bit; half as many words are its two halves combined."""
    bits = SHORT * 64
    while bits < 2 * len(elements):
        bits *= 2
    flips = np.bincount((elements >> np.uint64(24)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<u8")


def sketched(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, a 128-bit digest of the set, and its sketches."""
    inner = pa.struct([("band", pa.int32()), ("need", pa.int32()), ("used", pa.int32()), ("blocks", pa.binary())])
    for batch, texts in slices(batches):
        words, first = word_hashes(texts)
        n, a, b, short, out = [], [], [], [], []
        for i in range(len(texts)):
            s = shingles(words[first[i] : first[i + 1]], width)
            n.append(len(s))
            a.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
            b.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
            short.append(short_sketch(s).view(np.int64))
            row = []
            for band in bands_of(len(s), percent) if len(s) else []:
                need, count = blocks_of_band(band, percent)
                if need > 1:  # else only equal sets link, and those are one class
                    found = blocks(s, count)
                    raw = found.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BLOCK_BYTES :].tobytes()
                    row.append({"band": band, "need": need, "used": int(np.count_nonzero(found)), "blocks": raw})
            out.append(row)
        columns = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(short, pa.list_(pa.int64())), pa.array(out, pa.list_(inner))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "a", "b", "short", "sketches"])


def _verified(batches: Iterator[pa.RecordBatch], percent: int, width: int) -> Iterator[pa.RecordBatch]:
    """Of rows (u, v, text of u, text of v) the pairs that link."""

    def elements(text: str) -> np.ndarray:
        words, _ = word_hashes([text])
        return shingles(words, width)

    before, p = None, None
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = x.as_py(), y.as_py()
            if x != before:  # rows come by u, so a hub's text is mostly the one before
                before, p = x, elements(x)
            q = elements(y)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _may_link(na: str, fa: str, nb: str, fb: str, percent: int) -> Column:
    """Whether sizes and short sketches allow a link; sizes in the bounds differ so little that the longer sketch is halved a known number of times."""
    x, y = F.col(fa), F.col(fb)

    def halved(s: Column, other: Column) -> Column:
        half = (F.size(s) / 2).cast("int")
        return F.when(F.size(s) > F.size(other), F.zip_with(F.slice(s, F.lit(1), half), F.slice(s, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(s)

    for _ in range(math.ceil(math.log2(100 / percent)) or 1):
        x, y = halved(x, y), halved(y, x)
    apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, p: s + p)
    bound = F.floor((F.col(na) + F.col(nb)) * (100 - percent) / F.lit(100 + percent))
    small, large = F.least(na, nb), F.greatest(na, nb)
    return (small * 100 >= large * percent) & (apart <= bound)


def _only(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` with (or without) a match in ``keys``; keys are broadcast if they are counted to be few, else both sides are shuffled."""
    few = keys.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, on, how)


def _key_rows(classes: DataFrame) -> DataFrame:
    """(key, node, band) of the blocks that may be keys: those with bits, or all of a set that has too few of these."""
    s = classes.select("node", F.explode("sketches").alias("s")).select("node", "s.*")
    s = s.withColumn("at", F.explode(F.sequence(F.lit(0), (F.length("blocks") / BLOCK_BYTES).cast("int") - 1)))
    s = s.withColumn("block", F.expr(f"substring(blocks, at * {BLOCK_BYTES} + 1, {BLOCK_BYTES})"))
    with_bits = F.col("block") != F.lit(bytes(BLOCK_BYTES))
    return s.where(with_bits | (F.col("used") < F.col("need"))).select(F.xxhash64("band", "at", "block").alias("key"), "node", "band")


def _rarest(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """The shared blocks of each text and band that are among its rarest; blocks that no other text has are rarer and not here.

    Of ``used`` blocks with bits linked texts share more than ``used - need``, so the rarest that they share is never among those left
    out, whatever else either has. A set with too few blocks with bits leaves out none.
    """
    bounds = classes.select("node", F.explode("sketches").alias("s")).select("node", "s.band", "s.need", "s.used")
    own = Window.partitionBy("node", "band")
    ranked = shared.join(bounds, ["node", "band"]).withColumn("rank", F.row_number().over(own.orderBy("many", "key"))).withColumn("mine", F.count("*").over(own))
    alone = F.col("used") - F.col("mine")
    return ranked.where((F.col("used") < F.col("need")) | (F.col("rank") + alone <= F.col("need"))).select("key", "node", "many")


def linked_classes(classes: DataFrame, docs: DataFrame, percent: int, width: int, at: Scratch) -> DataFrame:
    """(node, root) for each class of equal sets that links with another; a class is named by its smallest doc_id."""
    same = Window.partitionBy("key")
    shared = at.save(_key_rows(classes).withColumn("many", F.count("*").over(same)).where("many > 1"), "shared-keys")
    shared = at.save(_rarest(shared, classes), "rarest-keys")
    if shared.isEmpty():
        return at.save(shared.select("node", F.col("node").alias("root")), "roots")
    weight = at.save(shared.groupBy("node").agg(F.sum("many").alias("weight")), "weights")
    short = at.save(_only(classes, weight.select("node"), ["node"]).select("node", "n", "short"), "short-sketches")

    def sides(rows: DataFrame, u: str, v: str) -> DataFrame:
        """``rows`` with sizes and short sketches of both classes, where these allow a link."""
        for c in (u, v):
            rows = rows.join(short.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("short").alias(f"short_{c}")), c)
        return rows.where(_may_link(f"n_{u}", f"short_{u}", f"n_{v}", f"short_{v}", percent))

    def side(pairs: DataFrame, c: str, name: str) -> DataFrame:
        """``pairs`` with the text of one side; the pairs of a text, where they are many, are dealt to several tasks."""
        cells = pairs.groupBy(c).agg((F.count("*") / CELL).cast("int").alias("cells"))
        dealt = pairs.join(cells, c).withColumn("cell", F.pmod(F.xxhash64("u", "v"), F.col("cells") + 1).cast("int"))
        few = pairs.count() <= BROADCAST_ROWS
        copies = docs.join(F.broadcast(cells) if few else cells, docs["doc_id"] == cells[c]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells"))))
        return dealt.drop("cells").join(copies.select(F.col("doc_id").alias(c), "cell", F.col("text").alias(name)), [c, "cell"]).select("u", "v", name)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        bounded_batches(docs.sparkSession)
        both = side(pairs, "u", "x").join(side(pairs, "v", "y"), ["u", "v"])
        return at.save(both.mapInArrow(lambda it: _verified(it, percent, width), "u long, v long").distinct(), name)

    # hubs: every class against one class, of those it shares a key with, that agrees most elsewhere
    hub = F.max(F.struct("weight", F.negative("node").alias("minus"))).over(same)
    star = shared.join(weight, "node").withColumn("h", hub).select("node", F.col("h.weight").alias("weight"), F.negative("h.minus").alias("hub")).where("node <> hub").distinct()
    star = sides(star, "node", "hub").groupBy("node").agg(F.max_by("hub", F.struct("weight", F.negative("hub"))).alias("hub"))
    pairs = at.save(star.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct(), "hub-pairs")
    links = verified(pairs, "hub-links")
    roots = at.save(components(links, "u", "v", at), "roots")

    # the rest: classes of a key that hubs have not brought together, a key of many classes in cells of a few
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), (F.count("*") / CELL).cast("int").alias("cells")).where("lo < hi")
    placed = placed.drop("many").join(apart.select("key", "cells"), "key").join(short, "node")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("cells") + 1).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells"))))
    placed = placed.withColumn("cell", F.struct(F.least("own", "other"), F.greatest("own", "other")))
    a, b = (placed.select("key", "cell", "own", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "short", "root")]) for x in "uv")
    here = (a["key"] == b["key"]) & (a["cell"] == b["cell"]) & (F.col("node_u") < F.col("node_v")) & (F.col("root_u") != F.col("root_v"))
    rest = a.join(b, here & _may_link("n_u", "short_u", "n_v", "short_v", percent)).select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct()
    rest = at.save(rest.join(pairs, ["u", "v"], "left_anti"), "other-pairs")
    if rest.isEmpty():
        return roots
    more = verified(rest, "other-links")
    if more.isEmpty():
        return roots
    return at.save(components(links.union(more), "u", "v", at), "roots")


def jaccard_components(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Components of documents under "Jaccard similarity of the shingle sets is at least ``percent`` / 100".

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored. Returns one row per
    input row: doc_id, n_shingles (size of its set) and component_id (smallest doc_id reachable by
    links, itself included).

    A text of fewer than ``width`` words has its whole sequence as one shingle. A null text, an empty one
    and one without words have no shingle, link with nothing and keep their own doc_id. Rows that repeat
    a doc_id are returned once each; if their texts differ, the id links where one of them does. Rows with a null doc_id link
    with nothing and have a null component_id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    at = Scratch(spark, "jaccard-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    every = at.save(docs.mapInArrow(lambda it: sketched(it, width, percent), SKETCHES), "sketches")
    marks = at.save(every.select("doc_id", "n", "a", "b"), "sizes")
    sets = every.where("n > 0 and doc_id is not null")
    node = sets.groupBy("a", "b", "n").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    node = at.save(node, "classes")
    copies = sets.select("doc_id", "a", "b", "n").join(node.where("copies > 1"), ["a", "b", "n"]).where("doc_id <> node").select("doc_id", "a", "b").distinct()
    classes = _only(sets, at.save(copies, "copies"), ["doc_id", "a", "b"], "left_anti").select(F.col("doc_id").alias("node"), "n", "short", "sketches")
    roots = linked_classes(classes, docs, percent, width, at)
    at.keep("sizes", "classes", "roots")
    named = node.where("copies > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    alone = roots.join(node.where("copies = 1").select("node"), "node").select(F.col("node").alias("doc_id"), F.col("root").alias("alone"))
    out = marks.select("doc_id", F.col("n").alias("n_shingles"), "a", "b", "n")
    out = out.join(named.select("a", "b", "n", "root"), ["a", "b", "n"], "left").join(alone.dropDuplicates(["doc_id"]), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "alone", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The documents without near copies: of each component the document of the smallest doc_id stays, with all its columns.

    Rows with a null doc_id, and those without words, stay. Of rows that repeat the smallest doc_id all stay.
    """
    found = jaccard_components(docs, percent, width).where("component_id < doc_id").select("doc_id").distinct()
    drop = found.toDF(free_name(docs, "drop"))
    return docs.join(drop, docs["doc_id"].cast("long") == drop[drop.columns[0]], "left_anti")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=90, width=3)
