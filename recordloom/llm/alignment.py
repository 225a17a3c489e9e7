"""Aligning the tokens of two tokenizers by the bytes where they end, on Arrow tables.

In a task, the ids of some documents are list arrays: flattened, with parent indices, they give the bytes of every token,
and cumulative sums of the lengths, less the sum at the beginning of the document, the offset where each token
ends. A hash join of both sides on document and end gives the links, and ``Table.group_by`` their partial counts
per pair of ids. Spark merges these counts, finds each B id's greatest, and joins them back to the links of the documents, which
are kept as distinct pairs with their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, slices, table, whole_text
from .tokens import Encoder

#: Distinct pairs of ids that are broadcast, 20 bytes each; more are joined by shuffle, in so many parts per pair.
BROADCAST_PAIRS, SALTS = 1 << 21, 32
#: Texts that one step aligns, in characters.
STEP_CHARS = 1 << 19
ALIGNED = "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>, part_pairs array<long>, part_counts array<long>"


class Side:
    """One tokenizer: the bytes of its ids, and ids as text with what may follow them in a group."""

    def __init__(self, token_bytes: list[bytes], after: str, last: str):
        self.bytes = pa.array(token_bytes, pa.binary())
        self.lengths = pc.binary_length(self.bytes).cast(pa.int64())
        self.size = len(token_bytes)
        self.names = [f"{i}{end}" for i in range(self.size) for end in (after, last)]


class Pair:
    """Tokenizers A (byte-level, a file of the tokenizers library) and B (a sentencepiece model)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.encoder = Encoder(path_a, leading_blank=True)
        self.encoder.tokenizer.encode_special_tokens = True
        back = {letter: byte for byte, letter in self.encoder.letters.items()}
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        entries = [""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            entries[i] = entry
        self.a = Side([bytes(back[c] for c in e) if all(c in back for c in e) else e.encode() for e in entries], ",", "|")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = range(self.model.get_piece_size())
        self.b = Side([bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in pieces], ",", ";")
        self.names = pa.array(self.a.names + self.b.names)
        self.lead = len(self.encoder.encode("x"))

    def ids_a(self, text: str) -> np.ndarray:
        """Ids of a blank and the text: a letter before them is always a match by itself, and its ids are left out."""
        return self.encoder.encode("x " + text)[self.lead :] if text else np.empty(0, dtype=np.int64)


def _lists(ids: list) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
    flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids]) if ids else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def _content(side: Side, lists: pa.ListArray) -> list[memoryview]:
    """Joined bytes of each document's tokens."""
    joined = side.bytes.take(pc.list_flatten(lists))
    ends = np.frombuffer(joined.buffers()[1], dtype=np.int32, count=len(joined) + 1)[np.asarray(lists.offsets)] if len(joined) else np.zeros(len(lists) + 1, dtype=np.int32)
    data = memoryview(joined.buffers()[2] or b"").cast("B")
    return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _ends(side: Side, lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Document and end, in one number, of every token; the offsets of a document are cumulative sums of its own lengths."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(side.lengths.take(flat))
    starts = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(lists.offsets)
    inside = pc.subtract(running, starts.take(parent))
    return pc.add(pc.shift_left(parent.cast(pa.int64()), pa.scalar(40, pa.int64())), inside), flat


def align(pair: Pair, texts: list[str]) -> dict[str, list]:
    """Columns of ``ALIGNED`` but the first two for some texts, the partial counts in the first row."""
    plain = [t.encode() for t in texts]
    a, b = _lists([pair.ids_a(t) for t in texts]), _lists(pair.model.encode(texts, num_threads=1))
    sound = [bool(t) and x == b" " + t and y == x for t, x, y in zip(plain, _content(pair.a, a), _content(pair.b, b), strict=True)]
    if not all(sound):
        mask = pa.array(sound)
        empty = pa.scalar([], a.type)
        a, b = pc.if_else(mask, a, empty), pc.if_else(mask, b, empty)
        a, b = (pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(pc.list_value_length(x).to_numpy()))), pa.int32()), pc.list_flatten(x)) for x in (a, b))
    (ends_a, ids_a), (ends_b, ids_b) = _ends(pair.a, a), _ends(pair.b, b)
    links = pa.table({"end": ends_a, "a": ids_a}).join(pa.table({"end": ends_b, "b": ids_b}), "end", join_type="inner", use_threads=False)
    links = links.append_column("doc", pc.shift_right(links["end"], pa.scalar(40, pa.int64())))
    links = links.append_column("pair", pc.add(pc.multiply(links["a"], pair.b.size), links["b"]))
    total = links.group_by("pair", use_threads=False).aggregate([("end", "count")])
    own = links.group_by(["doc", "pair"], use_threads=False).aggregate([("end", "count")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    n, docs = len(texts), np.arange(len(texts) + 1)
    cuts = np.searchsorted(own["doc"].to_numpy(), docs)
    own_pairs, own_times = own["pair"].to_numpy(), own["end_count"].to_numpy()
    borders = np.sort(links["end"].to_numpy())
    borders = borders[np.diff(borders, prepend=-1) > 0]
    return {
        "n_a": pc.list_value_length(a).cast(pa.int64()),
        "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": pa.array(np.diff(np.searchsorted(borders, docs << 40)), pa.int64()),
        "n_links": pa.array(np.bincount(links["doc"].to_numpy(), minlength=n), pa.int64()),
        "groups_sha256": pa.array(_group_digests(pair, np.asarray(ends_a), np.asarray(ids_a), np.asarray(ends_b), np.asarray(ids_b), borders, n)),
        "pairs": pa.array([own_pairs[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int64())),
        "times": pa.array([own_times[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int64())),
        "part_pairs": pa.array([total["pair"].to_numpy()] + [None] * (n - 1), pa.list_(pa.int64())),
        "part_counts": pa.array([total["end_count"].to_numpy()] + [None] * (n - 1), pa.list_(pa.int64())),
    }


def _group_digests(pair: Pair, ends_a: np.ndarray, ids_a: np.ndarray, ends_b: np.ndarray, ids_b: np.ndarray, borders: np.ndarray, n: int) -> list[str]:
    """Digest of each document's groups: the ids of both sides as text in the order of the groups, A's before B's."""
    group = np.concatenate((np.searchsorted(borders, ends_a), np.searchsorted(borders, ends_b)))
    side = np.repeat([0, 1], (len(ids_a), len(ids_b)))
    order = np.argsort(group * 2 + side, kind="stable")
    run = (group * 2 + side)[order]
    last = np.append(run[1:] != run[:-1], True) if len(run) else np.empty(0, dtype=bool)
    name = 2 * (np.concatenate((ids_a, ids_b)) + side * pair.a.size)[order] + last
    text = pair.names.take(pa.array(name, pa.int64()))
    doc = np.concatenate((ends_a, ends_b))[order] >> 40
    cuts = np.searchsorted(doc, np.arange(n + 1))
    places = np.frombuffer(text.buffers()[1], dtype=np.int32, count=len(text) + 1) if len(text) else np.zeros(1, dtype=np.int32)
    data = memoryview(text.buffers()[2] or b"")
    spans = zip(places[cuts[:-1]].tolist(), places[cuts[1:]].tolist(), strict=True)
    return [hashlib.sha256(data[start : stop - 1]).hexdigest() if stop > start else "" for start, stop in spans]


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """This worker's tokenizers."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    pair, at = pair_of(path_a, path_b), TaskContext.get().partitionId() << 40
    for batch, texts in slices(batches, STEP_CHARS):
        columns = {"row_id": pa.array(range(at, at + len(texts)), pa.int64()), "doc_id": batch.column(0)} | align(pair, texts)
        at += len(texts)
        yield pa.RecordBatch.from_pydict(columns)


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair (A id times the size of B, and B id), its links over all documents, and whether no pair of its B id has more."""
    part = aligned.select(F.explode(F.arrays_zip("part_pairs", "part_counts")).alias("p"))
    counts = part.groupBy(F.col("p.part_pairs").alias("pair")).agg(F.sum("p.part_counts").alias("n"))
    best = counts.groupBy(F.pmod("pair", F.lit(size_b)).alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", F.pmod("pair", F.lit(size_b))).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, size_b: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs``: the tokens, groups and links of both tokenizers, with the corpus-wide counts of its links.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. A null or empty text, and one whose tokens do
    not give a blank and the text in both tokenizers, has no tokens: zeros and an empty digest. Rows that repeat, or have no
    doc_id, give a row each and count each; an empty table gives an empty result. ``size_b`` is at least the
    number of B's ids. The table of pair counts is broadcast if it has at most ``broadcast_pairs`` rows; otherwise links
    meet it in a shuffle, where every pair is in ``SALTS`` parts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    at = Scratch(spark, "alignment")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    aligned = at.save(rows.mapInArrow(lambda it: _aligned(it, path_a, path_b), ALIGNED), "aligned")
    counts = at.save(link_counts(aligned, size_b), "counts")
    links = aligned.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row_id", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    if counts.count() <= broadcast_pairs:
        met = links.join(F.broadcast(counts), "pair")
    else:
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = links.withColumn("salt", F.pmod("row_id", F.lit(SALTS))).join(salted, ["pair", "salt"])
    sums = met.groupBy("row_id").agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    kept = aligned.select("row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row_id", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return kept.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    import sentencepiece

    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return aligned_documents(table(spark, sf_dir, "documents"), path_a, path_b, size_b)
