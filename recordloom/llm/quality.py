"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The inputs x are the text's words, hashed to buckets with logarithmic counts of unit length, and
standardised statistics of its characters, words and lines. The pairwise term costs as much as
the linear one, by the sum-of-squares identity. The machine is fitted in numpy on a bounded sample
of labelled rows; scoring is one pass over the texts, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, slices, table, whole_text
from .wordhash import word_hashes

BUCKETS = 1 << 15
FACTORS = 8
#: At most so many labelled rows are used for fitting, those of the smallest hashed doc_id.
FIT_ROWS = 6000
THRESHOLD = 0.7
HELD_OUT = 2
_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32,), "other": range(128, 256), "stop": b".", "comma": b",", "bang": b"!", "bar": b"|", "sign": b"#$%&*@^~", "mark": b"\"'()[]{}<>:;?/\\_-+="}
_KIND_OF = np.zeros(256, dtype=np.int64)
for _i, _chars in enumerate(_KINDS.values(), 1):
    _KIND_OF[list(_chars)] = _i
STATISTICS = len(_KINDS) + 11


def statistics(text: str, raw: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of kinds of characters, and how long and how repetitive words and lines are."""
    n, w = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(_KIND_OF[raw], minlength=len(_KINDS) + 1)[1:] / n
    lines = text.split("\n")
    length = np.fromiter(map(len, lines), dtype=float, count=len(lines))
    pairs = len(np.unique(words[:-1] + words[1:] * np.uint64(3))) / max(1, len(words) - 1)
    top = counts.max(initial=0) / w
    return np.concatenate((kinds, [
        np.log1p(len(words)), np.log1p(len(lines)), n / w, np.log1p(length.mean()), np.log1p(length.std()),
        len(counts) / w, top, pairs, len(set(lines)) / len(lines), np.count_nonzero(counts == 1) / w, float(len(words) == 0),
    ]))


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text: word buckets, their values, and the statistics."""
    hashes, first = word_hashes(texts, lower=False)
    for i, text in enumerate(texts):
        own = hashes[first[i] : first[i + 1]]
        bucket, counts = np.unique((own >> np.uint64(64 - 15)).astype(np.int32), return_counts=True)
        value = np.log1p(counts)
        value = value / max(1e-9, np.sqrt((value * value).sum()))
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        yield bucket, value.astype(np.float32), statistics(text, raw, own, counts)


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    std: np.ndarray

    def inputs(self, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = np.clip((stats - self.mean) / self.std, -4, 4) / np.sqrt(STATISTICS)
        return np.concatenate((bucket, np.arange(BUCKETS, BUCKETS + STATISTICS, dtype=bucket.dtype))), np.concatenate((value, scaled.astype(np.float32)))

    def score(self, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> float:
        index, x = self.inputs(bucket, value, stats)
        vx = self.v[index] * x[:, None]
        total = vx.sum(axis=0)
        z = self.bias + float(self.w[index] @ x) + 0.5 * float(total @ total - (vx * vx).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 14, rate: float = 0.08, decay: float = 1e-4) -> Machine:
    """Logistic loss, AdaGrad, small batches in an order that a seed fixes. Without both labels the score is the labels' mean."""
    stats = np.array([r[2] for r in rows]) if rows else np.zeros((1, STATISTICS))
    rng = np.random.default_rng(7)
    size = BUCKETS + STATISTICS
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32), stats.mean(0), stats.std(0) + 1e-6)
    if len(set(labels.tolist())) < 2:
        m.v[:] = 0
        return m
    data = [m.inputs(*r) for r in rows]
    gw, gv, gb = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 32):
            part = order[at : at + 32]
            index = np.concatenate([data[i][0] for i in part])
            x = np.concatenate([data[i][1] for i in part])
            begin = np.cumsum([0, *(len(data[i][0]) for i in part[:-1])])
            size_of = np.diff([*begin, len(index)])
            vx = m.v[index] * x[:, None]
            total = np.add.reduceat(vx, begin, axis=0)
            z = m.bias + np.add.reduceat(m.w[index] * x, begin) + 0.5 * ((total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), begin))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            e = np.repeat(error, size_of).astype(np.float32) * x
            own, back = np.unique(index, return_inverse=True)
            dw = np.bincount(back, e, len(own)).astype(np.float32) + decay * m.w[own]
            each = e[:, None] * (np.repeat(total, size_of, axis=0) - vx)
            dv = np.stack([np.bincount(back, each[:, f], len(own)) for f in range(FACTORS)], 1).astype(np.float32) + decay * m.v[own]
            gw[own] += dw * dw
            gv[own] += dv * dv
            gb += float(error.sum()) ** 2
            m.w[own] -= rate * dw / np.sqrt(gw[own])
            m.v[own] -= rate * dv / np.sqrt(gv[own])
            m.bias -= rate * float(error.sum()) / np.sqrt(gb)
    return m


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never used for fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        bucket, value, stats = zip(*features(texts), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(bucket), pa.list_(pa.int32())), pa.array(list(value), pa.list_(pa.float32())), pa.array(list(stats), pa.list_(pa.float64()))], names=["doc_id", "quality", "bucket", "value", "stats"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on at most ``fit_rows`` labelled documents that are not held out; only their features come to the driver, at most ``BUCKETS`` numbers each.

    Labels that contradict each other count for nothing; of rows that repeat a doc_id the smallest text counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and id is not null").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most").orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text")).join(F.broadcast(known), "id")
    rows = rows.groupBy("id", "quality").agg(F.min("text").alias("text"))
    found = rows.mapInArrow(_featured, "doc_id long, quality int, bucket array<int>, value array<float>, stats array<double>").toArrow()
    found = found.sort_by([("doc_id", "ascending")]).combine_chunks()
    each = lambda c: [x.values.to_numpy() for x in found.column(c)]
    return fit(list(zip(each("bucket"), each("value"), each("stats"), strict=True)), np.array(found.column("quality").to_pylist(), dtype=float))


def _scored(batches: Iterator[pa.RecordBatch], machine: Machine) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        scores = [machine.score(*f) for f in features(texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= threshold, else 0).

    Only the whole text is an input; a null text counts as empty and gets a score too, and so does a very long one.
    Rows may repeat; other columns are ignored. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = rows.mapInArrow(lambda it: _scored(it, machine), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _accepted(batches: Iterator[pa.RecordBatch], machine: Machine, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        yield batch.filter(pa.array([machine.score(*f) >= threshold for f in features(texts)], pa.bool_()))


def accepted(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns, without the rows whose score is below ``threshold``."""
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(lambda it: _accepted(it, machine, threshold), docs.schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
