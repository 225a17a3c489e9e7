"""Hierarchical multi-length packing.

Each document's tokens first fill windows of the longest context; what is left is routed to the
shortest context tier that holds it. Tiers are packed from the longest down: a window takes a
document of its tier, the gap is filled with whole documents of shorter tiers and at last with a
piece cut from one. Windows of each tier gather in step groups of equal token counts. A task packs the
documents of its own input split as they come, with a bounded pool, so nothing is shuffled; what is
left at its end goes to windows of powers of two, without padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, slices, table, whole_text
from .tokens import encoder

TIERS = (128, 256, 512, 1024)
#: Tokens of a step group: as many windows of one tier as make up this number.
STEP_TOKENS = 8192
#: A task packs when it holds so many tokens, and keeps half of them as choice for later windows.
POOL_TOKENS = 1 << 17

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, step_group long"


class Packer:
    """Packs pieces ``(doc, start, stop)``; ``doc`` is (doc_id, ids)."""

    def __init__(self, tiers: tuple[int, ...], task: int):
        self.tiers, self.longest = tiers, tiers[-1]
        self.pools: dict[int, deque] = {t: deque() for t in tiers}
        self.held = 0
        self.base = task << 36
        self.sequences = 0
        self.filled: dict[int, int] = {}
        self.groups: dict[int, int] = {}
        self.next_group = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        at, doc = 0, (doc_id, ids)
        while len(ids) - at >= self.longest:
            self._emit([(doc, at, at + self.longest)])
            at += self.longest
        if at < len(ids):
            self._pool((doc, at, len(ids)))

    def _pool(self, piece: tuple) -> None:
        n = piece[2] - piece[1]
        self.pools[next(t for t in self.tiers if t >= n)].append(piece)
        self.held += n

    def _take(self, tier: int) -> tuple:
        piece = self.pools[tier].popleft()
        self.held -= piece[2] - piece[1]
        return piece

    def _fill(self, window: list[tuple], gap: int) -> None:
        for tier in reversed(self.tiers):
            while gap and tier <= gap and self.pools[tier]:
                window.append(self._take(tier))
                gap -= window[-1][2] - window[-1][1]
        for tier in self.tiers:  # what fits is used up: a document is cut, of the shortest tier that has one
            while gap and self.pools[tier]:
                doc, start, stop = self._take(tier)
                cut = min(stop, start + gap)
                window.append((doc, start, cut))
                gap -= cut - start
                if cut < stop:
                    self._pool((doc, cut, stop))

    def pack(self, keep: int = 0) -> None:
        """Emit full windows, from the longest tier down, until at most ``keep`` tokens are held."""
        for tier in reversed(self.tiers):
            while self.pools[tier] and self.held >= max(tier, keep):
                first = self._take(tier)
                window = [first]
                self._fill(window, tier - (first[2] - first[1]))
                self._emit(window)

    def finish(self) -> None:
        self.pack()
        while self.held:
            size = 1 << (self.held.bit_length() - 1)
            window: list[tuple] = []
            self._fill(window, min(size, self.longest))
            self._emit(window)

    def _emit(self, window: list[tuple]) -> None:
        size = sum(stop - start for _, start, stop in window)
        if self.filled.get(size, 0) % max(1, STEP_TOKENS // size) == 0:
            self.groups[size] = self.next_group
            self.next_group += 1
        self.filled[size] = self.filled.get(size, 0) + 1
        offset = 0
        for (doc_id, ids), start, stop in window:
            crc = zlib.crc32(ids[start:stop].astype("<u4").tobytes())
            self.rows.append((doc_id, start, stop - start, crc, len(ids), self.base + self.sequences, offset, size, self.base + self.groups[size]))
            offset += stop - start
        self.sequences += 1


def packed(batches: Iterator[pa.RecordBatch], path: str, end: int, tiers: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, leading_blank=True)
    packer = Packer(tiers, TaskContext.get().partitionId())
    stop = np.array([end], dtype=enc.dtype)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def flush() -> pa.RecordBatch:
        columns = zip(*packer.rows, strict=True)
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
        packer.rows = []
        return out

    for batch, texts in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            packer.add(doc_id, np.concatenate((enc.encode(text), stop)))
        if packer.held >= POOL_TOKENS:
            packer.pack(POOL_TOKENS // 2)
        if packer.rows:
            yield flush()
    packer.finish()
    if packer.rows:
        yield flush()


def pack(docs: DataFrame, path: str, end: int = 0, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of packed sequences, one row each.

    ``docs`` needs doc_id and text; other columns are ignored. A document is its ids by the byte-level
    vocabulary at ``path`` and the id ``end``; a null text counts as empty and is its end id alone. Rows that
    repeat a doc_id are documents of their own. ``tiers`` are powers of two in ascending order. Every
    id is in exactly one piece, and every sequence has a power of two of tokens, at most the
    last tier. Returns doc_id, start (its document's ids before the piece), length, ids_crc32, doc_tokens,
    sequence_id, offset (in the sequence), context (the sequence's length) and step_group (sequences of one
    context that make up a step). An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lambda it: packed(it, path, end, tiers), SCHEMA)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
