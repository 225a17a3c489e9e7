"""Byte-level BPE in linear time: longest matches from an automaton, mended by backtracking.

A text is cut by the vocabulary's pattern, and every match is encoded by itself. Its bytes become one
Latin-1 character each, so that an automaton over strings finds, in one pass, the longest token
that starts at every byte. The encoder takes longest tokens from left to right. A token may follow another
only if the merges, applied to the two together, would leave the border between them; this is found by
undoing merges from the border outwards and is remembered per pair of ids. If a token does not fit, the longest
token that is its prefix is tried, and if none is left, the token before is taken back and the position is
marked as a dead end. Every position is given up at most once, so the work is linear in the bytes.

Neighbours that all keep their borders are what the merges give: a merge always joins two neighbours.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, slices, table, whole_text

#: Bytes of one generation of remembered matches, with ``ENTRY_BYTES`` besides the match and its ids for each; pairs of ids that are remembered.
KEEP_BYTES, ENTRY_BYTES, KEEP_PAIRS = 48 << 20, 160, 1 << 20
#: Longer matches are encoded each time.
KEEP_MATCH = 64
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with a base64 token and a number a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class BytePairs:
    """Encodes and decodes by a table of ranks; a rank is the id of its token. All 256 single bytes must be tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep: int = KEEP_BYTES):
        import ahocorasick
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a single byte is no token")
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.token = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.keep, self.held = keep, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: Tokens that merging can make; others are met as whole matches only.
        self.made: set[bytes] = set()
        for token in sorted(ranks, key=ranks.__getitem__):
            parts = self._merged(token, ranks[token])
            if len(parts) <= 2:
                self.made.add(token)
                if len(parts) == 2:
                    self.halves[ranks[token]] = (ranks[parts[0]], ranks[parts[1]])
        self.automaton = ahocorasick.Automaton()
        for token in self.made:
            self.automaton.add_word(token.decode("latin-1"), (ranks[token], len(token)))
        self.automaton.make_automaton()
        self.shorter = {ranks[t]: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.made), -1) for t in self.made}

    def _merged(self, data: bytes, below: int) -> list[bytes]:
        """One token's bytes after all merges of a lower rank."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _border_stays(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens together leaves them apart.

        Walks back through both sides' merges, the latest first, and looks at the pair that then met at the border: it would
        have been joined if its rank came before the merge undone last (of equal ranks, the one further left is first).
        """
        ranks, token, halves = self.ranks, self.token, self.halves
        before = 1 << 62
        while True:
            if ranks.get(token[left] + token[right], before) < before:
                return False
            go_left, go_right = left in halves, right in halves
            if not go_left and not go_right:
                return True
            if go_left and (not go_right or left > right):
                before, left = left, halves[left][1]
            else:
                before, right = right + 1, halves[right][0]

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.fits_memo.get(key)
        if known is None:
            if len(self.fits_memo) >= KEEP_PAIRS:
                self.fits_memo.clear()
            known = self.fits_memo[key] = self._border_stays(left, right)
        return known

    def encode_match(self, data: bytes) -> array:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return array("I", [whole])
        size, token, shorter, fits = len(data), self.token, self.shorter, self.fits
        longest = array("i", [0]) * size
        for end, (rank, n) in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - n] = rank  # ends ascend, so the last one is the longest
        dead, ids, at = bytearray(size + 1), array("I"), 0
        candidate = longest[0]
        while True:
            end = at + len(token[candidate])
            if not dead[end] and (not ids or fits(ids[-1], candidate)):
                ids.append(candidate)
                at = end
                if at == size:
                    return ids
                candidate = longest[at]
                continue
            candidate = shorter[candidate]
            while candidate < 0:
                dead[at] = 1
                last = ids.pop()
                at -= len(token[last])
                candidate = shorter[last]

    def _remember(self, match: str) -> bytes:
        ids = self.old.get(match)
        if ids is None:
            ids = self.encode_match(match.encode()).tobytes()
        if len(match) <= KEEP_MATCH:
            if self.held > self.keep:
                self.old, self.new, self.held = self.new, {}, 0
            self.new[match] = ids
            self.held += len(match) + len(ids) + ENTRY_BYTES
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, four bytes each."""
        known, out = self.new.get, []
        for match in self.split(text):
            out.append(known(match) or self._remember(match))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


_known: dict[tuple[str, str], BytePairs] = {}


def byte_pairs(path: str, pattern: str) -> BytePairs:
    """This worker's encoder of a file of ranks."""
    if (path, pattern) not in _known:
        _known[path, pattern] = BytePairs(read_ranks(path), pattern)
    return _known[path, pattern]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    pairs = byte_pairs(path, pattern)
    for batch, texts in slices(batches):
        ids = [pairs.encode(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    pairs = byte_pairs(path, pattern)
    for batch in batches:
        texts = [None if ids is None else pairs.decode(ids) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "data"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of whole texts, as little-endian unsigned 32-bit integers in a binary column.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. A null or empty text has no ids. Rows
    that repeat, or have no doc_id, give a row each, and an empty table an empty result. No token is special: strings
    of special tokens are plain text. Memory is bounded by the longest text and the remembered matches of a worker.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lambda it: _encoded(it, path, pattern), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Bytes of ids: doc_id and ids as ``encode`` gives them to doc_id and data; null ids give null."""
    bounded_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decoded(it, path, pattern), "doc_id long, data binary")


def _digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    pairs = byte_pairs(path, pattern)
    for batch, texts in slices(batches):
        rows = []
        for text in texts:
            ids = pairs.encode(text)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(pairs.decode(ids)).hexdigest()))
        counts, of_ids, of_texts = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row the number of ids, the digest of the ids and the digest of what they decode to; odd rows as in ``encode``.

    Encoding and decoding run in one pass over the texts, without a shuffle.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lambda it: _digests(it, path, pattern), SCHEMA)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
