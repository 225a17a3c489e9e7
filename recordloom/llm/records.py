"""Token ids in length-delimited binary records.

A record file is a run of frames::

    length of the payload      8 bytes
    masked CRC-32 of those     4 bytes
    payload                    1 byte of flags, doc_id (8 bytes, signed), number of ids (4 bytes), the ids
    masked CRC-32 of payload   4 bytes

all little-endian. Flag 1: ids take four bytes instead of two; flag 2: doc_id is null. A CRC is masked by a
rotation and a constant, so that the checksum of data that holds checksums stays useful. The index file beside it has
the offset of every frame (8 bytes each), so that records can be read in any order.

Tasks write one pair of files each, under a name of their own attempt, and report it as a row; only
reported files are read, so what a lost executor left behind is never seen. Files are opened by
URI through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, saved, slices, table, whole_text, work_dir
from .tokens import encoder

WIDE, NO_ID = 1, 2
_HEAD = struct.Struct("<QI")
_META = struct.Struct("<BqI")
_CRC = struct.Struct("<I")
MANIFEST = "part int, file string, index string, records long, tokens long"


class Damaged(ValueError):
    """A frame whose length or checksum is wrong."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record."""
    wide = ids.dtype.itemsize == 4
    flags = (WIDE if wide else 0) | (NO_ID if doc_id is None else 0)
    payload = _META.pack(flags, doc_id or 0, len(ids)) + ids.astype("<u4" if wide else "<u2", copy=False).tobytes()
    length = struct.pack("<Q", len(payload))
    return length + _CRC.pack(masked_crc(length)) + payload + _CRC.pack(masked_crc(payload))


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id, n = _META.unpack_from(payload)
    ids = np.frombuffer(payload, dtype="<u4" if flags & WIDE else "<u2", offset=_META.size)
    if len(ids) != n:
        raise Damaged(f"{len(ids)} ids instead of {n}")
    return None if flags & NO_ID else doc_id, ids


def read_frame(stream) -> bytes | None:
    """The next payload, checked; None at the end of the file."""
    head = stream.read(_HEAD.size)
    if not head:
        return None
    if len(head) < _HEAD.size or masked_crc(head[:8]) != _HEAD.unpack(head)[1]:
        raise Damaged("length")
    n = _HEAD.unpack(head)[0]
    payload, crc = stream.read(n), stream.read(4)
    if len(payload) < n or len(crc) < 4 or _CRC.unpack(crc)[0] != masked_crc(payload):
        raise Damaged("payload")
    return payload


def read_at(file: str, index: str, positions: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records of one file by position, in the order asked for: a shuffled read by way of the index."""
    fs, path = pafs.FileSystem.from_uri(file)
    _, index_path = pafs.FileSystem.from_uri(index)
    with fs.open_input_file(index_path) as f:
        offsets = np.frombuffer(f.read(), dtype="<u8")
    found = []
    with fs.open_input_file(path) as f:
        for p in positions:
            f.seek(int(offsets[p]))
            found.append(parse(read_frame(f)))
    return found


def _written(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, leading_blank: bool, end: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    name = f"part-{part:05d}-{uuid.uuid4().hex}"
    fs, path = pafs.FileSystem.from_uri(folder)
    enc = encoder(vocabulary, leading_blank)
    stop = np.array([end], dtype=enc.dtype)
    out, offsets, at, tokens = None, [], 0, 0
    for batch, texts in slices(batches):
        if out is None:
            fs.create_dir(path, recursive=True)
            out = fs.open_output_stream(f"{path}/{name}.rec")
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            ids = np.concatenate((enc.encode(text), stop))
            record = frame(doc_id, ids)
            out.write(record)
            offsets.append(at)
            at += len(record)
            tokens += len(ids)
    if out is not None:
        out.close()
        with fs.open_output_stream(f"{path}/{name}.idx") as f:
            f.write(np.array(offsets, dtype="<u8").tobytes())
        row = {"part": part, "file": f"{folder}/{name}.rec", "index": f"{folder}/{name}.idx", "records": len(offsets), "tokens": tokens}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("file", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())]))


def write_records(docs: DataFrame, folder: str, vocabulary: str, leading_blank: bool = False, end: int = 2) -> DataFrame:
    """Tokenize ``docs`` and write record files below ``folder`` in ascending doc_id order; returns their manifest.

    Every document is its whole text's ids and ``end``; a null or empty text is ``end`` alone. A null doc_id
    comes first; rows that repeat a doc_id are records of their own, in the order of their texts. Files
    follow each other in the order of ``part``. Other columns are ignored; an empty table writes no file.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return saved(rows.mapInArrow(lambda it: _written(it, folder, vocabulary, leading_blank, end), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, path = pafs.FileSystem.from_uri(file)
            rows: list[tuple] = []
            with fs.open_input_stream(path, buffer_size=1 << 20) as f:
                while True:
                    payload = read_frame(f)
                    if payload is None or len(rows) >= 5000:
                        columns = zip(*rows, strict=True) if rows else [[]] * 4
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        rows = []
                    if payload is None:
                        break
                    doc_id, ids = parse(payload)
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)


def read_records(manifest: DataFrame) -> DataFrame:
    """Read record files back, every checksum checked: doc_id, start (ids of all records before), n_tokens and ids_crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    return files.repartition(max(1, manifest.count())).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_records(table(spark, sf_dir, "documents"), work_dir(spark, "token-records"), public_tokenizers.path("word_bpe_49k.json"))
    return read_records(manifest)
