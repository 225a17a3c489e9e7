"""What several corpus operators share: shared scratch storage, table reading and batch helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere in this subpackage: runs of anything but space and the five ASCII controls 9-13.
WORD_GAP = r"[\x20\x09-\x0D]+"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 2000, mib: int = 8) -> None:
    """Keep Arrow batches small, so that very long texts don't add up in a Python worker."""
    spark.conf.set(ARROW_ROWS, str(rows))
    spark.conf.set(ARROW_BYTES, str(mib << 20))


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting only a local session gets a folder, a temporary one; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root and spark.sparkContext.getCheckpointDir():
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corpus-")
    if "://" not in root and root.startswith("/"):
        fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        root = ("file://" if fs.startswith("file:") else fs.rstrip("/")) + root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Intermediate tables of one run in one shared folder, removed as soon as they are no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.home, self.paths = spark, work_dir(spark, name), {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back.

        It runs once, however often the result is used, and a lost executor later costs nothing:
        the rows are in shared storage, not in an executor.
        """
        path = f"{self.home}/{name}-{len(self.paths)}"
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = (name, found)
        return found

    def drop(self, table: DataFrame) -> None:
        """Remove one table."""
        for path, (name, found) in self.paths.items():
            if found is table:
                remove(self.spark, path)
                self.paths[path] = (name, None)

    def keep(self, *names: str) -> None:
        """Remove all tables but those of these names."""
        for name, found in list(self.paths.values()):
            if found is not None and name not in names:
                self.drop(found)


def saved(df: DataFrame, name: str) -> DataFrame:
    """One intermediate table that stays: see ``Scratch.save``."""
    return Scratch(df.sparkSession, name).save(df, name)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have in any case, ``wanted`` if possible."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text, as a long."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("long")


#: Characters of the texts that are taken to the driver to fit a model on.
FIT_CHARS = 32_000_000


def sample_texts(docs: DataFrame, documents: int, chars: int = FIT_CHARS) -> list[str]:
    """Whole texts of at most ``documents`` documents, those of the smallest hashed doc_id, and of at most ``chars`` characters, to fit a model on.

    Identifiers and lengths are chosen first, so that no text moves but the chosen ones. Of rows that repeat a doc_id the smallest text counts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text")).where("id is not null")
    first = rows.groupBy("id").agg(F.max(F.length("text")).alias("chars")).orderBy(F.xxhash64("id"), "id").limit(documents)
    chosen, total = [], 0
    for r in sorted(first.collect(), key=lambda r: (r["chars"], r["id"])):
        total += r["chars"]
        if total <= chars:
            chosen.append((r["id"],))
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame(chosen, "id long")
    found = rows.join(F.broadcast(wanted), "id").groupBy("id").agg(F.min("text").alias("text"))
    return [r["text"] for r in sorted(found.collect(), key=lambda r: r["id"])]


def slices(batches: Iterator[pa.RecordBatch], budget: int = 1 << 20, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches to pieces of about ``budget`` bytes of text: one piece's rows, and its texts as strings."""
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        start, load = 0, 0
        for i, t in enumerate(texts):
            load += len(t) + 64
            if load >= budget:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, load = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
