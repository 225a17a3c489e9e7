"""Exact deduplication with streaming state.

Arriving texts are reduced to (digest, stable identifier, content locator). A structured stream keeps
one entry per digest in RocksDB, on disk and without expiry: the largest identifier, its locator and
the number of copies. Entries change as later micro-batches bring copies; nothing is ever evicted.
A digest that was hit more than once is checked on the full bytes of its texts; should two texts
share a digest, they are told apart by the texts themselves. Only built-in functions are used.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .common import Scratch, remove, table, whole_text

#: Bytes of arrivals (some 60 a row) that one micro-batch takes at most, about.
BATCH_BYTES = 64 << 30
BROADCAST_ROWS = 500_000
_STORE = "spark.sql.streaming.stateStore"
#: Disk-backed state, with one bound of memory for all state stores of an executor.
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "64",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "4",
    f"{_STORE}.rocksdb.allowFAllocate": "false",  # else every store reserves some megabytes of disk
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrivals(docs: DataFrame) -> DataFrame:
    """(doc_id, seq, digest, locator) of each row; ``seq`` tells rows apart that repeat an identifier."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("seq"),
        F.unhex(F.sha2(whole_text(), 256)).alias("digest"),
        F.input_file_name().alias("locator"),
    )


def dedup_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Start the stateful query over a stream of ``arrivals`` rows, until all that is there has been read.

    Each micro-batch writes the entries it changed to ``out``; running it again with the same
    checkpoint goes on where it ended, with all earlier digests still in the state.
    """
    state = stream.groupBy("digest").agg(F.max(F.struct("doc_id", "seq", "locator")).alias("keeper"), F.count("*").alias("copies"))

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with _settings(stream.sparkSession, STATE_CONF):
        return state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()


def state_of(spark: SparkSession, out: str) -> DataFrame:
    """The latest entry of each digest: (digest, keep_id, keep_seq, group_size, locator)."""
    schema = "digest binary, keeper struct<doc_id:bigint,seq:bigint,locator:string>, copies bigint, batch int"
    rows = spark.read.schema(schema).parquet(out)
    last = rows.groupBy("digest").agg(F.max_by("keeper", "copies").alias("keeper"), F.max("copies").alias("group_size"))
    return last.select("digest", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.seq").alias("keep_seq"), "group_size", F.col("keeper.locator").alias("locator"))


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are counted to be few (some 50 MB)."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _mixed_digests(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of more than one text among those that were hit: full bytes are compared, of hits only, copies merged before they move."""
    texts = docs.select(F.unhex(F.sha2(whole_text(), 256)).alias("digest"), whole_text().alias("text"))
    texts = texts.join(_few(hits.select("digest")), "digest", "left_semi")
    seen = texts.groupBy("digest", "text").agg(F.count("*").alias("n")).select("digest")
    return seen.groupBy("digest").count().where("count > 1").select("digest")


def _by_text(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """The exact way for digests that several texts share: their rows grouped by text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = texts.join(digests, "digest", "left_semi")
    best = texts.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    found = texts.join(best, "text")
    first = F.row_number().over(Window.partitionBy("text", "doc_id").orderBy("digest"))
    return found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (first == 1)).alias("kept"), "digest")


def _decided(docs: DataFrame, at: Scratch) -> DataFrame:
    spark, home = docs.sparkSession, at.home
    schema = "doc_id bigint, seq bigint, digest binary, locator string"
    arrivals(docs).write.parquet(f"{home}/arrivals")
    log = spark.read.schema(schema).parquet(f"{home}/arrivals")
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(f"{home}/arrivals")
    dedup_stream(stream, f"{home}/state", f"{home}/checkpoint").awaitTermination()
    if log.isEmpty():
        return log.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    hits = at.save(state_of(spark, f"{home}/state").where("group_size > 1"), "hits")
    remove(spark, f"{home}/state")
    remove(spark, f"{home}/checkpoint")
    mixed = at.save(_mixed_digests(docs, hits), "mixed")
    found = log.join(_few(hits), "digest", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("seq") == F.col("keep_seq"), F.lit(True)).alias("kept"),
        "digest",
    )
    if mixed.isEmpty():
        return found
    return found.join(mixed, "digest", "left_anti").select(found.columns).union(_by_text(docs, mixed))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without any change; a null text counts as empty, so null and
    empty texts are one group. Of equal texts the row with the largest doc_id stays (a null doc_id
    counts as smaller than any other). Of rows that repeat both doc_id and text exactly one is
    marked as kept. Other columns are ignored. An empty table gives an empty result.
    """
    found = _decided(docs, Scratch(docs.sparkSession, "exact-dedup"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_unique(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, whatever their names, without the rows that ``exact_dedup`` drops.

    Of rows that repeat both doc_id and text, but differ in other columns, one stays.
    """
    at = Scratch(docs.sparkSession, "exact-dedup")
    keys = _decided(docs, at).groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).where("not kept or n > 1")
    keys = at.save(keys.select(F.col("doc_id").alias("id"), F.col("digest").alias("own"), "kept"), "touched")
    at.keep("touched")
    remove(docs.sparkSession, f"{at.home}/arrivals")
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(whole_text(), 256)).alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own"))
    out = marked.join(_few(keys.select("id", "own")), same, "left_anti")
    again = keys.where("kept").select("id", "own")
    if not again.isEmpty():
        out = out.union(marked.join(_few(again), same, "left_semi").dropDuplicates(["doc_id", "digest"]))
    return out.select("row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB SQL.
OP4_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
