"""Each incoming record against every watchlist, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .normalize import small

BUCKETS = ["new", "modified", "unmatched", "stale"]


def classify(records: DataFrame, pipelines: DataFrame, tracking: DataFrame, rejected: DataFrame, matched: DataFrame, known: DataFrame) -> DataFrame:
    """(record columns, pipeline, bucket) of all records × pipelines that are not rejected.

    records (id, updated, …); pipelines (pipeline): a small dimension; tracking, rejected and matched (id, pipeline);
    known (id, known_date). A tracked record is modified if its known date differs, else stale, also
    when no date is known; an untracked one is new if it matched, else unmatched. A null id has no bucket.
    """
    every = records.where(F.col("id").isNotNull()).join(small(pipelines), F.expr("true"))
    every = every.join(rejected.select("id", "pipeline").distinct(), ["id", "pipeline"], "left_anti")
    return _with_bucket(every.join(_named(tracking, matched), ["id", "pipeline"], "left"), known, records.columns)


def touched(records: DataFrame, pipelines: DataFrame, tracking: DataFrame, rejected: DataFrame, matched: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``classify`` without the unmatched ones: no record meets a pipeline that neither tracks nor matches it."""
    pairs = _named(tracking, matched).join(small(pipelines), "pipeline", "left_semi").join(rejected, ["id", "pipeline"], "left_anti")
    return _with_bucket(records.join(pairs, "id"), known, records.columns)


def counts(records: DataFrame, pipelines: DataFrame, tracking: DataFrame, rejected: DataFrame, matched: DataFrame, known: DataFrame) -> DataFrame:
    """``bucket_counts`` of ``classify`` without its unmatched rows: they are all records less those rejected, tracked or matched."""
    found = touched(records, pipelines, tracking, rejected, matched, known).groupBy("pipeline").pivot("bucket", ["new", "modified", "stale"]).count()
    gone = records.select("id").join(rejected.select("id", "pipeline").distinct(), "id").groupBy("pipeline").agg(F.count("*").alias("_gone"))
    each = pipelines.join(found, "pipeline", "left").join(gone, "pipeline", "left").na.fill(0, ["new", "modified", "stale", "_gone"])
    each = each.join(F.broadcast(records.agg(F.count("id").alias("_all"))), F.expr("true")).where("_all > _gone")
    return each.select("pipeline", "new", "modified", F.expr("_all - _gone - new - modified - stale").alias("unmatched"), "stale")


def _named(tracking: DataFrame, matched: DataFrame) -> DataFrame:
    """(id, pipeline, _tracked): each pair that is tracked or matched, once."""
    both = tracking.select("id", "pipeline", F.lit(True).alias("_tracked")).unionByName(matched.select("id", "pipeline", F.lit(False).alias("_tracked")))
    return both.groupBy("id", "pipeline").agg(F.max("_tracked").alias("_tracked"))


def _with_bucket(rows: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (``columns``, pipeline) with their bucket instead of ``_tracked``; where that is null, the pair is neither tracked nor matched."""
    rows = rows.join(known.groupBy("id").agg(F.max("known_date").alias("_known")), "id", "left")
    tracked = F.when(F.col("_known").isNotNull() & ~F.col("_known").eqNullSafe(F.col("updated")), "modified").otherwise("stale")
    bucket = F.when(F.col("_tracked"), tracked).when(~F.col("_tracked"), "new").otherwise("unmatched")
    return rows.select(*columns, "pipeline", bucket.alias("bucket"))


def bucket_counts(classified: DataFrame) -> DataFrame:
    """One row per pipeline with the number of records in each bucket."""
    return classified.groupBy("pipeline").pivot("bucket", BUCKETS).count().na.fill(0, BUCKETS)


def registry(tracking: DataFrame, rejected: DataFrame, keywords: DataFrame) -> DataFrame:
    """One row per pipeline: how many records it tracks and rejects, and its keywords in order."""
    keys = tracking.select("pipeline").union(rejected.select("pipeline")).union(keywords.select("pipeline")).distinct()
    return (
        keys.join(tracking.groupBy("pipeline").agg(F.countDistinct("id").alias("tracked")), "pipeline", "left")
        .join(rejected.groupBy("pipeline").agg(F.countDistinct("id").alias("rejected")), "pipeline", "left")
        .join(keywords.groupBy("pipeline").agg(F.array_sort(F.collect_set("term")).alias("keywords")), "pipeline", "left")
        .na.fill(0, ["tracked", "rejected"])
    )


def real_changes(rows: DataFrame, count: str = "field_change_count") -> DataFrame:
    """Rows that report at least one changed field."""
    return rows.where(F.coalesce(F.col(count).try_cast("int"), F.lit(0)) > 0)
