"""Consecutive versions of records: which pairs are to be compared.

Windows run over (id, version) only; documents are joined to the pairs that survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pairs(index: DataFrame, id: str = "id", version: str = "version", carry: tuple[str, ...] = ()) -> DataFrame:
    """Every version with the one before it: id, prev_version, curr_version, total_versions, and prev_/curr_ of ``carry``."""
    order = Window.partitionBy(id).orderBy(version)
    rows = index.select(
        F.col(id).alias("id"),
        F.lag(version).over(order).alias("prev_version"),
        F.col(version).alias("curr_version"),
        F.count("*").over(Window.partitionBy(id)).alias("total_versions"),
        *[F.lag(c).over(order).alias(f"prev_{c}") for c in carry],
        *[F.col(c).alias(f"curr_{c}") for c in carry],
    )
    return rows.where("prev_version is not null")


def latest(rows: DataFrame, key: list[str], order: list, name: str = "_n") -> DataFrame:
    """The last row of each key; ``order`` must end in something unique, such as an ingest sequence."""
    last = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order])
    return rows.withColumn(name, F.row_number().over(last)).where(F.col(name) == 1).drop(name)


def latest_pair(index: DataFrame, id: str = "id", version: str = "version", carry: tuple[str, ...] = ()) -> DataFrame:
    return latest(pairs(index, id, version, carry), ["id"], ["curr_version"])


def gap_pairs(index: DataFrame, cache: DataFrame) -> DataFrame:
    """Pairs from the stored version of each id to every newer one, in a chain.

    index (id, version), cache (id, stored). An id that is not stored, or whose stored version is no longer in
    the index, gets its latest pair only. An id at its stored version gets none.
    """
    whole = Window.partitionBy("id")
    rows = index.join(cache.select("id", "stored"), "id", "left")
    rows = rows.withColumn("_has", F.max(F.coalesce(F.col("version") == F.col("stored"), F.lit(False))).over(whole)).withColumn("_top", F.max("version").over(whole))
    order = Window.partitionBy("id").orderBy("version")
    rows = rows.withColumn("prev_version", F.lag("version").over(order)).where("prev_version is not null")
    rows = rows.where("if(_has, version > stored, version = _top)")
    return rows.select("id", "prev_version", F.col("version").alias("curr_version"))


def unchanged(latest_index: DataFrame, prior: DataFrame) -> DataFrame:
    """Prior comparison rows of ids whose newest version (id, version) is the one compared before: they are carried forward."""
    return prior.join(latest_index.select("id", F.col("version").alias("_v")), "id").where("curr_version = _v").drop("_v")


def sentinels(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """A pair 0 → 0 for ids without any version, so that they are not tried again."""
    return wanted.select("id").distinct().join(index.select("id"), "id", "left_anti").select("id", F.lit(0).alias("prev_version"), F.lit(0).alias("curr_version"))
