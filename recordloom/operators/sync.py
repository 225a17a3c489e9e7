"""Keeping tables complete: records and comparisons that are missing, snapshots, state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import missing, upsert
from .versions import latest


def baseline(tracked: DataFrame, base: DataFrame, landed: DataFrame, id: str = "id") -> DataFrame:
    """``base`` with the tracked records that it lacks, as far as they have landed; running it again changes nothing."""
    wanted = missing(tracked.select(id).distinct(), base, id)
    return base.unionByName(landed.join(wanted, id, "left_semi").select(*base.columns))


def missing_pairs(tracked: DataFrame, compared: DataFrame, pairs: DataFrame) -> DataFrame:
    """Version pairs of tracked records that were never compared."""
    return pairs.join(missing(tracked.select("id").distinct(), compared, "id"), "id", "left_semi")


def snapshots(history: DataFrame, compared: DataFrame, order: list[str]) -> DataFrame:
    """Rows to append to a history keyed by (id, dept, version): the newest of each key that the history lacks."""
    keys = ["id", "dept", "version"]
    # ``latest`` leaves one row per key, in the order of the keys: the join neither removes copies nor sorts them again.
    return latest(compared, keys, order).join(history.select(*keys), keys, "left_anti").select(*history.columns)


def state_after(state: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """The high-water marks after a run."""
    return upsert(state, runs, keys)


def state_without(state: DataFrame, column: str, value: str) -> DataFrame:
    """Marks of one department set back, so that its next run begins anew."""
    return state.withColumn("last_run_date", F.when(F.col(column) == value, None).otherwise(F.col("last_run_date")))


def newest_mark(rows: DataFrame, key: str, mark: Column) -> DataFrame:
    """The newest run of each key."""
    return rows.groupBy(key).agg(F.max(mark).alias("last_run_date"))
