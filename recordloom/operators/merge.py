"""Keyed tables: what a table holds after a batch, under each conflict policy.

Every function takes the target and a batch and returns the table that results, so that it can be written
beside the old one and put in its place. Keys compare null-safely nowhere: rows without a key are left out of a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prepared(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with a full key, one per key: the last in ``order``."""
    has = F.lit(True)
    for k in keys:
        has = has & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    last = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return batch.where(has).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], preserve: list[str] = (), update: list[str] | None = None) -> DataFrame:
    """Insert new keys; for known ones take the batch's values, but for ``preserve`` (or all but ``update``)."""
    mine = target.withColumn("_old", F.lit(True)).alias("t")
    theirs = batch.select(*target.columns).withColumn("_new", F.lit(True)).alias("s")
    both = mine.join(theirs, keys, "full_outer")
    fresh = lambda c: c not in preserve and (update is None or c in update)

    def value(c: str) -> Column:
        use_new = F.col("_new") if fresh(c) else F.col("_new") & F.col("_old").isNull()
        return F.when(use_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return both.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def with_actions(target: DataFrame, batch: DataFrame, keys: list[str], preserve: list[str] = (), update: list[str] | None = None) -> DataFrame:
    """The table after ``upsert``, with what became of each row as ``action``.

    ``inserted`` and ``updated`` rows changed the table; ``unchanged`` ones are in the batch and say what the table
    says; ``kept`` ones are not in the batch. Null is a value like others, and equal to null.
    """
    fresh = [c for c in target.columns if c not in keys and c not in preserve and (update is None or c in update)]
    theirs = batch.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_s"), F.lit(True).alias("_new"))
    both = target.withColumn("_old", F.lit(True)).join(theirs, keys, "full_outer")
    same = F.lit(True)
    for c in fresh:
        same = same & F.col(c).eqNullSafe(F.col("_s")[c])
    action = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    take = lambda c: F.col("_new") & (F.lit(True) if c in fresh else F.col("_old").isNull())
    return both.select(*[F.col(c) if c in keys else F.when(take(c), F.col("_s")[c]).otherwise(F.col(c)).alias(c) for c in target.columns], action.alias("action"))


def write_bucketed(rows: DataFrame, path: str, keys: list[str], buckets: int, files: int = 1, dynamic: bool = False) -> None:
    """A keyed table as Parquet in ``buckets`` folders by hashed key, each of about ``files`` files."""
    part = F.pmod(F.hash(F.lit("file"), *keys), F.lit(files))
    dealt = rows.withColumn("bucket", F.pmod(F.hash(*keys), F.lit(buckets))).repartition("bucket", part)
    mode = dealt.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    mode.mode("overwrite" if dynamic else "errorifexists").parquet(path)


def merge_into(batch: DataFrame, path: str, staging: str, keys: list[str], buckets: int, files: int = 1, preserve: list[str] = (), update: list[str] | None = None) -> DataFrame:
    """Upsert a batch with one row per key into a table of ``write_bucketed``, of as many ``buckets``; one row of counts: n_inserted, n_updated, n_unchanged.

    Only the buckets that the batch's keys fall into are read, and only those in which a row changed are written. The
    rows go to ``staging`` first, a new folder, as a table can't be overwritten while it is read. A merge that broke off
    is mended by the same batch again, which inserts and updates what is not yet there.
    """
    spark = batch.sparkSession
    table = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in table.schema.fields if f.name != "bucket"}
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    batch = batch.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()])  # hashes go by type
    met = [r[0] for r in batch.select(bucket).distinct().collect()]  # numbers of buckets, at most ``buckets``
    after = with_actions(table.where(F.col("bucket").isin(met)), batch.withColumn("bucket", bucket), ["bucket", *keys], preserve, update)
    after.write.partitionBy("bucket", "action").mode("errorifexists").parquet(staging)
    staged = spark.read.schema(after.schema).parquet(staging)
    changed = [r[0] for r in staged.where("action in ('inserted', 'updated')").select("bucket").distinct().collect()]
    if changed:
        write_bucketed(staged.where(F.col("bucket").isin(changed)).select(*kinds), path, keys, buckets, files, dynamic=True)
    return staged.agg(*[F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("inserted", "updated", "unchanged")])


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the batch to append: those whose key the target doesn't have, one per key."""
    return batch.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*target.columns)


def touch(target: DataFrame, batch: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Insert new keys; for known ones only ``column`` changes."""
    return upsert(target, batch, keys, update=[column])


def new_and_repeated(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys of a batch are new, and how many the target has."""
    known = target.select(*keys).distinct().withColumn("_old", F.lit(True))
    return batch.select(*keys).distinct().join(known, keys, "left").agg(F.count_if(F.col("_old").isNull()).alias("n_new"), F.count_if(F.col("_old")).alias("n_repeated"))


def count_up(target: DataFrame, names: DataFrame, key: str, run: Column) -> DataFrame:
    """(key, first_seen_run, last_seen_run, occurrence_count) after a run that saw ``names``: once per run, however often."""
    seen = names.where(F.col(key).isNotNull() & (F.trim(key) != "")).select(key).distinct().withColumn("_seen", F.lit(True))
    both = target.join(seen, key, "full_outer")
    return both.select(
        key,
        F.coalesce("first_seen_run", run).alias("first_seen_run"),
        F.when(F.col("_seen"), run).otherwise(F.col("last_seen_run")).alias("last_seen_run"),
        (F.coalesce("occurrence_count", F.lit(0)) + F.coalesce(F.col("_seen").cast("int"), F.lit(0))).cast("long").alias("occurrence_count"),
    )


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All rows of the batch's keys replaced by the batch's rows."""
    return target.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def delete_keys(tables: dict[str, DataFrame], keys: DataFrame, on: list[str]) -> dict[str, DataFrame]:
    """Every table without the rows of one set of keys."""
    gone = keys.select(*on).distinct()
    return {name: table.join(gone, on, "left_anti") for name, table in tables.items()}


def set_where(target: DataFrame, members: DataFrame, on: list[str], column: str, old: str, new: str) -> DataFrame:
    """``column`` turned from ``old`` to ``new`` in rows whose key is among ``members``."""
    flag = members.select(*on).distinct().withColumn("_in", F.lit(True))
    rows = target.join(flag, on, "left")
    return rows.withColumn(column, F.when(F.col("_in") & (F.col(column) == old), F.lit(new)).otherwise(F.col(column))).select(*target.columns)


def update_from(target: DataFrame, changes: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Columns taken from ``changes`` where it has the key and a value."""
    got = changes.select(*on, *[F.col(c).alias(f"_{c}") for c in columns])
    return target.join(got, on, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def undecided(candidates: DataFrame, decided: DataFrame, on: list[str]) -> DataFrame:
    """Candidates that no earlier row of the log names, whatever its decision."""
    return candidates.join(decided.select(*on), on, "left_anti")


def orphans(rows: DataFrame, key: str, *holders: DataFrame) -> DataFrame:
    """Rows whose key none of the other tables has; a null there excludes nothing."""
    for h in holders:
        rows = rows.join(h.select(key), key, "left_anti")
    return rows


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.join(have.select(key), key, "left_anti")


def approved_ids(*logs: DataFrame) -> DataFrame:
    """Distinct ids that any log approved."""
    found = None
    for log in logs:
        one = log.where("decision = 'Approved'").select("id")
        found = one if found is None else found.union(one)
    return found.distinct()


def trimmed_ids(rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The table with blanks around an identifier removed, and how many rows that changed."""
    clean = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    return rows.withColumn(column, clean), rows.agg(F.count_if(clean != F.col(column)).alias("n_fixed"))


def with_columns_added(rows: DataFrame, added: dict[str, str]) -> DataFrame:
    """Columns that a table lacks, as null."""
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in added.items() if c not in rows.columns})


def overwrite(table: DataFrame, path: str) -> None:
    """Write a merged table. It must not be read from ``path`` itself: the result goes to a new path, then readers are switched."""
    table.write.mode("errorifexists").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    """Add rows to a table as they are."""
    rows.write.mode("append").parquet(path)
