"""Names through alias tables; lists of names without repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import strip_legal_form

#: Alias tables of at most so many rows are broadcast, larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint, if it is counted to be small."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def alias_map(sources: list[DataFrame], order: str | None = None) -> DataFrame:
    """One row (alias, canonical) per alias; of several definitions the first in the first source wins.

    First is the one of the smallest ``order`` column of its source; rows have no order of their own, so without it the first by name.
    """
    rows = None
    for rank, source in enumerate(sources):
        one = source.select(F.lower(F.trim("alias")).alias("alias"), F.trim("canonical").alias("canonical"), F.lit(rank).alias("rank"), (F.col(order) if order else F.lit(0)).cast("long").alias("at")).where("alias <> '' and canonical <> ''")
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("alias").agg(F.min_by("canonical", F.struct("rank", "at", "canonical")).alias("canonical"))


def with_canonical(rows: DataFrame, name: str, aliases: DataFrame, out: str, clean: bool = True) -> DataFrame:
    """Adds ``out``: the canonical name, else the name itself (without its legal form, if ``clean``)."""
    found = small(aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical")))
    rest = strip_legal_form(F.col(name)) if clean else F.trim(F.col(name))
    return rows.join(found, F.lower(F.trim(F.col(name))) == F.col("_alias"), "left").withColumn(out, F.coalesce("_canonical", rest)).drop("_alias", "_canonical")


def list_canonical(rows: DataFrame, key: str, names: Column, aliases: DataFrame, out: str, clean: bool = True) -> DataFrame:
    """(key, out): the names of an array column made canonical, empty ones left out, repetitions (in any case) dropped, first seen first."""
    items = rows.select(key, F.posexplode(names).alias("_pos", "_name")).where(F.trim("_name") != "")
    items = with_canonical(items, "_name", aliases, "_value", clean).where("_value <> ''")
    first = items.groupBy(key, F.lower("_value").alias("_same")).agg(F.min(F.struct("_pos", "_value")).alias("_first"))
    lists = first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("_first")), lambda s: s["_value"]).alias(out))
    return rows.select(key).distinct().join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def distinct_in_order(values: Column) -> Column:
    """An array's values, repetitions in any case dropped, first seen first."""
    lower = F.transform(values, lambda x: F.lower(x))
    return F.filter(values, lambda v, i: F.array_position(lower, F.lower(v)) == i + 1)


def drug_aliases(keywords: DataFrame) -> DataFrame:
    """(alias, canonical) of rows (drug_name, alias_names between bars); a drug's own name goes before any alias."""
    names = keywords.select(F.trim("drug_name").alias("canonical"), F.explode(F.concat(F.array("drug_name"), F.split(F.coalesce("alias_names", F.lit("")), r"\|"))).alias("alias"))
    names = names.select(F.lower(F.trim("alias")).alias("alias"), "canonical").where("alias not in ('', '-', 'nan') and canonical not in ('', '-')")
    own = F.when(F.col("alias") == F.lower("canonical"), 0).otherwise(1)
    return names.groupBy("alias").agg(F.min_by("canonical", F.struct(own, F.col("canonical"))).alias("canonical"))


def first_alias(keywords: DataFrame, key: str, alias: str) -> DataFrame:
    """One row per key: its first alias in order."""
    order = Window.partitionBy(key).orderBy(F.col(alias).asc_nulls_last())
    return keywords.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
