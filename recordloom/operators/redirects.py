"""Identifiers that moved to another one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve(lists: DataFrame, redirects: DataFrame) -> DataFrame:
    """(list, pos, id): each list with its identifiers replaced by canonical ones.

    lists (list, pos, id); redirects (requested, canonical). An id whose canonical one stands in the same list
    is dropped; of several that become equal the first stays.
    """
    to = redirects.groupBy("requested").agg(F.min("canonical").alias("canonical"))
    rows = lists.join(to, lists["id"] == to["requested"], "left").withColumn("_new", F.coalesce("canonical", "id"))
    present = lists.select("list", F.col("id").alias("_new"), F.lit(True).alias("_present")).distinct()
    rows = rows.join(present, ["list", "_new"], "left").where("canonical is null or canonical = id or _present is null")
    first = Window.partitionBy("list", "_new").orderBy("pos")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("list", "pos", F.col("_new").alias("id"))


def report(redirects: DataFrame, compared: DataFrame, newly: DataFrame) -> DataFrame:
    """Each redirect (requested, canonical, in_input) with what to do about it, whether it changed, and its comparison row."""
    fresh = newly.select(F.col("id").alias("canonical"), F.lit(True).alias("_fresh")).distinct()
    known = compared.select(F.col("id").alias("canonical"), "curr_version", "field_change_count")
    rows = redirects.join(fresh, "canonical", "left").join(known, "canonical", "left")
    action = F.when(F.col("in_input"), F.concat(F.lit("remove "), "requested")).otherwise(F.concat(F.lit("replace "), "requested", F.lit(" by "), "canonical"))
    status = F.when(F.col("_fresh") & (F.coalesce(F.col("field_change_count"), F.lit(0)) > 0), "changed").when(F.col("_fresh"), "compared, unchanged").otherwise("not compared in this run")
    return rows.select("requested", "canonical", "in_input", action.alias("action"), status.alias("change_status"), "curr_version", "field_change_count")
