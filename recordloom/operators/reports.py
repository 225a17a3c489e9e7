"""Report tables over comparison rows and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(rows: DataFrame, key: str, order: str, line: Column, out: str = "lines") -> DataFrame:
    """(key, lines): one line per row in order, joined by line breaks."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda s: s["l"]), "\n").alias(out))


def wide_pairs(rows: DataFrame, key: str, pair: Column, value: str, out: str = "by_pair") -> DataFrame:
    """One row per key with a map from each of its pairs of versions to the value.

    The schema does not grow with the longest history, so the names of pairs are never gathered. Of rows that repeat a pair the one of
    the smallest value counts, null last.
    """
    one = rows.groupBy(key, pair.alias("_pair")).agg(F.min(value).alias("_value"))
    return one.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_pair", "_value")))).alias(out))


def pair_columns(wide: DataFrame, key: str, names: list[str], column: str = "by_pair") -> DataFrame:
    """A page of the wide report: a column for each of the named pairs, null where a key lacks it."""
    return wide.select(key, *[F.col(column)[n].alias(n) for n in names])


def note_counts(rows: DataFrame) -> DataFrame:
    """How many comparison rows have each note; without a note they are OK."""
    return rows.groupBy(F.when(F.coalesce("note", F.lit("")) == "", "OK").otherwise(F.col("note")).alias("note")).agg(F.count("*").alias("n"))


def run_row(counts: DataFrame, compared: DataFrame, redirects: DataFrame, run_date: Column, seconds: Column) -> DataFrame:
    """The history row of a run from its bucket counts, comparisons and redirects."""
    total = counts.agg(F.sum("new").alias("new_candidates"), F.sum("modified").alias("modified_trials"), F.sum("unmatched").alias("unmatched"))
    diffs = compared.agg(F.count_if(F.coalesce(F.col("field_change_count"), F.lit(0)) > 0).alias("field_diffs"))
    moved = redirects.agg(F.count("*").alias("canonical_fixes"))
    return total.join(diffs, F.expr("true")).join(moved, F.expr("true")).select(run_date.alias("run_date"), "*", seconds.alias("duration_s"))


def digest(run: DataFrame) -> DataFrame:
    """The five counts of a run as rows (item, n)."""
    return run.unpivot([], ["new_candidates", "unmatched", "modified_trials", "field_diffs", "canonical_fixes"], "item", "n")


def sheets(prior: DataFrame, fresh: DataFrame) -> dict[str, DataFrame]:
    """The latest comparison of every id: all of them, and the newly compared ones."""
    rest = prior.join(fresh.select("id"), "id", "left_anti")
    return {"all": rest.unionByName(fresh), "newly_compared": fresh}


def list_slices(changes: DataFrame, tracked: DataFrame, key: str, name: str) -> DataFrame:
    """The changes of each list's records: a change is in every list that tracks its record."""
    return changes.join(tracked.select(key, name).distinct(), key)


def slice_counts(slices: DataFrame, key: str, name: str) -> DataFrame:
    """How many records changed, and how often, per list."""
    return slices.groupBy(name).agg(F.countDistinct(key).alias("records"), F.count("*").alias("changes"))


def totals(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row: how many rows there are, and how many of them each test holds for."""
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in tests.items()])


def sizes(dictionary: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: the rows of a dictionary and its distinct values by column."""
    return dictionary.agg(F.count("*").alias("rows"), *[F.countDistinct(c).alias(n) for n, c in columns.items()])
