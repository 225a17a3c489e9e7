"""Readers and writers of landed records, keyword files and dimension tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import small

MODULES = {
    "protocolSection": ("identificationModule", "statusModule", "sponsorCollaboratorsModule", "oversightModule", "descriptionModule", "conditionsModule", "designModule", "armsInterventionsModule", "outcomesModule", "eligibilityModule", "contactsLocationsModule", "ipdSharingStatementModule", "referencesModule"),
    "derivedSection": ("conditionBrowseModule", "interventionBrowseModule", "miscInfoModule"),
}


def date_range(state: DataFrame, today: Column | None = None, back: int = 10) -> DataFrame:
    """One row (from_date, to_date): from the last run on, that day included, else ``back`` days."""
    now = F.current_date() if today is None else today
    return state.agg(F.max("last_run_date").alias("last")).select(F.coalesce(F.col("last"), F.date_sub(now, back)).alias("from_date"), now.alias("to_date"))


def delta(records: DataFrame, updated: str, first: dt.date, last: dt.date) -> DataFrame:
    """Records updated between two days, both included. The bounds are literals, so they reach the file scan."""
    return records.where(F.col(updated).between(F.lit(first), F.lit(last)))


def due_pipelines(records: DataFrame, updated: str, state: DataFrame, today: dt.date, back: int = 10) -> DataFrame:
    """Records that any pipeline has still to see, with these pipelines in order as ``pipelines``.

    state (pipeline, last_run_date): each pipeline's range is that of ``date_range``, its newest mark counts; null stands
    for one that never ran. The scan gets the smallest mark of all as a literal. Days meet the pipelines due on them in a
    table of one row per day, so a record stays one row, however many pipelines there are.
    """
    marks = state.where("pipeline is not null").groupBy("pipeline").agg(F.coalesce(F.max(F.to_date("last_run_date")), F.date_sub(F.lit(today), back)).alias("from_date")).where(F.col("from_date") <= F.lit(today))
    first = marks.agg(F.min("from_date")).first()[0]
    days = marks.select("pipeline", F.explode(F.sequence("from_date", F.lit(today))).alias("_day")).groupBy("_day").agg(F.array_sort(F.collect_list("pipeline")).alias("pipelines"))
    end = today + dt.timedelta(days=1)  # a time on the last day belongs to it
    scanned = records.where("false") if first is None else records.where((F.col(updated) >= F.lit(first)) & (F.col(updated) < F.lit(end)))
    return scanned.join(small(days), F.to_date(updated) == F.col("_day")).drop("_day")


def raw_modules(records: DataFrame, id: str, doc: str) -> DataFrame:
    """id, official title and one column of JSON text per module of a VARIANT document."""
    get = lambda s, m: F.to_json(F.try_variant_get(doc, F.lit(f"$.{s}.{m}"), "variant")).alias(f"raw_{m}")
    title = F.try_variant_get(doc, F.lit("$.protocolSection.identificationModule.officialTitle"), "string").alias("official_title")
    return records.select(id, title, *[get(s, m) for s, ms in MODULES.items() for m in ms])


def harvest(rows: DataFrame, text: str, pattern: str = r"NCT\d+") -> DataFrame:
    """All distinct identifiers in a text column, sorted."""
    return rows.select(F.explode(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)).alias("id")).distinct().orderBy("id")


def id_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Identifiers of a CSV column, trimmed, without blanks."""
    return spark.read.option("header", True).csv(path).select(F.trim(column).alias("id")).where("id <> ''")


def keyword_lines(spark: SparkSession, path: str) -> DataFrame:
    """Keywords of a text file, one a line in lower case; lines that begin with # are comments."""
    return spark.read.text(path).where("not startswith(value, '#')").select(F.lower(F.trim("value")).alias("term")).where("term <> ''")


def keyword_table(spark: SparkSession, path: str) -> DataFrame:
    """Keywords of a CSV file: of a drug and an alias column, else of a column with a known name, else of the first."""
    df = spark.read.option("header", True).csv(path)
    names = {c.strip().lower(): c for c in df.columns}
    drug = next((names[n] for n in ("drug_name", "drug", "drug name") if n in names), None)
    alias = next((names[n] for n in ("alias_names", "alias", "aliases", "alias names") if n in names), None)
    if drug and alias:
        found = df.select(F.explode(F.concat(F.array(drug), F.split(F.coalesce(alias, F.lit("")), r"\|"))).alias("term"))
    else:
        found = df.select(F.col(next((names[n] for n in ("keyword", "keywords", "term", "terms") if n in names), df.columns[0])).alias("term"))
    return found.select(F.lower(F.trim("term")).alias("term")).where("term not in ('', '-', 'nan')").distinct()


def dimension(table: DataFrame, columns: list[str], order: list[str], **equal: str) -> DataFrame:
    """Distinct rows of a dimension table, filtered and in order."""
    for c, v in equal.items():
        table = table.where(F.col(c) == v)
    return table.select(*columns).distinct().orderBy(*order)


def not_landed(wanted: DataFrame, landed: DataFrame, id: str = "id") -> DataFrame:
    """What is still to be ingested."""
    return wanted.join(landed.select(id), id, "left_anti")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).mode("errorifexists").csv(path)


def split_failures(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and (id, error) of the others; the latter replace the dead letters of the run before, also if there are none."""
    return rows.where("error is null").drop("error"), rows.where("error is not null").select("id", "error")


def facts(table: DataFrame, ids: DataFrame, columns: list[str], id: str = "id") -> DataFrame:
    """The wanted columns of a table's rows for a list of identifiers; only these columns are read."""
    return table.join(ids.select(id).distinct(), id, "left_semi").select(*columns)
