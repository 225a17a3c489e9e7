"""Change events, their stages, and the histories they feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .diff import PLACES, RESULTS
from .merge import insert_if_absent, set_where

# Fixed values: (module, field, stages); "*" is any other field of a module or any other module.
ROUTES = [
    ("study status", "overall status", ["STATUS_HISTORY", "EMBED_INVALIDATE"]),
    ("study status", "start date", ["DATE_HISTORY"]),
    ("study status", "completion date", ["DATE_HISTORY", "EMBED_INVALIDATE"]),
    ("study status", "primary completion date", ["DATE_HISTORY", "EMBED_INVALIDATE"]),
    ("study design", "phase", ["PHASE_HISTORY", "EMBED_INVALIDATE"]),
    ("status", "overall status", ["STATUS_HISTORY", "EMBED_INVALIDATE"]),
    ("design", "phase", ["PHASE_HISTORY", "EMBED_INVALIDATE"]),
    ("contacts/locations", "*", []),
    ("status dates", "completion date", ["DATE_HISTORY", "EMBED_INVALIDATE"]),
    ("status dates", "primary completion date", ["DATE_HISTORY", "EMBED_INVALIDATE"]),
    ("status dates", "start date", ["DATE_HISTORY"]),
    ("status dates", "*", []),
    ("*", "*", ["EMBED_INVALIDATE"]),
]
DATE_FIELDS = {"start date": "start_date", "study start date": "start_date", "completion date": "completion_date", "primary completion date": "primary_completion_date"}
_NAMES = {r"^overallStatus$": "overall status", r"^phases(\[\d+\])?$": "phase", r"^startDateStruct\.date$": "start date", r"^completionDateStruct\.date$": "completion date", r"^primaryCompletionDateStruct\.date$": "primary completion date"}


def events(changes: DataFrame) -> DataFrame:
    """Changes as events: adds change_type and field_name (the name that routes and histories know, else the field)."""
    kind = F.when(F.col("module").isin(RESULTS), "SUMMARY").when(F.col("old_value").isNull(), "ADDED").when(F.col("new_value").isNull(), "REMOVED").otherwise("MODIFIED")
    name: Column = F.col("field")
    for pattern, said in _NAMES.items():
        name = F.when(F.col("field").rlike(pattern), F.lit(said)).otherwise(name)
    return changes.withColumn("change_type", kind).withColumn("field_name", name)


def stages(module: Column, field: Column) -> Column:
    """The stages of an event: those of its module and field, else of the module, else of any."""
    table = F.create_map(*[x for m, f, s in ROUTES for x in (F.lit(f"{m}\t{f}"), F.array(*map(F.lit, s)).cast("array<string>"))])
    m, f = F.lower(F.trim(module)), F.trim(F.element_at(F.split(F.lower(field), r"\."), 1))
    at = lambda a, b: F.try_element_at(table, F.concat(a, F.lit("\t"), b))
    return F.coalesce(at(m, f), at(m, F.lit("*")), at(F.lit("*"), F.lit("*")))


def job_stages(routed: DataFrame, keys: list[str]) -> DataFrame:
    """All stages that a job's events need."""
    return routed.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("stages")))).alias("stages"))


def transitions(found: DataFrame, keys: list[str], name: str, order: str) -> DataFrame:
    """The first modification of one field per key: old_value, new_value."""
    rows = found.where((F.col("field_name") == name) & (F.col("change_type") == "MODIFIED"))
    return rows.groupBy(*keys).agg(F.min_by(F.struct("old_value", "new_value"), order).alias("_t")).select(*keys, F.col("_t.old_value").alias("old_value"), F.col("_t.new_value").alias("new_value"))


def date_changes(found: DataFrame, keys: list[str]) -> DataFrame:
    """Modifications of dates: keys…, date_field, old_value, new_value."""
    names = F.create_map(*[F.lit(x) for item in DATE_FIELDS.items() for x in item])
    rows = found.where("change_type = 'MODIFIED'").withColumn("date_field", F.try_element_at(names, F.lower(F.trim("field_name"))))
    return rows.where("date_field is not null").select(*keys, "date_field", "old_value", "new_value")


def history_rows(found: DataFrame, keys: list[str], order: str) -> DataFrame:
    """What jobs write, in one pass: keys…, history ("status", "phase", "dates", "invalidated"), date_field, old_value, new_value.

    ``found`` are events; a job, one per ``keys``, does only the stages that its events need, and no history has a row
    without a new value. A job's row holds its first transitions and its changes of dates.
    """
    names = F.create_map(*[F.lit(x) for item in DATE_FIELDS.items() for x in item])
    modified = F.col("change_type") == "MODIFIED"
    rows = found.withColumn("_stages", stages(F.col("module"), F.col("field_name"))).withColumn("_date", F.when(modified, F.try_element_at(names, F.lower(F.trim("field_name")))))
    values = F.struct("old_value", "new_value")
    first = lambda name: F.min_by(values, F.when(modified & (F.col("field_name") == name), F.col(order)))
    needs = lambda stage: F.bool_or(F.array_contains("_stages", stage))
    jobs = rows.groupBy(*keys).agg(
        F.when(needs("STATUS_HISTORY"), first("overall status")).alias("_status"), F.when(needs("PHASE_HISTORY"), first("phase")).alias("_phase"),
        F.when(needs("DATE_HISTORY"), F.collect_list(F.when(F.col("_date").isNotNull(), F.struct(F.col("_date").alias("date_field"), "old_value", "new_value")))).alias("_dates"), needs("EMBED_INVALIDATE").alias("_embed"),
    )
    none = F.lit(None).cast("string")
    row = lambda history, date, t: F.struct(F.lit(history).alias("history"), date.alias("date_field"), (t["old_value"] if t is not None else none).alias("old_value"), (t["new_value"] if t is not None else none).alias("new_value"))
    some = F.array(F.when(F.col("_status.new_value") != "", row("status", none, F.col("_status"))), F.when(F.col("_phase.new_value") != "", row("phase", none, F.col("_phase"))), F.when(F.col("_embed"), row("invalidated", none, None)))
    dates = F.transform(F.filter(F.coalesce("_dates", F.array().cast("array<struct<date_field:string,old_value:string,new_value:string>>")), lambda t: t["new_value"] != ""), lambda t: row("dates", t["date_field"], t))
    return jobs.select(*keys, F.explode_outer(F.filter(F.concat(some, dates), lambda r: r.isNotNull())).alias("_r")).where("_r is not null").select(*keys, "_r.*")


def histories(found: DataFrame, keys: list[str], order: str) -> dict[str, DataFrame]:
    """What jobs write: "status" and "phase" (keys…, old_value, new_value), "dates" (with date_field), and "invalidated" (keys…): the parts of ``history_rows``."""
    rows = history_rows(found, keys, order)
    part = lambda name, *columns: rows.where(F.col("history") == name).select(*keys, *columns)
    values = ("old_value", "new_value")
    return {"status": part("status", *values), "phase": part("phase", *values), "dates": part("dates", "date_field", *values), "invalidated": part("invalidated")}


def events_of_text(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Events of rendered text: key, pos, module, field_name, change_type, old_value, new_value.

    Sections begin with "[Module]". Results make one SUMMARY event a section; lines of places are added (+), removed (-)
    or updated; outcome lines get the number of their outcome before the name.
    """
    raw = rows.select(key, F.transform(F.split(text, r"\R"), lambda x: F.trim(x)).alias("_lines"))
    named = lambda line: F.nullif(F.regexp_extract(line, r"^\[(.+)\]$", 1), F.lit(""))
    outcome = r"(?i)^(Primary|Secondary) Outcome #\d+:$"

    def cuts(mark) -> Column:
        """The places of the lines that ``mark`` finds, and the place after the last line."""
        return F.concat(F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: mark(F.get("_lines", i))), F.array(F.size("_lines")))

    def pieces(at: str) -> Column:
        """From each cut to the next: the place of the first line, and the lines."""
        return F.transform(F.slice(at, 1, F.size(at) - 1), lambda i, k: F.struct(i.alias("at"), F.slice("_lines", i + 1, F.get(at, k + 1) - i).alias("lines")))

    # sections are cut out of their text and the outcomes out of their section within a row; outer forms, as for others the optimizer computes each array twice
    sections = raw.select(key, "_lines", cuts(lambda x: named(x).isNotNull()).alias("_at")).select(key, F.transform(pieces("_at"), lambda s: s.withField("module", named(F.get(s["lines"], F.lit(0))))).alias("_s"))
    said = lambda s: F.filter(s["lines"], lambda x: (x != "") & named(x).isNull())
    of_module = lambda s: F.filter("_s", lambda t: t["module"] == s["module"])
    summed = lambda s: F.array(F.get(s["lines"], F.lit(0)), F.array_join(F.flatten(F.transform(of_module(s), said)), " "))
    first = F.filter("_s", lambda s: ~s["module"].isin(RESULTS) | (F.get(of_module(s), F.lit(0))["at"] == s["at"]))
    first = F.transform(first, lambda s: s.withField("lines", F.when(s["module"].isin(RESULTS), summed(s)).otherwise(s["lines"])))  # results: one line of all
    sections = sections.select(key, F.inline_outer(first).alias("_start", "_lines", "module"))
    inner = F.when(F.col("module") == "Outcome Measures", cuts(lambda x: x.rlike(outcome))).otherwise(F.array(F.size("_lines")))
    sections = sections.withColumn("_at", F.concat(F.array(F.lit(0)), inner)).select(key, "_start", "module", F.inline_outer(pieces("_at")).alias("_from", "_lines"))
    top = F.get("_lines", F.lit(0))
    sections = sections.withColumn("_outcome", F.when(top.rlike(outcome) & (F.col("module") == "Outcome Measures"), F.regexp_replace(top, r"(?i)^(\w+) Outcome (#\d+):$", "$1 $2.")))
    lines = sections.select(key, "_start", "module", "_outcome", "_from", F.posexplode_outer("_lines").alias("_i", "_line")).withColumn("pos", F.col("_start") + F.col("_from") + F.col("_i")).where(named(F.col("_line")).isNull() & (F.col("_line") != ""))
    part = lambda pattern, i: F.nullif(F.trim(F.regexp_extract("_line", pattern, i)), F.lit(""))
    modified, added, removed = r"^(.+?):\s+Old:\s+(.*?)\s+\|\s+New:\s+(.*?)\s*$", r"^(.+?):\s+Added:\s+(.*?)\s*$", r"^(.+?):\s+Removed:\s+(.*?)\s*$"
    summary = F.col("module").isin(RESULTS)
    place = F.col("module") == PLACES
    kind = (
        F.when(summary, "SUMMARY").when(F.col("_line").rlike(modified), "MODIFIED").when(F.col("_line").rlike(added), "ADDED").when(F.col("_line").rlike(removed), "REMOVED")
        .when(place & F.col("_line").rlike(r"^\+\s+."), "ADDED").when(place & F.col("_line").rlike(r"^-\s+."), "REMOVED")
    )
    mark = place & F.col("_line").rlike(r"^[+-]\s")
    body = F.regexp_replace("_line", r"^[+-]\s+", "")
    return lines.withColumn("change_type", kind).where("change_type is not null").select(
        key, "pos", "module", "change_type",
        F.when(summary, "_summary").when(mark, F.lit("location")).otherwise(F.concat(F.coalesce("_outcome", F.lit("")), part(r"^(.+?):\s", 1))).alias("field_name"),
        F.when(mark & (kind == "REMOVED"), body).when(kind == "MODIFIED", part(modified, 2)).when(kind == "REMOVED", part(removed, 2)).alias("old_value"),
        F.when(summary, F.col("_line")).when(mark & (kind == "ADDED"), body).when(kind == "MODIFIED", part(modified, 3)).when(kind == "ADDED", part(added, 2)).alias("new_value"),
    )


JOB_TYPES = ["TRIAL_MODIFIED", "NEW_TRIAL", "TRACKING_LIST_ADDED"]


def priority_rank() -> Column:
    """IMMEDIATE before NORMAL before all else."""
    return F.when(F.col("priority") == "IMMEDIATE", 0).when(F.col("priority") == "NORMAL", 1).otherwise(2)


def next_jobs(queue: DataFrame, limit: int, dept: str | None = None) -> DataFrame:
    """The pending jobs to do: by priority, then age, then id."""
    rows = queue.where("status = 'PENDING'")
    return (rows if dept is None else rows.where(F.col("dept") == dept)).orderBy(priority_rank(), "created_at", "id").limit(limit)


def finished(jobs: DataFrame, error: Column | None = None) -> DataFrame:
    """Jobs with their new status: FAILED with at most 1000 characters of the error, or for a type that nobody handles; else DONE."""
    problem = F.when(~F.col("job_type").isin(JOB_TYPES), F.concat(F.lit("unknown job type: "), F.col("job_type"))).otherwise(error if error is not None else F.lit(None).cast("string"))
    return jobs.withColumn("error", F.left(problem, F.lit(1000))).withColumn("status", F.when(problem.isNull(), "DONE").otherwise("FAILED"))


def invalidated(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents of touched records, ACTIVE turned to PENDING."""
    return set_where(documents, ids, ["id"], "document_status", "ACTIVE", "PENDING")


def new_jobs(queue: DataFrame, compared: DataFrame, candidates: DataFrame) -> DataFrame:
    """Jobs to append: changed records at once, new candidates normally; none that the queue has."""
    changed = compared.where(F.coalesce(F.col("field_change_count").try_cast("int"), F.lit(0)) > 0)
    jobs = changed.select("id", "dept", F.lit("TRIAL_MODIFIED").alias("job_type"), F.lit("IMMEDIATE").alias("priority"), "run_date").unionByName(candidates.select("id", "dept", F.lit("NEW_TRIAL").alias("job_type"), F.lit("NORMAL").alias("priority"), "run_date"))
    return insert_if_absent(queue.select(*jobs.columns), jobs, ["id", "dept", "job_type", "run_date"])


def only_invalidating(jobs: DataFrame) -> DataFrame:
    """Jobs of new or newly listed records, which only invalidate documents."""
    return jobs.where(F.col("job_type").isin("NEW_TRIAL", "TRACKING_LIST_ADDED"))
