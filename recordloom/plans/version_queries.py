"""Versions, differences, events and reports. A user's events are the versions of a record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import diff, events, reports, versions
from ..streaming import increments
from .registry import home_of, query, read

_INDEX = """v AS (
  SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version, strftime(ts, '%Y-%m-%d') AS date, event_type AS status,
         CAST(floor(coalesce(value, 0) * 100) AS BIGINT) AS cents, json_extract_string(props, '$.k') AS k
  FROM events)"""
_PAIRS = f"""{_INDEX}, p AS (
  SELECT id, lag(version) OVER w AS prev_version, version AS curr_version, count(*) OVER (PARTITION BY id) AS total_versions,
         lag(date) OVER w AS prev_date, date AS curr_date, lag(status) OVER w AS prev_status, status AS curr_status
  FROM v WINDOW w AS (PARTITION BY id ORDER BY version) QUALIFY lag(version) OVER w IS NOT NULL)"""
_CHANGES = f"""{_PAIRS}, j AS (
  SELECT p.id, prev_version, curr_version, a.status s0, b.status s1, a.cents c0, b.cents c1, a.k k0, b.k k1
  FROM p JOIN v a ON a.id = p.id AND a.version = prev_version JOIN v b ON b.id = p.id AND b.version = curr_version),
c AS (
  SELECT id, prev_version, curr_version, 'Study Status' AS module, 'overallStatus' AS field, s0 AS old_value, s1 AS new_value FROM j WHERE s0 IS DISTINCT FROM s1
  UNION ALL SELECT id, prev_version, curr_version, 'Study Status', 'amounts[0].cents', CAST(c0 AS VARCHAR), CAST(c1 AS VARCHAR) FROM j WHERE c0 <> c1
  UNION ALL SELECT id, prev_version, curr_version, 'Study Design', 'designInfo.k', k0, k1 FROM j WHERE k0 IS DISTINCT FROM k1)"""


def index(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ev = read(spark, d, "events")
    return ev.select(F.col("user_id").alias("id"), F.row_number().over(order).cast("long").alias("version"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("status"), F.floor(F.coalesce("value", F.lit(0.0)) * 100).cast("long").alias("cents"), "props")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """Each version as a nested document."""
    status = F.struct(F.col("status").alias("overallStatus"), F.array(F.struct("cents")).alias("amounts"))
    design = F.struct(F.struct(F.get_json_object("props", "$.k").alias("k")).alias("designInfo"))
    doc = F.struct(F.struct(status.alias("statusModule"), design.alias("designModule")).alias("protocolSection"))
    return index(spark, d).select("id", "version", F.parse_json(F.to_json(doc)).alias("doc"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return versions.pairs(index(spark, d), carry=("date", "status"))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    labels = F.array(*map(F.lit, ("Study Status", "Study Design", "Document Section")))
    return diff.field_changes(_pairs(spark, d).withColumn("module_labels", labels), documents(spark, d), depth=6)


@query(f"WITH {_PAIRS} SELECT * FROM p")
def version_pairs(spark, d):
    return _pairs(spark, d)


@query(f"WITH {_PAIRS} SELECT * FROM p WHERE curr_version = total_versions")
def latest_pair(spark, d):
    return versions.latest_pair(index(spark, d), carry=("date", "status"))


@query(f"""WITH {_INDEX}, c AS (SELECT DISTINCT id, CASE WHEN id % 5 = 0 THEN 100000 ELSE id % 40 + 1 END AS stored FROM v WHERE id % 3 <> 0),
m AS (SELECT v.id, version, stored, lag(version) OVER (PARTITION BY v.id ORDER BY version) AS prev_version, max(version) OVER (PARTITION BY v.id) AS top,
      max(CASE WHEN version = stored THEN 1 ELSE 0 END) OVER (PARTITION BY v.id) AS has FROM v LEFT JOIN c ON c.id = v.id)
SELECT id, prev_version, version AS curr_version FROM m WHERE prev_version IS NOT NULL AND CASE WHEN has = 1 THEN version > stored ELSE version = top END""")
def gap_fill_chain(spark, d):
    ix = index(spark, d)
    cache = ix.select("id").distinct().where("id % 3 <> 0").select("id", F.when(F.col("id") % 5 == 0, 100000).otherwise(F.col("id") % 40 + 1).alias("stored"))
    return versions.gap_pairs(ix, cache)


@query(f"WITH {_PAIRS} SELECT id, curr_version, prev_version FROM p WHERE curr_version = total_versions")
def carry_forward(spark, d):
    """Of all pairs compared before, those whose record has no newer version."""
    newest = versions.latest(index(spark, d), ["id"], ["version"])
    prior = _pairs(spark, d).select("id", "prev_version", "curr_version")
    return versions.unchanged(newest, prior).select("id", "curr_version", "prev_version")


@query("SELECT c_custkey AS id, 0 AS prev_version, 0 AS curr_version FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def sentinel_rows(spark, d):
    return versions.sentinels(read(spark, d, "customer").select(F.col("c_custkey").alias("id")), index(spark, d))


@query(f"WITH {_CHANGES} SELECT * FROM c")
def field_diff(spark, d):
    return _changes(spark, d)


@query(f"WITH {_CHANGES} SELECT module, field, count(*) AS n FROM c GROUP BY ALL")
def diff_counts(spark, d):
    return _changes(spark, d).groupBy("module", "field").agg(F.count("*").alias("n"))


@query(f"""WITH {_CHANGES} SELECT id, module, count(*) FILTER (old_value IS NULL) AS n_added, count(*) FILTER (old_value IS NOT NULL AND new_value IS NOT NULL) AS n_changed,
count(*) FILTER (new_value IS NULL) AS n_removed FROM c GROUP BY id, module""")
def diff_summary(spark, d):
    return diff.result_counts(_changes(spark, d), ["id"])


_RENDER = f"""WITH {_CHANGES}, r AS (
  SELECT id, prev_version, curr_version, module, '[' || module || ']' || chr(10) || string_agg('  ' || CASE field WHEN 'overallStatus' THEN 'Overall Status' WHEN 'designInfo.k' THEN 'Design Info - K' ELSE 'Amounts #1 - Cents' END || ': ' ||
    CASE WHEN old_value IS NULL THEN 'Added: ' || new_value WHEN new_value IS NULL THEN 'Removed: ' || old_value ELSE 'Old: ' || old_value || '  |  New: ' || new_value END, chr(10) ORDER BY field) AS text, count(*) AS n
  FROM c GROUP BY id, prev_version, curr_version, module)
SELECT id, prev_version, curr_version, CAST(sum(n) AS BIGINT) AS field_change_count, string_agg(text, chr(10) || chr(10) ORDER BY module) AS field_changes FROM r GROUP BY ALL"""


@query(_RENDER)
def diff_text(spark, d):
    return diff.render(_changes(spark, d), ["id", "prev_version", "curr_version"])


@query(f"""WITH {_CHANGES} SELECT id, curr_version, module, CASE field WHEN 'overallStatus' THEN 'Overall Status' WHEN 'designInfo.k' THEN 'Design Info - K' ELSE 'Amounts #1 - Cents' END AS field_name,
CASE WHEN old_value IS NULL THEN 'ADDED' WHEN new_value IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS change_type, old_value, new_value FROM c""")
def events_of_text(spark, d):
    """Rendered differences, parsed back."""
    text = diff.render(_changes(spark, d), ["id", "prev_version", "curr_version"]).withColumn("key", F.struct("id", "curr_version"))
    return events.events_of_text(text, "key", "field_changes").select("key.id", "key.curr_version", "module", "field_name", "change_type", "old_value", "new_value")


@query(f"""WITH {_CHANGES} SELECT id, curr_version, module, CASE field WHEN 'overallStatus' THEN 'overall status' ELSE field END AS field_name,
CASE WHEN old_value IS NULL THEN 'ADDED' WHEN new_value IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS change_type,
CASE WHEN field = 'overallStatus' THEN 'STATUS_HISTORY,EMBED_INVALIDATE' ELSE 'EMBED_INVALIDATE' END AS stages FROM c""")
def event_route(spark, d):
    found = events.events(_changes(spark, d))
    return found.select("id", "curr_version", "module", "field_name", "change_type", F.array_join(events.stages(F.col("module"), F.col("field_name")), ",").alias("stages"))


@query(f"WITH {_CHANGES} SELECT id, CASE WHEN bool_or(field = 'overallStatus') THEN 'EMBED_INVALIDATE,STATUS_HISTORY' ELSE 'EMBED_INVALIDATE' END AS stages FROM c GROUP BY id")
def job_stages(spark, d):
    found = events.events(_changes(spark, d))
    return events.job_stages(found.withColumn("stages", events.stages(F.col("module"), F.col("field_name"))), ["id"]).select("id", F.array_join("stages", ",").alias("stages"))


@query(f"WITH {_CHANGES} SELECT id, CASE WHEN bool_or(field = 'overallStatus') THEN 'EMBED_INVALIDATE,STATUS_HISTORY' ELSE 'EMBED_INVALIDATE' END AS stages FROM c GROUP BY id")
def all_job_stages(spark, d):
    """The stages of the changes of all versions, as ``job_stages``."""
    found = events.events(_changes(spark, d))
    return events.job_stages(found.withColumn("stages", events.stages(F.col("module"), F.col("field_name"))), ["id"]).select("id", F.array_join("stages", ",").alias("stages"))


@query(f"WITH {_CHANGES} SELECT id, arg_min(old_value, curr_version) AS old_value, arg_min(new_value, curr_version) AS new_value FROM c WHERE field = 'overallStatus' GROUP BY id")
def status_history(spark, d):
    return events.transitions(events.events(_changes(spark, d)), ["id"], "overall status", "curr_version")


@query(f"WITH {_PAIRS} SELECT id, curr_version, 'start_date' AS date_field, prev_date AS old_value, curr_date AS new_value FROM p WHERE prev_date <> curr_date")
def date_history(spark, d):
    p = _pairs(spark, d).where("prev_date <> curr_date").select("id", "curr_version", F.lit("Study Status").alias("module"), F.lit("startDateStruct.date").alias("field"), F.col("prev_date").alias("old_value"), F.col("curr_date").alias("new_value"))
    return events.date_changes(events.events(p), ["id", "curr_version"])


_FACILITY = """s AS (
  SELECT l_orderkey AS id, month(l_shipdate) % 2 = 1 AS old, 'S' || l_suppkey AS place, l_returnflag AS city, l_linestatus AS country, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
         row_number() OVER (PARTITION BY l_orderkey, month(l_shipdate) % 2, l_suppkey ORDER BY l_linenumber DESC, l_returnflag DESC, l_linestatus DESC, l_quantity DESC) AS n FROM lineitem),
u AS (SELECT * FROM s WHERE n = 1), o AS (SELECT * FROM u WHERE old), w AS (SELECT * FROM u WHERE NOT old),
j AS (SELECT coalesce(o.id, w.id) AS id, coalesce(o.place, w.place) AS place, o.city c0, w.city c1, o.country k0, w.country k1, o.quantity q0, w.quantity q1 FROM o FULL JOIN w ON o.id = w.id AND o.place = w.place)"""


@query(f"""WITH {_FACILITY}
SELECT id, CASE WHEN q0 IS NULL THEN '__added__' ELSE '__removed__' END AS field, CASE WHEN q0 IS NOT NULL THEN concat_ws(', ', place, c0, k0) END AS old_value, CASE WHEN q1 IS NOT NULL THEN concat_ws(', ', place, c1, k1) END AS new_value FROM j WHERE q0 IS NULL OR q1 IS NULL
UNION ALL SELECT id, 'location.city [' || place || ']', c0, c1 FROM j WHERE q0 IS NOT NULL AND q1 IS NOT NULL AND c0 <> c1
UNION ALL SELECT id, 'location.country [' || place || ']', k0, k1 FROM j WHERE q0 IS NOT NULL AND q1 IS NOT NULL AND k0 <> k1
UNION ALL SELECT id, 'location.quantity [' || place || ']', q0, q1 FROM j WHERE q0 IS NOT NULL AND q1 IS NOT NULL AND q0 <> q1""")
def facility_diff(spark, d):
    li = read(spark, d, "lineitem")
    place = F.struct(F.col("l_linenumber").alias("n"), F.concat(F.lit("S"), "l_suppkey").alias("facility"), F.col("l_returnflag").alias("city"), F.col("l_linestatus").alias("country"), F.col("l_quantity").cast("long").alias("quantity"))
    sides = li.groupBy(F.col("l_orderkey").alias("id"), (F.month("l_shipdate") % 2 == 1).alias("old")).agg(F.array_sort(F.collect_list(place)).alias("p"))
    doc = F.struct(F.transform("p", lambda x: x.dropFields("n")).alias("locations"))
    return diff.place_changes(sides.select("id", "old", F.parse_json(F.to_json(doc)).alias("doc")), ["id"], depth=3)


@query(f"WITH {_PAIRS} SELECT id, count(*) AS pairs, string_agg(prev_version || '-' || curr_version || '=' || coalesce(curr_status, ''), ', ' ORDER BY curr_version) AS by_pair, max(curr_status) FILTER (prev_version = 1) AS \"1-2\", max(curr_status) FILTER (prev_version = 2) AS \"2-3\" FROM p GROUP BY id")
def wide_pair_report(spark, d):
    """All pairs of a record in one map, shown as text in the order of versions, and a page of two columns out of it."""
    pair = F.concat_ws("-", F.col("prev_version").cast("string"), F.col("curr_version").cast("string"))
    wide = reports.wide_pairs(_pairs(spark, d), "id", pair, "curr_status")
    page = reports.pair_columns(wide, "id", ["1-2", "2-3"])
    number = lambda e: F.element_at(F.split(e["key"], "-"), 2).cast("long")
    entries = F.array_sort(F.transform(F.map_entries("by_pair"), lambda e: F.struct(number(e).alias("n"), F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))).alias("text"))))
    text = wide.select("id", F.size("by_pair").cast("long").alias("pairs"), F.array_join(F.transform(entries, lambda e: e["text"]), ", ").alias("by_pair"))
    return text.join(page, "id")


@query(f"WITH {_CHANGES}, m AS (SELECT id, arg_min(old_value, curr_version) AS old_value, arg_min(new_value, curr_version) AS new_value FROM c WHERE field = 'overallStatus' GROUP BY id) SELECT 'status' AS history, id, old_value, new_value FROM m UNION ALL SELECT DISTINCT 'invalidated', id, NULL, NULL FROM c")
def job_histories(spark, d):
    """All histories that a record's events feed, and the records whose documents are invalidated."""
    return events.history_rows(events.events(_changes(spark, d)), ["id"], "curr_version").select("history", "id", "old_value", "new_value")


@query(f"WITH {_PAIRS} SELECT id, prev_version || '-' || curr_version AS pair, curr_status AS value FROM p")
def pair_report(spark, d):
    """All pairs of all ids as long rows, where ``wide_pair_report`` has columns."""
    return _pairs(spark, d).select("id", F.concat_ws("-", F.col("prev_version").cast("string"), F.col("curr_version").cast("string")).alias("pair"), F.col("curr_status").alias("value"))


@query(f"WITH {_PAIRS} SELECT id, string_agg(curr_version || ': ' || curr_status, chr(10) ORDER BY curr_version) AS lines FROM p GROUP BY id")
def stacked_versions(spark, d):
    return reports.stacked(_pairs(spark, d), "id", "curr_version", F.concat_ws(": ", F.col("curr_version").cast("string"), "curr_status"))


_NOTE = f"""{_PAIRS}, n AS (SELECT c_custkey AS id FROM customer), t AS (SELECT id, count(*) AS total_versions FROM v GROUP BY id)"""
_NOTED = f"""{_NOTE}, r AS (SELECT n.id, coalesce(t.total_versions, 0) AS total_versions, p.prev_version, p.curr_version, p.prev_date, p.curr_date, p.curr_status,
  CASE WHEN p.curr_version % 2 = 0 THEN 'Study Status' WHEN p.curr_version IS NOT NULL THEN '' END AS modules_changed
  FROM n LEFT JOIN t ON t.id = n.id LEFT JOIN p ON p.id = n.id AND p.curr_version = p.total_versions)"""
_NOTE_CASE = "CASE WHEN total_versions = 0 THEN 'NO_HISTORY' WHEN total_versions = 1 THEN 'SINGLE_VERSION' WHEN coalesce(modules_changed, '') = '' THEN 'NO_CHANGES_IN_VERSION' ELSE '' END"


def _compared(spark, d):
    nct = lambda c: F.concat(F.lit("NCT"), F.lpad(F.col(c).cast("string"), 8, "0"))
    ix = index(spark, d).withColumn("id", nct("id"))
    labels = F.when(F.col("curr_version") % 2 == 0, F.array(F.lit("Study Status"))).otherwise(F.array().cast("array<string>"))
    pairs = versions.latest_pair(ix, carry=("date", "status")).withColumn("module_labels", labels)
    docs = documents(spark, d).withColumn("id", nct("id"))
    text = diff.render(diff.field_changes(pairs, docs, depth=6), ["id", "prev_version", "curr_version"])
    wanted = read(spark, d, "customer").select(nct("c_custkey").alias("id"))
    return diff.comparison_rows(wanted, pairs, ix, text)


@query(f"WITH {_NOTED} SELECT 'NCT' || lpad(CAST(id AS VARCHAR), 8, '0') AS id, {_NOTE_CASE} AS note, total_versions, prev_version, curr_version, prev_date, curr_date, curr_status, modules_changed FROM r")
def comparison_rows(spark, d):
    return _compared(spark, d).drop("field_change_count", "field_changes")


@query(f"WITH {_NOTED}, q AS (SELECT {_NOTE_CASE} AS note FROM r) SELECT CASE WHEN note = '' THEN 'OK' ELSE note END AS note, count(*) AS n FROM q GROUP BY ALL")
def note_histogram(spark, d):
    return reports.note_counts(_compared(spark, d))


@query(f"WITH {_PAIRS} SELECT id, prev_version, curr_version FROM p")
def streamed_version_pairs(spark, d):
    """Pairs from keyed state: all versions read as a stream until it is drained."""
    home = home_of(spark, "version-pairs")
    index(spark, d).select(F.col("id").cast("string").alias("id"), "version").write.parquet(f"{home}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", increments.ROCKS)
    try:
        stream = increments.version_pairs(increments.landings(spark, f"{home}/in", "id string, version long"))
        increments.drain(stream, f"{home}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{home}/out/batch={n}")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema(increments.PAIRS).parquet(f"{home}/out").select(F.col("id").cast("long").alias("id"), "prev_version", "curr_version")


@query(f"WITH {_PAIRS} SELECT id, prev_version, curr_version FROM p")
def repaired_version_pairs(spark, d):
    """Pairs from keyed state of versions that come in any order, a file at a time: a late one takes its pair back and gives two."""
    home = home_of(spark, "repaired-pairs")
    index(spark, d).select(F.col("id").cast("string").alias("id"), "version").repartition(4, F.hash("id", "version")).write.parquet(f"{home}/in")
    lanes = max(32, read(spark, d, "events").count() // 25_000)
    with increments.rocks(spark):
        stream = increments.pair_changes(increments.landings(spark, f"{home}/in", "id string, version long", files=1), lanes=lanes)
        increments.drain(stream, f"{home}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{home}/out/batch={n}")).awaitTermination()
    pairs = increments.standing_pairs(spark.read.schema(increments.PAIR_CHANGES).parquet(f"{home}/out"))
    return pairs.withColumn("id", F.col("id").cast("long"))
