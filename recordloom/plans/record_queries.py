"""Matching, classification, names, keyed writes, queues and concepts, on the tables at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths, scalars
from ..operators import classify, concepts, events, flatten, match, merge, normalize, redirects, reports, versions
from ..sources import landing
from ..streaming import increments
from .registry import dealt, home_of, query, read

_SPLIT = "1996-01-01"

# ---- fields


@query("""SELECT o_orderkey, CASE WHEN lower(trim(o_orderstatus)) IN ('f', 'o') THEN NULL END AS none_flag,
CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 4 = 1 THEN false WHEN o_orderkey % 4 = 2 THEN true END AS flag, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS INTEGER) AS number FROM orders""")
def to_bool_and_int(spark, d):
    o = read(spark, d, "orders")
    word = F.when(F.col("o_orderkey") % 4 == 0, " TRUE").when(F.col("o_orderkey") % 4 == 1, "no").when(F.col("o_orderkey") % 4 == 2, "1").otherwise("maybe")
    number = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".5")))
    return o.select("o_orderkey", scalars.to_bool(F.col("o_orderstatus")).alias("none_flag"), scalars.to_bool(word).alias("flag"), scalars.text_to_int(number).alias("number"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') END AS date, CASE o_orderkey % 3 WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' END AS precision FROM orders""")
def date_pair(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.left(day, F.lit(7))).otherwise(F.date_format("o_orderdate", "MMM yyyy"))
    return read(spark, d, "orders").select("o_orderkey", scalars.date_pair(raw).alias("p")).select("o_orderkey", F.col("p.date").cast("string").alias("date"), "p.precision")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS value, CASE WHEN p_size % 2 = 0 THEN 'YEARS' END AS unit, CASE WHEN p_size % 2 = 0 THEN '>=' || p_size || ' Years | Adult' ELSE 'Adult' END AS ages FROM part")
def min_age(spark, d):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat_ws(" ", F.col("p_size").cast("string"), F.lit("Years"))).otherwise("N/A")
    rows = read(spark, d, "part").select("p_partkey", scalars.min_age(raw).alias("a"))
    return rows.select("p_partkey", "a.value", "a.unit", scalars.age_range(F.col("a.value"), F.col("a.unit"), F.array(F.lit(" Adult"), F.lit(""), F.lit("Adult "))).alias("ages"))


@query("SELECT p_partkey, upper(replace(replace(p_type, ' ', ''), ',', '_')) || '_' || upper(replace(p_brand, ' ', '')) AS phase FROM part")
def phase_norm(spark, d):
    return read(spark, d, "part").select("p_partkey", scalars.phases_of_text(F.concat_ws(", ", "p_type", "p_brand")).alias("phase"))


@query("SELECT s_suppkey, trim(regexp_replace(s_name, '\\s+', ' ', 'g')) AS clean FROM supplier")
def legal_suffix_clean(spark, d):
    forms = F.element_at(F.array(*map(F.lit, (" Co., Ltd.", ", Inc.", " GmbH", " LLC, Inc."))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return read(spark, d, "supplier").select("s_suppkey", scalars.strip_legal_form(F.concat("s_name", forms)).alias("clean"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([upper(trim(x)) FOR x IN string_split(p_name || ' ' || p_brand, ' ') IF trim(x) <> ''])), '|') AS tokens FROM part")
def sorted_tokens(spark, d):
    return read(spark, d, "part").select("p_partkey", scalars.sorted_tokens(F.replace(F.concat_ws(" ", "p_name", "p_brand"), F.lit(" "), F.lit("|"))).alias("tokens"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place FROM lineitem")
def natural_order(spark, d):
    """Places by the natural order of paths such as lines[12].part[7]."""
    path = F.concat(F.lit("lines["), F.col("l_linenumber").cast("string"), F.lit("].part["), F.col("l_partkey").cast("string"), F.lit("]"))
    order = Window.partitionBy("l_orderkey").orderBy(paths.natural_key(path), "l_suppkey", "l_quantity", "l_extendedprice")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(order).cast("long").alias("place"))


@query("SELECT l_orderkey, l_linenumber, 'Primary Outcomes #' || (l_linenumber + 1) || ' - Time Frame' AS said, 'Old: <' || l_returnflag || '>  |  New: é & ' || l_linestatus AS label FROM lineitem")
def readable_change(spark, d):
    path = F.concat(F.lit("outcomesModule.primaryOutcomes["), F.col("l_linenumber").cast("string"), F.lit("].timeFrame"))
    label = paths.change_label(F.concat(F.lit("&lt;"), "l_returnflag", F.lit("&gt;")), F.concat(F.lit("&#233; &amp; "), "l_linestatus"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", paths.readable(path).alias("said"), label.alias("label"))


@query("""SELECT doc_id, coalesce('[source] ' || nullif(source, ''), '') || CASE WHEN source <> '' AND text <> '' THEN chr(10) || chr(10) ELSE '' END || coalesce('[text] ' || nullif(text, ''), '') AS sections FROM documents""")
def labelled_sections(spark, d):
    sections = scalars.labelled_sections({"source": F.col("source"), "none": F.lit(None).cast("string"), "text": F.col("text")}, None, None)
    return read(spark, d, "documents").select("doc_id", sections.alias("sections"))


@query("""SELECT doc_id, concat_ws(chr(10) || chr(10), CASE WHEN source <> '' THEN '[source] ' || source END, CASE WHEN text <> '' THEN '[text] ' || text END) AS sections FROM documents""")
def whole_sections(spark, d):
    """Whole texts of every row, as ``labelled_sections``."""
    return read(spark, d, "documents").select("doc_id", scalars.labelled_sections({"source": F.col("source"), "text": F.col("text")}).alias("sections"))


# ---- keywords and classification

_TERMS = ("password", "MIT License", "of the", "und die", "para los")
_WORDS = "(VALUES " + ", ".join(f"('{t.lower()}', {i})" for i, t in enumerate(_TERMS)) + ") AS k(term, ord)"
_HAS = "regexp_matches(lower(text), '(^|[^a-z0-9_à-ÿ])' || term || '($|[^a-z0-9_à-ÿ])')"


def _terms(spark) -> DataFrame:
    return spark.createDataFrame([(t.lower(), t.upper(), i) for i, t in enumerate(_TERMS)], "term string, canonical string, ord int")


@query(f"SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM {_WORDS} WHERE {_HAS})")
def keyword_semi_match(spark, d):
    pattern = F.concat(F.lit("(?i)(?<![a-z0-9_à-ÿ])"), match.quoted(F.col("term")), F.lit("(?![a-z0-9_à-ÿ])"))
    found = match.matches(read(spark, d, "documents"), "doc_id", F.lower("text"), _terms(spark), lambda c: pattern)
    return found.select("doc_id").distinct()


@query(f"""WITH h AS (SELECT doc_id, upper(term) AS c, ord FROM documents, {_WORDS} WHERE regexp_matches(lower(text), '(^|[^a-z0-9])' || term || '($|[^a-z0-9])'))
SELECT doc_id, string_agg(c, ' | ' ORDER BY ord) AS tags FROM h GROUP BY doc_id""")
def tag_terms(spark, d):
    return match.tagged(read(spark, d, "documents"), "doc_id", F.col("text"), _terms(spark))


@query("SELECT p.p_partkey, b.term FROM part p JOIN (SELECT DISTINCT lower(p_brand) AS term FROM part) b ON lower(p.p_brand) = b.term")
def many_keywords(spark, d):
    """Many keywords against many texts: joined by word first."""
    part = read(spark, d, "part")
    absent = spark.range(match.PREFILTER_FROM).select(F.concat(F.lit("absent term "), F.col("id").cast("string")).alias("term"))
    words = part.select(F.lower("p_brand").alias("term")).distinct().unionByName(absent)
    rows = part.select("p_partkey", F.concat_ws(" ", F.lit("x"), "p_brand", F.lit("y")).alias("text"))
    return match.matches(rows, "p_partkey", F.col("text"), words, match.between_alnum).select("p_partkey", "term")


@query("SELECT lower(trim(term)) AS term, min(ord) AS ord FROM (SELECT p_brand AS term, 0 AS ord FROM part UNION ALL SELECT x, 0 FROM (SELECT unnest(string_split(p_type, ' ')) AS x FROM part) UNION ALL SELECT n_name, 1 FROM nation) WHERE lower(trim(term)) NOT IN ('', '-', 'nan') GROUP BY 1")
def keyword_set(spark, d):
    drugs = read(spark, d, "part").select(F.col("p_brand").alias("drug_name"), F.replace("p_type", F.lit(" "), F.lit("|")).alias("alias_names"))
    return match.keyword_set(drugs, read(spark, d, "nation").select(F.col("n_name").alias("term")))


_CLASSIFY = """WITH p AS (SELECT DISTINCT source AS pipeline FROM documents WHERE source IS NOT NULL),
r AS (SELECT doc_id AS id, CAST(n_chars AS VARCHAR) AS updated FROM documents),
c AS (SELECT r.id, r.updated, p.pipeline,
  CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.id AND l.quality = 1 AND (l.doc_id + length(p.pipeline) + ascii(right(p.pipeline, 1))) % 2 = 0)
       THEN CASE WHEN r.id % 3 = 0 AND r.id % 2 = 0 THEN 'modified' ELSE 'stale' END
       WHEN regexp_matches(t.text, '(^|[^A-Za-z0-9])password') THEN 'new' ELSE 'unmatched' END AS bucket
  FROM r CROSS JOIN p JOIN documents t ON t.doc_id = r.id WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.id AND l.toxic = 1))"""


def _classified(spark, d, how=classify.classify) -> DataFrame:
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    pipelines = docs.select(F.col("source").alias("pipeline")).where("pipeline is not null").distinct()
    records = docs.select(F.col("doc_id").alias("id"), F.col("n_chars").cast("string").alias("updated"))
    every = labels.crossJoin(F.broadcast(pipelines)).select(F.col("doc_id").alias("id"), "pipeline", "quality", "toxic")
    tracking = every.where((F.col("quality") == 1) & ((F.col("id") + F.length("pipeline") + F.ascii(F.right("pipeline", F.lit(1)))) % 2 == 0))
    hits = docs.where(F.col("text").rlike("(^|[^A-Za-z0-9])password")).select(F.col("doc_id").alias("id")).crossJoin(F.broadcast(pipelines))
    known = docs.where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, "other").otherwise(F.col("n_chars").cast("string")).alias("known_date"))
    return how(records, pipelines, tracking, every.where("toxic = 1"), hits, known)


@query(f"{_CLASSIFY} SELECT * FROM c")
def classify_trials(spark, d):
    return _classified(spark, d)


_COUNTS = "count(*) FILTER (bucket = 'new') AS new, count(*) FILTER (bucket = 'modified') AS modified, count(*) FILTER (bucket = 'unmatched') AS unmatched, count(*) FILTER (bucket = 'stale') AS stale"


@query(f"{_CLASSIFY} SELECT pipeline, {_COUNTS} FROM c GROUP BY pipeline")
def bucket_counts(spark, d):
    return _classified(spark, d, classify.counts)


@query(f"{_CLASSIFY} SELECT * FROM c")
def classify_all(spark, d):
    """Every record against every source, as ``classify_trials``."""
    return _classified(spark, d)


@query(f"{_CLASSIFY} SELECT pipeline, {_COUNTS} FROM c GROUP BY pipeline")
def bucket_counts_all(spark, d):
    return classify.bucket_counts(_classified(spark, d))


@query(f"""{_CLASSIFY}, n AS (SELECT {_COUNTS} FROM c), o AS (SELECT count(*) FILTER (o_orderkey % 7 > 0) AS diffs FROM orders), k AS (SELECT count(*) AS fixes FROM customer WHERE c_custkey % 10 = 0)
SELECT 'new_candidates' AS item, new AS n FROM n UNION ALL SELECT 'unmatched', unmatched FROM n UNION ALL SELECT 'modified_trials', modified FROM n UNION ALL SELECT 'field_diffs', diffs FROM o UNION ALL SELECT 'canonical_fixes', fixes FROM k""")
def run_digest(spark, d):
    compared = read(spark, d, "orders").select((F.col("o_orderkey") % 7).alias("field_change_count"))
    moved = read(spark, d, "customer").where("c_custkey % 10 = 0")
    return reports.digest(reports.run_row(_classified(spark, d, classify.counts), compared, moved, F.lit("2024-01-30"), F.lit(0.0)))


@query("""SELECT n_name AS pipeline, (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_nationkey = n_nationkey) AS tracked, (SELECT count(DISTINCT s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey) AS rejected,
(SELECT string_agg(DISTINCT lower(c_mktsegment), ',' ORDER BY lower(c_mktsegment)) FROM customer WHERE c_nationkey = n_nationkey) AS keywords FROM nation
WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey) OR EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey)""")
def pipeline_registry(spark, d):
    n = F.broadcast(read(spark, d, "nation"))
    c, s = read(spark, d, "customer"), read(spark, d, "supplier")
    tracking = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("pipeline"), F.col("c_custkey").alias("id"), F.lower("c_mktsegment").alias("term"))
    rejected = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("pipeline"), F.col("s_suppkey").alias("id"))
    found = classify.registry(tracking.select("pipeline", "id"), rejected, tracking.select("pipeline", "term"))
    return found.withColumn("keywords", F.array_join("keywords", ","))


# ---- names

_ALIAS = "(SELECT lower(n_name) AS alias, r_name AS canonical FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0)"


def _aliases(spark, d) -> DataFrame:
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    rows = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).where("n_nationkey % 2 = 0")
    return normalize.alias_map([rows.select(F.col("n_name").alias("alias"), F.col("r_name").alias("canonical"))])


@query(f"SELECT c_custkey, coalesce(canonical, n_name) AS name FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN {_ALIAS} a ON a.alias = lower(n_name)")
def alias_normalize(spark, d):
    c, n = read(spark, d, "customer"), read(spark, d, "nation")
    rows = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", F.concat(F.lit(" "), F.lower("n_name")).alias("raw"), "n_name")
    return normalize.with_canonical(rows, "raw", _aliases(spark, d), "name").select("c_custkey", F.when(F.lower(F.trim("raw")) == F.col("name"), F.col("n_name")).otherwise(F.col("name")).alias("name"))


@query(f"""WITH i AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = (o_orderkey + c_nationkey) % 25),
m AS (SELECT o_custkey, pos, coalesce(canonical, n_name) AS v FROM i LEFT JOIN {_ALIAS} a ON a.alias = lower(n_name)), f AS (SELECT o_custkey, min(pos) AS pos, arg_min(v, pos) AS v FROM m GROUP BY o_custkey, lower(v))
SELECT o_custkey, string_agg(v, ' | ' ORDER BY pos) AS names FROM f GROUP BY o_custkey""")
def list_dedupe(spark, d):
    o, c, n = read(spark, d, "orders"), read(spark, d, "customer"), read(spark, d, "nation")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), F.col("n_nationkey") == (F.col("o_orderkey") + F.col("c_nationkey")) % 25)
    lists = rows.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "n_name"))), lambda s: s["n_name"]).alias("raw"))
    return normalize.list_canonical(lists, "o_custkey", F.col("raw"), _aliases(spark, d), "names").select("o_custkey", F.array_join("names", " | ").alias("names"))


@query("SELECT DISTINCT lower(p_brand) AS alias, p_brand AS canonical FROM part")
def drug_aliases(spark, d):
    rows = read(spark, d, "part").select(F.col("p_brand").alias("drug_name"), F.concat(F.lit("-| |"), F.upper("p_brand")).alias("alias_names"))
    return normalize.drug_aliases(rows)


@query("SELECT p_brand, min(p_name) AS p_name FROM part GROUP BY p_brand")
def first_alias(spark, d):
    return normalize.first_alias(read(spark, d, "part").select("p_brand", "p_name"), "p_brand", "p_name")


# ---- keyed tables: orders before a day are the target, a batch changes every third of them and adds the rest

_TARGET = f"t AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS seen FROM orders WHERE o_orderdate < TIMESTAMP '{_SPLIT}')"
_BATCH = f"b AS (SELECT o_orderkey AS id, 'X' AS status, 'none' AS priority, '2000-01-01' AS seen FROM orders WHERE o_orderdate >= TIMESTAMP '{_SPLIT}' OR o_orderkey % 3 = 0)"


def _target(spark, d) -> DataFrame:
    o = read(spark, d, "orders").where(F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp"))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"))


def _batch(spark, d) -> DataFrame:
    o = read(spark, d, "orders").where((F.col("o_orderdate") >= F.lit(_SPLIT).cast("timestamp")) | (F.col("o_orderkey") % 3 == 0))
    rows = o.select(F.col("o_orderkey").alias("id"), F.lit("X").alias("status"), F.lit("none").alias("priority"), F.lit("2000-01-01").alias("seen"))
    return merge.prepared(rows.union(rows.withColumn("status", F.lit("W"))), ["id"], [F.col("status")])


@query(f"WITH {_TARGET}, {_BATCH} SELECT coalesce(b.id, t.id) AS id, coalesce(b.status, t.status) AS status, coalesce(b.priority, t.priority) AS priority, coalesce(b.seen, t.seen) AS seen FROM t FULL JOIN b ON b.id = t.id")
def upsert_merge(spark, d):
    return merge.upsert(_target(spark, d), _batch(spark, d), ["id"])


@query(f"WITH {_TARGET}, {_BATCH} SELECT coalesce(b.id, t.id) AS id, coalesce(b.status, t.status) AS status, coalesce(t.priority, b.priority) AS priority, coalesce(b.seen, t.seen) AS seen FROM t FULL JOIN b ON b.id = t.id")
def upsert_preserve(spark, d):
    return merge.upsert(_target(spark, d), _batch(spark, d), ["id"], preserve=["priority"])


@query(f"WITH {_TARGET}, {_BATCH} SELECT * FROM b WHERE id NOT IN (SELECT id FROM t)")
def insert_if_absent(spark, d):
    return merge.insert_if_absent(_target(spark, d), _batch(spark, d), ["id"])


@query(f"WITH {_TARGET}, {_BATCH} SELECT coalesce(b.id, t.id) AS id, coalesce(t.status, b.status) AS status, coalesce(t.priority, b.priority) AS priority, coalesce(b.seen, t.seen) AS seen FROM t FULL JOIN b ON b.id = t.id")
def touch_last_seen(spark, d):
    return merge.touch(_target(spark, d), _batch(spark, d), ["id"], "seen")


@query(f"WITH {_TARGET}, {_BATCH} SELECT count(*) FILTER (t.id IS NULL) AS n_new, count(*) FILTER (t.id IS NOT NULL) AS n_repeated FROM b LEFT JOIN t ON t.id = b.id")
def new_and_repeated(spark, d):
    return merge.new_and_repeated(_target(spark, d), _batch(spark, d), ["id"])


@query("""WITH t AS (SELECT c_name AS name, 'r1' AS first_seen_run, 'r2' AS last_seen_run, CAST(count(*) AS BIGINT) AS occurrence_count FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 2 = 0 GROUP BY c_name),
s AS (SELECT DISTINCT c_name AS name FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 3 = 0)
SELECT coalesce(t.name, s.name) AS name, coalesce(first_seen_run, 'r3') AS first_seen_run, CASE WHEN s.name IS NOT NULL THEN 'r3' ELSE last_seen_run END AS last_seen_run,
coalesce(occurrence_count, 0) + CASE WHEN s.name IS NULL THEN 0 ELSE 1 END AS occurrence_count FROM t FULL JOIN s ON s.name = t.name""")
def counter_upsert(spark, d):
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    names = o.join(c, o["o_custkey"] == c["c_custkey"]).select("c_custkey", F.col("c_name").alias("name"))
    target = names.where("c_custkey % 2 = 0").groupBy("name").agg(F.lit("r1").alias("first_seen_run"), F.lit("r2").alias("last_seen_run"), F.count("*").alias("occurrence_count"))
    return merge.count_up(target, names.where("c_custkey % 3 = 0"), "name", F.lit("r3"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 5 <> 0 UNION ALL SELECT l_orderkey, 0, sum(l_quantity) FROM lineitem WHERE l_orderkey % 5 = 0 GROUP BY l_orderkey""")
def replace_by_key(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = li.where("l_orderkey % 5 = 0").groupBy("l_orderkey").agg(F.lit(0).alias("l_linenumber"), F.sum("l_quantity").alias("l_quantity"))
    return merge.replace_by_key(li, batch, "l_orderkey")


@query("""SELECT 'orders' AS name, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) UNION ALL SELECT 'customer', count(*) FROM customer WHERE NOT coalesce(c_acctbal < 0, false)""")
def cascade_delete(spark, d):
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    gone = c.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    left = merge.delete_keys({"orders": o.withColumnRenamed("o_custkey", "id"), "customer": c.withColumnRenamed("c_custkey", "id")}, gone, ["id"])
    counts = [t.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, t in left.items()]
    return counts[0].union(counts[1])


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') THEN 'Approved' ELSE o_orderstatus END AS decision, o_custkey FROM orders")
def auto_approve(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("decision"), "o_custkey")
    members = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return merge.set_where(o, members, ["o_custkey"], "decision", "O", "Approved").select("id", "decision", "o_custkey")


@query("SELECT DISTINCT id FROM (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def approved_ids(spark, d):
    a = read(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "Approved").alias("decision"))
    b = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "Approved").alias("decision"))
    return merge.approved_ids(a, b)


@query("SELECT c_custkey AS id, c_name AS name, coalesce(s_name, 'none') AS drug FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def update_from(spark, d):
    rows = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("none").alias("drug"))
    return merge.update_from(rows, read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("drug")), ["id"], ["drug"])


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def orphan_keys(spark, d):
    orders = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    users = read(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return merge.orphans(read(spark, d, "customer").select("c_custkey"), "c_custkey", orders, users)


@query("SELECT DISTINCT l_partkey AS id, l_suppkey AS pipeline FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_partkey = l.l_partkey AND x.l_suppkey = l.l_suppkey AND x.l_returnflag = 'R')")
def undecided(spark, d):
    li = read(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("pipeline"), "l_returnflag")
    return merge.undecided(li.select("id", "pipeline").distinct(), li.where("l_returnflag = 'R'"), ["id", "pipeline"])


@query("SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def missing_keys(spark, d):
    have = read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("id"))
    return merge.missing(read(spark, d, "part").select(F.col("p_partkey").alias("id")), have, "id")


@query("""WITH l AS (SELECT c_nationkey AS list, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos, c_custkey AS id FROM customer),
m AS (SELECT list, pos, id, CASE WHEN id % 10 = 3 THEN id - 2 WHEN id % 10 = 4 THEN id - 3 END AS canonical FROM l),
n AS (SELECT list, pos, coalesce(canonical, id) AS id, canonical, EXISTS (SELECT 1 FROM l WHERE l.list = m.list AND l.id = m.canonical) AS present FROM m)
SELECT list, min(pos) AS pos, id FROM n WHERE canonical IS NULL OR NOT present GROUP BY list, id""")
def redirect_resolve(spark, d):
    c = read(spark, d, "customer")
    pos = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long")
    moved = c.where("c_custkey % 10 in (3, 4)").select(F.col("c_custkey").alias("requested"), F.when(F.col("c_custkey") % 10 == 3, F.col("c_custkey") - 2).otherwise(F.col("c_custkey") - 3).alias("canonical"))
    return redirects.resolve(c.select(F.col("c_nationkey").alias("list"), pos.alias("pos"), F.col("c_custkey").alias("id")), moved)


# ---- queues

_QUEUE = "q AS (SELECT o_orderkey AS id, CASE left(o_orderpriority, 1) WHEN '1' THEN 'IMMEDIATE' WHEN '2' THEN 'NORMAL' ELSE 'LOW' END AS priority, CASE WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'DONE' END AS status, o_orderdate AS created_at FROM orders)"


def _queue(spark, d) -> DataFrame:
    rank = F.left("o_orderpriority", F.lit(1))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(rank == "1", "IMMEDIATE").when(rank == "2", "NORMAL").otherwise("LOW").alias("priority"), F.when(F.col("o_orderstatus") == "O", "PENDING").otherwise("DONE").alias("status"), F.col("o_orderdate").alias("created_at"))


@query(f"WITH {_QUEUE} SELECT id, priority FROM q WHERE status = 'PENDING' ORDER BY CASE priority WHEN 'IMMEDIATE' THEN 0 WHEN 'NORMAL' THEN 1 ELSE 2 END, created_at, id LIMIT 500")
def priority_queue(spark, d):
    return events.next_jobs(_queue(spark, d), 500).select("id", "priority")


@query(f"WITH {_QUEUE} SELECT id, (row_number() OVER (ORDER BY CASE priority WHEN 'IMMEDIATE' THEN 0 WHEN 'NORMAL' THEN 1 ELSE 2 END, created_at, id) - 1) // 2000 AS turn FROM q JOIN orders ON o_orderkey = id WHERE status = 'PENDING' AND o_custkey % 2 = 0")
def prioritized_stream(spark, d):
    """The pending jobs of a department, drained from a stream by priority and age, 2000 a turn, up to 500 turns a batch."""
    home = home_of(spark, "prioritized")
    dept = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("D"), F.col("o_custkey") % 2).alias("dept"))
    jobs = _queue(spark, d).where("status = 'PENDING'").join(dept, "id").select("id", "dept", "priority", F.col("created_at").cast("timestamp").alias("created_at"))
    jobs.write.parquet(f"{home}/in")
    with increments.rocks(spark):
        stream = increments.landings(spark, f"{home}/in", "id bigint, dept string, priority string, created_at timestamp")
        turns = increments.prioritized(stream, f"{home}/queue", lambda jobs, n: jobs.write.mode("overwrite").parquet(f"{home}/out/batch={n}"), 2000, "D0", turns=500)
        turns.processAllAvailable()
        turns.stop()
    return spark.read.schema("id bigint, turn bigint").parquet(f"{home}/out").select("id", "turn")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown job type: OTHER' WHEN o_orderkey % 7 = 0 THEN repeat('e', 1000) END AS error, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 'FAILED' ELSE 'DONE' END AS status FROM orders""")
def job_status(spark, d):
    jobs = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, "OTHER").otherwise("NEW_TRIAL").alias("job_type"))
    return events.finished(jobs, F.when(F.col("id") % 7 == 0, F.repeat(F.lit("e"), F.lit(1500)))).select("id", "error", "status")


@query("""SELECT o_custkey AS id, 'd' AS dept, 'TRIAL_MODIFIED' AS job_type, 'IMMEDIATE' AS priority, 'r' AS run_date FROM orders WHERE o_orderkey % 7 > 0 AND o_custkey % 4 <> 0 GROUP BY o_custkey
UNION ALL SELECT c_custkey, 'd', 'NEW_TRIAL', 'NORMAL', 'r' FROM customer WHERE c_acctbal < 0""")
def enqueue_jobs(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    same = (F.lit("d").alias("dept"), F.lit("r").alias("run_date"))
    queue = c.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("id"), F.lit("TRIAL_MODIFIED").alias("job_type"), F.lit("NORMAL").alias("priority"), *same)
    compared = o.select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 7).cast("string").alias("field_change_count"), *same)
    return events.new_jobs(queue, compared, c.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), *same))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, d):
    return versions.latest(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---- sources and flattening


@query(f"SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '{_SPLIT}' AND TIMESTAMP '1996-03-01'")
def delta_scan(spark, d):
    import datetime as dt

    return landing.delta(read(spark, d, "orders"), "o_orderdate", dt.datetime(1996, 1, 1), dt.datetime(1996, 3, 1)).select("o_orderkey")


@query("SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9]{6,}')) AS id FROM documents")
def id_harvest(spark, d):
    return landing.harvest(read(spark, d, "documents"), "text", "[0-9]{6,}")


@query("SELECT s_suppkey AS id, 'Site ' || s_suppkey AS site_name, n_name AS city, CASE WHEN r_name = 'AMERICA' THEN r_name END AS state, CASE WHEN r_name = 'AMERICA' THEN 'United States' ELSE r_name END AS country, NULL AS zip FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def explode_sites(spark, d):
    s, n, r = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "region")
    rows = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    place = F.struct(F.concat(F.lit("Site "), F.col("s_suppkey").cast("string")).alias("facility"), F.col("n_name").alias("city"), F.col("r_name").alias("state"), F.when(F.col("r_name") == "AMERICA", "United States").otherwise(F.col("r_name")).alias("country"), F.lit("").alias("zip"))
    return flatten.site_rows(rows.select(F.col("s_suppkey").alias("id"), F.array(place).alias("places")), "id", F.col("places"))


_COUNTRY = "CASE n_name WHEN 'UNITED STATES' THEN 'United States' WHEN 'CANADA' THEN 'Canada' ELSE n_name END"


@query(f"""WITH s AS (SELECT s_suppkey AS id, s_name, CAST(s_suppkey AS VARCHAR) AS k, {_COUNTRY} AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT id, s_name AS site_name, 'City ' || k AS city, CASE WHEN country IN ('United States', 'Canada') THEN 'State ' || k END AS state, country, NULL AS zip FROM s
UNION ALL SELECT id, NULL, NULL, NULL, country, 'Z' || k FROM s
UNION ALL SELECT id, 'Hospital ' || k, 'Town', NULL, country, NULL FROM s""")
def sites_of_text(spark, d):
    """Rendered places, read back: whole ones, one named by digits with a zip, one in no known country, one with brackets inside."""
    n = read(spark, d, "nation").withColumn("country", F.expr(_COUNTRY))
    s = read(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("k", F.col("s_suppkey").cast("string"))
    place = F.struct(F.col("s_name").alias("facility"), F.concat(F.lit("City "), "k").alias("city"), F.concat(F.lit("State "), "k").alias("state"), "country", F.lit("RECRUITING").alias("status"))
    others = [
        F.format_string("%s (%s, Z%s) [COMPLETED]", "k", "country", "k"), F.concat(F.lit("Lost "), "k", F.lit(" (Town, Nowhere)")),
        F.format_string("Hospital %s ( Site 0014) (Town, %s (formerly known)) [WITHDRAWN]", "k", "country"),
    ]
    rows = s.select(F.col("s_suppkey").alias("id"), F.concat_ws(" | ", flatten.places_text(F.array(place)), *others).alias("locations"))
    return flatten.site_rows_of_text(rows, "id", "locations", flatten.known_values(n, "country"))


@query("SELECT DISTINCT trim(x) AS value FROM (SELECT unnest(string_split(p_brand || ' | ' || p_type || ' |  ', ' | ')) AS x FROM part) WHERE trim(x) <> ''")
def known_values(spark, d):
    rows = read(spark, d, "part").select(F.concat(F.concat_ws(" | ", "p_brand", "p_type"), F.lit(" |  ")).alias("v"))
    return flatten.known_values(rows, "v")


_STUDY = "s AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"""WITH {_STUDY} SELECT 'NCT' || c_custkey AS nct_id, c_name AS brief_title, 'PHASE' || (c_custkey % 3 + 1) AS phases, c_mktsegment AS overall_status, CAST(n AS INTEGER) AS enrollment,
'Main ' || c_custkey || ' (' || n_name || ') [OPEN] | Solo' AS locations, n_name AS countries, 'Main ' || c_custkey || '|Solo' AS sites, 'Ann Lee (PI) - ' || n_name AS overall_officials, 18 AS min_age_value, 'YEARS' AS min_age_unit,
'2024-0' || (c_custkey % 9 + 1) || '-01' AS start_parsed, 'MONTH' AS start_precision, c_custkey % 2 = 0 AS has_dmc, CAST(1 AS INTEGER) AS reference_count, '[R] about ' || c_name AS citations FROM s""")
def organized_records(spark, d):
    c, n, o = read(spark, d, "customer"), read(spark, d, "nation"), read(spark, d, "orders")
    count = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).join(count, "c_custkey", "left").na.fill(0, ["n"])
    key = F.col("c_custkey").cast("string")
    text = lambda s: F.lit(s)
    places = F.array(
        F.struct(F.concat(text("1. Main "), key, text(" /ID# 5")).alias("facility"), text("OPEN").alias("status"), text(None).cast("string").alias("city"), F.col("n_name").alias("country")),
        F.struct(text("Solo").alias("facility"), text("").alias("status"), text("").alias("city"), text("").alias("country")),
    )
    protocol = F.struct(
        F.struct(F.concat(text("NCT"), key).alias("nctId"), F.col("c_name").alias("briefTitle")).alias("identificationModule"),
        F.struct(F.col("c_mktsegment").alias("overallStatus"), F.struct(F.concat(text("2024-0"), (F.col("c_custkey") % 9 + 1).cast("string")).alias("date")).alias("startDateStruct")).alias("statusModule"),
        F.struct(F.array(F.concat(text("Phase "), (F.col("c_custkey") % 3 + 1).cast("string"))).alias("phases"), F.struct(F.col("n").alias("count")).alias("enrollmentInfo")).alias("designModule"),
        F.struct((F.col("c_custkey") % 2 == 0).alias("oversightHasDmc")).alias("oversightModule"),
        F.struct(text("18 Years").alias("minimumAge")).alias("eligibilityModule"),
        F.struct(F.array(F.struct(text("Ann Lee").alias("name"), text("PI").alias("role"), F.col("n_name").alias("affiliation")), F.struct(text("Medical Desk").alias("name"), text("").alias("role"), text("").alias("affiliation"))).alias("overallOfficials"), places.alias("locations")).alias("contactsLocationsModule"),
        F.struct(F.array(F.struct(text("R").alias("type"), F.concat(text("about "), "c_name").alias("citation"))).alias("references")).alias("referencesModule"),
    )
    raw = rows.select(key.alias("nct_id"), F.to_json(F.struct(protocol.alias("protocolSection"))).alias("doc"))
    out = flatten.organized(raw)
    clean = F.regexp_replace(F.regexp_replace("locations", r" /ID# 5", ""), r"^1\. ", "")
    return out.select(
        "nct_id", "brief_title", "phases", "overall_status", "enrollment", clean.alias("locations"), F.array_join("countries", "|").alias("countries"), F.array_join("sites", "|").alias("sites"), "overall_officials",
        "min_age_value", "min_age_unit", F.col("start_parsed").cast("string").alias("start_parsed"), "start_precision", "has_dmc", "reference_count", "citations",
    )


# ---- concepts

_DICT = [("1", "SECRET", "CREDENTIAL", "password;token", 0.9, False), ("2", "LICENCE", "MIT", "mit license", 0.9, False), ("3", "LICENCE", "GPL", "gnu general public license;gpl", 0.8, False)]


def _dictionary(spark) -> DataFrame:
    return spark.createDataFrame(_DICT, "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")


_NORM = "lower(regexp_replace(text, '\\s+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT doc_id AS id, {_NORM} AS t FROM documents),
h AS (SELECT id, 'SECRET' AS concept, 0 AS o, 'CREDENTIAL' AS c FROM t WHERE regexp_matches(t, '(^|[^a-z0-9])(password|token)($|[^a-z0-9])')
UNION ALL SELECT id, 'LICENCE', 1, 'MIT' FROM t WHERE regexp_matches(t, '(^|[^a-z0-9])mit license($|[^a-z0-9])') UNION ALL SELECT id, 'LICENCE', 2, 'GPL' FROM t WHERE regexp_matches(t, '(^|[^a-z0-9])(gnu general public license|gpl)($|[^a-z0-9])'))
SELECT id, concept, string_agg(c, '|' ORDER BY o) AS names FROM h GROUP BY id, concept""")
def concept_match(spark, d):
    texts = concepts.routed(read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), "id", {"SECRET": ["text"], "LICENCE": ["text"]})
    return concepts.concepts(texts, _dictionary(spark)).select("id", "concept", F.array_join("canonicals", "|").alias("names"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 = 1 THEN 'EGFR' END AS names FROM part WHERE p_size % 3 = 1")
def negation_filter(spark, d):
    """Mentions that are negated before or after don't count, the others do."""
    said = F.element_at(F.array(F.lit("patients with no egfr mutation"), F.lit("no prior drug. egfr mutation positive"), F.lit("egfr mutation excluded")), (F.col("p_size") % 3 + 1).cast("int"))
    texts = dealt(read(spark, d, "part").select("p_partkey", "p_size"), "p_partkey").select(F.col("p_partkey").alias("id"), F.lit("GENE").alias("concept"), said.alias("text"))
    words = spark.createDataFrame([("1", "GENE", "EGFR", "egfr", 1.0, True)], "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")
    return concepts.concepts(texts, words).select("id", F.array_join("canonicals", "|").alias("names"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'ECOG_0_1' WHEN 1 THEN 'ECOG_0_2' ELSE 'ECOG_2' END AS kept, CASE WHEN p_size % 2 = 0 THEN 'DRUG A 5 MG' ELSE '' END AS regimen FROM part")
def composite_suppress(spark, d):
    values = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("ECOG_0"), F.lit("ECOG_0_1"), F.lit("ECOG_1"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("ECOG_0_1"), F.lit("ECOG_0_2"), F.lit("ECOG_2"))).otherwise(F.array(F.lit("ECOG_2")))
    doses = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("1.8 MG/KG IV Q3W"), F.lit("DRUG A 5 MG"))).otherwise(F.array(F.lit("QW"), F.lit("IV")))
    return read(spark, d, "part").select("p_partkey", F.array_join(concepts.without_included(values), "|").alias("kept"), F.array_join(concepts.without_dosing(doses), "|").alias("regimen"))


@query("SELECT p_partkey AS id, array_to_string(list_sort(list_distinct([CASE WHEN x = 'TIN' THEN 'METAL' ELSE x END FOR x IN string_split(upper(p_name), ' ')])), '|') AS v FROM part")
def canonical_tokens(spark, d):
    rows = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.replace("p_name", F.lit(" "), F.lit("|")).alias("v"))
    words = read(spark, d, "part").select(F.lit("tin").alias("variant"), F.lit("metal").alias("canonical")).distinct()
    return concepts.canonical_tokens(rows, "id", "v", words)


@query("SELECT coalesce(c_custkey, s_suppkey) AS id, coalesce(s_name, c_name) AS name FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) FULL JOIN supplier ON s_suppkey = c_custkey")
def merged_results(spark, d):
    a = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = read(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return concepts.merged(a, b, "id")
