"""Reads of files and facts, fields, slices, totals and queues, on the tables at hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import classify, concepts, events, flatten, match, merge, reports, sync
from ..sources import landing
from ..streaming import increments
from .registry import dealt, home_of, query, read


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)")
def orphans_of_three(spark, d):
    """Rows that neither of two other tables holds; many have neither."""
    orders = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    suppliers = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return merge.orphans(read(spark, d, "customer").where("c_custkey % 2 = 0").select("c_custkey"), "c_custkey", orders, suppliers)


@query(r"SELECT DISTINCT p_partkey, term FROM part, (SELECT DISTINCT lower(string_split(p_name, ' ')[1]) AS term FROM part) WHERE regexp_matches(lower(p_name), '\b' || term || '\b')")
def whole_word_match(spark, d):
    part = read(spark, d, "part")
    words = part.select(F.lower(F.get(F.split("p_name", " "), F.lit(0))).alias("term")).distinct()
    return match.matches(part, "p_partkey", F.col("p_name"), words, match.whole_word).select("p_partkey", "term")


@query("SELECT DISTINCT trim(p_brand) AS id FROM part")
def csv_ids(spark, d):
    """Identifiers written to a CSV file with blanks around them, and read back."""
    home = home_of(spark, "ids")
    landing.write_csv(read(spark, d, "part").select(F.concat(F.lit(" "), "p_brand").alias("nct"), F.lit("x").alias("other")), f"{home}/ids")
    return landing.id_column(spark, f"{home}/ids", "nct").distinct()


@query("SELECT lower(n_name) AS term FROM nation")
def keyword_lines(spark, d):
    home = home_of(spark, "keywords")
    nations = read(spark, d, "nation").select(F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("value"))
    nations.union(read(spark, d, "region").select(F.concat(F.lit("# "), "r_name"))).write.text(f"{home}/lines")
    return landing.keyword_lines(spark, f"{home}/lines")


@query("SELECT lower(p_brand) AS term FROM part UNION SELECT lower(unnest(string_split(p_type, ' '))) FROM part")
def keyword_table(spark, d):
    home = home_of(spark, "keywords")
    landing.write_csv(read(spark, d, "part").select(F.col("p_brand").alias("Drug Name"), F.replace("p_type", F.lit(" "), F.lit("|")).alias("Aliases")), f"{home}/table")
    return landing.keyword_table(spark, f"{home}/table")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def facts_by_id(spark, d):
    orders = read(spark, d, "orders").withColumnRenamed("o_custkey", "id")
    return landing.facts(orders, read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id")), ["o_orderkey", "o_totalprice"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 IN (1, 3)")
def real_changes(spark, d):
    counted = F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderkey").cast("string")).when(F.col("o_orderkey") % 4 == 0, "0").otherwise("n/a")
    return classify.real_changes(read(spark, d, "orders").withColumn("field_change_count", counted)).select("o_orderkey")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand END AS kept FROM part")
def blocked_values(spark, d):
    values = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("HBV"), F.col("p_brand"))).otherwise(F.array(F.lit("HBV"), F.lit("HCV")))
    return read(spark, d, "part").select("p_partkey", F.element_at(match.without_values(values, ["HBV", "HCV"]), 1).alias("kept"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE coalesce(source, '') END AS word, coalesce(CAST(n_chars AS VARCHAR), '') AS chars, concat_ws(' ', nullif(source, ''), nullif(lang, '')) AS joined,
coalesce(source, '') || '|a_b + ' || replace(coalesce(lang, ''), ' ', '_') AS combo FROM documents""")
def small_fields(spark, d):
    rows = read(spark, d, "documents").withColumn("_s", F.coalesce("source", F.lit("")))
    word = scalars.null_words(F.when(F.col("doc_id") % 5 == 0, F.array(F.lit(" None "), F.lit("N/A"), F.lit(""))[(F.col("doc_id") % 3).cast("int")]).otherwise(F.col("source")))
    return rows.select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, word).otherwise(F.coalesce(word, F.lit(""))).alias("word"), scalars.null_to_blank(F.col("n_chars")).alias("chars"),
        scalars.joined_text(F.col("source"), F.col("lang")).alias("joined"), scalars.combo_names(F.concat("_s", F.lit("|a b + "), F.coalesce("lang", F.lit("")))).alias("combo"),
    )


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Adult' WHEN p_size % 3 = 1 THEN '>=' || p_size || ' Years | Adult | Child' ELSE '>=' || p_size || ' Years' END AS age FROM part""")
def age_ranges(spark, d):
    size = F.col("p_size") % 3
    groups = F.when(size == 0, F.array(F.lit(" Adult "), F.lit(""))).when(size == 1, F.array(F.lit("Adult"), F.lit("Child"), F.lit("Adult")))
    return read(spark, d, "part").select("p_partkey", scalars.age_range(F.when(size > 0, F.col("p_size")), F.lit("YEARS"), groups).alias("age"))


@query("""SELECT n_nationkey AS id, CASE WHEN n_regionkey = 0 THEN '' ELSE '[{"measure":"' || n_name || '","description":"d","timeFrame":"1 year"}]' END AS outcomes,
CASE WHEN n_regionkey = 1 THEN '' ELSE 'Ann ' || n_name || ' (Head) - Phone: 1, Email: a@b.c' END AS contacts FROM nation""")
def outcomes_and_contacts(spark, d):
    n = read(spark, d, "nation")
    measure = F.struct(F.concat(F.lit(" "), "n_name").alias("measure"), F.lit("d ").alias("description"), F.lit("1 year").alias("timeFrame"))
    outcomes = F.when(F.col("n_regionkey") == 0, F.array().cast("array<struct<measure:string,description:string,timeFrame:string>>")).otherwise(F.array(measure))
    person = F.struct(F.when(F.col("n_regionkey") == 1, F.lit("Call Center")).otherwise(F.concat(F.lit("Ann "), "n_name")).alias("name"), F.lit("Head").alias("role"), F.lit("1").alias("phone"), F.lit("a@b.c").alias("email"))
    return n.select(F.col("n_nationkey").alias("id"), flatten.outcomes_json(outcomes).alias("outcomes"), flatten.contacts_text(F.array(person)).alias("contacts"))


@query("SELECT 'L' || n_regionkey AS list, count(DISTINCT o_orderkey) AS records, count(*) AS changes FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def list_slices(spark, d):
    """The changes of the records of each list, and how many there are."""
    c, n, o = read(spark, d, "customer"), read(spark, d, "nation"), read(spark, d, "orders")
    tracked = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    tracked = tracked.select(F.concat(F.lit("L"), "n_regionkey").alias("list"), F.col("o_orderkey").alias("id"))
    changes = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return reports.slice_counts(reports.list_slices(changes, tracked, "id", "list"), "id", "list")


@query("SELECT count(*) AS total, count(*) FILTER (c_acctbal < 0) AS tagged FROM customer")
def tagged_totals(spark, d):
    return reports.totals(read(spark, d, "customer"), {"tagged": F.col("c_acctbal") < 0})


@query("SELECT count(*) AS rows, count(DISTINCT p_brand) AS concepts, count(DISTINCT p_type) AS names FROM part")
def dictionary_sizes(spark, d):
    return reports.sizes(read(spark, d, "part"), {"concepts": "p_brand", "names": "p_type"})


@query("SELECT c_custkey AS id FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def appended_rows(spark, d):
    home = home_of(spark, "append")
    for rows in (read(spark, d, "customer").select(F.col("c_custkey").alias("id")), read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))):
        merge.append(rows, f"{home}/t")
    return spark.read.schema("id bigint").parquet(f"{home}/t")


@query("SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderpriority <> '1-URGENT'")
def invalidation_jobs(spark, d):
    """Jobs of new or newly listed records invalidate their documents and do nothing else."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "TRIAL_MODIFIED").when(F.col("o_orderpriority") == "2-HIGH", "NEW_TRIAL").otherwise("TRACKING_LIST_ADDED")
    return events.only_invalidating(read(spark, d, "orders").select(F.col("o_custkey").alias("id"), kind.alias("job_type"))).select("id").distinct()


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'DONE' END AS status FROM orders")
def drained_queue(spark, d):
    """A queue of jobs as a stream, finished batch by batch until it is empty; a job of an unknown type fails."""
    home = home_of(spark, "queue")
    kind = F.when(F.col("o_orderstatus") == "P", "OTHER").otherwise("NEW_TRIAL")
    schema = "id bigint, job_type string, priority string"
    read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), kind.alias("job_type"), F.col("o_orderpriority").alias("priority")).repartition(4).write.parquet(f"{home}/in")

    def work(batch, n: int) -> None:
        events.finished(batch).select("id", "status").write.mode("overwrite").parquet(f"{home}/out/batch={n}")

    increments.drain(increments.landings(spark, f"{home}/in", schema, files=2), f"{home}/checkpoint", work).awaitTermination()
    return spark.read.schema("id bigint, status string").parquet(f"{home}/out").select("id", "status")


@query("SELECT DISTINCT o_custkey AS id, 2 AS n FROM orders WHERE o_custkey % 3 <> 0 AND o_custkey % 2 = 0")
def second_pass(spark, d):
    """Pairs of tracked records that the first pass has not compared."""
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("id")).distinct()
    return sync.missing_pairs(o.where("id % 2 = 0"), o.where("id % 3 = 0"), o.withColumn("n", F.lit(2))).select("id", "n")


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'GOLD' END AS \"METAL\", CASE WHEN p_size % 3 = 0 THEN 'ROUND' END AS \"SHAPE\" FROM part")
def concept_columns(spark, d):
    """One row per record with a column per concept, ready for a table."""
    part = dealt(read(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")
    said = part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "a gold ring").otherwise("no ring").alias("metal"), F.when(F.col("p_size") % 3 == 0, "round").otherwise("").alias("shape"))
    words = spark.createDataFrame([("1", "METAL", "GOLD", "gold; golden", 1.0, True), ("2", "SHAPE", "ROUND", "round", 1.0, False)], "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")
    return concepts.extraction(said, said.select("id"), words, {"METAL": ["metal"], "SHAPE": ["shape"]})


_SEEN = """now AS (SELECT c_custkey AS id, 'Pending' AS decision, CASE WHEN c_custkey % 2 = 0 THEN '1996' WHEN c_custkey % 5 > 0 THEN '1997' END AS last_seen FROM customer WHERE c_nationkey < 12),
old AS (SELECT c_custkey AS id, 'Approved' AS decision, CASE WHEN c_custkey % 7 > 0 THEN '1996' END AS last_seen FROM customer WHERE c_custkey % 3 > 0)"""


def _seen(spark, d):
    """A log of decisions and a batch of sightings."""
    c, id = read(spark, d, "customer"), F.col("c_custkey")
    now = c.where("c_nationkey < 12").select(id.alias("id"), F.lit("Pending").alias("decision"), F.when(id % 2 == 0, "1996").when(id % 5 > 0, "1997").alias("last_seen"))
    old = c.where("c_custkey % 3 > 0").select(id.alias("id"), F.lit("Approved").alias("decision"), F.when(id % 7 > 0, "1996").alias("last_seen"))
    return old, now


@query(f"""WITH {_SEEN} SELECT coalesce(old.id, now.id) AS id, coalesce(old.decision, now.decision) AS decision, CASE WHEN now.id IS NULL THEN old.last_seen ELSE now.last_seen END AS last_seen,
CASE WHEN now.id IS NULL THEN 'kept' WHEN old.id IS NULL THEN 'inserted' WHEN old.last_seen IS NOT DISTINCT FROM now.last_seen THEN 'unchanged' ELSE 'updated' END AS action FROM old FULL JOIN now ON old.id = now.id""")
def merge_actions(spark, d):
    """A merge that says of every row what became of it; known rows keep their decision."""
    return merge.with_actions(*_seen(spark, d), ["id"], preserve=["decision"])


@query(f"""WITH {_SEEN}, j AS (SELECT old.id AS o, now.id AS n, old.last_seen IS NOT DISTINCT FROM now.last_seen AS same, CASE WHEN now.id IS NULL THEN old.last_seen ELSE now.last_seen END AS seen FROM old FULL JOIN now ON old.id = now.id)
SELECT count(*) FILTER (o IS NULL) AS n_inserted, count(*) FILTER (o IS NOT NULL AND n IS NOT NULL AND NOT same) AS n_updated, count(*) FILTER (o IS NOT NULL AND n IS NOT NULL AND same) AS n_unchanged, count(*) AS n_rows, count(*) FILTER (seen = '1997') AS n_later FROM j""")
def merged_in_place(spark, d):
    """The merge written into a table by buckets; new and repeated rows are counted by the merge itself."""
    home, (old, now) = home_of(spark, "merged"), _seen(spark, d)
    merge.write_bucketed(old, f"{home}/table", ["id"], 16)
    counts = merge.merge_into(now, f"{home}/table", f"{home}/staging", ["id"], 16, preserve=["decision"])
    table = spark.read.parquet(f"{home}/table").agg(F.count("*").alias("n_rows"), F.count_if(F.col("last_seen") == "1997").alias("n_later"))
    return counts.join(table, F.expr("true"))  # one row each
