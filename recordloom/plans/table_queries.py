"""Tables kept complete, landings, reports of moved identifiers, and the same on streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import concepts, events, flatten, merge, redirects, reports, sync
from ..sources import landing
from ..streaming import increments
from .registry import home_of, query, read


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'landed' FROM customer WHERE c_custkey % 2 = 1 AND c_custkey IN (SELECT o_custkey FROM orders) AND c_acctbal > 0")
def baseline_sync(spark, d):
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    base = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    landed = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.lit("landed").alias("name"))
    return sync.baseline(o.select(F.col("o_custkey").alias("id")), base, landed)


@query("SELECT l_orderkey AS id, l_partkey AS version, max(l_quantity) AS quantity FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1, 2")
def version_snapshots(spark, d):
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit("d").alias("dept"), F.col("l_partkey").alias("version"), F.col("l_quantity").alias("quantity"))
    return sync.snapshots(li.where("id % 3 = 0"), li, ["quantity"]).select("id", "version", "quantity")


@query("SELECT c_mktsegment AS dept, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE strftime(max(o_orderdate), '%Y-%m-%d') END AS last_run_date FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment")
def state_reset(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    state = sync.newest_mark(rows.withColumnRenamed("c_mktsegment", "dept"), "dept", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return sync.state_without(sync.state_after(state, state, ["dept"]), "dept", "BUILDING")


@query("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS from_date, '1999-01-01' AS to_date FROM orders")
def scan_range(spark, d):
    state = read(spark, d, "orders").select(F.to_date("o_orderdate").alias("last_run_date"))
    return landing.date_range(state, F.lit("1999-01-01").cast("date")).select(F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND o_orderstatus = 'O' THEN 'PENDING' WHEN o_orderstatus = 'O' THEN 'ACTIVE' ELSE 'NONE' END AS document_status FROM orders""")
def invalidate_documents(spark, d):
    o = read(spark, d, "orders")
    documents = o.select(F.col("o_custkey").alias("id"), "o_orderkey", F.when(F.col("o_orderstatus") == "O", "ACTIVE").otherwise("NONE").alias("document_status"))
    touched = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return events.invalidated(documents, touched).select(F.col("o_orderkey").alias("id"), "document_status")


@query("SELECT s_suppkey, s_name AS name FROM supplier")
def trim_identifiers(spark, d):
    rows = read(spark, d, "supplier").select("s_suppkey", F.concat(F.lit(" \n"), "s_name", F.lit("\t ")).alias("name"))
    return merge.trimmed_ids(rows, "name")[0]


@query("SELECT count(*) AS n_fixed FROM supplier WHERE s_suppkey % 2 = 0")
def trimmed_count(spark, d):
    rows = read(spark, d, "supplier").select(F.concat(F.when(F.col("s_suppkey") % 2 == 0, " ").otherwise(""), "s_name").alias("name"))
    return merge.trimmed_ids(rows, "name")[1]


@query("""SELECT 'c' || c_custkey AS requested, 'c' || (c_custkey - 1) AS canonical, c_custkey % 2 = 0 AS in_input, CASE WHEN c_custkey % 2 = 0 THEN 'remove c' || c_custkey ELSE 'replace c' || c_custkey || ' by c' || (c_custkey - 1) END AS action,
CASE WHEN c_custkey % 5 = 0 AND n > 5 THEN 'changed' WHEN c_custkey % 5 = 0 THEN 'compared, unchanged' ELSE 'not compared in this run' END AS change_status, n AS field_change_count
FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN count(*) > 5 THEN count(*) ELSE 0 END AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey - 1 WHERE c_custkey % 10 IN (0, 3)""")
def redirect_report(spark, d):
    key = lambda k: F.concat(F.lit("c"), k.cast("string"))
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    moved = c.where("c_custkey % 10 in (0, 3)").select(key(F.col("c_custkey")).alias("requested"), key(F.col("c_custkey") - 1).alias("canonical"), (F.col("c_custkey") % 2 == 0).alias("in_input"))
    n = F.count("*")
    compared = o.groupBy("o_custkey").agg(F.when(n > 5, n).otherwise(0).cast("long").alias("field_change_count")).select(key(F.col("o_custkey")).alias("id"), F.lit(1).alias("curr_version"), "field_change_count")
    newly = c.where("c_custkey % 5 = 0").select(key(F.col("c_custkey") - 1).alias("id"))
    return redirects.report(moved, compared, newly).drop("curr_version")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'fresh' ELSE c_name END AS note FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def latest_sheet(spark, d):
    c = read(spark, d, "customer")
    prior = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("note"))
    fresh = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.lit("fresh").alias("note"))
    return reports.sheets(prior, fresh)["all"]


@query("SELECT o_orderkey AS id, '{\"status\":\"' || o_orderstatus || '\"}' AS raw_status, o_orderpriority AS official_title FROM orders")
def raw_modules(spark, d):
    doc = F.struct(F.struct(F.struct(F.col("o_orderpriority").alias("officialTitle")).alias("identificationModule"), F.struct(F.col("o_orderstatus").alias("status")).alias("statusModule")).alias("protocolSection"))
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.parse_json(F.to_json(doc)).alias("doc"))
    return landing.raw_modules(rows, "id", "doc").select("id", F.col("raw_statusModule").alias("raw_status"), "official_title")


@query("SELECT 'NCT' || p_partkey AS nct_id, p_brand || '; ' || p_type AS conditions, 'DRUG: ' || p_name AS interventions FROM part")
def scan_rows(spark, d):
    protocol = F.struct(
        F.struct(F.concat(F.lit("NCT"), F.col("p_partkey").cast("string")).alias("nctId")).alias("identificationModule"),
        F.struct(F.array("p_brand", F.lit(""), "p_type").alias("conditions")).alias("conditionsModule"),
        F.struct(F.array(F.struct(F.lit("DRUG").alias("type"), F.col("p_name").alias("name"))).alias("interventions")).alias("armsInterventionsModule"),
    )
    raw = read(spark, d, "part").select(F.to_json(F.struct(protocol.alias("protocolSection"))).alias("doc"))
    return flatten.scan_rows(raw).select("nct_id", "conditions", "interventions")


@query("SELECT id FROM (SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100)")
def pending_extraction(spark, d):
    c, s = read(spark, d, "customer"), read(spark, d, "supplier")
    rows = c.join(s, c["c_custkey"] == s["s_suppkey"], "left").select(F.col("c_custkey").alias("id"), F.struct("c_acctbal", F.negative("c_custkey")).alias("newest"), F.col("s_name").alias("gene"))
    rows = merge.with_columns_added(rows, {"regimen": "string", "gene": "string"})
    return concepts.pending(rows, ["gene", "regimen"], limit=100, newest="newest").select("id")


@query("SELECT CAST(user_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d') AS updated FROM events GROUP BY ALL")
def streamed_without_copies(spark, d):
    """Records that land again with the same day, before the watermark, are dropped by the stream."""
    home = home_of(spark, "landings")
    read(spark, d, "events").select(F.col("user_id").cast("string").alias("id"), F.date_trunc("day", "ts").alias("ts")).repartition(4).write.parquet(f"{home}/in")
    stream = increments.without_late_copies(increments.landings(spark, f"{home}/in", "id string, ts timestamp"), "ts", ["id", "ts"], "60 days")
    increments.drain(stream, f"{home}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{home}/out/batch={n}")).awaitTermination()
    rows = spark.read.schema("id string, ts timestamp").parquet(f"{home}/out")
    return rows.select("id", F.date_format("ts", "yyyy-MM-dd").alias("updated"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status, 'X' AS seen FROM orders")
def streamed_upsert(spark, d):
    """A stream merged into a table batch by batch; a batch that comes again changes nothing."""
    home = home_of(spark, "upserts")
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.lit("X").alias("seen"))
    o.repartition(3).write.parquet(f"{home}/in")
    o.withColumn("seen", F.lit("old")).where("id % 2 = 0").write.parquet(f"{home}/table/v=-1")
    schema = "id bigint, status string, seen string"

    def apply(batch, n: int) -> None:  # batches follow each other, so the table before batch n is the one that batch n - 1 left
        table = spark.read.schema(schema).parquet(f"{home}/table/v={n - 1}")
        merge.upsert(table, merge.prepared(batch, ["id"], [F.col("seen")]), ["id"]).write.mode("overwrite").parquet(f"{home}/table/v={n}")

    query = increments.drain(increments.landings(spark, f"{home}/in", schema, files=1), f"{home}/checkpoint", apply)
    query.awaitTermination()
    last = spark.read.option("basePath", f"{home}/table").schema(f"{schema}, v int").parquet(f"{home}/table").agg(F.max("v")).first()[0]
    return spark.read.schema(schema).parquet(f"{home}/table/v={last}")


@query("SELECT n_name AS value FROM nation WHERE n_regionkey = 1")
def dimension_rows(spark, d):
    return landing.dimension(read(spark, d, "nation").withColumn("dept", F.col("n_regionkey").cast("string")).withColumnRenamed("n_name", "value"), ["value"], ["value"], dept="1")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'no balance' END AS error FROM customer WHERE c_custkey % 2 = 0")
def dead_letters(spark, d):
    rows = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", F.when(F.col("c_custkey") % 2 == 0, "no balance").alias("error"))
    return landing.split_failures(rows)[1]


@query("SELECT p_partkey AS id, row_number() OVER (ORDER BY p_partkey) AS place FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def resumed_ingest(spark, d):
    """What is left to ingest, numbered in order: ids are dealt by range, and each range begins where those before it end."""
    todo = landing.not_landed(read(spark, d, "part").select(F.col("p_partkey").alias("id")), read(spark, d, "supplier").select(F.col("s_suppkey").alias("id")))
    home = home_of(spark, "ingest")
    todo.repartitionByRange("id").withColumn("range", F.spark_partition_id()).write.parquet(f"{home}/dealt")
    dealt = spark.read.schema("id bigint, range int").parquet(f"{home}/dealt")
    sizes = dealt.groupBy("range").agg(F.count("*").alias("n"))  # one row per range
    before = sizes.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("id")) + F.col("before")
    return dealt.join(F.broadcast(before), "range").select("id", place.cast("long").alias("place"))
