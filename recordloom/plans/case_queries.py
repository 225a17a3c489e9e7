"""Cases in which order, distance or repetition decides: marks, definitions, windows of text, layouts, a second drain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import concepts, diff, flatten, normalize
from ..sources import landing
from ..streaming import increments
from .registry import dealt, home_of, query, read


@query("""WITH m AS (SELECT n_name AS pipeline, CASE WHEN n_nationkey % 4 = 0 THEN DATE '2001-07-20' ELSE DATE '2001-01-01' + CAST(n_nationkey * 9 AS INTEGER) END AS first FROM nation)
SELECT o_orderkey AS id, string_agg(pipeline, '|' ORDER BY pipeline) AS pipelines FROM orders JOIN m ON CAST(o_orderdate AS DATE) BETWEEN first AND DATE '2001-07-30' GROUP BY o_orderkey""")
def due_records(spark, d):
    """Records updated since the mark of each pipeline; some pipelines never ran."""
    n = F.col("n_nationkey")
    marks = read(spark, d, "nation").select(F.col("n_name").alias("pipeline"), F.when(n % 4 > 0, F.date_add(F.lit(dt.date(2001, 1, 1)), (n * 9).cast("int"))).alias("last_run_date"))
    older = marks.withColumn("last_run_date", F.date_sub("last_run_date", 300))
    records = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    due = landing.due_pipelines(records, "o_orderdate", marks.unionByName(older), dt.date(2001, 7, 30))
    return due.select("id", F.array_join("pipelines", "|").alias("pipelines"))


@query("SELECT DISTINCT p_name AS value FROM part WHERE p_brand = 'Brand#8' AND p_type = 'PROMO'")
def dimension_of_two(spark, d):
    """A dimension filtered by two columns."""
    rows = read(spark, d, "part").select(F.col("p_name").alias("value"), F.col("p_brand").alias("dept"), F.col("p_type").alias("indication"))
    return landing.dimension(rows, ["value"], ["value"], dept="Brand#8", indication="PROMO")


@query("""WITH r AS (SELECT lower(p_brand) AS alias, p_partkey || ' a' AS canonical, 0 AS rank, -p_partkey AS pos FROM part WHERE p_size < 5
UNION ALL SELECT lower(p_brand), p_partkey || ' b', 1, p_partkey FROM part UNION ALL SELECT lower(p_type), p_partkey || ' c', 1, p_partkey FROM part)
SELECT alias, canonical FROM r QUALIFY row_number() OVER (PARTITION BY alias ORDER BY rank, pos) = 1""")
def defined_in_order(spark, d):
    """Aliases with many definitions in two sources: the first of the first source counts."""
    part, key = read(spark, d, "part"), F.col("p_partkey")
    name = lambda s: F.concat(key.cast("string"), F.lit(f" {s} ")).alias("canonical")
    first = part.where("p_size < 5").select(F.upper("p_brand").alias("alias"), name("a"), F.negative(key).alias("at"))
    second = part.select("p_brand", name("b"), key.alias("at")).withColumnRenamed("p_brand", "alias").unionByName(part.select(F.concat(F.lit(" "), "p_type").alias("alias"), name("c"), key.alias("at")))
    return normalize.alias_map([first, second], "at")


@query("""SELECT 'NCT' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS nct_id, CAST(max(o_orderkey) AS VARCHAR) AS brief_title,
'https://cdn.clinicaltrials.gov/large-docs/' || right(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 2) || '/NCT' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '/Prot_' || max(o_orderkey) || '.pdf | https://cdn.clinicaltrials.gov/large-docs/' || right(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 2) || '/NCT' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '/SAP.pdf' AS study_documents FROM orders GROUP BY o_custkey""")
def last_document_wins(spark, d):
    """Of several documents of one record the last to arrive is flattened, with the addresses of its files."""
    key, title = F.concat(F.lit("NCT"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")), F.col("o_orderkey").cast("string")
    named = F.struct(F.struct(key.alias("nctId"), title.alias("briefTitle")).alias("identificationModule"))
    files = F.array(F.struct(F.concat(F.lit("Prot_"), title, F.lit(".pdf")).alias("filename")), F.struct(F.lit("SAP.pdf").alias("filename")))
    doc = F.to_json(F.struct(named.alias("protocolSection"), F.struct(F.struct(files.alias("largeDocs")).alias("largeDocumentModule")).alias("documentSection")))
    raw = read(spark, d, "orders").select(key.alias("nct_id"), doc.alias("doc"), F.col("o_orderkey").alias("at"))
    return flatten.organized(raw, order="at").select("nct_id", "brief_title", "study_documents")


_WORDS = "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean"


@query("SELECT p_partkey AS id, 'EGFR' AS names FROM part WHERE p_size % 2 = 0 AND p_size % 7 <> 0 AND 3 * (p_partkey % 100) + 9 <= 200")
def exact_mentions(spark, d):
    """A marker is matched as written, not as a drug's target, and only with a clinical word within 200 characters."""
    size, far = F.col("p_size"), (F.col("p_partkey") % 100).cast("int")
    said = F.concat(F.when(size % 2 == 0, "EGFR").otherwise("egfr"), F.when(size % 7 == 0, " blocker").otherwise(""), F.repeat(F.lit(" xx"), far), F.lit(" mutation"))
    texts = dealt(read(spark, d, "part").select("p_partkey", "p_size"), "p_partkey").select(F.col("p_partkey").alias("id"), F.lit("GENE").alias("concept"), said.alias("text"))
    words = spark.createDataFrame([("1", "GENE", "EGFR", "EGFR", 1.0, False)], _WORDS)
    return concepts.concepts(texts, words).select("id", F.array_join("canonicals", "|").alias("names"))


@query("SELECT p_partkey AS id, '2L' AS names FROM part WHERE p_size % 2 = 0 OR 3 * (p_partkey % 60) + 6 > 100")
def past_lines(spark, d):
    """A line of therapy after a word of the past is none, unless a clause ends between them or the word is over 100 characters back."""
    said = F.concat(F.lit("prior"), F.repeat(F.lit(" xx"), (F.col("p_partkey") % 60).cast("int")), F.when(F.col("p_size") % 2 == 0, ". ").otherwise(" "), F.lit("second line"))
    texts = dealt(read(spark, d, "part").select("p_partkey", "p_size"), "p_partkey").select(F.col("p_partkey").alias("id"), F.lit("LINE_OF_THERAPY").alias("concept"), said.alias("text"))
    words = spark.createDataFrame([("1", "LINE_OF_THERAPY", "2L", "second line", 1.0, False)], _WORDS)
    return concepts.concepts(texts, words).select("id", F.array_join("canonicals", "|").alias("names"))


@query("""SELECT o_orderkey AS id, 11 AS field_change_count, '[Adverse Events]' || chr(10) || '  1 data points added; 1 values updated; 2 data points removed' || chr(10) || chr(10)
|| '[Contacts/Locations]' || chr(10) || '  Added (2):' || chr(10) || '    + Hall & Co' || chr(10) || '    + Hall ' || o_custkey || chr(10) || '  Removed (1):' || chr(10) || '    - Old ' || o_orderstatus || chr(10) || chr(10)
|| '[Eligibility]' || chr(10) || '  Steps #3: Added: ' || o_orderkey || chr(10) || '  Steps #11: Removed: x' || chr(10) || chr(10)
|| '[Outcome Measures]' || chr(10) || '  Primary Outcome #11:' || chr(10) || '    Time Frame: Old: 1  |  New: ' || o_custkey || chr(10) || '  Secondary Outcome #2:' || chr(10) || '    Measure: Added: m' AS field_changes FROM orders""")
def diff_layouts(spark, d):
    """Changes as text in each layout: counted results, places in order of their text, natural order of fields, outcomes with primary ones first."""
    o = read(spark, d, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    row = lambda module, field, old, new: F.struct(F.lit(module).alias("module"), F.lit(field).alias("field"), (F.lit(old) if old is None or isinstance(old, str) else old).cast("string").alias("old_value"), (F.lit(new) if new is None or isinstance(new, str) else new).cast("string").alias("new_value"))
    rows = F.array(
        row("Outcome Measures", "secondaryOutcomes[1].measure", None, "m"), row("Outcome Measures", "primaryOutcomes[10].timeFrame", "1", cust),
        row("Eligibility", "steps[10]", "x", None), row("Eligibility", "steps[2]", None, key),
        row("Contacts/Locations", "__removed__", F.concat(F.lit("Old "), "o_orderstatus"), None), row("Contacts/Locations", "__added__", None, F.concat(F.lit("Hall "), cust)), row("Contacts/Locations", "__added__", None, "Hall &amp; Co"),
        row("Adverse Events", "a", None, "1"), row("Adverse Events", "b", "1", "2"), row("Adverse Events", "c", "1", None), row("Adverse Events", "d", "1", None),
    )
    changes = o.select(F.col("o_orderkey").alias("id"), F.explode(rows).alias("r")).select("id", "r.*")
    return diff.render(changes, ["id"])


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 3 END AS run FROM orders")
def drained_again(spark, d):
    """Three runs over a stream: the second finds nothing new and does nothing, the third takes up what came since."""
    home, ids = home_of(spark, "drained"), read(spark, d, "orders").select(F.col("o_orderkey").alias("id"))

    def run(number: int) -> None:
        take = lambda batch, n: batch.withColumn("run", F.lit(number)).write.mode("overwrite").parquet(f"{home}/out/{number}-{n}")
        increments.drain(increments.landings(spark, f"{home}/in", "id bigint"), f"{home}/checkpoint", take).awaitTermination()

    ids.where("id % 2 = 0").write.parquet(f"{home}/in")
    run(1)
    run(2)
    ids.where("id % 2 <> 0").write.mode("append").parquet(f"{home}/in")
    run(3)
    return spark.read.schema("id bigint, run int").parquet(f"{home}/out/*")
