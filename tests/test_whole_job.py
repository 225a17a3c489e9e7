"""Cases in which a query or an operator once did less than the whole job."""

from pyspark.sql import functions as F

from recordloom.functions import scalars
from recordloom.operators import concepts, match, sync
from recordloom.plans import QUERIES, registry

FOLDER = "/root/testdata/sf0.001"


def test_many_keywords_find_what_few_find(spark):
    texts = ["这是GPL许可", "üabc", "a gpl b", "xgpl", "\u212agpl", "C++ or c", "né de"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    terms = [("gpl",), ("abc",), ("c++",), ("né",), ("许可",)]
    many = terms + [(f"absent{i}",) for i in range(match.PREFILTER_FROM)]
    for pattern in (match.between_alnum, match.whole_word):
        few, more = ({tuple(r) for r in match.matches(rows, "id", F.col("text"), spark.createDataFrame(t, "term string"), pattern).collect()} for t in (terms, many))
        assert few == more and (2, "gpl") in few


def test_reports_and_stages_take_every_version(spark):
    pairs = QUERIES["version_pairs"](spark, FOLDER)
    assert QUERIES["pair_report"](spark, FOLDER).count() == pairs.count()
    changed = QUERIES["field_diff"](spark, FOLDER).select("id").distinct().count()
    assert QUERIES["all_job_stages"](spark, FOLDER).count() == changed


def test_every_source_is_classified(spark):
    sources = {r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("source").distinct().collect()} - {None}
    assert len(sources) > 3 and {r["pipeline"] for r in QUERIES["bucket_counts_all"](spark, FOLDER).collect()} == sources


def test_sections_are_whole(spark):
    rows = spark.createDataFrame([("s", "x" * 9000), (None, "y"), ("s", None), (None, "")], "source string, text string")
    got = [r[0] for r in rows.select(scalars.labelled_sections({"source": F.col("source"), "text": F.col("text")})).collect()]
    assert got == ["[source] s\n\n[text] " + "x" * 9000, "[text] y", "[source] s", ""]


def test_one_pattern_finds_what_single_ones_find(spark):
    terms = ["", "a", "ab", "abc", "a.c", "c++", "(x", "né", "né de", "a|b", "[z]", "\\E", "x\ny", "许可", "#1", "a b"]
    texts = ["xx ab yy", "A.C", "abcd", "c++", "-(X-", "NÉ", "né de", "aa|b", "a|b", "[z]", "q \\E q", "x\ny", "#12", "#1", "", "许可证", "A  B", "a b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for pattern in (match.between_alnum, match.whole_word):
        for some in (terms, terms[1:], ["c++"], []):
            words = spark.createDataFrame([(t,) for t in [*some, None]], "term string")
            single = {tuple(r) for r in rows.crossJoin(words).where(F.rlike("text", pattern(F.col("term")))).select("id", "term").collect()}
            assert {tuple(r) for r in match.matches(rows, "id", F.col("text"), words, pattern).collect()} == single
            if pattern is match.whole_word:
                assert {r["id"] for r in match.having_keyword(rows, "id", F.col("text"), words).collect()} == {i for i, _ in single}


def test_snapshots_group_the_rows_once(spark, capsys):
    keys = "id long, dept string, version long, quantity double"
    rows = spark.createDataFrame([(1, "d", 1, 5.0), (1, "d", 1, 7.0), (1, "d", 1, None), (2, "d", 1, 1.0), (None, "d", 1, 3.0), (None, "d", 1, 2.0), (3, None, 2, None)], keys)
    history = spark.createDataFrame([(2, "d", 1, 9.0), (3, None, 2, 1.0)], keys)
    added = sync.snapshots(history, rows, ["quantity"])
    assert {tuple(r) for r in added.collect()} == {(1, "d", 1, 7.0), (None, "d", 1, 3.0), (3, None, 2, None)} and added.count() == 3
    added.explain()
    plan = capsys.readouterr().out
    assert "Window" in plan and "Aggregate" not in plan  # rows of every key were kept a second time, in two hash tables


def test_a_line_end_ends_a_clause_and_blanks_are_no_variant(spark):
    schema = "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean"
    words = spark.createDataFrame([("1", "GENE", "EGFR", "EGFR;\t", 1.0, True)], schema)
    texts = spark.createDataFrame([(1, "GENE", "no\nEGFR mutation"), (2, "GENE", "no EGFR mutation"), (3, "GENE", "EGFR mutation, not EGFR;EGFR"), (4, "GENE", None), (5, "GENE", "")], "id long, concept string, text string")
    found = concepts.occurrences(texts, concepts.variants(words))
    assert sorted((r["id"], r["before"], r["after"]) for r in found.collect()) == [
        (1, "no\n", " mutation"), (2, "no ", " mutation"), (3, "", " mutation, not EGFR;EGFR"), (3, "EGFR mutation, not ", ";EGFR"), (3, "EGFR mutation, not EGFR;", ""),
    ]
    assert sorted(r["id"] for r in found.where(concepts.valid(found)).collect()) == [1, 3, 3]


def test_small_tables_of_long_work_are_dealt_to_more_tasks(spark):
    rows = spark.range(2500).coalesce(1)
    assert [registry.dealt(rows.limit(n), "id", 1000).rdd.getNumPartitions() for n in (0, 900, 2500)] == [1, 1, 3]
