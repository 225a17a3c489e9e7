"""Cases that the tables can't express, and properties."""

import pytest
from pyspark.sql import functions as F

from recordloom.functions import paths, scalars
from recordloom.operators import classify, concepts, diff, events, flatten, match, merge, normalize, versions


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_flatten_drops_empty_containers_and_keeps_null(spark):
    df = spark.sql("""select parse_json('{"a":1,"b":{"c":[10,{"d":null}],"e":{}},"f":"x"}') as doc""")
    assert {r["path"]: r["value"] for r in diff.flatten(df, "doc").collect()} == {"a": "1", "b.c[0]": "10", "b.c[1].d": None, "f": "x"}


def test_flatten_refuses_deeper_documents(spark):
    df = spark.sql("""select parse_json('{"a":{"b":{"c":1}}}') as doc""")
    with pytest.raises(Exception, match="nested deeper"):
        diff.flatten(df, "doc", depth=2).collect()


def changes(spark, old, new, labels):
    pairs = spark.createDataFrame([("x", 1, 2, labels)], "id string, prev_version int, curr_version int, module_labels array<string>")
    docs = spark.createDataFrame([("x", 1, old), ("x", 2, new)], "id string, version int, doc string").withColumn("doc", F.parse_json("doc"))
    return diff.field_changes(pairs, docs)


def test_null_is_absent_and_only_listed_modules_count(spark):
    old = '{"protocolSection":{"statusModule":{"s":"A","n":null},"descriptionModule":{"t":"1"}}}'
    new = '{"protocolSection":{"statusModule":{"s":"B"},"descriptionModule":{"t":"2"}}}'
    got = changes(spark, old, new, ["Study Status", "Document Section", "Nonsense"]).collect()
    assert [(r["field"], r["old_value"], r["new_value"]) for r in got] == [("s", "A", "B")]


def test_labels_of_one_module_report_once(spark):
    old, new = '{"protocolSection":{"referencesModule":{"a":1}}}', '{"protocolSection":{"referencesModule":{"a":2}}}'
    assert changes(spark, old, new, ["References", "More Information"]).count() == 1


def test_numbers_are_compared_as_numbers_and_text_is_not_a_number(spark):
    old, new = '{"protocolSection":{"statusModule":{"a":1,"b":"1"}}}', '{"protocolSection":{"statusModule":{"a":1.0,"b":1}}}'
    assert [r["field"] for r in changes(spark, old, new, ["Study Status"]).collect()] == ["b"]


def test_places_by_facility(spark):
    wrap = lambda places: '{"protocolSection":{"contactsLocationsModule":{"locations":[' + places + "]}}}"
    x, y, z = ('{"facility":"%s","city":"C"}' % n for n in "XYZ")
    got = changes(spark, wrap(f"{x},{y}"), wrap(f"{y},{z}"), ["Contacts/Locations"]).collect()
    assert sorted((r["field"], r["old_value"], r["new_value"]) for r in got) == [("__added__", None, "Z, C"), ("__removed__", "X, C", None)]
    moved = changes(spark, wrap('{"facility":"X","geoPoint":{"lat":1}}'), wrap('{"facility":"X","geoPoint":{"lat":2}}'), ["Contacts/Locations"])
    assert moved.count() == 0


def test_diff_of_itself_is_empty_and_swap_swaps(spark):
    a, b = '{"protocolSection":{"statusModule":{"p":1,"q":2}}}', '{"protocolSection":{"statusModule":{"q":3,"r":4}}}'
    assert changes(spark, a, a, ["Study Status"]).count() == 0
    there = {(r["field"], r["old_value"], r["new_value"]) for r in changes(spark, a, b, ["Study Status"]).collect()}
    back = {(r["field"], r["new_value"], r["old_value"]) for r in changes(spark, b, a, ["Study Status"]).collect()}
    assert there == back and len(there) == 3


def test_rendered_text_parses_back(spark):
    old = '{"protocolSection":{"statusModule":{"overallStatus":"A"},"outcomesModule":{"primaryOutcomes":[{"measure":"P"}]},"contactsLocationsModule":{"locations":[{"facility":"X"}]}},"resultsSection":{"adverseEventsModule":{"n":1}}}'
    new = '{"protocolSection":{"statusModule":{"overallStatus":"B"},"outcomesModule":{"primaryOutcomes":[{"measure":"Q"}]},"contactsLocationsModule":{"locations":[{"facility":"Y"}]}},"resultsSection":{"adverseEventsModule":{"n":2,"m":3}}}'
    text = diff.render(changes(spark, old, new, ["Study Status", "Outcome Measures", "Contacts/Locations", "Adverse Events"]), ["id", "prev_version", "curr_version"])
    said = text.first()["field_changes"]
    assert "  Primary Outcome #1:\n    Measure: Old: P  |  New: Q" in said and "  Added (1):\n    + Y" in said and "  1 data points added; 1 values updated" in said
    got = {(r["module"], r["field_name"], r["change_type"], r["old_value"], r["new_value"]) for r in events.events_of_text(text, "id", "field_changes").collect()}
    assert got == {
        ("Study Status", "Overall Status", "MODIFIED", "A", "B"), ("Outcome Measures", "Primary #1.Measure", "MODIFIED", "P", "Q"),
        ("Contacts/Locations", "location", "ADDED", None, "Y"), ("Contacts/Locations", "location", "REMOVED", "X", None),
        ("Adverse Events", "_summary", "SUMMARY", None, "1 data points added; 1 values updated"),
    }


@pytest.mark.parametrize("path, said", [("phases[0]", "Phases #1"), ("startDateStruct.date", "Start Date Struct - Date"), ("statusModule.whyStopped", "Why Stopped")])
def test_readable(spark, path, said):
    assert one(spark, paths.readable(F.lit(path))) == said


def test_natural_order(spark):
    df = spark.createDataFrame([("x[10]",), ("x[2]",), ("a.b",), ("a1",)], "p string")
    assert [r["p"] for r in df.orderBy(paths.natural_key(F.col("p"))).collect()] == ["a1", "a.b", "x[2]", "x[10]"]


def test_references_are_decoded(spark):
    assert one(spark, paths.decode_references(F.lit("a &lt;b&gt; &#233;&#xE9; &amp;lt;"))) == "a <b> éé &lt;"


@pytest.mark.parametrize("raw, want", [("Acme Co., Ltd.", "Acme"), ("Acme Inc.", "Acme"), ("Texas", "Texas"), ("A  B GmbH", "A B")])
def test_legal_forms(spark, raw, want):
    assert one(spark, scalars.strip_legal_form(F.lit(raw))) == want


def test_scalars(spark):
    assert one(spark, scalars.phases(F.array(F.lit("PHASE1"), F.lit("PHASE2")))) == "PHASE1_PHASE2"
    assert one(spark, scalars.phases_of_text(F.lit("PHASE1, PHASE2"))) == "PHASE1_PHASE2"
    assert one(spark, scalars.phases_of_text(F.lit(None).cast("string"))) == ""
    assert one(spark, scalars.null_to_blank(F.lit(float("nan")))) == ""
    assert one(spark, scalars.null_words(F.lit(" N/A "))) is None
    assert one(spark, scalars.combo_names(F.lit("DRUG A + DRUG B|DRUG C"))) == "DRUG_A + DRUG_B|DRUG C"
    assert one(spark, scalars.number_to_int(F.lit(1.5))) == 1
    assert one(spark, scalars.date_pair(F.lit("2024-02-31")))["date"] is None


def test_sites(spark):
    df = spark.sql("select array(named_struct('facility','1. Foo Clinic /ID# 77'), named_struct('facility','015'), named_struct('facility','Foo Clinic')) as p")
    assert df.select(flatten.sites(F.col("p")).alias("s")).first()["s"] == ["Foo Clinic"]


def test_whole_words(spark):
    df = spark.createDataFrame([(1, "xabcx"), (2, "x ABC y"), (3, "x a.c y")], "id int, t string")
    words = spark.createDataFrame([("abc",)], "term string")
    assert [r["id"] for r in match.having_keyword(df, "id", F.col("t"), words).collect()] == [2]
    many = words.union(spark.range(300).selectExpr("concat('zz', id) as term"))
    assert [r["id"] for r in match.having_keyword(df, "id", F.col("t"), many).collect()] == [2]


def test_list_of_names(spark):
    df = spark.createDataFrame([(1, ["Acme Inc.", "ACME", ""])], "id int, names array<string>")
    none = spark.createDataFrame([], "alias string, canonical string")
    assert normalize.list_canonical(df, "id", F.col("names"), none, "out").first()["out"] == ["Acme"]


def test_merges_are_idempotent_and_keyless_rows_are_left_out(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = merge.prepared(spark.createDataFrame([("b", 3), ("b", 4), ("", 5), (None, 6), ("c", 7)], "k string, v int"), ["k"], [F.col("v")])
    once = merge.upsert(target, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merge.upsert(once, batch, ["k"]).collect())) == [("a", 1), ("b", 4), ("c", 7)]


def test_orphans_with_null_holders(spark):
    rows, held = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("a",), (None,)], "id string")
    assert [r["id"] for r in merge.orphans(rows, "id", held).collect()] == ["b"]


def test_gap_chain_falls_back(spark):
    ix = spark.createDataFrame([(i, v) for i in (1, 2, 3) for v in (1, 2, 3)], "id int, version int")
    cache = spark.createDataFrame([(1, 1), (2, 9)], "id int, stored int")
    assert sorted(map(tuple, versions.gap_pairs(ix, cache).collect())) == [(1, 1, 2), (1, 2, 3), (2, 2, 3), (3, 2, 3)]


NEGATIONS = [
    ("DRUG", "platinum", True, "no prior egfr, platinum", False),
    ("STAGE", "stage iv", True, "hr negative, stage iv disease", True),
    ("GENE", "EGFR", True, "absence of EGFR mutations. EGFR exon 20 insertion", True),
    ("GENE", "MET", False, "patients met the test criteria", False),
    ("GENE", "PD-L1", False, "PD-L1 inhibitor status", False),
    ("LINE_OF_THERAPY", "adjuvant", False, "prior adjuvant therapy", False),
    ("DRUG", "cisplatin", True, "cisplatin not allowed", False),
]


@pytest.mark.parametrize("concept, variant, negatable, text, found", NEGATIONS)
def test_negation(spark, concept, variant, negatable, text, found):
    words = spark.createDataFrame([("1", concept, "C", variant, 1.0, negatable)], "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")
    texts = spark.createDataFrame([(1, concept, text)], "id int, concept string, text string")
    assert (concepts.concepts(texts, words).count() == 1) is found


def test_dosing_and_ranges(spark):
    assert one(spark, concepts.without_dosing(F.array(F.lit("1.8 MG/KG IV Q3W"), F.lit("QW"), F.lit("DRUG A")))) == ["DRUG A"]
    assert one(spark, concepts.without_included(F.array(F.lit("ECOG_0"), F.lit("ECOG_0_1")))) == ["ECOG_0_1"]


def test_extraction_of_wanted_records(spark):
    schema = "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean"
    words = spark.createDataFrame([("1", "STATUS", "ECOG_0", "ecog 0", 0.9, False), ("2", "STATUS", "ECOG_0_1", "ecog 0 or 1", 0.8, False), ("3", "REGIMEN", "QW", "weekly dose", 0.5, False), ("4", "DISEASE", "HBV", "hepatitis b", 0.9, False)], schema)
    rows = spark.createDataFrame([(1, "ECOG 0 or 1, weekly dose, hepatitis B", ""), (2, "ecog 0", ""), (3, "ecog 0", "")], "id int, a string, b string")
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    elsewhere = spark.createDataFrame([(2, None, "R", "S"), (9, "x", "y", "z")], "id int, DISEASE string, REGIMEN string, STATUS string")
    routes = {"STATUS": ["a", "b"], "REGIMEN": ["a"], "DISEASE": ["a"]}
    got = {r["id"]: (r["STATUS"], r["REGIMEN"], r["DISEASE"]) for r in concepts.extraction(rows, ids, words, routes, elsewhere, {"DISEASE": ["HBV"]}).collect()}
    assert got == {1: ("ECOG_0_1", None, None), 2: ("S", "R", None)}
    mine = {r["id"]: r["STATUS"] for r in concepts.extraction(rows, ids, words, routes, elsewhere, external_first=False).collect()}
    assert mine == {1: "ECOG_0_1", 2: "ECOG_0"}


def test_a_clause_bounds_what_is_past_and_what_is_negative(spark):
    rows = [(1, "LINE", "No prior surgery. Patients get first-line therapy", 1), (2, "LINE", "after failed first-line therapy", 0), (3, "STATUS", "HR negative, stage IV, her2 positive", 1), (4, "STATUS", "negative for her2", 0), (5, "STATUS", "no negative, her2 finding", 0)]
    texts = spark.createDataFrame([(i, "LINE_OF_THERAPY" if c == "LINE" else c, t) for i, c, t, _ in rows], "id long, concept string, text string")
    words = spark.createDataFrame([("1", "LINE_OF_THERAPY", "FIRST_LINE", "first-line", 1.0, False), ("2", "STATUS", "HER2", "her2", 1.0, True)], "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")
    assert {r["id"] for r in concepts.concepts(texts, words).collect()} == {i for i, _, _, n in rows if n}


def test_context_has_no_end_but_its_characters(spark):
    text = "EGFR " * 60 + "was measured"  # more mentions than gaps were once read
    texts = spark.createDataFrame([(1, "GENE", text)], "id long, concept string, text string")
    words = spark.createDataFrame([("1", "GENE", "EGFR", "EGFR", 1.0, True)], "id string, concept string, canonical_value string, variants string, confidence double, negation_support boolean")
    found = concepts.occurrences(texts, concepts.variants(words)).collect()
    assert len(found) == 60
    for i, r in enumerate(sorted(found, key=lambda r: -len(r["after"]) if len(r["after"]) < 200 else -1000)):
        assert len(r["before"]) <= 200 and len(r["after"]) <= 200
    assert max(len(r["after"]) for r in found) == 200 and any(r["after"] == " was measured" for r in found)


def test_deep_documents_are_read_to_their_leaves(spark):
    deep = "{\"a\":" * 25 + "[1]" + "}" * 25
    df = spark.createDataFrame([(deep,), ('{"s":"[{"}',)], "doc string").withColumn("doc", F.parse_json("doc"))
    assert diff.nesting(df, "doc") == 26
    assert {r["path"] for r in diff.flatten(df, "doc").collect()} == {".".join("a" * 25) + "[0]", "s"}


def test_notes_of_failures_and_latest_pairs(spark):
    wanted = spark.createDataFrame([(f"NCT0000000{i}",) for i in range(6)], "id string")
    index = spark.createDataFrame([("NCT00000004", 1), ("NCT00000004", 2)], "id string, version int")
    pairs = spark.createDataFrame([("NCT00000004", 1, 2, [])], "id string, prev_version int, curr_version int, module_labels array<string>")
    for c in ("prev_date", "curr_date", "curr_status"):
        pairs = pairs.withColumn(c, F.lit("x"))
    rendered = spark.createDataFrame([], "id string, prev_version int, curr_version int, field_change_count long, field_changes string")
    failures = spark.createDataFrame([("NCT00000000", "404"), ("NCT00000001", "400"), ("NCT00000002", "503"), ("NCT00000003", "timeout")], "id string, error string")
    got = {r["id"][-1]: r["note"] for r in diff.comparison_rows(wanted, pairs, index, rendered, failures, latest=True).collect()}
    assert got == {"0": "NCT_NOT_FOUND", "1": "INVALID_NCT_ID", "2": "ERROR: HTTP 503", "3": "ERROR: timeout", "4": "NO_CHANGES_IN_LATEST", "5": "NO_HISTORY"}


def test_first_and_last_definitions_by_order(spark):
    source = spark.createDataFrame([("X", "Zeta", 1), ("x", "Alpha", 2)], "alias string, canonical string, at int")
    assert normalize.alias_map([source], "at").collect()[0]["canonical"] == "Zeta" and normalize.alias_map([source]).collect()[0]["canonical"] == "Alpha"
    docs = spark.createDataFrame([("N", '{"protocolSection":{"identificationModule":{"acronym":"Z"}}}', 1), ("N", '{"protocolSection":{"identificationModule":{"acronym":"A"}}}', 2)], "nct_id string, doc string, at int")
    assert flatten.organized(docs, order="at").collect()[0]["acronym"] == "A"


def test_routes_of_other_module_names_and_histories(spark):
    rows = [(1, "Status Dates", "start date"), (2, "Status Dates", "other"), (3, "status", "overall status"), (4, "Design", "phase"), (5, "Status Dates", "completion date")]
    df = spark.createDataFrame(rows, "id int, module string, field string")
    got = {r["id"]: r["s"] for r in df.select("id", events.stages(F.col("module"), F.col("field")).alias("s")).collect()}
    assert got == {1: ["DATE_HISTORY"], 2: [], 3: ["STATUS_HISTORY", "EMBED_INVALIDATE"], 4: ["PHASE_HISTORY", "EMBED_INVALIDATE"], 5: ["DATE_HISTORY", "EMBED_INVALIDATE"]}
    found = spark.createDataFrame([("a", 2, "Study Status", "overallStatus", "OPEN", "CLOSED"), ("a", 3, "Study Design", "phases[0]", "P1", "P2"), ("a", 3, "Study Status", "startDateStruct.date", "2020", "2021"), ("b", 2, "Contacts/Locations", "x", "1", "2")], "id string, curr_version int, module string, field string, old_value string, new_value string")
    h = events.histories(events.events(found), ["id"], "curr_version")
    assert [tuple(r) for r in h["status"].collect()] == [("a", "OPEN", "CLOSED")] and [tuple(r) for r in h["phase"].collect()] == [("a", "P1", "P2")]
    assert [r["date_field"] for r in h["dates"].collect()] == ["start_date"] and [r["id"] for r in h["invalidated"].collect()] == ["a"]


def test_a_large_dictionary_finds_what_a_small_one_finds(spark):
    said = ["PD-L1 positive, egfr\tmutation", "no anti-PD-L1 test", "α-synuclein status high", "EGFRvIII amplified", "C++ (EGFR) mutated", "Kras mutated", "", "--"]
    texts = spark.createDataFrame([(i, c, t) for i, t in enumerate(said) for c in ("GENE", "DISEASE")] + [(99, "GENE", None)], "id int, concept string, text string")
    known = [("GENE", "PDL1", "PD-L1"), ("GENE", "EGFR", "EGFR;egfr mutation"), ("DISEASE", "SNCA", "α-synuclein"), ("DISEASE", "CPP", "c++"), ("GENE", "KRAS", "kras"), ("DISEASE", "DASH", "--")]
    more = [("GENE", f"X{i}", f"absent {i}") for i in range(match.PREFILTER_FROM)]
    schema = "id int, concept string, canonical_value string, variants string, confidence double, negation_support boolean"
    table = lambda rows: spark.createDataFrame([(i, *r, 1.0, True) for i, r in enumerate(rows)], schema)
    small, large = (sorted(map(tuple, concepts.occurrences(texts, concepts.variants(table(rows))).drop("ord").collect())) for rows in (known, known + more))
    assert small == large and {r[2] for r in small} == {"PDL1", "EGFR", "SNCA", "CPP", "KRAS", "DASH"}


def test_counts_are_those_of_whole_rows(spark):
    records = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "id int, updated string")
    pipelines = spark.createDataFrame([("p",), ("q",), ("r",)], "pipeline string")
    pair = lambda *rows: spark.createDataFrame(list(rows), "id int, pipeline string")
    tracking, rejected, matched = pair((1, "p"), (1, "p"), (2, "q"), (9, "p"), (1, "other")), pair((3, "p"), (3, "p"), (1, "r"), (2, "r"), (3, "r"), (8, "q")), pair((1, "p"), (3, "p"), (3, "q"), (None, "p"))
    known = spark.createDataFrame([(1, "a"), (2, "x")], "id int, known_date string")
    args = (records, pipelines, tracking, rejected, matched, known)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(classify.counts(*args)) == rows(classify.bucket_counts(classify.classify(*args))) == [("p", 0, 0, 1, 2), ("q", 1, 1, 2, 0)]
    assert rows(classify.touched(*args)) == rows(classify.classify(*args).where("bucket <> 'unmatched'"))


def test_sites_of_odd_texts(spark):
    texts = {
        1: "A (Rome, Italy) [DONE] | 0042 (Boston, Massachusetts, United States, 02115) | No brackets | B ()",
        2: "Clinic ( Site 7) (Ankara, Turkey (Türkiye)) [X] |  | C (Paris, Île-de-France, France, ) | (Italy)",
        3: None, 4: "", 5: "D (Springfield, Italy, France)", 6: "E (Toronto, Ontario, Canada) | E (Toronto, Ontario, Canada)", 7: "F (x, Atlantis)",
    }
    known = spark.createDataFrame([(c,) for c in ("Italy", "United States", "Turkey", "France", "Canada", "Italy")], "value string")
    rows = spark.createDataFrame([*texts.items(), (5, texts[5])], "id long, places string")
    got = sorted((tuple(r) for r in flatten.site_rows_of_text(rows, "id", "places", known).collect()), key=repr)
    twice = (5, "D", "Springfield", None, "Italy", "France")
    canada = (6, "E", "Toronto", "Ontario", "Canada", None)
    assert got == sorted([
        (1, "A", "Rome", None, "Italy", None), (1, None, "Boston", "Massachusetts", "United States", "02115"), (2, "Clinic", "Ankara", None, "Turkey", None),
        (2, "C", "Paris", None, "France", None), (2, None, None, None, "Italy", None), twice, twice, canada, canada,
    ], key=repr)
    assert flatten.site_rows_of_text(rows.limit(0), "id", "places", known).count() == 0


def test_wide_pairs_as_a_map_and_a_page(spark):
    from recordloom.operators import reports

    rows = spark.createDataFrame([(1, "1-2", "a"), (1, "2-3", None), (1, "1-2", "b"), (2, "10-11", "c")], "id long, pair string, v string")
    wide = reports.wide_pairs(rows, "id", F.col("pair"), "v")
    assert {r["id"]: r["by_pair"] for r in wide.collect()} == {1: {"1-2": "a", "2-3": None}, 2: {"10-11": "c"}}
    assert sorted(map(tuple, reports.pair_columns(wide, "id", ["1-2", "10-11"]).collect())) == [(1, "a", None), (2, None, "c")]


def test_natural_order_of_long_numbers(spark):
    names = ["x[2]", "x[10]", "x[99999999999999999999999]", "x[100000000000000000000000]"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "p string")
    assert [r["p"] for r in df.orderBy(paths.natural_key(F.col("p"))).collect()] == names


def test_a_difference_is_found_in_its_row(spark):
    """No leaf is shuffled: the only groupings of a rendered difference are by pair, and of places by place."""
    docs = spark.createDataFrame([("a", "b", "c")], "id string, o string, n string").select("id", F.parse_json(F.lit('{"x":[1,{"y":null,"z":"1"}],"k":{"a":1}}')).alias("_old"), F.parse_json(F.lit('{"x":[1.0,{"z":1,"w":"q"}],"k":[]}')).alias("_new"))
    found = diff.compare(docs, ["id"]).first()["changes"]
    assert [tuple(c) for c in found] == [("k.a", "1", None), ("x[1].w", None, "q"), ("x[1].z", "1", "1")]
    plan = diff.compare(docs.union(docs), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_histories_read_events_once(spark):
    found = spark.createDataFrame([("a", 1, "Study Status", "overallStatus", "A", "B"), ("a", 2, "Study Status", "startDateStruct.date", "x", "y"), ("b", 1, "Study Design", "phases[0]", "1", "")], "id string, v int, module string, field string, old_value string, new_value string").repartition(2)
    rows = events.history_rows(events.events(found), ["id"], "v")
    assert {tuple(r) for r in rows.collect()} == {("a", "status", None, "A", "B"), ("a", "dates", "start_date", "x", "y"), ("a", "invalidated", None, None, None), ("b", "invalidated", None, None, None)}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1
