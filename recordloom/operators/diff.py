"""Field-by-field comparison of nested documents (VARIANT columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import change_label, decode_references, natural_key, readable
from ..functions.scalars import bound

# Labels of modules and where they are in a document. Two labels name the references.
MODULES = {
    "Study Status": "protocolSection.statusModule",
    "Contacts/Locations": "protocolSection.contactsLocationsModule",
    "Outcome Measures": "protocolSection.outcomesModule",
    "Eligibility": "protocolSection.eligibilityModule",
    "Arms/Interventions": "protocolSection.armsInterventionsModule",
    "Study Design": "protocolSection.designModule",
    "Description": "protocolSection.descriptionModule",
    "Sponsor/Collaborators": "protocolSection.sponsorCollaboratorsModule",
    "Identification": "protocolSection.identificationModule",
    "Conditions": "protocolSection.conditionsModule",
    "References": "protocolSection.referencesModule",
    "More Information": "protocolSection.referencesModule",
    "IPD Sharing": "protocolSection.ipdSharingStatementModule",
    "Participant Flow": "resultsSection.participantFlowModule",
    "Baseline Characteristics": "resultsSection.baselineCharacteristicsModule",
    "Outcome Measures (Results)": "resultsSection.outcomeMeasuresModule",
    "Adverse Events": "resultsSection.adverseEventsModule",
}
RESULTS = [label for label, path in MODULES.items() if path.startswith("resultsSection")]
PLACES = "Contacts/Locations"


def nesting(rows: DataFrame, doc: str) -> int:
    """How deep the deepest document is nested."""
    marks = F.split(F.regexp_replace(F.regexp_replace(F.to_json(doc), r'"(?:[^"\\\\]|\\\\.)*+"', ""), r"[^\[\]{}]", ""), "")
    step = lambda s, c: F.when(c.isin("[", "{"), s["now"] + 1).when(c.isin("]", "}"), s["now"] - 1).otherwise(s["now"])
    deepest = F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")), lambda s, c: F.struct(step(s, c).alias("now"), F.greatest(s["top"], step(s, c)).alias("top")), lambda s: s["top"])
    return rows.agg(F.coalesce(F.max(deepest), F.lit(0))).first()[0]


def flatten(rows: DataFrame, doc: str, depth: int | None = None) -> DataFrame:
    """``rows`` without ``doc``, one row per leaf of it: path (a.b[0].c) and value (text; null for a JSON null).

    Empty objects and arrays have no leaf. Numbers print alike whether written 1 or 1.0. Without ``depth`` the documents
    are read once more for how deep they are nested; where ``depth`` is known, one nested deeper is an error, not a cut.
    """
    keep = [c for c in rows.columns if c != doc]
    depth = max(1, nesting(rows, doc)) if depth is None else depth
    rows = rows.select(*keep, F.lit("").alias("path"), F.col(doc).alias("_v"))
    members = "transform(map_entries(try_variant_get(_v, '$', 'map<string,variant>')), e -> struct(if(path = '', e.key, concat(path, '.', e.key)) as path, e.value as value))"
    elements = "transform(try_variant_get(_v, '$', 'array<variant>'), (x, i) -> struct(concat(path, '[', i, ']') as path, x as value))"
    for _ in range(depth):
        rows = rows.select(*keep, F.explode(F.expr(f"coalesce({members}, {elements}, array(struct(path as path, _v as value)))")).alias("_e"))
        rows = rows.select(*keep, F.col("_e.path").alias("path"), F.col("_e.value").alias("_v"))
    deep = F.expr("try_variant_get(_v, '$', 'map<string,variant>') is not null or try_variant_get(_v, '$', 'array<variant>') is not null")
    text = F.coalesce(F.expr("try_variant_get(_v, '$', 'string')"), F.to_json("_v"))
    value = F.when(deep, F.raise_error(F.lit(f"document nested deeper than {depth} levels"))).when(F.expr("_v is null or is_variant_null(_v)"), None).otherwise(text)
    kind = F.when(F.expr("schema_of_variant(_v) = 'STRING'"), "text").otherwise("other")
    return rows.select(*keep, "path", value.alias("value"), F.when(value.isNotNull(), kind).alias("kind")).where("path <> ''")


def changed_modules(pairs: DataFrame, labels: str) -> DataFrame:
    """One row per pair and listed module: its label (of labels for one module the first in order) and path; unknown labels are skipped."""
    known = F.create_map(*[F.lit(x) for item in MODULES.items() for x in item])
    rest = [c for c in pairs.columns if c != labels]
    rows = pairs.select(*rest, F.explode(labels).alias("module")).withColumn("module_path", F.try_element_at(known, F.col("module"))).where("module_path is not null")
    return rows.groupBy(*rest, "module_path").agg(F.min("module").alias("module"))


def _leaves(doc: str, depth: int, side: int) -> str:
    """The leaves of a document that are not null, as an array of (path, side, value, kind): see ``flatten``."""
    members = "transform(map_entries(try_variant_get(s.v, '$', 'map<string,variant>')), e -> struct(if(s.path = '', e.key, concat(s.path, '.', e.key)) as path, e.value as v))"
    elements = "transform(try_variant_get(s.v, '$', 'array<variant>'), (x, i) -> struct(concat(s.path, '[', i, ']') as path, x as v))"
    start = f"if({doc} is null, cast(array() as array<struct<path: string, v: variant>>), array(struct('' as path, {doc} as v)))"
    container = "try_variant_get(s.v, '$', 'map<string,variant>') is not null or try_variant_get(s.v, '$', 'array<variant>') is not null"
    found = f"a{depth}"
    for k in reversed(range(depth + 1)):  # a level is taken apart only where something is left to take apart
        inner = start if k == 0 else f"flatten(transform(a{k - 1}, s -> coalesce({members}, {elements}, array(s))))"
        rest = found if k == depth else f"if(exists(a{k}, s -> {container}), {found}, a{k})"
        found = f"transform(array({inner}), a{k} -> {rest})[0]"
    deep = "try_variant_get(s.v, '$', 'map<string,variant>') is not null or try_variant_get(s.v, '$', 'array<variant>') is not null"
    value = f"if({deep}, raise_error('document nested deeper than {depth} levels'), coalesce(try_variant_get(s.v, '$', 'string'), to_json(s.v)))"
    kept = f"filter({found}, s -> s.path <> '' and s.v is not null and not is_variant_null(s.v))"
    return f"transform({kept}, s -> struct(s.path as path, {side} as side, {value} as value, if(schema_of_variant(s.v) = 'STRING', 'text', 'other') as kind))"


def compare(rows: DataFrame, keys: list[str], depth: int | None = None) -> DataFrame:
    """Rows (keys…, _old, _new: two documents) with their changed leaves as an array ``changes`` of (path, old_value, new_value). Absent and null are the same.

    The leaves of both stand in one array, sorted by path, and neighbours are compared: no leaf leaves its row. Of two
    leaves of one document that have one path the greater counts.
    """
    if depth is None:
        depth = max(1, nesting(rows.select(F.explode(F.array("_old", "_new")).alias("doc")), "doc"))
    leaves = f"sort_array(concat({_leaves('_old', depth, 0)}, {_leaves('_new', depth, 1)}))"
    unique = "filter(l, (s, i) -> not coalesce(get(l, i + 1).path = s.path and get(l, i + 1).side = s.side, false))"
    met = "get(u, i - 1).path = s.path"
    pair = f"if(s.side = 0, struct(s.path as path, s.value as old_value, cast(null as string) as new_value), struct(s.path as path, if({met}, get(u, i - 1).value, null) as old_value, s.value as new_value))"
    last = "not coalesce(get(u, i + 1).path = s.path, false)"
    same = f"coalesce({met} and get(u, i - 1).value = s.value and get(u, i - 1).kind = s.kind, false)"
    changed = f"filter(transform(u, (s, i) -> if({last} and not {same}, {pair}, null)), c -> c is not null)"
    # bound names: an array that is looked up in is computed once, wherever the optimizer moves the expression
    return rows.select(*keys, F.expr(f"transform(transform(array({leaves}), l -> {unique}), u -> {changed})[0]").alias("changes"))


def field_changes(pairs: DataFrame, versions: DataFrame, depth: int | None = None) -> DataFrame:
    """Changes of version pairs: id, prev_version, curr_version, module, field, old_value, new_value.

    pairs (id, prev_version, curr_version, module_labels array); versions (id, version, doc variant). Only listed
    modules are compared. Places are matched by facility, not by position (see ``place_changes``).
    """
    keys = ["id", "prev_version", "curr_version"]
    known = F.create_map(*[F.lit(x) for item in MODULES.items() for x in item])
    labels = F.array_sort(F.array_distinct(F.filter("module_labels", lambda m: F.try_element_at(known, m).isNotNull())))  # of labels for one module the first
    named = F.transform(labels, lambda m: F.struct(m.alias("module"), F.try_element_at(known, m).alias("path")))
    paths = F.transform(labels, lambda m: F.try_element_at(known, m))
    chosen = F.filter(named, lambda x, i: F.array_position(paths, x["path"]) == i + 1)
    docs = lambda name: versions.select("id", F.col("version").alias(name), F.col("doc").alias(f"_{name}"))

    def cut(doc: str, m: Column) -> Column:
        """The module of a document; paths are literals, as one that comes from a column is parsed again in every row."""
        return F.coalesce(*[F.when(m["path"] == path, F.try_variant_get(doc, F.lit(f"$.{path}"), "variant")) for path in dict.fromkeys(MODULES.values())])


    def both(some: DataFrame, modules: Column) -> DataFrame:
        """Both documents of each of ``some`` pairs, cut to ``modules``; equal modules are not taken apart."""
        rows = some.select(*keys, modules.alias("_chosen"))
        rows = rows.join(docs("prev_version"), ["id", "prev_version"], "left").join(docs("curr_version"), ["id", "curr_version"], "left")
        rows = rows.select(*keys, "_prev_version", "_curr_version", F.explode("_chosen").alias("_m"))
        rows = rows.select(*keys, F.col("_m.module").alias("module"), cut("_prev_version", F.col("_m")).alias("_old"), cut("_curr_version", F.col("_m")).alias("_new"))
        return rows.where(~F.to_json("_old").eqNullSafe(F.to_json("_new")))

    # pairs that don't list places never meet a document for them
    placed = both(pairs.where(F.array_contains("module_labels", PLACES)), F.filter(chosen, lambda x: x["module"] == PLACES))
    side = lambda old, doc: F.struct(F.lit(old).alias("old"), F.col(doc).alias("doc"))
    placed = placed.select(*keys, F.inline(F.array(side(True, "_old"), side(False, "_new")))).where("doc is not null")
    others = both(pairs, F.filter(chosen, lambda x: x["module"] != PLACES))
    plain = compare(others, [*keys, "module"], depth).select(*keys, "module", F.inline_outer("changes").alias("field", "old_value", "new_value")).where("field is not null")
    return plain.unionByName(place_changes(placed, keys, depth).withColumn("module", F.lit(PLACES))).select(*keys, "module", "field", "old_value", "new_value")


def place_changes(sides: DataFrame, keys: list[str], depth: int | None = None) -> DataFrame:
    """Changes of rows (keys…, old, doc) with ``locations``: places added or removed, and changed details of the others.

    A place is known by its facility, else its city, else its position; of two with one name the later
    counts. Coordinates are not compared.
    """
    at = sides.select(*keys, "old", F.posexplode(F.expr("try_variant_get(doc, '$.locations', 'array<variant>')")).alias("_i", "_place"))
    get = lambda p: F.nullif(F.try_variant_get("_place", F.lit(f"$.{p}"), "string"), F.lit(""))
    named = at.withColumn("place", F.coalesce(get("facility"), get("city"), F.concat(F.lit("location_"), "_i"))).withColumn("_said", F.concat_ws(", ", "place", get("city"), get("country")))
    here = lambda old: F.max_by(F.struct("_said", F.to_json("_place").alias("_json")), F.when(F.col("old") == old, F.col("_i")))
    there = named.groupBy(*keys, "place").agg(here(True).alias("_o"), here(False).alias("_n"))
    old, new = F.col("_o._said"), F.col("_n._said")
    moved = F.when(old.isNull() | new.isNull(), F.array(F.struct(F.when(old.isNull(), "__added__").otherwise("__removed__").alias("path"), old.alias("old_value"), new.alias("new_value"))))
    # one row per place holds both of its sides: those that differ are taken apart there
    differ = old.isNotNull() & new.isNotNull() & (F.col("_o._json") != F.col("_n._json"))
    parsed = lambda side: F.parse_json(F.when(differ, F.col(f"{side}._json")))
    rows = there.where(moved.isNotNull() | differ).select(*keys, "place", moved.alias("_moved"), parsed("_o").alias("_old"), parsed("_n").alias("_new"))
    detail = lambda c: F.struct(F.concat(F.lit("location."), c["path"], F.lit(" ["), "place", F.lit("]")).alias("path"), c["old_value"].alias("old_value"), c["new_value"].alias("new_value"))
    details = F.transform(F.filter("changes", lambda c: ~c["path"].isin("geoPoint.lat", "geoPoint.lon")), detail)
    return compare(rows, [*keys, "place", "_moved"], depth).select(*keys, F.inline_outer(F.coalesce("_moved", details)).alias("field", "old_value", "new_value")).where("field is not null")


def result_counts(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes per module: how many values were added, updated and removed."""
    old, new = F.col("old_value").isNull(), F.col("new_value").isNull()
    return changes.groupBy(*keys, "module").agg(F.count_if(old).alias("n_added"), F.count_if(~old & ~new).alias("n_changed"), F.count_if(new).alias("n_removed"))


def render(changes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, field_change_count, field_changes): the changes of a pair as text, one section per module.

    Places list what was added, removed and updated; results are counted; outcomes are grouped by number, primary ones
    first; all else is in natural order of the field.
    """

    def said(c: Column) -> Column:
        """What one change says, in the order in which changes are told."""
        field, module, old, new = c["field"], c["module"], c["old_value"], c["new_value"]
        outcome = (module == "Outcome Measures") & field.rlike(r"(?i)^(primary|secondary)Outcomes\[\d+\]\..")
        number = F.regexp_extract(field, r"(?i)^\w+Outcomes\[(\d+)\]", 1).try_cast("int")
        primary = F.lower(field).startswith("primary")
        rank = F.when(outcome, F.when(primary, 0).otherwise(1)).when(field == "__added__", 0).when(field == "__removed__", 1).otherwise(2)
        head = (
            F.when(outcome, F.concat(F.when(primary, "  Primary Outcome #").otherwise("  Secondary Outcome #"), (number + 1).cast("string"), F.lit(":")))
            .when(module == PLACES, F.when(field == "__added__", "  Added").when(field == "__removed__", "  Removed").otherwise("  Updated details"))
            .otherwise("")
        )
        line = (
            F.when(field == "__added__", F.concat(F.lit("    + "), decode_references(new)))
            .when(field == "__removed__", F.concat(F.lit("    - "), decode_references(old)))
            .otherwise(F.concat(F.when(outcome | (module == PLACES), "    ").otherwise("  "), readable(F.when(outcome, F.regexp_replace(field, r"^\w+\[\d+\]\.", "")).otherwise(field)), F.lit(": "), change_label(old, new)))
        )
        result = module.isin(RESULTS)
        kind = F.when(old.isNull(), 0).when(new.isNull(), 2).otherwise(1)
        return F.struct(
            module.alias("module"), F.when(result, 0).otherwise(rank).alias("rank"), F.coalesce(F.when(outcome & ~result, number), F.lit(0)).alias("number"), F.when(result, "").otherwise(head).alias("head"),
            F.when(~result, natural_key(field)).alias("order"), F.when(~result, line).alias("line"), F.when(result, kind).alias("kind"),
        )

    # one grouping, in which changes are as they came: nothing longer than they are is shuffled or sorted
    rows = changes.groupBy(*keys).agg(F.collect_list(F.struct("module", "field", "old_value", "new_value")).alias("_c"))

    def whole(c: Column) -> Column:
        """The text of all changes, in order."""
        before = lambda i: F.get(c, i - 1)
        count = lambda s, name, value: F.size(F.filter(c, lambda x: (x["module"] == s["module"]) & (x[name] == value)))
        part = lambda s, kind, words: bound(count(s, "kind", kind), lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit(words))))

        def text(s: Column, i: Column) -> Column:
            result = s["module"].isin(RESULTS)
            section = (i == 0) | (before(i)["module"] != s["module"])
            group = section | (before(i)["rank"] != s["rank"]) | (before(i)["number"] != s["number"]) | (before(i)["head"] != s["head"])
            summary = F.concat(F.lit("  "), F.concat_ws("; ", part(s, 0, " data points added"), part(s, 1, " values updated"), part(s, 2, " data points removed")))
            title = F.when(~group | (s["head"] == ""), F.lit("")).when(s["module"] == PLACES, F.concat(s["head"], F.lit(" ("), count(s, "head", s["head"]).cast("string"), F.lit("):\n"))).otherwise(F.concat(s["head"], F.lit("\n")))
            start = F.when(i == 0, F.lit("")).when(section, F.lit("\n\n")).otherwise(F.lit("\n"))
            return F.when(result & ~section, None).otherwise(F.concat(start, F.when(section, F.concat(F.lit("["), s["module"], F.lit("]\n"))).otherwise(""), F.when(result, summary).otherwise(F.concat(title, s["line"]))))

        return F.array_join(F.transform(c, text), "")

    return rows.select(*keys, F.size("_c").cast("long").alias("field_change_count"), bound(F.sort_array(F.transform("_c", said)), whole).alias("field_changes"))


def comparison_rows(wanted: DataFrame, pairs: DataFrame, index: DataFrame, rendered: DataFrame, failures: DataFrame | None = None, latest: bool = False) -> DataFrame:
    """One row per wanted id and pair: note, total_versions, versions, dates, status, modules, number and text of changes.

    note is '' for a comparison, INVALID_NCT_ID for a malformed id, NO_HISTORY, SINGLE_VERSION, or
    NO_CHANGES_IN_VERSION (of ``latest`` pairs NO_CHANGES_IN_LATEST) where no module is listed. ``failures`` (id, error: an
    HTTP code or a message) are records that could not be read: NCT_NOT_FOUND for 404, INVALID_NCT_ID for 400, else ERROR and what it was.
    """
    total = index.groupBy("id").agg(F.count("*").alias("total_versions"))
    rows = wanted.select("id").distinct().join(total, "id", "left").na.fill(0, ["total_versions"]).join(pairs.drop("total_versions"), "id", "left").join(rendered, ["id", "prev_version", "curr_version"], "left")
    if failures is not None:
        rows = rows.join(failures.groupBy("id").agg(F.min(F.col("error").cast("string")).alias("_error")), "id", "left")
    error = F.col("_error") if failures is not None else F.lit(None).cast("string")
    note = (
        F.when(error == "404", "NCT_NOT_FOUND").when(error == "400", "INVALID_NCT_ID").when(error.rlike(r"^\d+$"), F.concat(F.lit("ERROR: HTTP "), error)).when(error.isNotNull(), F.concat(F.lit("ERROR: "), error))
        .when(~F.col("id").rlike(r"^NCT\d{8}$"), "INVALID_NCT_ID")
        .when(F.col("total_versions") == 0, "NO_HISTORY")
        .when(F.col("total_versions") == 1, "SINGLE_VERSION")
        .when(F.coalesce(F.size("module_labels"), F.lit(0)) == 0, "NO_CHANGES_IN_LATEST" if latest else "NO_CHANGES_IN_VERSION")
        .otherwise("")
    )
    return rows.select(
        "id", note.alias("note"), "total_versions", "prev_version", "curr_version", "prev_date", "curr_date", "curr_status",
        F.array_join("module_labels", ", ").alias("modules_changed"), F.coalesce("field_change_count", F.lit(0)).alias("field_change_count"), "field_changes",
    )
