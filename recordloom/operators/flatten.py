"""A nested study document as one wide, typed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_pair, min_age, phases, to_bool
from ..schemas import STUDY
from .match import is_person
from .normalize import distinct_in_order

STUDY_URL = "https://clinicaltrials.gov/study/"
DOCUMENT_URL = "https://cdn.clinicaltrials.gov/large-docs/"


def outcomes_json(c: Column) -> Column:
    """Outcomes as a JSON array of measure, description and time frame, trimmed; '' if there are none."""
    trimmed = F.transform(c, lambda o: F.struct(F.trim(o["measure"]).alias("measure"), F.trim(o["description"]).alias("description"), F.trim(o["timeFrame"]).alias("timeFrame")))
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.to_json(trimmed)).otherwise("")


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _joined(c: Column, sep: str) -> Column:
    return F.coalesce(F.array_join(F.filter(c, lambda x: x.isNotNull() & (x != "")), sep), F.lit(""))


def contacts_text(c: Column) -> Column:
    """"Name (role) - Phone: …, Email: …" of each person."""

    def one(p: Column) -> Column:
        reach = F.concat_ws(", ", F.concat(F.lit("Phone: "), _filled(p["phone"])), F.concat(F.lit("Email: "), _filled(p["email"])))
        who = F.concat(F.trim(p["name"]), F.coalesce(F.concat(F.lit(" ("), _filled(p["role"]), F.lit(")")), F.lit("")))
        return F.concat_ws(" - ", who, F.nullif(reach, F.lit("")))

    return _joined(F.transform(F.filter(c, lambda p: is_person(p["name"])), one), " | ")


def officials_text(c: Column) -> Column:
    """"Name (role) - affiliation" of each official who is a person."""
    one = lambda p: F.concat_ws(" - ", F.concat(F.trim(p["name"]), F.coalesce(F.concat(F.lit(" ("), _filled(p["role"]), F.lit(")")), F.lit(""))), _filled(p["affiliation"]))
    return _joined(F.transform(F.filter(c, lambda p: is_person(p["name"])), one), " | ")


def places_text(c: Column) -> Column:
    """"Facility (City, State, Country) [STATUS]" of each place, as far as its parts are known."""

    def one(p: Column) -> Column:
        where = F.nullif(F.concat_ws(", ", _filled(p["city"]), _filled(p["state"]), _filled(p["country"])), F.lit(""))
        name = _filled(p["facility"])
        both = F.when(name.isNotNull() & where.isNotNull(), F.concat(name, F.lit(" ("), where, F.lit(")"))).otherwise(F.coalesce(name, where))
        return F.when(both.isNotNull(), F.concat_ws(" ", both, F.concat(F.lit("["), _filled(p["status"]), F.lit("]"))))

    return _joined(F.transform(c, one), " | ")


def countries(c: Column) -> Column:
    """Distinct countries of places, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda p: F.trim(p["country"])), lambda x: x != "")))


def sites(c: Column) -> Column:
    """Distinct facilities in order, without "/ID# …" and a leading number; those without a letter are left out."""
    clean = F.transform(c, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p["facility"], r"\s*/\s*ID#.*$", ""), r"^\s*\d+\.\s+", "")))
    return F.array_distinct(F.filter(clean, lambda x: x.rlike("[A-Za-z]")))


#: Countries whose places have a state. Fixed values.
STATE_COUNTRIES = ("United States", "Canada", "Australia")


def site_rows(rows: DataFrame, key: str, places: Column) -> DataFrame:
    """One row per place: site, city, state (in the US, Canada and Australia only), country, zip."""
    at = rows.select(key, F.explode(places).alias("p"))
    state = F.when(F.col("p.country").isin(*STATE_COUNTRIES), _filled(F.col("p.state")))
    return at.select(key, _filled(F.col("p.facility")).alias("site_name"), _filled(F.col("p.city")).alias("city"), state.alias("state"), _filled(F.col("p.country")).alias("country"), _filled(F.col("p.zip")).alias("zip"))


def site_rows_of_text(rows: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """Site rows out of "Facility (City, State, Country, Zip) [STATUS] | …", the form of ``places_text``.

    ``known`` has the names of countries in ``value``. The last bracket of a place, which may hold brackets itself, has its parts between
    commas; the first of them that is a known country, without what it has in brackets, decides: the first part is the city, the part before
    the country its state (in three countries), the part after it the zip. Places without brackets or without a known country give no row.
    A facility loses a trailing "(Site 12)", and one of digits only is none. Parts meet the countries in a join, which Spark broadcasts
    if they are few; a place is one row from splitting to the end, so a key with many places is no hot group. Repeated rows give their places each.
    """
    entry = F.trim(F.regexp_replace(F.trim(F.col("_entry")), r"\s*\[[^\]]+\]\s*$", ""))
    flat, nested = r"^(.*?)\(([^)]+)\)\s*$", r"^(.*?)\(((?:[^()]|\([^()]*\))*)\)\s*$"
    pattern = lambda group: F.when(entry.rlike(flat), F.regexp_extract(entry, flat, group)).when(entry.rlike(nested), F.regexp_extract(entry, nested, group))
    facility = F.trim(F.regexp_replace(F.trim(pattern(1)), r"\s*\(\s*[Ss]ite\s+\d+\s*\)\s*$", ""))
    at = rows.select(F.col(key).alias("_key"), F.posexplode(F.split(text, r" \| ")).alias("_n", "_entry"))
    at = at.select("_key", "_n", F.when(~facility.rlike(r"^\d+$"), _filled(facility)).alias("_site"), F.transform(F.split(pattern(2), ","), lambda p: F.trim(p)).alias("_parts"))
    at = at.where("_parts IS NOT NULL").groupBy("_key", "_n", "_site", "_parts").agg(F.count("*").alias("_times"))
    part = at.select("*", F.posexplode("_parts").alias("_i", "_part")).withColumn("_country", F.trim(F.regexp_replace("_part", r"\s*\([^)]+\)", "")))
    met = part.join(known.select(F.col("value").alias("_country")).distinct(), "_country")
    first = met.groupBy("_key", "_n", "_site", "_parts", "_times").agg(F.min(F.struct("_i", "_country")).alias("_c"))
    i, parts = F.col("_c._i"), F.col("_parts")
    return first.select(
        F.col("_key").alias(key), F.col("_site").alias("site_name"), F.when(i > 0, F.get(parts, F.lit(0))).alias("city"),
        F.when(F.col("_c._country").isin(*STATE_COUNTRIES) & (i >= 2), F.get(parts, i - 1)).alias("state"), F.col("_c._country").alias("country"),
        _filled(F.get(parts, i + 1)).alias("zip"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_copy"),
    ).drop("_copy")


def known_values(rows: DataFrame, column: str, sep: str = r" \| ") -> DataFrame:
    """Distinct values of a delimited text column."""
    return rows.select(F.explode(F.split(column, sep)).alias("v")).select(F.trim("v").alias("value")).where("value <> ''").distinct()


def organized(raw: DataFrame, key: str = "nct_id", doc: str = "doc", order: str | None = None) -> DataFrame:
    """One wide row per document of (key, JSON text); of several documents of one key the last by ``order``, without it the last in text order."""
    one = raw.groupBy(key).agg((F.max_by(doc, F.struct(order, doc)) if order else F.max(doc)).alias(doc))
    s = one.select(F.col(key).alias("_key"), F.from_json(doc, STUDY).alias("s"))
    p = lambda path: F.col(f"s.protocolSection.{path}")
    d = lambda path: F.col(f"s.derivedSection.{path}")
    id = F.coalesce(_filled(p("identificationModule.nctId")), F.col("_key"))
    st, de, el, sp, cl = "statusModule", "designModule", "eligibilityModule", "sponsorCollaboratorsModule", "contactsLocationsModule"
    dates = {"start": f"{st}.startDateStruct.date", "primary_completion": f"{st}.primaryCompletionDateStruct.date", "completion": f"{st}.completionDateStruct.date", "last_update": f"{st}.lastUpdatePostDateStruct.date", "status_verified": f"{st}.statusVerifiedDate", "first_post": f"{st}.studyFirstPostDateStruct.date", "first_submit": f"{st}.studyFirstSubmitDate"}
    names = F.transform(p("armsInterventionsModule.interventions"), lambda i: F.trim(i["name"]))
    references = p("referencesModule.references")
    terms = lambda c: _joined(F.transform(F.filter(c, lambda t: _filled(t["term"]).isNotNull()), lambda t: F.concat(F.coalesce(t["id"], F.lit("")), F.lit(": "), t["term"])), " | ")
    columns: dict[str, Column] = {
        "nct_id": id,
        "study_url": F.when(id != "", F.concat(F.lit(STUDY_URL), id)).otherwise(""),
        "other_ids": _joined(F.concat(F.array(p("identificationModule.orgStudyIdInfo.id")), F.coalesce(F.transform(p("identificationModule.secondaryIdInfos"), lambda x: x["id"]), F.array().cast("array<string>"))), ", "),
        "brief_title": p("identificationModule.briefTitle"),
        "official_title": p("identificationModule.officialTitle"),
        "acronym": p("identificationModule.acronym"),
        "org_full_name": p("identificationModule.organization.fullName"),
        "overall_status": p(f"{st}.overallStatus"),
        "status_verified_date": p(f"{st}.statusVerifiedDate"),
        "exclusion_rationale": p(f"{st}.whyStopped"),
        "expanded_access": to_bool(p(f"{st}.expandedAccessInfo.hasExpandedAccess")),
        "fda_regulated_drug": to_bool(p("oversightModule.isFdaRegulatedDrug")),
        "fda_regulated_device": to_bool(p("oversightModule.isFdaRegulatedDevice")),
        "has_dmc": to_bool(p("oversightModule.oversightHasDmc")),
        "healthy_volunteers": to_bool(p(f"{el}.healthyVolunteers")),
    }
    for name in ("start", "primaryCompletion", "completion", "studyFirstPost", "lastUpdatePost"):
        snake = "".join("_" + c.lower() if c.isupper() else c for c in name)
        columns |= {f"{snake}_date": p(f"{st}.{name}DateStruct.date"), f"{snake}_date_type": p(f"{st}.{name}DateStruct.type")}
    columns |= {"study_first_submit_date": p(f"{st}.studyFirstSubmitDate"), "study_first_submit_qc_date": p(f"{st}.studyFirstSubmitQcDate"), "last_update_submit_date": p(f"{st}.lastUpdateSubmitDate")}
    for name, path in dates.items():
        columns |= {f"{name}_parsed": date_pair(p(path))["date"], f"{name}_precision": date_pair(p(path))["precision"]}
    columns |= {
        "sponsor": p(f"{sp}.leadSponsor.name"),
        "sponsor_class": p(f"{sp}.leadSponsor.class"),
        "responsible_party_type": p(f"{sp}.responsibleParty.type"),
        "collaborators": distinct_in_order(F.transform(p(f"{sp}.collaborators"), lambda c: F.trim(c["name"]))),
        "brief_summary": p("descriptionModule.briefSummary"),
        "detailed_description": p("descriptionModule.detailedDescription"),
        "conditions": distinct_in_order(F.transform(p("conditionsModule.conditions"), lambda x: F.trim(x))),
        "study_type": p(f"{de}.studyType"),
        "phases": F.coalesce(phases(p(f"{de}.phases")), F.lit("")),
        "allocation": p(f"{de}.designInfo.allocation"),
        "intervention_model": p(f"{de}.designInfo.interventionModel"),
        "masking": p(f"{de}.designInfo.maskingInfo.masking"),
        "primary_purpose": p(f"{de}.designInfo.primaryPurpose"),
        "enrollment": p(f"{de}.enrollmentInfo.count").try_cast("int"),
        "enrollment_type": p(f"{de}.enrollmentInfo.type"),
        "interventions": _joined(names, ", "),
        "intervention_names": distinct_in_order(names),
        "primary_outcomes": outcomes_json(p("outcomesModule.primaryOutcomes")),
        "secondary_outcomes": outcomes_json(p("outcomesModule.secondaryOutcomes")),
        "eligibility_criteria": p(f"{el}.eligibilityCriteria"),
        "sex": p(f"{el}.sex"),
        "minimum_age": p(f"{el}.minimumAge"),
        "min_age_value": min_age(p(f"{el}.minimumAge"))["value"],
        "min_age_unit": min_age(p(f"{el}.minimumAge"))["unit"],
        "standard_ages": p(f"{el}.stdAges"),
        "central_contacts": contacts_text(p(f"{cl}.centralContacts")),
        "overall_officials": officials_text(p(f"{cl}.overallOfficials")),
        "locations": places_text(p(f"{cl}.locations")),
        "countries": countries(p(f"{cl}.locations")),
        "sites": sites(p(f"{cl}.locations")),
        "ipd_sharing": p("ipdSharingStatementModule.ipdSharing"),
        "mesh_conditions": terms(d("conditionBrowseModule.meshes")),
        "mesh_interventions": terms(d("interventionBrowseModule.meshes")),
        "study_documents": _joined(F.transform(F.col("s.documentSection.largeDocumentModule.largeDocs"), lambda x: F.concat(F.lit(DOCUMENT_URL), F.right(id, F.lit(2)), F.lit("/"), id, F.lit("/"), x["filename"])), " | "),
        "reference_count": F.coalesce(F.size(references), F.lit(0)),
        "pmids": _joined(F.transform(references, lambda r: r["pmid"]), ", "),
        "citations": _joined(F.transform(F.filter(references, lambda r: _filled(r["citation"]).isNotNull()), lambda r: F.concat(F.lit("["), F.coalesce(r["type"], F.lit("")), F.lit("] "), r["citation"])), " | "),
        "primary_drug": F.lit(""),
    }
    return s.select(*[c.alias(n) for n, c in columns.items()]).where("nct_id <> ''")


def scan_rows(raw: DataFrame, doc: str = "doc") -> DataFrame:
    """The light row of a delta scan: lists joined by "; ", interventions as "type: name"."""
    s = raw.select(F.from_json(doc, STUDY).alias("s"))
    p = lambda path: F.col(f"s.protocolSection.{path}")
    kind = F.transform(p("armsInterventionsModule.interventions"), lambda i: F.concat_ws(": ", _filled(i["type"]), _filled(i["name"])))
    return s.select(
        p("identificationModule.nctId").alias("nct_id"), p("identificationModule.briefTitle").alias("title"), p("statusModule.overallStatus").alias("status"),
        p("statusModule.lastUpdatePostDateStruct.date").alias("last_update"), _joined(p("conditionsModule.conditions"), "; ").alias("conditions"), _joined(kind, "; ").alias("interventions"),
        p("sponsorCollaboratorsModule.leadSponsor.name").alias("sponsor"), _joined(p("designModule.phases"), "; ").alias("phases"), p("designModule.studyType").alias("study_type"),
        _joined(F.transform(F.col("s.derivedSection.conditionBrowseModule.meshes"), lambda t: t["term"]), "; ").alias("mesh_terms"),
    ).where("nct_id <> ''")
