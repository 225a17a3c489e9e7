"""Keyword sets, and records that mention them."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import BROADCAST_ROWS, small

# First words of contacts that are no persons.
NO_PERSON = (
    "medical", "toll", "call", "clinical", "global", "senior", "chief", "vice", "executive", "study", "director", "manager", "regulatory", "safety",
    "trial", "project", "country", "regional", "national", "local", "site", "head", "pharmacovigilance", "investigational", "principal", "lead", "general", "associate", "assistant",
)
#: From so many keywords on, records and keywords are first joined by word.
PREFILTER_FROM = 200


def keyword_set(keywords: DataFrame, general: DataFrame) -> DataFrame:
    """(term, ord) of drugs with their aliases, then general terms; of equal terms the first stays."""
    drugs = keywords.select(F.explode(F.concat(F.array("drug_name"), F.split(F.coalesce("alias_names", F.lit("")), r"\|"))).alias("term"), F.lit(0).alias("ord"))
    rows = drugs.unionByName(general.select("term", F.lit(1).alias("ord"))).select(F.lower(F.trim("term")).alias("term"), "ord")
    return rows.where("term not in ('', '-', 'nan')").groupBy("term").agg(F.min("ord").alias("ord"))


def quoted(c: Column) -> Column:
    """A text as a literal pattern."""
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E"))


def whole_word(c: Column) -> Column:
    r"""Pattern for a keyword between word boundaries (\b), in any case."""
    return F.concat(F.lit(r"(?i)\b"), quoted(c), F.lit(r"\b"))


def between_alnum(c: Column) -> Column:
    """Pattern for a keyword that no ASCII letter or digit touches, in any case."""
    return F.concat(F.lit("(?i)(?<![A-Za-z0-9])"), quoted(c), F.lit("(?![A-Za-z0-9])"))


def folded(terms: list[str]) -> str:
    """A pattern for any of some texts, common beginnings written once."""
    groups: dict[str, list[str]] = {}
    for t in sorted(set(terms)):
        groups.setdefault(t[:1], []).append(t)
    parts = []
    for group in groups.values():
        head = os.path.commonprefix(group)
        rests = [t[len(head) :] for t in group]
        parts.append(re.escape(head) + (folded(rests) if any(rests) else ""))
    return "(?:" + "|".join(parts) + ")"


def any_term(terms: list[str], pattern) -> str:
    """One pattern, compiled once, for the texts in which ``pattern`` finds any of the terms."""
    firsts = "" if "" in terms else f"(?=[{''.join(re.escape(c) for c in sorted({t[0] for t in terms}))}])"  # few places pass this first
    if pattern is whole_word:
        return rf"(?i){firsts}\b{folded(terms)}\b"
    return rf"(?i){firsts}(?<![A-Za-z0-9]){folded(terms)}(?![A-Za-z0-9])"


def few_terms(keywords: DataFrame) -> list[str] | None:
    """The terms of a keyword table of at most PREFILTER_FROM rows, else None."""
    found = keywords.select("term").limit(PREFILTER_FROM + 1).collect()
    return [r[0] for r in found if r[0] is not None] if len(found) <= PREFILTER_FROM else None


def runs(c: Column) -> Column:
    """The runs of ASCII letters and digits of a text, in small letters, with repetitions and empty ones.

    Runs are cut before they are lowered: some other letters have ASCII ones as their small letters.
    """
    return F.transform(F.split(c, r"[^A-Za-z0-9]+"), lambda w: F.lower(w))


def first_run(c: Column) -> Column:
    """The first run of a keyword, null if it has none. No pattern here lets an ASCII letter or digit touch it, so it is a whole run in a text that has the keyword."""
    return F.try_element_at(F.filter(runs(c), lambda w: w != ""), F.lit(1))


def haystack(*columns: str) -> Column:
    return F.concat_ws(" | ", *columns)


def matches(rows: DataFrame, key: str, text: Column, keywords: DataFrame, pattern=whole_word) -> DataFrame:
    """Distinct (key, keyword columns…) where ``text`` has the keyword ``term``.

    Few keywords are compared with the rows that have any of them, which one pattern for all tells if ``pattern`` is
    ``whole_word`` or ``between_alnum``. Many are first joined by their first run of ASCII
    letters and digits with the runs of the rows, so only rows that have that run are searched; keywords that have
    none are compared with every row.
    """
    texts = rows.select(F.col(key), text.alias("_text"))
    terms = few_terms(keywords)
    if terms is not None:
        if pattern in (whole_word, between_alnum):
            texts = texts.where(F.rlike("_text", F.lit(any_term(terms, pattern))) if terms else F.lit(False))
        found = texts.join(F.broadcast(keywords), F.expr("true")).where(F.rlike(F.col("_text"), pattern(F.col("term"))))
        return found.drop("_text").distinct()
    lead = keywords.withColumn("_lead", first_run(F.col("term")))
    # Where keywords are too many to be broadcast, (row, run) pairs meet them without the texts, which follow by key.
    known, few = lead.where("_lead is not null"), lead.count() <= BROADCAST_ROWS
    words = texts.select(key, *(["_text"] if few else []), F.explode(F.array_distinct(runs(F.col("_text")))).alias("_lead"))
    found = words.join(F.broadcast(known) if few else known, "_lead")
    found = found if few else found.join(texts, key)
    loose = texts.join(small(lead.where("_lead is null")), F.expr("true")).select(key, "_text", *keywords.columns)
    found = found.select(key, "_text", *keywords.columns).unionByName(loose).where(F.rlike(F.col("_text"), pattern(F.col("term"))))
    return found.drop("_text").distinct()


def having_keyword(rows: DataFrame, key: str, text: Column, keywords: DataFrame) -> DataFrame:
    """The rows whose text has any keyword as a whole word; many keywords are first joined by word, as in ``matches``."""
    terms = few_terms(keywords.select("term").distinct())
    if terms is None:
        return rows.join(matches(rows, key, text, keywords.select("term").distinct()).select(key).distinct(), key, "left_semi")
    return rows.where(F.rlike(text, F.lit(any_term(terms, whole_word))) if terms else F.lit(False))


def tagged(rows: DataFrame, key: str, text: Column, terms: DataFrame, out: str = "tags") -> DataFrame:
    """(key, tags): canonical names whose terms the text has, in the order of ``ord``; rows (term, canonical, ord)."""
    found = matches(rows, key, text, terms, between_alnum)
    first = found.groupBy(key, "canonical").agg(F.min("ord").alias("_ord"))
    return first.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_ord", "canonical"))), lambda s: s["canonical"]), " | ").alias(out))


def is_person(name: Column) -> Column:
    """Whether a contact is a person's name: two words at least, no telephone number, no office."""
    n = F.trim(name)
    first = F.rtrim(F.lower(F.element_at(F.split(n, r"\s+"), 1)), F.lit(","))
    return F.coalesce((F.length(n) >= 4) & (F.size(F.split(n, r"\s+")) >= 2) & ~n.rlike(r"^\d") & ~first.isin(*NO_PERSON), F.lit(False))


def without_values(values: Column, blocked: list[str]) -> Column:
    """An array without the blocked values; null if nothing is left."""
    rest = F.array_except(values, F.array(*map(F.lit, blocked)).cast("array<string>"))
    return F.when(F.size(rest) > 0, rest)
