"""Column functions that clean and type the text fields of a record. Missing values are null inside the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def null_to_blank(c: Column) -> Column:
    """For sinks that know no null: null and NaN become empty text (a column of numbers becomes text)."""
    text = c.cast("string")
    return F.when(c.isNull() | (F.lower(text) == "nan"), F.lit("")).otherwise(text)


def to_bool(c: Column) -> Column:
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin("true", "yes", "1"), F.lit(True)).when(word.isin("false", "no", "0"), F.lit(False))


def text_to_int(c: Column) -> Column:
    """Text that is an integer, else null ("1.5" is none)."""
    word = F.trim(c)
    return F.when(word.rlike(r"^[+-]?\d+$"), word.try_cast("int"))


def number_to_int(c: Column) -> Column:
    """A number, cut to an integer."""
    return c.try_cast("int")


def date_pair(c: Column) -> Column:
    """``struct<date, precision>``: YYYY-MM-DD is a DAY, YYYY-MM the first of its MONTH, all else null. Dates that don't exist are null."""
    word = F.trim(c)
    day, month = word.rlike(r"^\d{4}-\d{2}-\d{2}$"), word.rlike(r"^\d{4}-\d{2}$")
    date = F.when(day, F.try_to_date(word, "yyyy-MM-dd")).when(month, F.try_to_date(F.concat(word, F.lit("-01")), "yyyy-MM-dd"))
    return F.struct(date.alias("date"), F.when(date.isNotNull(), F.when(day, F.lit("DAY")).otherwise(F.lit("MONTH"))).alias("precision"))


def min_age(c: Column) -> Column:
    """``struct<value, unit>`` of texts such as "18 Years"; the unit in upper case."""
    word = F.trim(c)
    fits = word.rlike(r"^\d+\s+[A-Za-z]+$")
    return F.struct(
        F.when(fits, F.regexp_extract(word, r"^(\d+)", 1).try_cast("int")).alias("value"),
        F.when(fits, F.upper(F.regexp_extract(word, r"([A-Za-z]+)$", 1))).alias("unit"),
    )


def phases(c: Column) -> Column:
    """An array of phases as one text: upper case, without blanks, joined by "_"."""
    return F.array_join(F.filter(F.transform(c, lambda p: F.upper(F.regexp_replace(p, r"\s+", ""))), lambda p: p != ""), "_")


def phases_of_text(c: Column) -> Column:
    return phases(F.split(F.coalesce(c, F.lit("")), ","))


# Legal forms at the end of a company's name.
LEGAL_FORMS = (
    r"Inc\.|Incorporated|LLC|L\.L\.C\.|Ltd\.|Limited|Corp\.|Corporation|Co\.,?\s*Ltd\.?|GmbH|S\.A\.|AG|PLC"
    r"|B\.V\.|N\.V\.|SE|S\.p\.A\.|K\.K\.|AB|AS|OY|SAS|SRL"
)


def strip_legal_form(c: Column, any_ending: bool = False) -> Column:
    """A name without legal forms at its end, up to three, blanks collapsed.

    A blank or comma must stand before the form. With ``any_ending`` it needn't, which also cuts words that
    merely end like one (Texas).
    """
    gap = r",?\s*" if any_ending else r"(?:,\s*|\s+)"
    for _ in range(3):
        c = F.regexp_replace(c, rf"(?i){gap}(?:{LEGAL_FORMS})\s*$", "")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normal_text(c: Column) -> Column:
    """Lower case, blanks collapsed."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def null_words(c: Column) -> Column:
    """Text that says that there is none, as null."""
    return F.when(~F.lower(F.trim(c)).isin("null", "none", "n/a", ""), c)


def sorted_tokens(c: Column) -> Column:
    """A text of values between bars: trimmed, upper case, distinct, sorted; null if none."""
    values = F.filter(F.transform(F.split(c, r"\|"), lambda v: F.upper(F.trim(v))), lambda v: v != "")
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(values)), "|"), F.lit(""))


def combo_names(c: Column) -> Column:
    """In values of parts joined by " + ", blanks inside a part become "_"."""
    value = lambda v: F.array_join(F.transform(F.split(v, r" \+ "), lambda p: F.replace(F.trim(p), F.lit(" "), F.lit("_"))), " + ")
    return F.array_join(F.transform(F.split(c, r"\|"), lambda v: F.when(v.contains(" + "), value(v)).otherwise(v)), "|")


def age_range(value: Column, unit: Column, standard: Column) -> Column:
    """">=18 Years | Adult" from an age and an array of age groups; null if neither is there."""
    least = F.when(value.isNotNull() & (unit != ""), F.concat(F.lit(">="), value.cast("string"), F.lit(" "), F.initcap(unit)))
    groups = F.filter(F.transform(F.coalesce(standard, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda s: s != "")
    parts = F.array_compact(F.array_distinct(F.concat(F.array(least), groups)))
    return F.nullif(F.array_join(parts, " | "), F.lit(""))


def joined_text(*columns: Column) -> Column:
    """Non-empty texts in order, a blank between them."""
    return F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in columns])


def labelled_sections(sections: dict[str, Column], each: int | None = None, whole: int | None = None) -> Column:
    """"[label] text" of non-empty sections; if asked for, each cut to ``each`` characters and all to ``whole``."""
    cut = lambda c, n: c if n is None else F.left(c, F.lit(n))
    parts = F.array_compact(F.array(*[F.when(c != "", F.concat(F.lit(f"[{label}] "), cut(c, each))) for label, c in sections.items()]))
    return cut(F.array_join(parts, "\n\n"), whole)


def bound(value: Column, said) -> Column:
    """``said(value)``, with ``value`` computed once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), said), F.lit(0))
