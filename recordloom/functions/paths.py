"""Column functions over the paths and values of a document's fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named character references that are decoded, "&amp;" last.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&deg;": "°", "&plusmn;": "±", "&micro;": "µ", "&le;": "≤", "&ge;": "≥", "&reg;": "®", "&trade;": "™", "&copy;": "©"}


def decode_references(c: Column) -> Column:
    """Named (see REFERENCES) and decimal or hexadecimal character references as characters."""
    for name, char in REFERENCES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    number = lambda m: F.char(F.coalesce(F.conv(F.regexp_extract(m, r"^&#[xX]([0-9A-Fa-f]+);$", 1), 16, 10).try_cast("int"), F.regexp_extract(m, r"^&#(\d+);$", 1).try_cast("int")))
    pieces = F.split(c, r"&#(?:\d+|[xX][0-9A-Fa-f]+);")
    marks = F.regexp_extract_all(c, F.lit(r"(&#(?:\d+|[xX][0-9A-Fa-f]+);)"), 1)
    woven = F.array_join(F.zip_with(pieces, marks, lambda p, m: F.concat(p, F.coalesce(number(m), m, F.lit("")))), "")
    return F.replace(F.when(c.rlike(r"&#(\d|[xX])"), woven).otherwise(c), F.lit("&amp;"), F.lit("&"))


def title_words(c: Column) -> Column:
    """Every run of letters with a capital first and small letters after, whatever stands between."""
    letters, gaps = F.regexp_extract_all(c, F.lit(r"([A-Za-z]+)"), 1), F.split(c, r"[A-Za-z]+")
    return F.array_join(F.zip_with(gaps, letters, lambda g, w: F.concat(g, F.coalesce(F.initcap(w), F.lit("")))), "")


def readable(path: Column) -> Column:
    """``primaryOutcomes[0].timeFrame`` as "Primary Outcomes #1 - Time Frame"."""
    bare = F.regexp_replace(path, r"^\w+Module\.", "")
    gaps, places = F.split(bare, r"\[\d+\]"), F.regexp_extract_all(bare, F.lit(r"\[(\d+)\]"), 1)
    counted = F.array_join(F.zip_with(gaps, places, lambda g, i: F.concat(g, F.coalesce(F.concat(F.lit(" #"), (i.cast("int") + 1).cast("string")), F.lit("")))), "")
    words = F.replace(counted, F.lit("."), F.lit(" - "))
    words = F.regexp_replace(F.regexp_replace(words, r"([a-z])([A-Z])", "$1 $2"), r"([A-Z]+)([A-Z][a-z])", "$1 $2")
    return title_words(F.trim(words))


def natural_key(path: Column) -> Column:
    """A sort key by which embedded numbers of any length count as numbers: x[2] before x[10]."""
    pieces = F.regexp_extract_all(F.lower(path), F.lit(r"(\d+|\D+)"), 1)

    def number(digits: Column) -> Column:
        """The count of digits, then the digits: longer numbers are greater."""
        bare = F.ltrim(digits, F.lit("0"))
        return F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)

    return F.transform(pieces, lambda p: F.when(p.rlike(r"^\d"), number(p)).otherwise(p))


def change_label(old: Column, new: Column) -> Column:
    """"Added: …", "Removed: …" or "Old: …  |  New: …"."""
    o, n = decode_references(old), decode_references(new)
    return F.when(old.isNull(), F.concat(F.lit("Added: "), n)).when(new.isNull(), F.concat(F.lit("Removed: "), o)).otherwise(F.concat(F.lit("Old: "), o, F.lit("  |  New: "), n))
