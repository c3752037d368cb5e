"""String operators as column expressions. All take NULL to NULL unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's split knows it, in a form that Java's and RE2's syntax share.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def collapse(text: Column) -> Column:
    """Single spaces, none at the ends."""
    return F.btrim(F.regexp_replace(text, SPACE + "+", " "))


def normalize(text: Column) -> Column:
    """Lower case, single spaces, plain dashes and quotes; NULL becomes empty."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "–—‘’“”", "--''\"\"")
    return collapse(plain)


def normalize_key(text: Column) -> Column:
    """Lower case and single spaces, as keys of deduplication are compared; NULL becomes empty."""
    return collapse(F.lower(F.coalesce(text, F.lit(""))))


def word_count(text: Column) -> Column:
    """Words between white space; NULL and blank count 0."""
    t = collapse(F.coalesce(text, F.lit("")))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "))) + 1)


# What is cut out of page texts, once white space is collapsed.
NOISE = [
    r"(?:Baca juga|Lihat juga|Simak juga):[^.]*", r"ADVERTISEMENT", r"SCROLL TO CONTINUE.*", r"Halaman \d+ dari \d+", r"Halaman Selanjutnya.*",
    r"\[Gambas:[^\]]*\]", r"Google News", r"Ikuti kami di.*", r"Follow @\w+", r"(?:Editor|Pewarta|Sumber):.*",
]


def clean(text: Column) -> Column:
    """Page text without known noise, with single spaces; several patterns reach to the text's end. NULL becomes empty."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ")
    for p in NOISE:
        t = F.regexp_replace(t, "(?i)" + p, "")
    return collapse(t)


def sql_clean(text: str) -> str:
    t = f"regexp_replace(COALESCE({text}, ''), '{SPACE}+', ' ', 'g')"
    for p in NOISE:
        t = f"regexp_replace({t}, '(?i){p}', '', 'g')"
    return f"trim(regexp_replace({t}, '{SPACE}+', ' ', 'g'))"


# Beginnings of lines that are cut up to the line's end.
AD_LINES = r"(?:baca juga|lihat juga|simak juga|advertisement|scroll to continue|ikuti kami)"


def clean_lines(text: Column) -> Column:
    """Text without advertising lines, with single line feeds. A last line without a line feed stays."""
    t = F.regexp_replace(text, "(?i)" + AD_LINES + r"[^\n]*\n", "\n")
    return F.btrim(F.regexp_replace(t, r"\n+", "\n"), F.lit(" \n\t\r"))


def clean_ocr(text: Column) -> Column:
    """Scanned text without stray marks, a frequent misreading mended, single spaces."""
    return collapse(F.replace(F.translate(text, "\\/*_[]{}|~^`", ""), F.lit("Bartai"), F.lit("Partai")))


def truncate_around(text: Column, word: str, limit: int = 1500, head: int = 800, around: int = 350, mark: str = "\n\n...\n\n") -> Column:
    """A text beyond the limit as its head and the surroundings of the first mention of a word after it, else its first limit characters."""
    at = F.instr(F.substring(F.lower(text), head + 1, 1 << 30), word)
    start = F.greatest(F.lit(0), at - 1 - around)
    stop = F.least(F.length(text) - head, at - 1 + around)
    part = F.substring(text, head + start + 1, stop - start)
    return F.when(F.length(text) <= limit, text).when(at > 0, F.concat(F.substring(text, 1, head), F.lit(mark), part)).otherwise(F.substring(text, 1, limit))


def densest_paragraphs(text: Column, score, limit: int = 1500, best: int = 3, least: int = 50) -> Column:
    """The paragraphs of the highest score(paragraph, index) in their own order; ties go to the earlier one.

    Paragraphs of up to `least` characters are left out; texts up to the limit, or without paragraphs, stay whole up to it.
    """
    paragraphs = F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda p: F.btrim(p)), lambda p: F.length(p) > least)
    scored = F.transform(paragraphs, lambda p, i: F.struct((-score(p, i)).alias("s"), i.alias("i"), p.alias("p")))
    top = F.array_sort(F.transform(F.slice(F.array_sort(scored), 1, best), lambda x: F.struct(x["i"], x["p"])))
    joined = F.array_join(F.transform(top, lambda x: x["p"]), "\n\n")
    cut = F.when(F.length(joined) > limit, F.concat(F.substring(joined, 1, limit), F.lit("..."))).otherwise(joined)
    return F.when(F.length(text) <= limit, text).when(F.size(paragraphs) == 0, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(cut)


def summary(text: Column, limit: int = 200) -> Column:
    """The first sentence of more than 15 characters, and the second if both fit; cut at a word with dots."""
    t = F.btrim(text, F.lit(" \n\t\r"))
    s = F.filter(F.transform(F.split(t, r"(?<=[.!?])\s+"), lambda x: F.btrim(x)), lambda x: F.length(x) > 15)
    first, second = F.get(s, F.lit(0)), F.get(s, F.lit(1))
    out = F.when(second.isNotNull() & (F.length(first) + F.length(second) + 2 <= limit), F.concat(first, F.lit(" "), second)).otherwise(F.coalesce(first, t))
    cut = F.concat(F.regexp_replace(F.substring(out, 1, limit), r" [^ ]*$", ""), F.lit("..."))
    return F.when(text.isNull() | (F.length(t) < 10), "").when(F.length(out) > limit, cut).otherwise(out)


def snippet(text: Column, start: Column, stop: Column, around: int = 80) -> Column:
    """Text around a span [start, stop), with dots where it is cut."""
    a, b = F.greatest(F.lit(0), start - around), F.least(F.length(text), stop + around)
    return F.concat(F.when(a > 0, "...").otherwise(""), F.btrim(F.substring(text, a + 1, b - a)), F.when(b < F.length(text), "...").otherwise(""))


def flags(text: Column, sets: dict[str, list[str]], none: str) -> Column:
    """Names of the sets of which any pattern matches, in the sets' order, joined by ', '; `none` where there is none."""
    found = [F.when(text.rlike("(?:" + "|".join(v) + ")"), F.lit(k)) for k, v in sets.items()]
    return F.coalesce(F.nullif(F.concat_ws(", ", *found), F.lit("")), F.lit(none))


def highest_amount(text: Column) -> Column:
    """The greatest amount of rupiah in a text, 0 if there is none.

    Misread digits are mended (s for 5, b for 8, o for 0); long digit strings that begin with 0 are phone or account
    numbers; amounts of 10^13 and more are no amounts.
    """
    t = F.lower(text)
    t = F.regexp_replace(t, r"(?<=\d)s(?=[.,\d]|$)", "5")
    t = F.regexp_replace(t, r"(?<=\d)b(?=[.,\d]|$)", "8")
    t = F.regexp_replace(t, r"(?<=\d)o+|o+(?=\d)", "0")
    t = F.replace(F.replace(t, F.lit(",="), F.lit("")), F.lit("-,"), F.lit("."))
    digits = F.transform(F.regexp_extract_all(t, F.lit(r"\b(?:rp|pp|bp|idr)[.\-\s]*(\d+(?:[.,]\d+)*)"), 1), lambda x: F.regexp_replace(x, r"\D", ""))
    plain = F.transform(F.filter(digits, lambda x: ~(x.startswith("0") & (F.length(x) > 8))), lambda x: x.try_cast("decimal(38,0)"))
    told = F.regexp_extract_all(t, F.lit(r"([0-9]+(?:[.,][0-9]+)?\s?(?:ribu|rb|juta|jt|miliar|milyar|triliun))\b"), 1)

    def value(x):
        n = F.replace(F.regexp_extract(x, r"^([0-9.,]+)", 1), F.lit(","), F.lit(".")).try_cast("double")
        unit = F.regexp_extract(x, r"([a-z]+)$", 1)
        scale = F.when(unit.isin("ribu", "rb"), 1e3).when(unit.isin("juta", "jt"), 1e6).when(unit == "triliun", 1e12).otherwise(1e9)
        return F.floor(n * scale).cast("decimal(38,0)")

    every = F.filter(F.concat(plain, F.transform(told, value)), lambda x: x < F.lit(10**13))
    return F.coalesce(F.array_max(every).cast("bigint"), F.lit(0).cast("bigint"))
