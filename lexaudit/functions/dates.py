"""Wall-clock dates as the pages write them (offsets are dropped, not converted; see operators.timestamps for instants)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexaudit.lexicon import let

# Indonesian months, of which the first that occurs in a text is put into English.
MONTHS = {
    "januari": "January", "februari": "February", "maret": "March", "april": "April", "mei": "May", "juni": "June",
    "juli": "July", "agustus": "August", "september": "September", "oktober": "October", "november": "November", "desember": "December",
}
# Notations, in the order in which they are tried, after a zone or offset at the end is cut off.
FORMATS = [
    "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d", "d/M/yyyy H:m:s", "d/M/yyyy H:m", "d/M/yyyy",
    "d MMMM yyyy H:m", "d MMMM yyyy", "d MMM yyyy H:m", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy",
]


def _english(text: Column) -> Column:
    def first(t: Column) -> Column:
        out = F.when(F.lit(False), t)
        for name, english in MONTHS.items():
            out = out.when(F.lower(t).contains(name), F.regexp_replace(t, f"(?i){name}", english))
        return out.otherwise(t)

    return let(F.btrim(text), first)


def _cleaned(text: Column) -> Column:
    t = F.regexp_replace(_english(text), r"(?i)^(?:Senin|Selasa|Rabu|Kamis|Jumat|Sabtu|Minggu),?\s*", "")
    t = F.btrim(F.regexp_replace(t, r"(?i)\s*(?:WIB|WITA|WIT)\s*$", ""))
    return F.regexp_replace(t, r"(T\d{1,2}:\d{2}:\d{2})(?:\.\d{1,6})?(?:Z|[+-]\d{2}:?\d{2})?$", "$1")


def wall_time(text: Column) -> Column:
    """The wall time of a text in one of the notations, as a timestamp without zone; NULL for others."""
    return let(_cleaned(text), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in FORMATS]))


def iso_text(text: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss of a text in a known notation, else the first yyyy-MM-dd in it, else the trimmed text; NULL is empty."""
    t = F.coalesce(F.btrim(text), F.lit(""))
    return F.coalesce(F.date_format(wall_time(t), "yyyy-MM-dd HH:mm:ss"), F.nullif(F.regexp_extract(t, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), t)


def recency(at: Column, as_of: Column) -> Column:
    """1.0 within a day, falling by tiers to 0.1; 0.8 for the future, 0.3 for NULL."""
    days = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / 86_400_000_000)
    tiers = F.when(at.isNull(), 0.3).when(days < 0, 0.8)
    for most, value in ((1, 1.0), (3, 0.9), (7, 0.8), (14, 0.6), (30, 0.4), (90, 0.2)):
        tiers = tiers.when(days <= most, value)
    return tiers.otherwise(0.1)


def post_date(text: Column, none: str = "Tanggal Tidak Tersedia") -> Column:
    """yyyy-MM-dd of an English 'Month d, yyyy' or an Indonesian 'd month yyyy' in a text, else `none`."""
    t = F.lower(text)
    months = F.create_map(*[F.lit(x) for i, (a, b) in enumerate(MONTHS.items(), 1) for n in sorted({a, b.lower()}) for x in (n, f"{i:02d}")])
    names = "|".join(sorted({n for a, b in MONTHS.items() for n in (a, b.lower())}))
    en, ind = rf"({names}) (\d{{1,2}}), (\d{{4}})", rf"(\d{{1,2}}) ({names}) (\d{{4}})"

    def made(p, m, d):
        return F.when(t.rlike(p), F.concat_ws("-", F.regexp_extract(t, p, 3), F.try_element_at(months, F.regexp_extract(t, p, m)), F.lpad(F.regexp_extract(t, p, d), 2, "0")))

    return F.coalesce(made(en, 1, 2), made(ind, 2, 1), F.lit(none))


def monthly_periods(year: int) -> str:
    """The twelve yyyymm of a year, comma-joined."""
    return ",".join(f"{year}{m:02d}" for m in range(1, 13))
