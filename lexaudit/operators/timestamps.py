"""Free-text timestamps to one instant (problem 6).

Every notation is reduced to a wall time and, where the text names one, an offset; a value without offset takes the
zone of its source. Where a source declares no zone, its zone is estimated: each candidate's offset history turns the
source's wall times into instants, and the candidate with the fewest violations (instants after the record's ingestion,
or away from the instant another record of the same item states with an offset) is chosen.
Only built-in expressions are used, on UTC micros, so the session's time zone has no influence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaudit.session import barrier, source_key

# Month names and short forms, Indonesian and English.
MONTHS = {
    "januari": 1, "january": 1, "jan": 1, "februari": 2, "february": 2, "feb": 2, "pebruari": 2,
    "maret": 3, "march": 3, "mar": 3, "april": 4, "apr": 4, "mei": 5, "may": 5,
    "juni": 6, "june": 6, "jun": 6, "juli": 7, "july": 7, "jul": 7, "agustus": 8, "august": 8, "agu": 8, "agt": 8, "ags": 8, "aug": 8,
    "september": 9, "sept": 9, "sep": 9, "oktober": 10, "october": 10, "okt": 10, "oct": 10,
    "november": 11, "nopember": 11, "nov": 11, "nop": 11, "desember": 12, "december": 12, "des": 12, "dec": 12,
}

# Weekday names, Indonesian and English, with short forms.
WEEKDAYS = (
    "senin selasa rabu kamis jumat jum'at sabtu minggu ahad sen sel rab kam jum sab min "
    "monday tuesday wednesday thursday friday saturday sunday mon tue tues wed thu thur thurs fri sat sun"
).split()

# Seconds east of UTC of the abbreviations in use in the zones of `sources`.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wib": 7 * 3600, "wita": 8 * 3600, "wit": 9 * 3600, "ist": 19800, "cet": 3600, "cest": 7200,
    "est": -5 * 3600, "edt": -4 * 3600, "aest": 10 * 3600, "aedt": 11 * 3600,
}

#: Separates the parts of the canonical form year, month, day, hour, minute, second, a or p, zone.
_SEP = "\u0001"
_TIME = r"(?:(?:\s*[,|-]\s*|\s*t|\s+)(?:(?:pukul|jam|at)\s+)?(\d{1,2})[:.]?(\d{2})(?:[:.]?(\d{2})(?:[.,]\d+)?)?(?:\s*([ap])\.?m\.?)?)?"
_ZONE = r"\s*\(?([a-z]+|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?)?\)?$"
_FORMS = (
    # date pattern, places of year, month and day in it
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)", (1, 2, 3)),
    (r"^(\d{4})(\d{2})(\d{2})(?=$|[t\s+z-])", (1, 2, 3)),
    (r"^\(?(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?!\d)\)?", (3, 2, 1)),
    (r"^(\d{1,2})[\s-]+([a-z]+)\.?[\s,-]+(\d{4})(?!\d)", (3, 2, 1)),
    (r"^([a-z]+)\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?!\d)", (3, 1, 2)),
)


def parse_timestamps(df: DataFrame, text: str) -> DataFrame:
    """Adds ts_local (wall time as seconds since 1970 as if UTC), ts_offset (seconds east of UTC, NULL if the text
    names none) and ts_has_time.

    ts_local is NULL where the text is NULL, names no full calendar day, an impossible date or time, or a zone that is
    not known. Digits alone of length 10 or 13 are seconds or milliseconds since 1970. In all-numeric dates that do not
    begin with the year the day comes first; two-digit years are 20xx; fractions of seconds are cut off.
    """
    clean = F.btrim(F.regexp_replace(F.lower(F.col(text)), r"[\s\p{Z}\p{Cc}]+", " "))
    clean = F.regexp_replace(clean, rf"^(?:{'|'.join(sorted(WEEKDAYS, key=len, reverse=True))})\.?(?:\s*,\s*|\s+(?=[\d(]))", "")
    # every notation is rewritten to one canonical form; texts of no notation stay as they are
    form = clean
    for pattern, places in _FORMS:
        form = F.regexp_replace(form, pattern + _TIME + _ZONE, _SEP.join(f"${g}" for g in (*places, 4, 5, 6, 7, 8)))
    d = barrier(df.withColumn("_c", form).withColumn("_p", F.split("_c", _SEP)), "_c", "_p")
    d = d.withColumn("_p", F.when(F.size("_p") == 8, F.col("_p")))
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    zones = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])

    def part(i: int) -> Column:
        return F.nullif(F.get("_p", F.lit(i)), F.lit(""))

    d = d.withColumns({
        "_y": part(0).try_cast("int"), "_yl": F.length(part(0)), "_mt": part(1), "_d": part(2).try_cast("int"), "_h": part(3).try_cast("int"),
        "_n": part(4).try_cast("int"), "_s": part(5).try_cast("int"), "_ap": part(6), "_z": F.regexp_replace(part(7), r"^(?:utc|gmt)(?=[+-])", ""),
    })
    d = d.withColumns({
        "_y": F.when(F.col("_yl") == 2, F.col("_y") + 2000).otherwise(F.col("_y")),
        "_m": F.coalesce(F.col("_mt").try_cast("int"), F.try_element_at(months, F.col("_mt"))),
        "_t": F.col("_h").isNotNull(),
        "_h": F.when(F.col("_ap").isNull(), F.coalesce("_h", F.lit(0))).when(F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_ap") == "p", 12).otherwise(0)).otherwise(-1),
        "_n": F.coalesce("_n", F.lit(0)), "_s": F.coalesce("_s", F.lit(0)),
        # +7, +07, +0700 and +07:00
        "_zn": F.regexp_replace(F.regexp_replace("_z", r"^([+-])(\d)(?=$|:|\d{2}$)", "$10$2"), r"^([+-]\d{2})$", "$100"),
    })
    d = barrier(d.withColumn("_zn", F.regexp_replace("_zn", ":", "")), "_y", "_m", "_d", "_t", "_h", "_n", "_s", "_z", "_zn")
    offset = F.when(F.col("_zn").rlike(r"^[+-]\d{4}$"), F.when(F.substring("_zn", 1, 1) == "-", -1).otherwise(1) * (F.substring("_zn", 2, 2).try_cast("int") * 3600 + F.substring("_zn", 4, 2).try_cast("int") * 60)).otherwise(F.try_element_at(zones, F.col("_z")))
    leap = (F.col("_y") % 4 == 0) & ((F.col("_y") % 100 != 0) | (F.col("_y") % 400 == 0))
    last = F.when(F.col("_m") == 2, F.when(leap, 29).otherwise(28)).when(F.col("_m").isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (
        F.col("_y").between(1, 9999) & F.col("_m").between(1, 12) & F.col("_d").between(1, last)
        & F.col("_h").between(0, 23) & F.col("_n").between(0, 59) & F.col("_s").between(0, 59)
    )
    d = d.withColumns({
        "_o": offset, "_v": valid,
        "_e": F.when(F.col("_c").rlike(r"^\d{13}$"), F.floor(F.col("_c").try_cast("bigint") / 1000).cast("bigint")).when(F.col("_c").rlike(r"^\d{10}$"), F.col("_c").try_cast("bigint")),
    })
    usable = F.col("_v") & (F.col("_z").isNull() | F.col("_o").isNotNull())
    wall = F.when(usable, F.unix_date(F.make_date("_y", "_m", "_d")).cast("bigint") * 86400 + F.col("_h") * 3600 + F.col("_n") * 60 + F.col("_s"))
    d = d.withColumns({
        "ts_local": F.coalesce("_e", wall),
        "ts_offset": F.when(F.col("_e").isNotNull(), 0).when(usable, F.col("_o")),
        "ts_has_time": F.col("_e").isNotNull() | F.coalesce("_t", F.lit(False)),
    })
    return barrier(d.drop(*[c for c in d.columns if c.startswith("_") and c not in df.columns]), "ts_local", "ts_offset", "ts_has_time")


def local_to_utc(local: Column, zone: Column) -> Column:
    """Seconds since 1970 UTC of a wall time in a named zone.

    A wall time that occurs twice means the first; one that a clock change skips gives NULL, as does a NULL zone.
    """
    wall = F.timestamp_seconds(local)
    utc = F.to_utc_timestamp(wall, zone)
    return F.when(F.from_utc_timestamp(utc, zone) == wall, F.unix_seconds(utc))


def estimate_zones(values: DataFrame, candidates: list[str], slack_s: int = 300) -> DataFrame:
    """The zone of each source that violates least: source_key, zone, violations, n_values.

    values: source_key, ts_local, and the evidence: ingested (seconds UTC by which the record existed) and stated
    (seconds UTC that another record of the same item names with an offset), either NULL where unknown. A violation is
    an instant later than ingested, or more than slack_s away from stated, or a wall time the candidate skips. On a tie
    the candidate listed first wins; where all of several candidates tie, nothing speaks for any, and zone is NULL. Counts are partial-aggregated per source and candidate before the shuffle.
    """
    if not candidates:
        raise ValueError("no candidate zones")
    rank = F.posexplode(F.array(*[F.lit(c) for c in candidates])).alias("rank", "zone")
    tried = values.where("source_key IS NOT NULL AND ts_local IS NOT NULL").select("source_key", "ts_local", "ingested", "stated", rank)
    at = local_to_utc(F.col("ts_local"), F.col("zone"))
    bad = at.isNull() | F.coalesce(at > F.col("ingested") + slack_s, F.lit(False)) | F.coalesce(F.abs(at - F.col("stated")) > slack_s, F.lit(False))
    counts = tried.groupBy("source_key", "zone", "rank").agg(F.sum(bad.cast("bigint")).alias("violations"), F.count("*").alias("n_values"))
    return (
        counts.groupBy("source_key")
        .agg(F.min_by(F.struct("zone", "violations", "n_values"), F.struct("violations", "rank")).alias("b"), F.max("violations").alias("_most"))
        .select("source_key", F.when((F.col("_most") > F.col("b.violations")) | F.lit(len(candidates) == 1), F.col("b.zone")).alias("zone"), "b.violations", "b.n_values")
    )


def declared_zones(sources: DataFrame) -> DataFrame:
    """source_key, zone of the sources that declare one; of several the first by name."""
    return (
        sources.select(source_key("source").alias("source_key"), F.nullif(F.btrim("tz_name"), F.lit("")).alias("zone"))
        .where("source_key IS NOT NULL AND zone IS NOT NULL")
        .groupBy("source_key")
        .agg(F.min("zone").alias("zone"))
    )


def normalize_timestamps(records: DataFrame, text: str, zones: DataFrame) -> DataFrame:
    """Adds utc_epoch to records that have a source_key: offset in the text first, else the zone of the source.

    NULL where the text names no instant, or it has no offset and the source no zone.
    """
    d = parse_timestamps(records, text).join(zones.select("source_key", F.col("zone").alias("_zone")), "source_key", "left")
    utc = F.when(F.col("ts_offset").isNotNull(), F.col("ts_local") - F.col("ts_offset")).otherwise(local_to_utc(F.col("ts_local"), F.col("_zone")))
    return d.withColumn("utc_epoch", utc.cast("bigint")).drop("_zone", "ts_local", "ts_offset", "ts_has_time")


def dated_records(articles: DataFrame, scored: DataFrame) -> DataFrame:
    """tbl, record_id, item_id, source_key, text, ingested of both tables; rows without an id are left out."""
    a = articles.select(F.lit("articles").alias("tbl"), F.col("article_id").alias("record_id"), F.col("article_id").alias("item_id"), source_key("source").alias("source_key"), F.col("published_date").alias("text"), F.unix_seconds(F.col("crawled_at").cast("timestamp")).alias("ingested"))
    s = scored.select(F.lit("scored_articles").alias("tbl"), F.col("scored_id").alias("record_id"), F.col("article_id").alias("item_id"), source_key("source").alias("source_key"), F.col("published_date").alias("text"), F.unix_seconds(F.col("scored_at").cast("timestamp")).alias("ingested"))
    return a.unionByName(s).where("record_id IS NOT NULL")


def zone_evidence(records: DataFrame) -> DataFrame:
    """Zone-less values with a time of day, each with the instants that bound it (see estimate_zones).

    stated comes from a record of the same item whose text has an offset; the least if several differ.
    """
    d = parse_timestamps(records, "text")
    stated = d.where("ts_offset IS NOT NULL AND ts_has_time AND item_id IS NOT NULL").groupBy("item_id").agg(F.min(F.col("ts_local") - F.col("ts_offset")).alias("stated"))
    return d.where("ts_offset IS NULL AND ts_has_time").select("item_id", "source_key", "ts_local", "ingested").join(stated, "item_id", "left")


def normalized_records(articles: DataFrame, scored: DataFrame, sources: DataFrame, candidates: list[str]) -> DataFrame:
    """tbl, record_id, utc_epoch of every record whose text names an instant; each record once.

    Sources that declare no zone get the estimated one of estimate_zones(). If copies of a record differ, the earliest
    instant holds. Empty tables give an empty result.
    """
    records = dated_records(articles, scored)
    declared = declared_zones(sources)
    undeclared = records.join(declared, "source_key", "left_anti").where("source_key IS NOT NULL")
    zones = declared.unionByName(estimate_zones(zone_evidence(undeclared), candidates).select("source_key", "zone"))
    return (
        normalize_timestamps(records, "text", zones)
        .where("utc_epoch IS NOT NULL")
        .groupBy("tbl", "record_id")
        .agg(F.min("utc_epoch").alias("utc_epoch"))
    )
