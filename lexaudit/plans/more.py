"""Further queries: search strings, the modular preflight, verdict filters, lookups, reports and checkpoints."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexaudit import lexicon
from lexaudit.registry import query
from lexaudit.session import source_key, table

SQ = lexicon.sql_text

# The search for one site, before its dates.
SEARCH = 'site:{} "Kota Bandung" (PHK OR "lowongan kerja" OR "job fair" OR "pabrik tutup" OR UMK OR buruh OR pengangguran OR "tenaga kerja" OR "padat karya")'
HEAD, TAIL = SEARCH.split("{}")


@query("search_strings", f"SELECT source, replace(url_encode({SQ(HEAD)} || source || {SQ(TAIL + ' after:2025-11-01 before:2025-11-08')}), '%2F', '/') AS q FROM sources")
def search_strings(spark, d):
    """The encoded search string of each site, with the span of days as predicates for the provider."""
    q = F.url_encode(F.concat(F.lit(HEAD), "source", F.lit(TAIL + " after:2025-11-01 before:2025-11-08")))
    return table(spark, d, "sources").select("source", F.replace(F.replace(q, F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")).alias("q"))


# Further topic patterns of the modular preflight.
TOPIC_MORE = [
    r"\bloker", r"\bbursa kerja", r"\brekrutmen", r"\bjob[\s\-]?fair", r"\blowongan", r"\bphk", r"\bpemutusan hubungan kerja", r"\bdirumahkan", r"\bpengangguran",
    r"\bgaji", r"\bupah", r"\bhonorer", r"\bpegawai", r"\bdikontrak", r"\bumk", r"\bumr", r"\bserikat pekerja", r"\bbpjs ketenagakerjaan", r"\bdisnaker", r"\btka", r"\bpkwt", r"\bmagang",
]


def flexible(patterns: list[str]) -> str:
    """One alternation of patterns in which a space may also be a hyphen or nothing. Capitals stay capitals."""
    return "(?:" + "|".join(p.replace(" ", r"[\s\-]?") for p in patterns) + ")"


PRIMARY, SECONDARY = flexible(lexicon.SETS["topic_primary"] + TOPIC_MORE), flexible(lexicon.SETS["topic_secondary"])
S_ENDS = " OR ".join(f"ends_with(u, '{e}')" for e in lexicon.EXTENSIONS)


@query("preflight_modular", f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN {S_ENDS} THEN 'document' WHEN (CASE WHEN regexp_matches(t, {SQ(PRIMARY)}) THEN 20 ELSE 0 END) + (CASE WHEN regexp_matches(t, {SQ(SECONDARY)}) THEN 10 ELSE 0 END) < 10 THEN 'low score' ELSE 'pass' END AS reason FROM (SELECT lower(COALESCE(url, '')) AS u, lower(COALESCE(title, '')) || ' ' || lower(COALESCE(url, '')) AS t FROM articles)) GROUP BY reason")
def preflight_modular(spark, d):
    """The modular job's preflight. Its title words are patterns compared as plain text, so that no title has one."""
    u, ti = F.lower(F.coalesce("url", F.lit(""))), F.lower(F.coalesce("title", F.lit("")))
    a = table(spark, d, "articles").select(u.alias("u"), F.concat_ws(" ", ti, u).alias("t"))
    ends = a.u.rlike("(?:" + "|".join(map(re.escape, lexicon.EXTENSIONS)) + ")$")
    score = F.when(a.t.rlike(PRIMARY), 20).otherwise(0) + F.when(a.t.rlike(SECONDARY), 10).otherwise(0)
    return a.groupBy(F.when(ends, "document").when(score < 10, "low score").otherwise("pass").alias("reason")).agg(F.count("*").alias("n"))


# Phrases of verdicts that are refused by the trade job (any case) and by the non-profit job (as they stand).
TRADE_REFUSED = ["diluar yuridiksi", "konteks tidak relevan", "out of jurisdiction", "error", "irrelevant", "luar yuridiksi", "tidak relevan"]
NONPROFIT_REFUSED = ["Out of Jurisdiction", "Irrelevant Context"]


@query("verdict_filters", "SELECT " + ", ".join(f"count(*) FILTER (WHERE NOT ({' OR '.join(f'contains({c}, {SQ(p)})' for p in ps)})) AS {n}" for n, c, ps in (("trade", "lower(COALESCE(text, ''))", TRADE_REFUSED), ("nonprofit", "COALESCE(text, '')", NONPROFIT_REFUSED))) + " FROM documents")
def verdict_filters(spark, d):
    """How many answers each job's filter lets pass; answers are whole texts here."""
    from lexaudit.operators import verdict

    t = F.coalesce("text", F.lit(""))
    passed = [F.count_if(verdict.passes(t, ps, ignore_case=i)).alias(n) for n, ps, i in (("trade", TRADE_REFUSED, True), ("nonprofit", NONPROFIT_REFUSED, False))]
    return table(spark, d, "documents").agg(*passed)


@query("keyword_pages", "SELECT doc_id FROM documents WHERE contains(lower(text), 'ekspor') OR contains(lower(text), 'tenaga kerja') OR contains(lower(text), 'pesangon')")
def keyword_pages(spark, d):
    t = F.lower("text")
    return table(spark, d, "documents").where(t.contains("ekspor") | t.contains("tenaga kerja") | t.contains("pesangon")).select("doc_id")


@query("code_equality", "SELECT c_custkey FROM customer WHERE CAST(c_nationkey AS VARCHAR) = '7'")
def code_equality(spark, d):
    return table(spark, d, "customer").where(F.col("c_nationkey").cast("string") == "7").select("c_custkey")


@query("empty_columns", "SELECT 'url' AS c, count(url) = 0 AS empty FROM articles UNION ALL SELECT 'author', count(author) = 0 FROM articles UNION ALL SELECT 'nothing', true")
def empty_columns(spark, d):
    """Which columns hold only NULL; one such column stands beside two of the table."""
    a = table(spark, d, "articles").select("url", "author", F.lit(None).cast("string").alias("nothing"))
    counts = a.agg(*[(F.count(c) == 0).alias(c) for c in a.columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("empty")) for c in a.columns])))


@query("sentinel_guards", "SELECT count(*) AS n FROM articles WHERE url IS NULL OR url IN ('TIDAK DITEMUKAN', '-', '')")
def sentinel_guards(spark, d):
    return table(spark, d, "articles").where(F.col("url").isNull() | F.col("url").isin("TIDAK DITEMUKAN", "-", "")).agg(F.count("*").alias("n"))


# Hosts of adverts and trackers.
ADVERTS = ["doubleclick.net", "googlesyndication.com", "ads-twitter.com", "gliastudios.com", "seedtag.com"]


@query("advert_hosts", f"SELECT count(*) FILTER (WHERE {' OR '.join(f'contains(lower(url), {SQ(h)})' for h in ADVERTS)}) AS blocked, count(*) AS n FROM feed_entries")
def advert_hosts(spark, d):
    hit = F.lower("url").rlike("(?:" + "|".join(map(re.escape, ADVERTS)) + ")")
    return table(spark, d, "feed_entries").agg(F.count_if(hit).alias("blocked"), F.count("*").alias("n"))


@query("lookup_first", "SELECT a.article_id, s.scored_id FROM articles a JOIN (SELECT article_id, min(scored_id) AS scored_id FROM scored_articles GROUP BY article_id) s USING (article_id)")
def lookup_first(spark, d):
    """Each article with the first of its scorings; the lookup side keeps one row a key before the join."""
    first = table(spark, d, "scored_articles").groupBy("article_id").agg(F.min("scored_id").alias("scored_id"))
    return table(spark, d, "articles").select("article_id").join(first, "article_id")


@query("lookup_fallback", "SELECT a.article_id, COALESCE(NULLIF(s.d, ''), NULLIF(a.published_date, ''), 'Tanggal Tidak Tersedia') AS day FROM articles a LEFT JOIN (SELECT article_id, min(published_date) AS d FROM scored_articles GROUP BY article_id) s USING (article_id)")
def lookup_fallback(spark, d):
    """A date from the lookup, else the row's own, else a stated text; an empty one counts as none."""
    known = table(spark, d, "scored_articles").groupBy("article_id").agg(F.min("published_date").alias("d"))
    a = table(spark, d, "articles").select("article_id", "published_date").join(known, "article_id", "left")
    return a.select("article_id", F.coalesce(F.nullif("d", F.lit("")), F.nullif("published_date", F.lit("")), F.lit("Tanggal Tidak Tersedia")).alias("day"))


@query("sites_in_order", "SELECT s AS source_key, count(*) AS n, min(article_id) AS first_id FROM (SELECT lower(trim(source)) AS s, article_id FROM articles WHERE trim(source) <> '') GROUP BY s")
def sites_in_order(spark, d):
    """Rows by site, with the place at which the site was first seen; combined in every task before the shuffle."""
    a = table(spark, d, "articles").select(source_key("source").alias("source_key"), "article_id").where("source_key IS NOT NULL")
    return a.groupBy("source_key").agg(F.count("*").alias("n"), F.min("article_id").alias("first_id"))


@query("stage_statistics", "SELECT batch_no, count(*) FILTER (WHERE parse_success) || '/' || count(*) AS success_rate, printf('%.1f%%', 100.0 * count(*) FILTER (WHERE parse_success) / count(*)) AS hit_rate FROM articles GROUP BY batch_no")
def stage_statistics(spark, d):
    good, every = F.count_if("parse_success"), F.count("*")
    return table(spark, d, "articles").groupBy("batch_no").agg(F.concat(good.cast("string"), F.lit("/"), every.cast("string")).alias("success_rate"), F.format_string("%.1f%%", 100.0 * good / every).alias("hit_rate"))


@query("date_text_order", "SELECT article_id, row_number() OVER (ORDER BY published_date DESC NULLS LAST, article_id) AS place FROM articles QUALIFY place <= 50")
def date_text_order(spark, d):
    """The first 50 by the date as it is written, downwards; the order is that of the text."""
    top = table(spark, d, "articles").select("article_id", "published_date").orderBy(F.desc_nulls_last("published_date"), "article_id").limit(50)
    w = Window.orderBy(F.desc_nulls_last("published_date"), "article_id")  # over 50 rows
    return top.select("article_id", F.row_number().over(w).cast("bigint").alias("place"))


@query("union_of_keys", "SELECT article_id AS id, title, NULL AS label FROM articles WHERE article_id <= 100 UNION ALL SELECT scored_id, title, relevance_label FROM scored_articles WHERE scored_id <= 100")
def union_of_keys(spark, d):
    """Rows of several shapes under the union of their columns; the feature is the first hundred of each, as a report shows."""
    a = table(spark, d, "articles").where("article_id <= 100").select(F.col("article_id").alias("id"), "title")
    s = table(spark, d, "scored_articles").where("scored_id <= 100").select(F.col("scored_id").alias("id"), "title", F.col("relevance_label").alias("label"))
    return a.unionByName(s, allowMissingColumns=True)


@query("rotated_backups", "SELECT site, stamp FROM (SELECT site, stamp, row_number() OVER (PARTITION BY site ORDER BY stamp DESC) AS rn FROM (SELECT DISTINCT site, strftime(fetched_at, '%Y%m%d_%H') AS stamp FROM feed_entries)) WHERE rn <= 5")
def rotated_backups(spark, d):
    """The five newest backups of each site, of which each hour makes one."""
    made = table(spark, d, "feed_entries").select("site", F.date_format("fetched_at", "yyyyMMdd_HH").alias("stamp")).distinct()
    return made.withColumn("rn", F.row_number().over(Window.partitionBy("site").orderBy(F.desc("stamp")))).where("rn <= 5").select("site", "stamp")


S_SANE = r"CASE WHEN COALESCE(text, '') = '' THEN '-' ELSE trim(regexp_replace(regexp_replace(replace(replace(replace(text, chr(10), ' '), chr(9), ' '), chr(13), ' '), '\s+', ' ', 'g'), '(?i)Supplier From\s*', '', 'g')) END"


@query("sanitized", f"SELECT doc_id, md5({S_SANE}) AS h FROM documents WHERE kind = 'manifest'")
def sanitized(spark, d):
    t = F.regexp_replace(F.regexp_replace("text", r"\s+", " "), r"(?i)Supplier From\s*", "")
    t = F.when(F.coalesce("text", F.lit("")) == "", "-").otherwise(F.btrim(t))
    return table(spark, d, "documents").where("kind = 'manifest'").select("doc_id", F.md5(t).alias("h"))


PROMPT = "Judul: {}\nSumber: {}\n\n{}"
# Fixed value: what stands for the rest of a content that is cut.
CUT_MARK = "\n\n[...konten dipotong karena terlalu panjang...]"


@query("prompts", f"SELECT article_id, md5('Judul: ' || COALESCE(title, 'N/A') || chr(10) || 'Sumber: ' || COALESCE(source, 'N/A') || chr(10) || chr(10) || CASE WHEN length(content) > 1500 THEN substr(content, 1, 1500) || {SQ(CUT_MARK)} ELSE COALESCE(content, '') END) AS h FROM articles")
def prompts(spark, d):
    """A template filled from each article, its content cut at a limit with a mark."""
    c = F.coalesce("content", F.lit(""))
    cut = F.when(F.length(c) > 1500, F.concat(F.substring(c, 1, 1500), F.lit(CUT_MARK))).otherwise(c)
    a, b, e, _ = PROMPT.split("{}")
    filled = F.concat(F.lit(a), F.coalesce("title", F.lit("N/A")), F.lit(b), F.coalesce("source", F.lit("N/A")), F.lit(e), cut)
    return table(spark, d, "articles").select("article_id", F.md5(filled).alias("h"))


@query("batch_verdicts", "SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN COALESCE(content, '') = '' THEN 'none' WHEN contains(lower(content), 'pesangon') THEN 'loss' WHEN contains(lower(content), 'lowongan') THEN 'gain' ELSE 'other' END AS verdict FROM articles) GROUP BY verdict")
def batch_verdicts(spark, d):
    """Verdicts of a model that takes texts in batches; a text on which it fails has an empty verdict, and the rest stay."""
    from lexaudit.operators import verdict

    def model(texts: list[str]) -> list[str]:
        return ["loss" if "pesangon" in t.lower() else "gain" if "lowongan" in t.lower() else "other" for t in texts]

    v = verdict.in_batches(table(spark, d, "articles").select("article_id", "content"), "article_id", "content", model, none="none")
    return v.groupBy("verdict").agg(F.count("*").alias("n"))


@query("epoch_days", "SELECT event_id, strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d') AS day FROM events")
def epoch_days(spark, d):
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    return table(spark, d, "events").select("event_id", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd").alias("day"))


@query("selected_text")
def selected_text(spark, d):
    """Title, tag link and body of pages by chains of selectors and by layers."""
    from lexaudit.functions import htmltree
    from lexaudit.plans.audit import _pages

    p = _pages(spark, d)
    chains = {"title": ["h1.judul", "title"], "about": ["meta[property=\"og:description\"]", "meta[name=\"description\"]"], "tag": ["a[rel=tag]"]}
    return p.select("article_id", *[htmltree.select_text(F.col("html"), c).alias(n) for n, c in chains.items()], htmltree.layered_text("html")["title"].alias("heading"))
