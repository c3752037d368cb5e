"""Queries of the audit operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexaudit import domains, lexicon
from lexaudit.functions import dates, htmlx, jsonx, text, urls
from lexaudit.operators import dedup, fuzzy, rules, scoring, spans, verdict
from lexaudit.registry import query
from lexaudit.session import barrier, shared_path, table
from lexaudit.sources import files

L, SQ = lexicon, lexicon.sql_text
SPACE = text.SPACE
#: The day that stands for today.
AS_OF = "2025-11-15 00:00:00"

# pieces of SQL that several queries share
S_COLLAPSE = lambda x: f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"
S_KEY = lambda x: S_COLLAPSE(f"lower(COALESCE({x}, ''))")
S_NORM = lambda x: S_COLLAPSE(f"translate(lower(COALESCE({x}, '')), '–—‘’“”', '--''''\"\"')")
S_WORDS = lambda x: f"(CASE WHEN {S_COLLAPSE(f"COALESCE({x}, '')")} = '' THEN 0 ELSE length({S_COLLAPSE(f"COALESCE({x}, '')")}) - length(replace({S_COLLAPSE(f"COALESCE({x}, '')")}, ' ', '')) + 1 END)"
S_ALL = "lower(COALESCE(title, '') || ' ' || COALESCE(url, '') || ' ' || COALESCE(content, ''))"
S_HOST = "lower(regexp_extract(COALESCE(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
S_DOMAINS = lambda ds: "'(?:" + "|".join(d.replace(".", r"\.") for d in ds) + ")'"
LAB = ("labour_positive", "labour_negative", "labour_issue")
COLS, SQL = domains.Columns(), domains.Sql()


def whole(d):
    """Lower-cased title, url and content."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("title", "url", "content")]))


@query("norm_text", f"SELECT doc_id, md5({S_NORM('text')}) AS h FROM documents")
def norm_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize(F.col("text"))).alias("h"))


@query("word_count", f"SELECT doc_id, CAST({S_WORDS('text')} AS INTEGER) AS n FROM documents")
def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", text.word_count(F.col("text")).alias("n"))


@query("lexicon_any", f"SELECT lang, count(*) AS n FROM documents WHERE {L.sql_any('lower(text)', *LAB)} GROUP BY lang")
def lexicon_any(spark, d):
    return table(spark, d, "documents").where(L.any_of(F.lower("text"), *LAB)).groupBy("lang").agg(F.count("*").alias("n"))


@query("lexicon_hit_count", f"SELECT doc_id, CAST({L.sql_count('lower(text)', *LAB)} AS INTEGER) AS n FROM documents")
def lexicon_hit_count(spark, d):
    return table(spark, d, "documents").select("doc_id", L.hit_count(F.lower("text"), *LAB).alias("n"))


@query("lexicon_literal_mode", f"SELECT article_id, CAST({L.sql_count('lower(content)', 'topic_secondary', mode='literal')} AS INTEGER) AS n FROM articles")
def lexicon_literal_mode(spark, d):
    return table(spark, d, "articles").select("article_id", L.hit_count(F.lower("content"), "topic_secondary", mode="literal").alias("n"))


def sql_tiered(t: str = "t", host: str = "h") -> str:
    c = L.sql_count(t, *scoring.WORK)
    anchor = L.sql_any(t, "work_anchors")
    return (
        f"greatest(0, least(100, CASE WHEN {anchor} THEN 40 WHEN {L.sql_any(t, 'work_districts')} THEN 30 WHEN {L.sql_any(t, 'work_landmarks')} THEN 35 "
        f"WHEN regexp_matches({t}, {SQ(scoring.PLACE)}) THEN 20 ELSE 0 END + CASE WHEN {c} >= 3 THEN 40 WHEN {c} = 2 THEN 30 WHEN {c} = 1 THEN 20 ELSE 0 END "
        f"+ CASE WHEN {L.sql_any(t, 'work_elsewhere')} THEN CASE WHEN {anchor} THEN -15 ELSE -60 END ELSE 0 END "
        f"+ CASE WHEN {L.sql_any(t, 'work_noise')} AND {c} < 2 THEN -25 ELSE 0 END + CASE WHEN regexp_matches({host}, {S_DOMAINS(L.CREDIBLE_DOMAINS)}) THEN 10 ELSE 0 END "
        f"+ CASE WHEN {anchor} AND {c} >= 1 THEN 10 ELSE 0 END))"
    )


S_SCORED = f"SELECT article_id, content, {S_ALL} AS t, {S_HOST} AS h FROM articles"


@query("labour_score_tiered", f"SELECT article_id, CAST({sql_tiered()} AS INTEGER) AS score FROM ({S_SCORED})")
def labour_score_tiered(spark, d):
    a = table(spark, d, "articles")
    return a.select("article_id", scoring.tiered(whole(a), urls.host(F.col("url"))).alias("score"))


def sql_prefix(t: str = "t") -> str:
    c = L.sql_count(t, *LAB)
    return (
        f"greatest(0, least(100, CASE WHEN {L.sql_any(t, 'labour_anchors')} THEN 40 WHEN {L.sql_any(t, 'labour_districts')} THEN 30 WHEN {L.sql_any(t, 'labour_landmarks')} THEN 35 "
        f"WHEN contains({t}, 'bandung') THEN 20 ELSE 0 END + CASE WHEN {c} >= 3 THEN 40 WHEN {c} >= 1 THEN 20 ELSE 0 END + CASE WHEN {L.sql_any(t, 'labour_elsewhere')} THEN -60 ELSE 0 END))"
    )


@query("labour_score_prefix", f"SELECT article_id, CAST({sql_prefix()} AS INTEGER) AS score FROM ({S_SCORED})")
def labour_score_prefix(spark, d):
    a = table(spark, d, "articles")
    return a.select("article_id", scoring.prefix_score(whole(a)).alias("score"))


S_TIER = "CASE WHEN score >= 70 THEN 'accept' WHEN score >= 30 AND n > 400 THEN 'accept long' WHEN score >= 30 THEN 'too short' ELSE 'reject' END"


@query("flagship_tier_decision", f"SELECT {S_TIER} AS decision, count(*) AS n FROM (SELECT {sql_tiered('t', 'COALESCE(h, \'\')')} AS score, n FROM (SELECT {S_NORM('text')} AS t, lower(source) AS h, length(text) AS n FROM documents)) GROUP BY 1")
def flagship_tier_decision(spark, d):
    t = table(spark, d, "documents").select(text.normalize(F.col("text")).alias("t"), F.coalesce(F.lower("source"), F.lit("")).alias("h"), F.length("text").alias("n"))
    s = t.select(scoring.tiered(F.col("t"), F.col("h")).alias("score"), "n")
    tier = F.when(F.col("score") >= 70, "accept").when((F.col("score") >= 30) & (F.col("n") > 400), "accept long").when(F.col("score") >= 30, "too short").otherwise("reject")
    return s.groupBy(tier.alias("decision")).agg(F.count("*").alias("n"))


P, S2 = len(L.patterns("topic_primary")), len(L.patterns("topic_secondary"))
S_QUALITY = f"greatest(0.0, least(1.0, 0.5 + CASE WHEN w >= 500 THEN 0.3 WHEN w >= 200 THEN 0.15 WHEN w < 100 THEN -0.2 ELSE 0.0 END + CASE WHEN COALESCE(length(title), 0) > 20 THEN 0.1 ELSE 0.0 END + CASE WHEN COALESCE(length(content), 0) > 300 THEN 0.1 ELSE 0.0 END))"
S_CRED = "CASE " + " ".join(f"WHEN regexp_matches(lower(COALESCE(source, '')), {S_DOMAINS(L.CREDIBILITY[k])}) THEN {v}" for k, v in (("high", 1.0), ("medium", 0.6), ("low", 0.2))) + " ELSE 0.3 END"


@query("quality_score", f"SELECT article_id, CAST(round({S_QUALITY}, 4) AS DOUBLE) AS q FROM (SELECT *, {S_WORDS('content')} AS w FROM articles)")
def quality_score(spark, d):
    return table(spark, d, "articles").select("article_id", F.round(scoring.quality_score(F.col("title"), F.col("content")), 4).alias("q"))


@query("credibility_tier", f"SELECT article_id, CAST({S_CRED} AS DOUBLE) AS c FROM articles")
def credibility_tier(spark, d):
    return table(spark, d, "articles").select("article_id", scoring.credibility_score(F.col("source")).alias("c"))


@query("credibility_lookup", "SELECT s.credibility, count(*) AS n FROM articles a JOIN sources s ON lower(trim(a.source)) = lower(trim(s.source)) GROUP BY 1")
def credibility_lookup(spark, d):
    from lexaudit.session import source_key

    a, s = table(spark, d, "articles").select(source_key("source").alias("k")), table(spark, d, "sources").select(source_key("source").alias("k"), "credibility")
    return a.join(s, "k").groupBy("credibility").agg(F.count("*").alias("n"))


@query("negative_penalty", f"SELECT article_id, CAST(round(least(1.0, 0.15 * {L.sql_count('t', 'off_topic')} + 0.1 * {L.sql_count('t', 'labour_noise')}), 4) AS DOUBLE) AS p FROM ({S_SCORED})")
def negative_penalty(spark, d):
    a = table(spark, d, "articles")
    return a.select("article_id", F.round(scoring.negative_penalty(whole(a)), 4).alias("p"))


@query("composite_score")
def composite_score(spark, d):
    a = table(spark, d, "articles")
    t, at = F.col("t"), dates.wall_time(F.col("published_date"))
    a = a.withColumn("t", whole(a))
    parts = {
        "keyword": scoring.keyword_score(t), "geographic": scoring.geographic_score(t), "credibility": scoring.credibility_score(F.col("source")),
        "quality": scoring.quality_score(F.col("title"), F.col("content")), "recency": dates.recency(at, F.lit(AS_OF).cast("timestamp_ntz")),
        "penalty": scoring.negative_penalty(t), "words": text.word_count(F.col("content")), "dated": F.coalesce(F.col("published_date"), F.lit("")) != "",
    }
    a = barrier(a.select("article_id", *[v.alias(k) for k, v in parts.items()]), *parts)
    total = scoring.composite({k: F.col(k) for k in scoring.WEIGHTS}, F.col("penalty"), F.col("words"), F.col("dated"))
    a = a.withColumn("total", F.round(total, 4))
    return a.select("article_id", "total", *[F.round(k, 4).alias(k) for k in scoring.WEIGHTS], scoring.label(F.col("total")).alias("label"))


@query("topic_hits", f"SELECT article_id, CAST({L.sql_count('t', 'topic_primary')} AS INTEGER) AS n FROM ({S_SCORED})")
def topic_hits(spark, d):
    a = table(spark, d, "articles")
    return a.select("article_id", F.size(L.hits(whole(a), "topic_primary")).alias("n"))


SPANS = [("loss", "pengurangan karyawan"), ("loss", "gelombang perumahan pegawai"), ("loss", "penutupan cabang usaha"), ("loss", "pemutusan kontrak kerja"), ("pay", "pesangon"), ("pay", "jadwal pembayaran pesangon"), ("pay", "upah"), ("pay", "kenaikan upah tahunan"), ("gain", "lowongan operator jahit"), ("gain", "rekrutmen petugas sensus"), ("gain", "penerimaan tenaga magang"), ("gain", "tenaga magang")]


@query("phrase_spans")
def phrase_spans(spark, d):
    found = spans.find_spans(table(spark, d, "articles"), SPANS, "article_id", "content")
    return spans.kept_spans(found).withColumnRenamed("id", "article_id")


@query("phrase_summary")
def phrase_summary(spark, d):
    return spans.summarize(spans.kept_spans(spans.find_spans(table(spark, d, "articles"), SPANS, "article_id", "content")), ["loss"]).withColumnRenamed("id", "article_id")


@query("phrase_snippets")
def phrase_snippets(spark, d):
    a = table(spark, d, "articles")
    kept = spans.kept_spans(spans.find_spans(a, SPANS, "article_id", "content")).withColumnRenamed("id", "article_id")
    return kept.join(a.select("article_id", "content"), "article_id").select("article_id", "start", "phrase", text.snippet(F.col("content"), F.col("start"), F.col("stop")).alias("snippet"))


IMPACT = ["phk", "dirumahkan", "pengurangan karyawan", "tutup", "bangkrut", "pailit"]


@query("phenomena_score", "SELECT article_id, CAST(least(50, 5 * n + 10 * h) + least(20, 3 * k) AS INTEGER) AS score FROM (SELECT article_id, " + L.sql_count("t", "labour_negative") + " AS h, " + L.sql_count("t", *LAB) + " AS n, " + " + ".join(f"CAST(contains(t, '{w}') AS INTEGER)" for w in IMPACT) + f" AS k FROM ({S_SCORED}))")
def phenomena_score(spark, d):
    a = table(spark, d, "articles")
    t = whole(a)
    k = sum((t.contains(w).cast("int") for w in IMPACT), F.lit(0))
    n, h = L.hit_count(t, *LAB), L.hit_count(t, "labour_negative")
    return a.select("article_id", (F.least(F.lit(50), 5 * n + 10 * h) + scoring.capped([(k, 3, 20)])).alias("score"))


S_HEAD = f"SELECT article_id, title, lower(COALESCE(title, '')) AS ti, lower(COALESCE(url, '')) AS u, lower(COALESCE(title, '') || ' ' || COALESCE(url, '')) AS t, lower(COALESCE(title, '') || ' ' || COALESCE(content, '')) AS body, content, url, {S_HOST} AS h FROM articles"


def heads(spark, d):
    """Articles with what the jobs' rules look at: ti, u, t (title and url) and body (title and content), lower case."""
    a = table(spark, d, "articles")
    ti, u, c = (F.coalesce(F.col(x), F.lit("")) for x in ("title", "url", "content"))
    joined = lambda x, y: F.lower(F.concat(x, F.lit(" "), y))
    return a.select("article_id", "title", "url", "content", F.lower(ti).alias("ti"), F.lower(u).alias("u"), joined(ti, u).alias("t"), joined(ti, c).alias("body"))


@query("preflight_labour", f"SELECT reason, count(*) AS n FROM (SELECT {domains.labour_preflight('ti', 'u', sql_tiered() + ' < 30', SQL)} AS reason FROM ({S_HEAD})) GROUP BY reason")
def preflight_labour(spark, d):
    low = scoring.tiered(F.col("t"), urls.host(F.col("url"))) < 30
    return rules.tally(heads(spark, d), domains.labour_preflight(F.col("ti"), F.col("u"), low, COLS))


def _preflight(domain):
    return f"SELECT reason, count(*) AS n FROM (SELECT {domains.preflight(domain, 'ti', 'u', 't', SQL)} AS reason FROM ({S_HEAD})) GROUP BY reason"


def _lexical(domain):
    return f"SELECT reason, count(*) AS n FROM (SELECT {domains.lexical(domain, 'body', SQL)} AS reason FROM ({S_HEAD})) GROUP BY reason"


@query("preflight_trade", _preflight(domains.TRADE))
def preflight_trade(spark, d):
    return rules.tally(heads(spark, d), domains.preflight(domains.TRADE, F.col("ti"), F.col("u"), F.col("t"), COLS))


@query("preflight_nonprofit", _preflight(domains.NONPROFIT))
def preflight_nonprofit(spark, d):
    return rules.tally(heads(spark, d), domains.preflight(domains.NONPROFIT, F.col("ti"), F.col("u"), F.col("t"), COLS))


@query("lexical_trade", _lexical(domains.TRADE))
def lexical_trade(spark, d):
    return rules.tally(heads(spark, d), domains.lexical(domains.TRADE, F.col("body"), COLS))


@query("lexical_nonprofit", _lexical(domains.NONPROFIT))
def lexical_nonprofit(spark, d):
    return rules.tally(heads(spark, d), domains.lexical(domains.NONPROFIT, F.col("body"), COLS))


#: The least characters of a text the trade and non-profit jobs go on with.
LEAST_CHARS = 150


def _pipeline_sql(domain):
    kept = ", ".join(f"'{k}'" for k in domains.KEPT)
    return (
        f"SELECT article_id, reason FROM (SELECT *, {domains.lexical(domain, 'body', SQL)} AS reason FROM (SELECT * FROM ({S_HEAD}) WHERE url IS NOT NULL AND length(content) >= {LEAST_CHARS} "
        f"AND NOT EXISTS (SELECT 1 FROM visited_urls v WHERE v.url = articles.url)) WHERE {domains.preflight(domain, 'ti', 'u', 't', SQL)} = 'pass') WHERE reason IN ({kept})"
    ).replace("articles.url)", "x.url)").replace(f"({S_HEAD}) WHERE url", f"({S_HEAD}) x WHERE x.url")


def _pipeline(spark, d, domain):
    """Unseen pages that pass the rules on title and url, with the reason by which their text is kept."""
    a = heads(spark, d).where("url IS NOT NULL").where(F.length("content") >= LEAST_CHARS)
    fresh = dedup.unseen(a, table(spark, d, "visited_urls"), "url")
    passed = fresh.where(domains.preflight(domain, F.col("ti"), F.col("u"), F.col("t"), COLS) == "pass")
    return passed.select("article_id", domains.lexical(domain, F.col("body"), COLS).alias("reason")).where(F.col("reason").isin(*domains.KEPT))


@query("pipeline_trade", _pipeline_sql(domains.TRADE))
def pipeline_trade(spark, d):
    return _pipeline(spark, d, domains.TRADE)


@query("pipeline_nonprofit", _pipeline_sql(domains.NONPROFIT))
def pipeline_nonprofit(spark, d):
    return _pipeline(spark, d, domains.NONPROFIT)


@query("mime_filter", "SELECT count(*) AS n FROM (SELECT metadata['content_type'] AS ct FROM articles) WHERE NOT (contains(lower(COALESCE(ct, '')), 'application/') AND NOT contains(lower(COALESCE(ct, '')), 'xhtml'))")
def mime_filter(spark, d):
    ct = F.try_element_at("metadata", F.lit("content_type"))
    return table(spark, d, "articles").where(urls.is_text_type(ct)).agg(F.count("*").alias("n"))


@query("visited_antijoin", "SELECT article_id FROM articles a WHERE NOT EXISTS (SELECT 1 FROM visited_urls v WHERE v.url = a.url)")
def visited_antijoin(spark, d):
    return dedup.unseen(table(spark, d, "articles").select("article_id", "url"), table(spark, d, "visited_urls"), "url").select("article_id")


@query("feed_cap_per_site", "SELECT site, klaster, feed_pos, url FROM (SELECT *, row_number() OVER (PARTITION BY site, klaster ORDER BY feed_pos, fetched_at, url, title, published) AS rn FROM feed_entries) WHERE rn <= 15")
def feed_cap_per_site(spark, d):
    order = [F.col(c).asc_nulls_last() for c in ("feed_pos", "fetched_at", "url", "title", "published")]
    return dedup.first_per_group(table(spark, d, "feed_entries"), ["site", "klaster"], order, 15).select("site", "klaster", "feed_pos", "url")


S_DKEY = f"COALESCE(NULLIF({S_KEY('url')}, ''), md5(concat_ws('|', {S_KEY('title')}, {S_KEY('source')})))"


@query("dedup_keep_first", f"SELECT article_id FROM (SELECT article_id, row_number() OVER (PARTITION BY {S_DKEY} ORDER BY article_id) AS rn FROM articles) WHERE rn = 1")
def dedup_keep_first(spark, d):
    key = dedup.dedup_key(F.col("url"), F.col("title"), F.col("source"))
    return dedup.keep_one(table(spark, d, "articles").select("article_id", key.alias("k")), ["k"], [F.col("article_id")]).select("article_id")


@query("dedup_keep_last", f"SELECT article_id FROM (SELECT article_id, row_number() OVER (PARTITION BY {S_DKEY} ORDER BY article_id DESC) AS rn FROM articles) WHERE rn = 1")
def dedup_keep_last(spark, d):
    key = dedup.dedup_key(F.col("url"), F.col("title"), F.col("source"))
    return dedup.keep_one(table(spark, d, "articles").select("article_id", key.alias("k")), ["k"], [F.col("article_id").desc()]).select("article_id")


@query("distinct_rows", "SELECT count(*) AS n FROM (SELECT DISTINCT * FROM feed_entries)")
def distinct_rows(spark, d):
    return table(spark, d, "feed_entries").distinct().agg(F.count("*").alias("n"))


@query("greedy_dual_key")
def greedy_dual_key(spark, d):
    a = table(spark, d, "articles").select("article_id", F.nullif(text.normalize_key(F.col("url")), F.lit("")).alias("u"), F.nullif(text.normalize_key(F.col("title")), F.lit("")).alias("t"))
    return dedup.greedy_two_keys(a, "u", "t", "article_id").select("article_id")


@query("merge_master", "SELECT article_id, batch_no FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY crawled_at DESC, article_id DESC) AS rn FROM articles WHERE url IS NOT NULL) WHERE rn = 1")
def merge_master(spark, d):
    a = table(spark, d, "articles").where("url IS NOT NULL").select("article_id", "batch_no", "url", "crawled_at")
    parts = [a.where(F.col("batch_no") <= 3), a.where(F.col("batch_no").between(4, 6)).withColumn("note", F.lit("middle")), a.where("batch_no > 6 OR batch_no IS NULL")]
    return dedup.merged(parts, "url", [F.col("crawled_at").desc_nulls_last(), F.col("article_id").desc()]).select("article_id", "batch_no")


@query("merge_statistics", "SELECT count(*) AS n_raw, count(*) - count(DISTINCT url) AS n_removed, count(DISTINCT url) AS n_final FROM articles WHERE url IS NOT NULL")
def merge_statistics(spark, d):
    per = table(spark, d, "articles").where("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("c"))
    return per.agg(F.sum("c").alias("n_raw"), (F.sum("c") - F.count("*")).alias("n_removed"), F.count("*").alias("n_final"))


S_FILE = "'audit_' || strftime(crawled_at, '%Y%m%d_%H%M%S') || '.json'"


@query("filename_pruning", f"SELECT count(*) AS n, CAST(max(strptime(regexp_extract(f, '(\\d{{8}}_\\d{{6}})', 1), '%Y%m%d_%H%M%S')) AS VARCHAR) AS latest FROM (SELECT {S_FILE} AS f FROM articles) WHERE regexp_extract(f, '(\\d{{8}})', 1) BETWEEN '20251101' AND '20251106'")
def filename_pruning(spark, d):
    f = F.concat(F.lit("audit_"), F.date_format("crawled_at", "yyyyMMdd_HHmmss"), F.lit(".json"))
    return table(spark, d, "articles").select(f.alias("f")).where(files.in_range(F.col("f"), "20251101", "20251106")).agg(F.count("*").alias("n"), F.max(files.file_time(F.col("f"))).cast("string").alias("latest"))


@query("drop_reasons", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN total_score IS NULL OR isnan(total_score) THEN 'no score' WHEN total_score < 0.1 THEN 'low score' WHEN word_count < 50 THEN 'short' WHEN scored_at < TIMESTAMP '2025-10-16 00:00:00' THEN 'old' ELSE 'kept' END AS reason FROM scored_articles) GROUP BY reason")
def drop_reasons(spark, d):
    s = table(spark, d, "scored_articles")
    reason = rules.first_reason([(F.col("total_score").isNull() | F.isnan("total_score"), "no score"), (F.col("total_score") < 0.1, "low score"), (F.col("word_count") < 50, "short"), (F.col("scored_at") < F.lit("2025-10-16 00:00:00").cast("timestamp_ntz"), "old")], "kept")
    return rules.tally(s, reason)


@query("label_distribution", "SELECT k AS label, count(*) AS n FROM (SELECT unnest(matched_keywords) AS k FROM scored_articles) GROUP BY k")
def label_distribution(spark, d):
    return table(spark, d, "scored_articles").select(F.explode("matched_keywords").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("session_summary", "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS high, CAST(round(100.0 * count(*) FILTER (WHERE value > 50) / greatest(count(*), 1), 1) AS DOUBLE) AS pct, CAST(round(avg(value), 6) AS DOUBLE) AS mean FROM events GROUP BY event_type")
def session_summary(spark, d):
    high = F.sum((F.coalesce(F.col("value") > 50, F.lit(False))).cast("bigint"))
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), high.alias("high"), F.round(100.0 * high / F.greatest(F.count("*"), F.lit(1)), 1).alias("pct"), F.round(F.avg("value"), 6).alias("mean"))


@query("topk_report", "SELECT DISTINCT scored_id, total_score FROM scored_articles WHERE total_score IS NOT NULL AND NOT isnan(total_score) ORDER BY total_score DESC, scored_id LIMIT 20")
def topk_report(spark, d):
    s = table(spark, d, "scored_articles").where("total_score IS NOT NULL AND NOT isnan(total_score)").select("scored_id", "total_score").distinct()
    return s.orderBy(F.desc("total_score"), "scored_id").limit(20)


@query("threshold_rank", "SELECT source, count(*) AS n, CAST(round(avg(total_score), 6) AS DOUBLE) AS mean FROM scored_articles WHERE total_score >= 0.3 AND NOT isnan(total_score) GROUP BY source")
def threshold_rank(spark, d):
    return table(spark, d, "scored_articles").where("total_score >= 0.3 AND NOT isnan(total_score)").groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg("total_score"), 6).alias("mean"))


@query("date_parse_iso")
def date_parse_iso(spark, d):
    return table(spark, d, "articles").select("article_id", dates.iso_text(F.col("published_date")).alias("iso"))


@query("recency_tier", f"SELECT event_id, CAST(CASE WHEN x < 0 THEN 0.8 WHEN x <= 1 THEN 1.0 WHEN x <= 3 THEN 0.9 WHEN x <= 7 THEN 0.8 WHEN x <= 14 THEN 0.6 WHEN x <= 30 THEN 0.4 WHEN x <= 90 THEN 0.2 WHEN x IS NULL THEN 0.3 ELSE 0.1 END AS DOUBLE) AS r FROM (SELECT event_id, floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 86400000000.0) AS x FROM events)")
def recency_tier(spark, d):
    return table(spark, d, "events").select("event_id", dates.recency(F.col("ts"), F.lit(AS_OF).cast("timestamp_ntz")).cast("double").alias("r"))


@query("time_window_union", "SELECT site, count(*) AS n FROM (SELECT DISTINCT url, site FROM feed_entries WHERE fetched_at >= TIMESTAMP '2025-11-08 00:00:00' AND fetched_at < TIMESTAMP '2025-11-15 00:00:00') GROUP BY site")
def time_window_union(spark, d):
    f = table(spark, d, "feed_entries").select("url", "site", "fetched_at").where(F.col("fetched_at") < F.lit(AS_OF).cast("timestamp_ntz"))
    day, week = (f.where(F.col("fetched_at") >= F.lit(x).cast("timestamp_ntz")) for x in ("2025-11-14 00:00:00", "2025-11-08 00:00:00"))
    return day.unionByName(week).select("url", "site").distinct().groupBy("site").agg(F.count("*").alias("n"))


@query("highest_amount")
def highest_amount(spark, d):
    return table(spark, d, "documents").select("doc_id", text.highest_amount(F.col("text")).alias("amount"))


S_FLAGS = "COALESCE(NULLIF(concat_ws(', ', " + ", ".join(f"CASE WHEN regexp_matches(lower(text), {SQ('(?:' + '|'.join(v) + ')')}) THEN '{k}' END" for k, v in L.FLAGS.items()) + "), ''), 'konten_umum')"


@query("auto_flag", f"SELECT doc_id, {S_FLAGS} AS flags FROM documents")
def auto_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", text.flags(F.lower("text"), L.FLAGS, "konten_umum").alias("flags"))


_M = {n: i for i, (a, b) in enumerate(dates.MONTHS.items(), 1) for n in (a, b.lower())}
_NAMES, _NUMBER = "|".join(sorted(_M)), "CASE {} " + " ".join(f"WHEN '{n}' THEN '{i:02d}'" for n, i in sorted(_M.items())) + " END"
S_DATED = lambda p, m, d: f"CASE WHEN regexp_matches(lower(text), '{p}') THEN regexp_extract(lower(text), '{p}', 3) || '-' || {_NUMBER.format(f"regexp_extract(lower(text), '{p}', {m})")} || '-' || lpad(regexp_extract(lower(text), '{p}', {d}), 2, '0') END"
S_POST = f"SELECT doc_id, COALESCE({S_DATED(f'({_NAMES}) (' + chr(92) + 'd{1,2}), (' + chr(92) + 'd{4})', 1, 2)}, {S_DATED('(' + chr(92) + 'd{1,2}) (' + _NAMES + ') (' + chr(92) + 'd{4})', 2, 1)}, 'Tanggal Tidak Tersedia') AS day FROM documents"


@query("post_date_fallback", S_POST)
def post_date_fallback(spark, d):
    return table(spark, d, "documents").select("doc_id", dates.post_date(F.col("text")).alias("day"))


S_TRUNC = "CASE WHEN length(text) <= 1500 THEN text WHEN pos > 0 THEN substr(text, 1, 800) || chr(10) || chr(10) || '...' || chr(10) || chr(10) || substr(text, 801 + greatest(0, pos - 351), least(length(text) - 800, pos + 349) - greatest(0, pos - 351)) ELSE substr(text, 1, 1500) END"


@query("smart_truncate", f"SELECT doc_id, md5({S_TRUNC}) AS h FROM (SELECT *, instr(substr(lower(text), 801), 'bandung') AS pos FROM documents)")
def smart_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.truncate_around(F.col("text"), "bandung")).alias("h"))


@query("densest_paragraphs")
def densest_paragraphs(spark, d):
    def score(p, i):
        t = F.lower(p)
        place = F.when(L.any_of(t, "labour_anchors", whole_words=True), 40).when(L.any_of(t, "labour_districts", whole_words=True), 30).when(t.rlike(scoring.PLACE), 15).otherwise(0)
        return place + 15 * L.hit_count(t, *LAB, whole_words=True) + F.when(i < 3, 10).otherwise(0)

    return table(spark, d, "articles").select("article_id", F.md5(text.densest_paragraphs(F.col("content"), score)).alias("h"))


@query("summary_extract")
def summary_extract(spark, d):
    return table(spark, d, "articles").select("article_id", text.summary(F.col("content")).alias("summary"))


@query("boilerplate_clean", f"SELECT article_id, md5({text.sql_clean('content')}) AS h FROM articles")
def boilerplate_clean(spark, d):
    return table(spark, d, "articles").select("article_id", F.md5(text.clean(F.col("content"))).alias("h"))


@query("ad_line_clean", f"SELECT article_id, md5(trim(regexp_replace(regexp_replace(content, '(?i){text.AD_LINES}[^' || chr(10) || ']*' || chr(10), chr(10), 'g'), chr(10) || '+', chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13))) AS h FROM articles")
def ad_line_clean(spark, d):
    return table(spark, d, "articles").select("article_id", F.md5(text.clean_lines(F.col("content"))).alias("h"))


@query("ocr_clean", f"SELECT doc_id, md5({S_COLLAPSE("replace(translate(text, '" + chr(92) + "/*_[]{}|~^`', ''), 'Bartai', 'Partai')")}) AS h FROM documents WHERE kind = 'ocr'")
def ocr_clean(spark, d):
    return table(spark, d, "documents").where("kind = 'ocr'").select("doc_id", F.md5(text.clean_ocr(F.col("text"))).alias("h"))


@query("url_page_all")
def url_page_all(spark, d):
    return table(spark, d, "articles").select("article_id", urls.all_pages(F.col("url"), ["portalnadirasa.id.example", "suarahayanoya.example"]).alias("u"))


@query("url_first_page", "SELECT article_id, CASE WHEN contains(u, '?') THEN u ELSE u || '?page=all' END AS u FROM (SELECT article_id, regexp_replace(url, '/page/\\d+', '', 'g') AS u FROM articles)")
def url_first_page(spark, d):
    return table(spark, d, "articles").select("article_id", urls.first_page(F.col("url")).alias("u"))


@query("url_decode_feed")
def url_decode_feed(spark, d):
    return table(spark, d, "feed_entries").select("url", urls.decode_feed(F.col("url")).alias("target")).distinct()


@query("url_parts", f"SELECT article_id, {S_HOST} AS host, regexp_extract(regexp_replace(regexp_extract(url, '^([^?]*)', 1), '/+$', ''), '([^/]*)$', 1) AS last FROM articles")
def url_parts(spark, d):
    return table(spark, d, "articles").select("article_id", urls.host(F.col("url")).alias("host"), urls.last_segment(F.col("url")).alias("last"))


def _pages(spark, d):
    """Articles as the pages they might have been."""
    a = table(spark, d, "articles")
    body = F.concat(F.lit("<p>"), F.regexp_replace(F.regexp_replace(F.coalesce("content", F.lit("")), "[<>&]", " "), r"\n+", "</p><p>"), F.lit("</p>"))
    tags = F.array_join(F.transform("tags", lambda t: F.concat(F.lit("<a rel=\"tag\" href=\"/t\">"), t, F.lit("</a>"))), "")
    images = F.array_join(F.transform("images", lambda t: F.concat(F.lit("<img src=\""), t, F.lit("\">"))), "")
    head = F.concat(F.lit("<html><head><title>"), F.regexp_replace(F.coalesce("title", F.lit("")), "[<>&]", " "), F.lit("</title><meta name=\"description\" content=\"x\"></head><body><script>var a = '<p>';</script>"))
    return a.select("article_id", F.concat(head, body, F.coalesce(tags, F.lit("")), F.coalesce(images, F.lit("")), F.lit("</body></html>")).alias("html"))


@query("html_title_body")
def html_title_body(spark, d):
    p = htmlx.parse_pages(_pages(spark, d))
    return p.select("article_id", "title", F.md5("body").alias("body"), "n_words", "parse_success", "parse_error")


@query("html_tags_images_links")
def html_tags_images_links(spark, d):
    return htmlx.parse_pages(_pages(spark, d)).select("article_id", F.array_join("tags", "|").alias("tags"), F.array_join("images", "|").alias("images"), F.size("links").alias("n_links"))


@query("longer_text", "SELECT article_id, CASE WHEN length(COALESCE(title, '')) > length(COALESCE(summary, '')) THEN COALESCE(title, '') ELSE COALESCE(summary, '') END AS t FROM articles")
def longer_text(spark, d):
    a, b = F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))
    return table(spark, d, "articles").select("article_id", F.when(F.length(a) > F.length(b), a).otherwise(b).alias("t"))


@query("json_robust")
def json_robust(spark, d):
    answer = F.concat(F.lit("Jawaban: ```json\n"), F.coalesce("props", F.lit("{}")), F.lit("\n``` selesai"))
    return table(spark, d, "events").select("event_id", F.md5(jsonx.robust_object(answer)).alias("h"))


@query("json_defaults", "SELECT event_id, COALESCE(json_extract_string(props, '$.k'), '-') AS k, 'x' AS missing FROM events")
def json_defaults(spark, d):
    return table(spark, d, "events").select("event_id", jsonx.with_defaults(F.col("props"), {"k": "-", "missing": "x"}).alias("v")).select("event_id", "v.*")


@query("json_walk")
def json_walk(spark, d):
    tree = F.to_json(F.struct(F.col("vec_id").cast("string").alias("shortcode"), F.struct(F.col("label").alias("taken_at"), F.struct(F.lit("isi").alias("text")).alias("caption")).alias("node")))
    return table(spark, d, "embeddings").select(F.inline(jsonx.walk_posts(tree)))


@query("json_unnest_numeric", "SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DOUBLE) AS value FROM orders")
def json_unnest_numeric(spark, d):
    j = F.to_json(F.struct(F.array(F.struct("o_orderkey", F.col("o_totalprice").cast("string").alias("value"))).alias("data")))
    rows = table(spark, d, "orders").select(F.explode(F.from_json(j, "data array<struct<o_orderkey:bigint,value:string>>")["data"]).alias("x"))
    return rows.select("x.o_orderkey", F.round(F.col("x.value").try_cast("double"), 2).alias("value"))


@query("flatten_struct", "SELECT article_id, array_to_string(tags, '; ') AS tags, metadata['kanal'] AS \"metadata.kanal\" FROM articles")
def flatten_struct(spark, d):
    return table(spark, d, "articles").select("article_id", F.array_join("tags", "; ").alias("tags"), F.try_element_at("metadata", F.lit("kanal")).alias("metadata.kanal"))


# What goods are called in both languages.
BRIDGE = {
    "pakaian": ["apparel", "garment", "shirt", "clothing", "knitted"], "tekstil": ["textile", "fabric", "yarn", "woven", "cotton"], "sepatu": ["footwear", "shoes", "sneakers", "boots"],
    "kopi": ["coffee", "arabica", "robusta", "beans"], "plastik": ["plastic", "polymer", "resin", "packaging"], "makanan": ["food", "snack", "noodle", "biscuit", "beverage"],
    "kertas": ["paper", "cardboard", "pulp", "carton"], "obat": ["pharmaceutical", "medicine", "medical", "drug"], "furnitur": ["furniture", "wood", "chair", "table", "cabinet"],
}


@query("bridge_keywords", "SELECT doc_id, array_to_string(list_concat(" + ", ".join(f"CASE WHEN contains(lower(text), '{k}') THEN {v} ELSE [] END" for k, v in BRIDGE.items()) + "), ',') AS words FROM documents")
def bridge_keywords(spark, d):
    t = F.lower("text")
    words = F.flatten(F.array(*[F.when(t.contains(k), F.array(*[F.lit(x) for x in v])).otherwise(F.array().cast("array<string>")) for k, v in BRIDGE.items()]))
    return table(spark, d, "documents").select("doc_id", F.array_join(words, ",").alias("words"))


@query("commodity_validation", "SELECT doc_id, CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for v in BRIDGE.values() for w in v) + " THEN 'SEJALAN' ELSE 'ANOMALI/BERBEDA' END AS v FROM documents WHERE kind = 'manifest'")
def commodity_validation(spark, d):
    known = F.array(*[F.lit(w) for v in BRIDGE.values() for w in v])
    hit = F.exists(known, lambda w: F.lower("text").contains(w))
    return table(spark, d, "documents").where("kind = 'manifest'").select("doc_id", F.when(hit, "SEJALAN").otherwise("ANOMALI/BERBEDA").alias("v"))


@query("fuzzy_best_match")
def fuzzy_best_match(spark, d):
    left = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    right = table(spark, d, "sources").select(F.crc32(F.col("source").cast("binary")).alias("id"), F.col("site_name").alias("name"))
    names = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    return fuzzy.best_matches(names.unionByName(right.withColumn("id", F.col("id") + 1000)), left.unionByName(names), 70.0)


# Markets and measures of capacity that pages claim.
MARKETS = ["usa", "america", "united states", "europe", "japan", "china", "korea", "middle east", "australia", "singapore", "malaysia", "germany", "uk", "united kingdom", "africa", "asia", "global"]
CAPACITY = r"(?:\b\d+\s*(?:tons|teu|containers|cartons|pallets|rolls)\b|capacity\s*of\s*\d+)"


S_MARKETS = "COALESCE(NULLIF(array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{chr(92)}b{m}{chr(92)}b') THEN '{m.title()}' END" for m in MARKETS) + "], lambda x: x IS NOT NULL)), ', '), ''), 'TIDAK ADA KLAIM PASAR')"
S_CAPACITY = f"COALESCE(NULLIF(array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), {SQ(CAPACITY)}))), ', '), ''), 'TIDAK ADA METRIK')"


@query("market_claims", f"SELECT doc_id, lang, markets, capacity, CASE WHEN lang = 'en' AND markets = 'TIDAK ADA KLAIM PASAR' THEN 'under-reported' ELSE 'SEJALAN' END AS flag FROM (SELECT doc_id, lang, {S_MARKETS} AS markets, {S_CAPACITY} AS capacity FROM documents WHERE kind = 'manifest')")
def market_claims(spark, d):
    t = F.lower("text")
    found = F.filter(F.array(*[F.when(t.rlike(rf"\b{m}\b"), F.initcap(F.lit(m))) for m in MARKETS]), lambda x: x.isNotNull())
    size = F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(CAPACITY), 0)))
    markets = F.coalesce(F.nullif(F.array_join(F.array_sort(found), ", "), F.lit("")), F.lit("TIDAK ADA KLAIM PASAR"))
    capacity = F.coalesce(F.nullif(F.array_join(size, ", "), F.lit("")), F.lit("TIDAK ADA METRIK"))
    m = table(spark, d, "documents").where("kind = 'manifest'").select("doc_id", "lang", markets.alias("markets"), capacity.alias("capacity"))
    flag = F.when((F.col("lang") == "en") & (F.col("markets") == "TIDAK ADA KLAIM PASAR"), "under-reported").otherwise("SEJALAN")
    return m.withColumn("flag", flag)


@query("macro_periods", "SELECT y AS year, string_agg(CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0'), ',' ORDER BY m) AS periods FROM range(2019, 2024) a(y), range(1, 13) b(m) GROUP BY y")
def macro_periods(spark, d):
    months = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.concat(F.col("id").cast("string"), F.lpad(m.cast("string"), 2, "0")))
    return spark.range(2019, 2024).select(F.col("id").alias("year"), F.array_join(months, ",").alias("periods"))


@query("manifest_check", "SELECT count(*) AS n, count(DISTINCT source) AS sources, count(DISTINCT lang) AS langs, count(DISTINCT kind) AS kinds FROM documents")
def manifest_check(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"), F.count_distinct("kind").alias("kinds"))


@query("null_cleanup", "SELECT article_id FROM articles WHERE source IS NOT NULL AND title IS NOT NULL AND url IS NOT NULL AND length(title) > 3")
def null_cleanup(spark, d):
    return table(spark, d, "articles").na.drop(subset=["source", "title", "url"]).where(F.length("title") > 3).select("article_id")


@query("query_matrix", "SELECT s.source, k.klaster, w.w AS win FROM sources s, (SELECT DISTINCT klaster FROM feed_entries WHERE klaster IS NOT NULL) k, (VALUES ('1d'), ('7d')) w(w)")
def query_matrix(spark, d):
    # clusters and windows are a few, and every source takes the same: an array beside each source makes the matrix
    clusters = table(spark, d, "feed_entries").where("klaster IS NOT NULL").agg(F.collect_set("klaster").alias("ks"))
    s = table(spark, d, "sources").select("source").withColumn("one", F.lit(1))
    m = s.join(clusters.withColumn("one", F.lit(1)), "one").select("source", F.explode("ks").alias("klaster"))
    return m.select("source", "klaster", F.explode(F.array(F.lit("1d"), F.lit("7d"))).alias("win"))


S_VERDICT = lambda a, b, c, e: f"CASE WHEN {L.sql_any('t', 'labour_negative')} THEN {a} WHEN {L.sql_any('t', 'labour_positive')} THEN {b} WHEN {L.sql_any('t', 'labour_issue')} THEN {c} ELSE {e} END"


@query("verdict_rule", f"SELECT employment, unemployment, count(*) AS n FROM (SELECT {S_VERDICT(chr(39) + '2 Turun' + chr(39), chr(39) + '1 Naik' + chr(39), chr(39) + '3 Tetap' + chr(39), chr(39) + 'Unknown' + chr(39))} AS employment, {S_VERDICT(chr(39) + '1 Naik' + chr(39), chr(39) + '2 Turun' + chr(39), chr(39) + '3 Tetap' + chr(39), chr(39) + 'Unknown' + chr(39))} AS unemployment FROM ({S_SCORED})) GROUP BY 1, 2")
def verdict_rule(spark, d):
    a = table(spark, d, "articles")
    v = a.select(whole(a).alias("t")).select(verdict.classify(F.col("t")).alias("v")).select("v.*")
    return v.groupBy("employment", "unemployment").agg(F.count("*").alias("n"))


@query("verdict_filter", "SELECT count(*) AS n FROM articles WHERE NOT contains(lower(COALESCE(title, '')), 'irrelevant') AND NOT contains(lower(COALESCE(title, '')), 'pasokan')")
def verdict_filter(spark, d):
    return table(spark, d, "articles").where(verdict.passes(F.col("title"), ["Irrelevant", "Pasokan"], ignore_case=True)).agg(F.count("*").alias("n"))


@query("checkpoint_batches", "SELECT site, CAST(ceil(rn / 50.0) AS BIGINT) AS part, count(*) AS n FROM (SELECT site, row_number() OVER (PARTITION BY site ORDER BY fetched_at, url, feed_pos, title, published, klaster) AS rn FROM feed_entries) GROUP BY 1, 2")
def checkpoint_batches(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("site").orderBy(*[F.col(c).asc_nulls_last() for c in ("fetched_at", "url", "feed_pos", "title", "published", "klaster")])
    return table(spark, d, "feed_entries").select("site", F.ceil(F.row_number().over(w) / 50.0).alias("part")).groupBy("site", "part").agg(F.count("*").alias("n"))


@query("visited_commit_policy", "SELECT DISTINCT url FROM articles WHERE url IS NOT NULL AND url <> '' AND (word_count >= 150 OR NOT parse_success)")
def visited_commit_policy(spark, d):
    # short pages are tried again later, so they aren't committed
    a = table(spark, d, "articles").where("url IS NOT NULL AND url <> ''")
    decision = F.when(~F.col("parse_success"), "rejected").when(F.col("word_count") < 150, "short").otherwise("accepted")
    return a.where(decision != "short").select("url").distinct()


@query("cache_ttl", f"SELECT count(*) AS n FROM events WHERE ts + INTERVAL 365 DAY >= TIMESTAMP '{AS_OF}'")
def cache_ttl(spark, d):
    e = table(spark, d, "events").withColumn("expires", F.col("ts") + F.expr("INTERVAL 365 DAY"))
    return files.live(e, F.lit(AS_OF).cast("timestamp_ntz")).agg(F.count("*").alias("n"))


@query("retention_filter", f"SELECT count(*) AS n FROM articles WHERE TIMESTAMP '{AS_OF}' - crawled_at > INTERVAL 5 DAY")
def retention_filter(spark, d):
    a = table(spark, d, "articles").select(F.col("crawled_at").cast("timestamp").alias("m"))
    return files.older_than(a, "m", F.lit(AS_OF).cast("timestamp"), 5).agg(F.count("*").alias("n"))


@query("column_widths", " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(least(60, greatest(max(length(CAST({c} AS VARCHAR))), {len(c)}) + 2) AS INTEGER) AS width FROM sources" for c in ("source", "site_name", "tz_name", "credibility", "keep_pct")))
def column_widths(spark, d):
    return files.width(table(spark, d, "sources"))


@query("pipeline_labour", f"SELECT article_id, CAST(score AS INTEGER) AS score, {S_VERDICT(chr(39) + '2 Turun' + chr(39), chr(39) + '1 Naik' + chr(39), chr(39) + '3 Tetap' + chr(39), chr(39) + 'Unknown' + chr(39))} AS employment FROM (SELECT *, {sql_prefix()} AS score FROM (SELECT *, {S_ALL} AS t FROM articles WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM visited_urls v WHERE v.url = articles.url)) WHERE length(content) >= 150) WHERE score >= 20")
def pipeline_labour(spark, d):
    """Unseen pages of some length, scored, gated and given a verdict; the verdict comes last, on what is left."""
    a = table(spark, d, "articles").where("url IS NOT NULL").select("article_id", "title", "url", "content").where(F.length("content") >= 150)
    fresh = dedup.unseen(a, table(spark, d, "visited_urls"), "url")
    scored = fresh.select("article_id", whole(fresh).alias("t")).withColumn("score", scoring.prefix_score(F.col("t"))).where("score >= 20")
    return scored.select("article_id", "score", verdict.classify(F.col("t"))["employment"].alias("employment"))


@query("stream_dedup", "SELECT DISTINCT url FROM feed_entries WHERE url IS NOT NULL")
def stream_dedup(spark, d):
    from lexaudit.streaming import feed

    src = shared_path(spark, "entries")
    f = table(spark, d, "feed_entries").where("url IS NOT NULL")
    f.select("url", "site", "fetched_at").repartition(2).write.parquet(src)
    stream = feed.once(feed.entries(spark, src, f.select("url", "site", "fetched_at").schema), "url")
    return feed.drain(stream, shared_path(spark, "drained")).select("url")
