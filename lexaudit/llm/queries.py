"""Queries of the training-text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaudit.llm import boilerplate, cutoffs, history, leaks, nearcopies, packing, repeats, residue, splitting
from lexaudit.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


CUTOFF_SQL = """
WITH r AS (SELECT scored_id, max(lower(trim(source))) AS s, max(total_score) AS t FROM scored_articles
           WHERE scored_id IS NOT NULL AND trim(source) <> '' AND total_score IS NOT NULL AND NOT isnan(total_score) GROUP BY scored_id),
     c AS (SELECT s, t, count(*) AS n FROM r GROUP BY s, t),
     w AS (SELECT s, t, sum(n) OVER (PARTITION BY s ORDER BY t DESC) AS up, sum(n) OVER (PARTITION BY s) AS al FROM c),
     k AS (SELECT w.s, max(w.t) AS cutoff, max(w.al) AS al, min(w.up) AS kept, max(g.keep_pct) AS pct
           FROM w JOIN sources g ON lower(trim(g.source)) = w.s WHERE w.up * 100 >= g.keep_pct * w.al GROUP BY w.s)
"""


@query("p1_found", CUTOFF_SQL + "SELECT r.scored_id FROM r JOIN k ON r.s = k.s WHERE r.t >= k.cutoff")
def p1_found(spark, sf_dir):
    return cutoffs.kept_records(table(spark, sf_dir, "scored_articles"), table(spark, sf_dir, "sources"))


@query("p1_cutoffs", CUTOFF_SQL + "SELECT s AS source_key, CAST(pct AS INTEGER) AS keep_pct, cutoff, CAST(al AS BIGINT) AS n_records, CAST(kept AS BIGINT) AS n_kept FROM k")
def p1_cutoffs(spark, sf_dir):
    return cutoffs.score_cutoffs(cutoffs.scored_records(table(spark, sf_dir, "scored_articles")), table(spark, sf_dir, "sources"))


@query("p2_found")
def p2_found(spark, sf_dir):
    return history.repeated_addresses(table(spark, sf_dir, "articles"), table(spark, sf_dir, "visited_urls"))


@query("p2_similar")
def p2_similar(spark, sf_dir):
    """Rows whose address shares six tenths of its tokens, of all that either has, with one accepted before: near duplicates."""
    return history.repeated_addresses(table(spark, sf_dir, "articles"), table(spark, sf_dir, "visited_urls"), 0.6)


@query("p8_containers")
def p8_containers(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("p8_fill")
def p8_fill(spark, sf_dir):
    return packing.fill(packing.pack_documents(table(spark, sf_dir, "documents")), 4096)


@query("p9_found")
def p9_found(spark, sf_dir):
    return leaks.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


@query("p9_alignments")
def p9_alignments(spark, sf_dir):
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).where("score >= 16")


@query("p10_found")
def p10_found(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return splitting.oversized(texts, 1500).select(F.col("id").alias("doc_id"))


@query("p10_pieces")
def p10_pieces(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return splitting.split_texts(texts, 1500, 100).withColumnRenamed("id", "doc_id")


LINES_SQL = r"""
WITH a AS (SELECT article_id, lower(trim(source)) AS s, string_split(content, chr(10)) AS ls FROM articles WHERE trim(source) <> ''),
     l AS (SELECT article_id, s, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM a),
     k AS (SELECT article_id, s, line_no, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS key FROM l),
     t AS (SELECT s, count(*) AS total FROM a GROUP BY s),
     f AS (SELECT k.s, key FROM k JOIN t ON k.s = t.s WHERE key <> '' GROUP BY k.s, key
           HAVING count(DISTINCT article_id) >= 4 AND count(DISTINCT article_id) * 100 >= 3 * max(total))
"""


@query("p5_found", LINES_SQL + "SELECT article_id, CAST(line_no AS INTEGER) AS line_no FROM k JOIN f ON k.s = f.s AND k.key = f.key")
def p5_found(spark, sf_dir):
    return repeats.repeated_lines(table(spark, sf_dir, "articles"))


@query("p5_blocks")
def p5_blocks(spark, sf_dir):
    return repeats.block_report(table(spark, sf_dir, "articles"))


@query("p5_clean", LINES_SQL + """, g AS (SELECT k.article_id, k.line_no FROM k JOIN f ON k.s = f.s AND k.key = f.key),
     o AS (SELECT article_id, string_split(content, chr(10)) AS ls FROM articles WHERE content IS NOT NULL),
     u AS (SELECT article_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM o),
     r AS (SELECT u.article_id, string_agg(line, chr(10) ORDER BY u.line_no) FILTER (WHERE g.line_no IS NULL) AS t FROM u LEFT JOIN g ON u.article_id = g.article_id AND u.line_no = g.line_no GROUP BY u.article_id)
SELECT a.article_id, CASE WHEN a.content IS NOT NULL THEN md5(COALESCE(r.t, '')) END AS content_md5 FROM articles a LEFT JOIN r ON a.article_id = r.article_id""")
def p5_clean(spark, sf_dir):
    articles = table(spark, sf_dir, "articles")
    return repeats.without_lines(articles, repeats.repeated_lines(articles)).select("article_id", F.md5("content").alias("content_md5"))


PAIRS_SQL = r"""
WITH b AS (SELECT article_id, regexp_extract_all(lower(COALESCE(title, '')), '[\p{L}\p{N}]+') AS t, regexp_extract_all(lower(content), '[\p{L}\p{N}]+') AS c FROM articles WHERE content IS NOT NULL),
     w AS (SELECT article_id, list_concat(t, c) AS ws FROM b WHERE len(c) >= 60),
     g AS (SELECT article_id, hash(ws[i], ws[i + 1], ws[i + 2]) AS h FROM (SELECT article_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w) GROUP BY ALL),
     n AS (SELECT article_id, count(*) AS n FROM g GROUP BY article_id),
     p AS (SELECT x.article_id AS a, y.article_id AS b, count(*) AS c FROM g x JOIN g y ON x.h = y.h AND x.article_id < y.article_id GROUP BY 1, 2)
SELECT a AS article_a, b AS article_b FROM p JOIN n m ON m.article_id = a JOIN n o ON o.article_id = b WHERE 2 * c >= m.n + o.n - c
"""


@query("p7_found", PAIRS_SQL)
def p7_found(spark, sf_dir):
    return nearcopies.similar_pairs(table(spark, sf_dir, "articles"))


@query("p7_groups")
def p7_groups(spark, sf_dir):
    return nearcopies.similar_groups(table(spark, sf_dir, "articles"))


@query("p3_found")
def p3_found(spark, sf_dir):
    articles = table(spark, sf_dir, "articles")
    left_out = residue.residue_articles(articles)
    return boilerplate.split_pages(articles).where("NOT in_story").select("article_id", "line_no").join(left_out, "article_id", "left_anti")


@query("p4_found")
def p4_found(spark, sf_dir):
    return residue.residue_articles(table(spark, sf_dir, "articles"))
