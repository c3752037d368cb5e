"""Lines repeated across one source's documents (problem 5).

Lines become identifiers; those that too few documents of a source hold to be in any repeated block end a run. What
remains of the concatenated documents are short runs. Their suffixes, sorted within source and first line, are a suffix
array; a pass along it with the common prefixes of neighbours counts the documents of every block of one or more lines,
holding no more than the stack of open prefixes, and keeps those that span many documents. The lines of these blocks are
deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexaudit.session import materialize, source_key


def document_lines(articles: DataFrame) -> DataFrame:
    """article_id, source_key and lines: array of (line_no, key) of the lines that have letters.

    key is a hash of the line's letters without case. line_no counts from 1 and counts blank lines. Rows with NULL
    source or id are left out.
    """
    letters = lambda x: F.regexp_replace(F.lower(x), r"[^\p{L}]+", "")
    numbered = F.transform(F.split("content", "\n"), lambda x, i: F.struct((i + 1).alias("line_no"), letters(x).alias("letters")))
    kept = F.filter(numbered, lambda x: x["letters"] != "")
    keyed = F.transform(kept, lambda x: F.struct(x["line_no"].alias("line_no"), F.xxhash64(x["letters"]).alias("key")))
    return articles.select("article_id", source_key("source").alias("source_key"), keyed.alias("lines")).where("source_key IS NOT NULL AND article_id IS NOT NULL")


#: Lines of a suffix; longer blocks are found as their stretches of so many lines.
LONGEST = 256


def shared_lines(lines: DataFrame, least_docs: int, least_pct: float) -> DataFrame:
    """source_key, key, least (documents it takes), of lines in least_docs documents of their source: those of all blocks are.

    Counts are combined before the shuffle, so that a source with most of the rows is counted in all tasks.
    """
    totals = lines.groupBy("source_key").agg(F.count("*").alias("total"))
    counts = lines.select("source_key", F.explode(F.array_distinct("lines.key")).alias("key")).groupBy("source_key", "key").agg(F.count("*").alias("n_docs"))
    some = counts.where(F.col("n_docs") >= least_docs).join(totals, "source_key")
    least = F.greatest(F.lit(least_docs), F.ceil(F.col("total") * least_pct / 100 - 1e-9)).cast("bigint")
    return some.select("source_key", "key", least.alias("least"))


def line_runs(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """article_id, source_key, line_nos, keys of each run of shared lines with none but letterless lines between."""
    each = lines.select("article_id", "source_key", F.posexplode("lines").alias("place", "line")).select("article_id", "source_key", "place", "line.line_no", "line.key")
    held = each.join(shared.select("source_key", "key"), ["source_key", "key"])
    # places less their rank are equal along a run
    rank = F.row_number().over(Window.partitionBy("article_id").orderBy("place"))
    runs = held.withColumn("run", F.col("place") - rank).groupBy("article_id", "source_key", "run").agg(F.array_sort(F.collect_list(F.struct("line_no", "key"))).alias("r"))
    return runs.select("article_id", "source_key", F.col("r.line_no").alias("line_nos"), F.col("r.key").alias("keys"))


def _common(a, b):
    """How many elements two arrays begin with in common."""
    both = F.least(F.size(a), F.size(b))
    at = F.array_position(F.zip_with(F.slice(a, F.lit(1), both), F.slice(b, F.lit(1), both), lambda x, y: x != y), True)
    return F.when(at > 0, at.cast("int") - 1).otherwise(both)


def repeated_blocks(runs: DataFrame, shared: DataFrame) -> DataFrame:
    """source_key, block (array of keys), n_docs of every block of lines that spans enough documents of its source.

    A block is reported with the longest common continuation of its occurrences; a document counts once, however often and
    with whatever continuations it has the block: of its own suffixes, each but the first takes one off what it has in
    common with the one before.
    """
    n = F.size("keys")
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.slice("keys", i, F.least(n - i + 1, F.lit(LONGEST))))
    own = runs.groupBy("article_id", "source_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(suffixes)))).alias("own"))
    # an article_id that several sources hold counts in each
    many = F.size("own")
    less = F.transform(F.sequence(F.lit(1), many), lambda i: F.when(i > 1, F.slice(F.get("own", i - 1), F.lit(1), _common(F.get("own", i - 2), F.get("own", i - 1)))).otherwise(F.array().cast("array<bigint>")))
    rows = own.select("source_key", F.inline(F.arrays_zip(F.col("own").alias("suffix"), less.alias("less"))))
    weighed = rows.select("source_key", F.inline(F.array(F.struct(F.col("suffix"), F.lit(1).alias("w")), F.struct(F.col("less").alias("suffix"), F.lit(-1).alias("w")))))
    weighed = weighed.where("size(suffix) > 0").groupBy("source_key", "suffix").agg(F.sum("w").alias("w")).withColumn("head", F.get("suffix", F.lit(0)))
    least = shared.select("source_key", F.col("key").alias("head"), "least")
    ordered = weighed.join(least, ["source_key", "head"]).repartition("source_key", "head").sortWithinPartitions("source_key", "head", "suffix")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list[int]] = []  # open prefixes of the last suffix: length and documents so far
        last: list[int] = []
        source, least = None, 0
        for b in batches:
            out: list[tuple] = []

            def close(h: int, out=out) -> None:
                carry = 0
                while stack and stack[-1][0] > h:
                    length, docs = stack.pop()
                    carry += docs
                    if carry >= least:
                        out.append((source, last[:length], carry))
                if carry and h:
                    if stack and stack[-1][0] == h:
                        stack[-1][1] += carry
                    else:
                        stack.append([h, carry])

            for r in b.itertuples(index=False):
                s = list(r.suffix)
                h = 0
                if r.source_key == source:
                    while h < len(s) and h < len(last) and s[h] == last[h]:
                        h += 1
                close(h)
                source, least, last = r.source_key, r.least, s
                stack.append([len(s), r.w])
            if out:
                yield pd.DataFrame(out, columns=["source_key", "block", "n_docs"])
        rest: list[tuple] = []
        while stack:
            length, docs = stack.pop()
            if docs >= least:
                rest.append((source, last[:length], docs))
            if stack:
                stack[-1][1] += docs
        yield pd.DataFrame(rest, columns=["source_key", "block", "n_docs"])

    return ordered.select("source_key", "suffix", "w", "least").mapInPandas(scan, "source_key string, block array<bigint>, n_docs bigint")


def repeated_lines(articles: DataFrame, least_docs: int = 4, least_pct: float = 3.0) -> DataFrame:
    """article_id, line_no of every occurrence of a line that belongs to a block spanning many documents of its source.

    Enough are least_docs documents that are at least least_pct percent of all rows of the source. Lines are the same
    if their letters are, without case. NULL content has no lines but counts as a row. Empty tables give no rows.
    """
    runs, shared = _runs(articles, least_docs, least_pct)
    inside = repeated_blocks(runs, shared).select("source_key", F.explode("block").alias("key")).distinct()
    each = runs.select("article_id", "source_key", F.inline(F.arrays_zip(F.col("line_nos").alias("line_no"), F.col("keys").alias("key"))))
    return each.join(inside, ["source_key", "key"], "left_semi").select("article_id", "line_no")


def _runs(articles: DataFrame, least_docs: int, least_pct: float) -> tuple[DataFrame, DataFrame]:
    lines = document_lines(articles)
    shared = materialize(shared_lines(lines, least_docs, least_pct), "shared")
    return materialize(line_runs(lines, shared), "runs"), shared


def block_report(articles: DataFrame, least_docs: int = 4, least_pct: float = 3.0) -> DataFrame:
    """source_key, first_key (of its first line), n_lines, n_docs of the repeated blocks of every source."""
    blocks = repeated_blocks(*_runs(articles, least_docs, least_pct))
    return blocks.select("source_key", F.get("block", F.lit(0)).alias("first_key"), F.size("block").alias("n_lines"), "n_docs")


def without_lines(articles: DataFrame, found: DataFrame) -> DataFrame:
    """articles with the lines of found(article_id, line_no) deleted from content; other rows and columns as they are."""
    drop = found.groupBy("article_id").agg(F.collect_set("line_no").alias("_drop"))
    kept = F.filter(F.split("content", "\n"), lambda x, i: ~F.array_contains("_drop", i + 1))
    joined = articles.join(drop, "article_id", "left")
    return joined.withColumn("content", F.when(F.col("_drop").isNull(), F.col("content")).otherwise(F.array_join(kept, "\n"))).select(articles.columns)
