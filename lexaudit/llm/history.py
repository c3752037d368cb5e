"""New batches against everything accepted before (problem 2).

An address is reduced to the tokens that decide which story it leads to. An inverted index holds, for every distinct
token set accepted so far, the rare-token prefix that any similar set must share, in a table bucketed by token that
only ever grows. A batch probes the index with its own prefixes, filters by length, verifies the overlap and appends
the postings of what is new. The history's texts aren't read or made into tokens again; of its postings, each batch scans
the buckets, and shuffles none of them as long as the plan joins by bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaudit.session import barrier, remove_path, shared_path

# Query parameters that carry tracking, presentation or the way a reader came.
TRACKING = (
    r"utm_\w+|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_[ce]id|_ga|ref|referrer|source|src|share|shared|from|via|amp|print|cetak|single|page|halaman|"
    r"oc|s|hl|gl|ceid|xtor|cmp|cid|ncid|ito|feature|view|mode|output|outputtype|medium|campaign"
)
#: Parameters in which redirects of feed services carry the target, and parameters that number a story.
TARGET = r"(?:u|url|q|to|target|link|dest|redirect)"
NUMBER = r"(?:id|p|article_?id|news_?id|story_?id|artikel|berita_?id)"


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def _unwrap(u: Column) -> Column:
    """The target of a feed service's redirect, else the address itself."""
    param = _decode(F.regexp_extract(u, rf"(?i)^https?://[^?#]*\?(?:[^#]*&)?{TARGET}=(https?(?:%3a|:)[^&#]+)", 1))
    segment = F.regexp_extract(u, r"/articles/([A-Za-z0-9_-]{16,})=*(?:[/?#]|$)", 1)
    # without padding, and cut to whole groups of four so that any rest can't spoil the decoding
    padded = F.rpad(F.translate(segment, "-_", "+/"), (F.ceil(F.length(segment) / 4) * 4).cast("int"), F.lit("="))
    packed = F.regexp_extract(F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1"), r"(https?://[\x21-\x7e]+)", 1)
    return F.coalesce(F.nullif(param, F.lit("")), F.nullif(F.coalesce(packed, F.lit("")), F.lit("")), u)


def with_story_tokens(df: DataFrame, url: str) -> DataFrame:
    """Adds tokens, array<string>: the sorted tokens that decide which story an address leads to; NULL for NULL or blank.

    Transport, device and print versions, ports, tracking, fragments, case and feed redirects leave no trace. A
    numbered story is its site and number; any other is its site with every part of path and query. Every token names
    the site, so that addresses of different sites share none.
    """
    d = df.withColumn("_u", F.nullif(F.btrim(F.regexp_replace(url, r"[\s\p{Cc}]+", "")), F.lit("")))
    d = barrier(d.withColumn("_u", _unwrap(F.col("_u"))), "_u")
    d = d.withColumn("_u", F.lower(_unwrap(F.col("_u"))))
    d = barrier(d.withColumn("_u", F.regexp_replace(F.regexp_replace("_u", r"^(?:[a-z][a-z0-9+.-]*:)?//", ""), r"#.*$", "")), "_u")
    host = F.regexp_replace(F.regexp_extract("_u", r"^([^/?]*)", 1), r"^[^@]*@|:\d*$|\.$", "")
    d = d.withColumns({"_h": F.regexp_replace(host, r"^(?:(?:www\d?|m|amp|mobile|wap|print|cetak)\.)+(?=.*\.)", ""), "_p": F.regexp_extract("_u", r"^[^/?]*([^?]*)", 1)})
    d = d.withColumn("_p", F.regexp_replace(_decode(F.col("_p")), r"/+", "/"))
    path = F.regexp_replace("_p", r"(?:/(?:amp|print|cetak|all)|/page/\d+|/)+$", "")
    params = F.filter(F.split(F.regexp_extract("_u", r"\?(.*)$", 1), "[&;]"), lambda x: (x != "") & ~x.rlike(rf"^(?:{TRACKING})(?:=|$)"))
    d = barrier(d.withColumns({"_p": F.regexp_replace(path, r"\.(?:amp\.)?(?:s?html?|php|aspx?)$|/index(?:\.\w+)?$", ""), "_q": params}), "_h", "_p", "_q")
    day = F.regexp_extract("_p", r"/(\d{4}/\d{1,2}/\d{1,2})(?:/|$)", 1)
    of_query = F.nullif(F.regexp_extract(F.array_join("_q", "&"), rf"(?:^|&){NUMBER}=(\d+)(?:&|$)", 1), F.lit(""))
    # a segment of digits, digits that end a segment, digits that begin one
    of_path = F.regexp_extract("_p", r"/(?:(?:[a-z]{1,4}-?)?(\d{5,})(?=/|$)|(?:[^/]*-)(\d{5,})$|(\d{5,})-[^/]*$)", 0)
    d = d.withColumns({"_d": day, "_n": F.coalesce(of_query, F.when(day == "", F.nullif(F.regexp_extract(of_path, r"(\d{5,})(?:/|$)|/(\d{5,})-", 0), F.lit("")))) })
    number = F.regexp_replace(F.regexp_replace("_n", r"\D", ""), "^0+(?=.)", "")
    rest = F.filter(F.split(F.regexp_replace("_p", r"/\d{4}/\d{1,2}/\d{1,2}(?=/|$)", ""), r"/"), lambda x: x != "")
    parts = F.transform(rest, lambda x, i: F.concat(F.lit("/"), i.cast("string"), F.lit(":"), x))
    plain = F.concat(F.array(F.concat(F.lit("@"), F.col("_d"))), parts, F.transform("_q", lambda x: F.concat(F.lit("?"), x)))
    tokens = F.when(F.col("_n").isNotNull(), F.array(F.concat(F.lit("#"), number))).otherwise(plain)
    d = d.withColumn("tokens", F.when(F.col("_h") != "", F.array_sort(F.array_distinct(F.transform(tokens, lambda x: F.concat("_h", x))))))
    return barrier(d.drop("_u", "_h", "_p", "_q", "_d", "_n"), "tokens")


class HistoryIndex:
    """An incremental inverted index over token sets, for Jaccard similarity of at least `threshold`.

    postings: token, batch, n (size of the set), tokens; one row for each token of the set's rare prefix, bucketed by
    token. order: token, df, counted over the first batch and frozen, so that a set's prefix never changes; tokens it
    doesn't know are the rarest. Both live in the session's shared folder and survive lost executors.
    """

    def __init__(self, spark: SparkSession, threshold: float = 1.0, buckets: int | None = None) -> None:
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be in (0, 1]")
        self.spark, self.threshold = spark, threshold
        self.buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.root = shared_path(spark, "history")
        self.name = f"lexaudit_postings_{uuid.uuid4().hex}"
        self.order: DataFrame | None = None
        self.empty = True

    def _prefixed(self, sets: DataFrame) -> DataFrame:
        """Adds prefix: the n - ceil(t n) + 1 rarest tokens, of which similar sets share one."""
        size = F.size("tokens")
        keep = size - F.ceil(F.round(self.threshold * size, 9)).cast("int") + 1
        single = sets.where(F.size("tokens") == 1).withColumn("prefix", F.col("tokens"))
        several = (
            sets.where(F.size("tokens") > 1)
            .select("*", F.explode("tokens").alias("_t"))
            .join(self.order.select(F.col("token").alias("_t"), "df"), "_t", "left")
            .groupBy("sig")
            .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("_t").alias("t")))).alias("_o"))
        )
        several = sets.join(several, "sig").withColumn("prefix", F.slice(F.col("_o.t"), F.lit(1), keep)).drop("_o")
        return single.unionByName(several)

    def _postings(self, sets: DataFrame, batch: int) -> DataFrame:
        return sets.select(F.explode("prefix").alias("token"), F.lit(batch).alias("batch"), F.size("tokens").alias("n"), "tokens")

    def _append(self, postings: DataFrame) -> None:
        w = postings.repartition(self.buckets, "token").write.mode("append").format("parquet").bucketBy(self.buckets, "token")
        w.option("path", f"{self.root}/postings").saveAsTable(self.name)
        self.empty = False

    def _similar(self, a: Column, b: Column) -> Column:
        common = F.size(F.array_intersect(a, b))
        return common >= F.lit(self.threshold) * (F.size(a) + F.size(b) - common) - 1e-9

    def start(self, rows: DataFrame) -> None:
        """Fits the token order on rows(tokens) and indexes them as batch 0. Rows without tokens are ignored."""
        sets = rows.where("size(tokens) > 0").select(F.xxhash64("tokens").alias("sig"), "tokens").groupBy("sig").agg(F.first("tokens").alias("tokens"))
        path = f"{self.root}/sets"
        sets.write.parquet(path)
        sets = self.spark.read.parquet(path)
        # the order of a set's only token is never asked for
        sets.where(F.size("tokens") > 1).select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")).write.parquet(f"{self.root}/order")
        self.order = self.spark.read.parquet(f"{self.root}/order")
        self._append(self._postings(self._prefixed(sets), 0))

    def batch(self, rows: DataFrame, number: int, out: str) -> None:
        """Probes with rows(id, sig, tokens), sig the xxhash64 of the tokens, writes the id of every row similar to an earlier one to `out`, appends the rest.

        Earlier are all former batches and the rows of this one with a lesser id. Equal token sets are one set in every
        join, so that a story fetched any number of times makes one posting and no pairs.
        """
        sets = rows.groupBy("sig").agg(F.min("id").alias("first_id"), F.first("tokens").alias("tokens"))
        probes = self._prefixed(sets).select("sig", "first_id", "tokens", F.size("tokens").alias("n"), "prefix")
        t = self.threshold
        keyed = probes.select("sig", "first_id", "tokens", "n", F.explode("prefix").alias("token"))
        old = self.spark.table(self.name).where(F.col("batch") < number).select("token", F.col("n").alias("m"), F.col("tokens").alias("other"))
        fits = (F.col("m") >= F.lit(t) * F.col("n") - 1e-9) & (F.col("n") >= F.lit(t) * F.col("m") - 1e-9)
        known = keyed.join(old, "token").where(fits & self._similar(F.col("tokens"), F.col("other"))).select("sig")
        if t < 1:  # different sets of one batch can be similar
            own = keyed.select("token", F.col("n").alias("m"), F.col("tokens").alias("other"), F.col("first_id").alias("other_id"))
            near = keyed.join(own, "token").where((F.col("other_id") < F.col("first_id")) & fits & self._similar(F.col("tokens"), F.col("other")))
            known = known.unionByName(near.select("sig"))
        state = f"{self.root}/state-{number}"
        probes.join(known.distinct().withColumn("known", F.lit(True)), "sig", "left").write.parquet(state)
        state_df = self.spark.read.parquet(state)
        hit = rows.join(state_df.select("sig", "first_id", "known"), "sig").where(F.col("known") | (F.col("id") != F.col("first_id")))
        hit.select("id", F.lit(number).alias("batch")).write.mode("append").parquet(out)
        # at a threshold of 1 a known set is in the index already
        self._append(self._postings(state_df.where("known IS NULL") if t == 1 else state_df, number))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.root)


def repeated_addresses(articles: DataFrame, visited: DataFrame, threshold: float = 1.0) -> DataFrame:
    """article_id of every row whose address leads to the story of a visited one or of an earlier row.

    Earlier is by (batch_no, article_id). Rows with NULL or blank url, NULL id or NULL batch are no case; blank visited
    rows are ignored. Equal rows count as copies of one another: all but the one with the least id are listed once.
    """
    spark = articles.sparkSession
    index = HistoryIndex(spark, threshold)
    out = shared_path(spark, "repeats")
    index.start(with_story_tokens(visited, "url"))
    rows = articles.where("batch_no IS NOT NULL AND article_id IS NOT NULL").select("batch_no", F.col("article_id").alias("id"), "url")
    inbox = f"{index.root}/inbox"  # a folder a batch, as batches arrive
    with_story_tokens(rows, "url").where("size(tokens) > 0").select("batch_no", "id", F.xxhash64("tokens").alias("sig"), "tokens").write.partitionBy("batch_no").parquet(inbox)
    schema = "id bigint, sig bigint, tokens array<string>, batch_no int"
    numbers = sorted(r[0] for r in spark.read.schema(schema).parquet(inbox).select("batch_no").distinct().collect())  # a row a batch
    spark.createDataFrame([], "id bigint, batch int").write.parquet(out)
    for place, number in enumerate(numbers, 1):
        index.batch(spark.read.schema(schema).parquet(inbox).where(F.col("batch_no") == number), place, out)
    index.close()
    return spark.read.schema("id bigint, batch int").parquet(out).select(F.col("id").alias("article_id")).distinct()
