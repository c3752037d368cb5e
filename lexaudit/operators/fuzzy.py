"""Names matched by likeness."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, a whole row of its table at a time as the bits of a number."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    every = (1 << len(a)) - 1
    row = every
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    """200 times the longest common subsequence over both lengths."""
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """0-100: the best ratio between the common words alone and with either side's rest; words compare as sets."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common = " ".join(sorted(x & y))
    one = f"{common} {' '.join(sorted(x - y))}".strip()
    two = f"{common} {' '.join(sorted(y - x))}".strip()
    if common and (one == common or two == common):
        return 100.0
    pairs = [(one, two), *([(common, one), (common, two)] if common else [])]
    return max(_ratio(p, q) for p, q in pairs)


def best_matches(left: DataFrame, right: DataFrame, least: float = 70.0, rare: int | None = None) -> DataFrame:
    """left_id, right_id, score: for each name of left(id, name) the most alike of right(id, name), from a least score.

    Ties go to the lesser right id. A match shares a word; names compare in lower case; NULL and blank match nothing.
    By default every shared word makes a pair. With `rare`, words that more than so many right names hold make pairs
    only for names without a rarer word, which spares most of the work and can miss matches by stock words alone.
    """

    def words(d: DataFrame, side: str) -> DataFrame:
        clean = F.btrim(F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", " "))
        return d.select(F.col("id").alias(f"{side}_id"), clean.alias(f"{side}_name")).where(F.col(f"{side}_name") != "")

    a, b = words(left, "left"), words(right, "right")
    bw = b.select("right_id", "right_name", F.explode(F.array_distinct(F.split("right_name", " "))).alias("w"))
    aw = a.select("left_id", "left_name", F.explode(F.array_distinct(F.split("left_name", " "))).alias("w"))
    if rare is not None:
        df = bw.groupBy("w").agg(F.count("*").alias("df"))
        least_df = F.min("df").over(Window.partitionBy("left_id"))
        aw = aw.join(df, "w").withColumn("least_df", least_df).where((F.col("df") <= rare) | (F.col("df") == F.col("least_df")))

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(p, q) for p, q in zip(x, y)])

    pairs = aw.join(bw, "w").select("left_id", "left_name", "right_id", "right_name").distinct()
    scored = pairs.withColumn("score", score("left_name", "right_name")).where(F.col("score") >= least)
    best = scored.groupBy("left_id").agg(F.max_by(F.struct("right_id", "score"), F.struct("score", -F.col("right_id"))).alias("b"))
    return best.select("left_id", "b.right_id", "b.score")
