"""Keeping one row of several, and membership in what was seen before."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexaudit.functions.text import normalize_key
from lexaudit.session import materialize


def keep_one(rows: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each key by an order, which should have no ties. NULL keys are equal. Extra columns stay."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_per_group(rows: DataFrame, keys: list, order: list[Column], n: int) -> DataFrame:
    """At most n rows of each key, the first by an order: a report with a stated limit."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def dedup_key(url: Column, title: Column, source: Column) -> Column:
    """The normalised url, else a hash of title and source."""
    return F.coalesce(F.nullif(normalize_key(url), F.lit("")), F.md5(F.concat_ws("|", normalize_key(title), normalize_key(source))))


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in seen; rows with NULL key stay. The seen side is used once per value."""
    return rows.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def greedy_two_keys(rows: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """Rows kept in order, unless one kept before has the same a or the same b. `order` is a unique bigint.

    Only rows tied by shared keys decide on one another: rows are gathered by connected component and gone through in
    order. Components are found by passing on the least order number until nothing changes; each round is written to
    the shared folder. A row with both keys unique is kept without that. NULL keys tie nothing.
    """
    na = F.count("*").over(Window.partitionBy(a))
    nb = F.count("*").over(Window.partitionBy(b))
    base = rows.withColumn("_lone", (F.col(a).isNull() | (na == 1)) & (F.col(b).isNull() | (nb == 1)))
    base = materialize(base, "rows")
    lone, tied = base.where("_lone").drop("_lone"), base.where("NOT _lone").drop("_lone")
    labels = materialize(tied.select(F.col(order).alias("_o"), F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(order).alias("_l")), "labels")
    while True:
        la = F.when(F.col("_a").isNotNull(), F.min("_l").over(Window.partitionBy("_a")))
        step = labels.withColumn("_n", F.coalesce(la, F.col("_l")))
        lb = F.when(F.col("_b").isNotNull(), F.min("_n").over(Window.partitionBy("_b")))
        step = materialize(step.withColumn("_m", F.coalesce(lb, F.col("_n"))), "labels")
        if step.where("_m <> _l").isEmpty():
            break
        labels = step.select("_o", "_a", "_b", F.col("_m").alias("_l"))

    def one(g: pd.DataFrame) -> pd.DataFrame:
        seen_a, seen_b, keep = set(), set(), []
        for r in g.sort_values("_o").itertuples(index=False):
            if r[1] is not None and r[1] in seen_a or r[2] is not None and r[2] in seen_b:
                continue
            seen_a.add(r[1])
            seen_b.add(r[2])
            keep.append(r[0])
        return pd.DataFrame({"_o": keep})

    kept = labels.select("_o", "_a", "_b", "_l").groupBy("_l").applyInPandas(lambda g: one(g), "_o bigint")
    return lone.unionByName(tied.join(kept, F.col(order) == F.col("_o"), "left_semi"))


def merged(files: list[DataFrame], key: str, order: list[Column]) -> DataFrame:
    """Files of differing columns as one, one row a key."""
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return keep_one(out, [key], order)
