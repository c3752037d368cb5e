"""Documents into containers of fixed capacity (problem 8).

First-fit decreasing by a tournament tree over the bins' free room, run independently in randomised groups of
documents: groups are bounded in size, so no task sees an unbounded share, and a random group has the mix of sizes of
the whole, so little room is lost to the grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaudit.llm.tokens import DEFAULT_RANKS, counter
from lexaudit.session import materialize

#: Items a group holds on average.
GROUP_ITEMS = 20_000


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item: in order of falling size (ties by place), each goes to the first bin with room for it.

    The tree's leaves are bins in the order they are opened, each inner node holds the greatest free room below it; the
    leftmost leaf with room is found by descent. Items larger than the capacity raise ValueError.
    """
    n = len(sizes)
    if n and max(sizes) > capacity:
        raise ValueError("an item exceeds the capacity")
    leaves = 1 << max(0, n - 1).bit_length()
    free = [capacity] * (2 * leaves)  # bins not yet opened have all their room
    bins = [0] * n
    for i in sorted(range(n), key=lambda k: (-sizes[k], k)):
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bins[i] = node - leaves
        free[node] -= size
        node //= 2
        while node:
            left, right = free[2 * node], free[2 * node + 1]
            free[node] = left if left > right else right
            node //= 2
    return bins


def token_sizes(documents: DataFrame, ranks: str = DEFAULT_RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and n_tokens of every document with an id; NULL text counts as empty. Extra columns are left out."""
    ident = documents.schema[id_col].dataType.simpleString()

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(ranks)
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "n_tokens": [c.count(t) if t else 0 for t in b["text"]]})

    return documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL").mapInPandas(sizes, f"id {ident}, n_tokens bigint")


def pack(sizes: DataFrame, capacity: int, seed: int = 7, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Packs sizes(id, n_tokens): container, place, id, part_no, part_tokens, from_token.

    Every row of sizes is packed once, whole, in one container; only a row larger than the capacity is cut, into parts
    of the full capacity and a rest. Empty documents take no room and are packed too. container is a text: group and
    number in the group. Rows with equal ids are separate items. Nothing is dropped.
    """
    sizes = materialize(sizes, "sizes")
    many = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity).cast("int"))
    n = sizes.agg(F.coalesce(F.sum(many), F.lit(0))).first()[0]
    groups = max(1, -(-n // group_items))
    parts = F.sequence(F.lit(0), many - 1)
    items = (
        sizes.select("id", "n_tokens", F.explode(parts).alias("part_no"))
        .withColumn("part_tokens", F.least(F.lit(capacity), F.col("n_tokens") - F.col("part_no").cast("bigint") * capacity))
        .withColumn("grp", F.pmod(F.xxhash64("id", "part_no", F.lit(seed)), F.lit(groups)).cast("int"))
        .drop("n_tokens")
    )
    ident = sizes.schema["id"].dataType.simpleString()

    def one(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["id", "part_no"], kind="stable")
        bins = first_fit_decreasing(g["part_tokens"].tolist(), capacity)
        g = g.assign(container=[f"{int(k)}-{b}" for k, b in zip(g["grp"], bins)], from_token=g["part_no"].astype("int64") * capacity)
        g["place"] = g.groupby("container").cumcount() + 1
        return g[["container", "place", "id", "part_no", "part_tokens", "from_token"]]

    return items.groupBy("grp").applyInPandas(one, f"container string, place bigint, id {ident}, part_no int, part_tokens bigint, from_token bigint")


def pack_documents(documents: DataFrame, capacity: int = 4096, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """The contents of each container: container, place, doc_id, part_no, part_tokens, from_token."""
    return pack(token_sizes(documents, ranks), capacity).withColumnRenamed("id", "doc_id")


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """How well a packing fills: n_containers, n_items, n_tokens, free_share, lower_bound (containers no packing can go below)."""
    per = packed.groupBy("container").agg(F.sum("part_tokens").alias("used"), F.count("*").alias("items"))
    return per.agg(
        F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), F.sum("used").alias("n_tokens"),
        (1 - F.sum("used") / (F.count("*") * capacity)).alias("free_share"), F.ceil(F.sum("used") / capacity).alias("lower_bound"),
    )
