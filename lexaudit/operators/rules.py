"""Ordered rules: the first that holds gives the reason. NULL conditions don't hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(rules: list[tuple[Column, str]], none: str) -> Column:
    """The reason of the first rule that holds, else `none`."""
    out = F.when(F.lit(False), F.lit(none))
    for condition, reason in rules:
        out = out.when(F.coalesce(condition, F.lit(False)), F.lit(reason))
    return out.otherwise(F.lit(none))


def tally(rows: DataFrame, reason: Column) -> DataFrame:
    """reason, n: how many rows each reason has."""
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
