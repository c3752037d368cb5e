"""Phrases in texts: all their places, and which of overlapping ones stay."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_spans(texts: DataFrame, phrases: list[tuple[str, str]], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, category, phrase, start, stop of every occurrence of (category, phrase), positions in characters from 0.

    Overlapping occurrences count; a phrase must not continue into a letter or digit at either end. NULL has none.
    """
    import ahocorasick  # noqa: F401  the worker's library, reported here if it is missing

    ident = texts.schema[id_col].dataType.simpleString()
    wanted = [(c, p.lower()) for c, p in phrases]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        by: dict[str, list[str]] = {}
        for c, p in wanted:
            by.setdefault(p, []).append(c)
        for p, cs in by.items():
            automaton.add_word(p, (p, cs))
        automaton.make_automaton()
        for b in batches:
            out = []
            for i, text in zip(b["id"], b["text"]):
                if not isinstance(text, str):
                    continue
                t = text.lower()
                for end, (p, cs) in automaton.iter(t):
                    s = end + 1 - len(p)
                    if (s and t[s - 1].isalnum()) or (end + 1 < len(t) and t[end + 1].isalnum()):
                        continue
                    out += [(i, c, p, s, end + 1) for c in cs]
            yield pd.DataFrame(out, columns=["id", "category", "phrase", "start", "stop"])

    return texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(find, f"id {ident}, category string, phrase string, start int, stop int")


def sweep(spans: Column) -> Column:
    """Of array<struct<start,stop,...>>, by start and then by length, those that don't overlap the last one kept; a longer
    one takes the place of the last."""

    def less(a, b):
        la, lb = a["stop"] - a["start"], b["stop"] - b["start"]
        return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(la > lb, -1).when(la < lb, 1).otherwise(0)

    ordered = F.array_sort(spans, less)
    start = F.slice(ordered, 1, 0)

    def merge(kept, x):
        last = F.try_element_at(kept, F.lit(-1))
        longer = x["stop"] - x["start"] > last["stop"] - last["start"]
        return (
            F.when((F.size(kept) == 0) | (x["start"] >= last["stop"]), F.array_append(kept, x))
            .when(longer, F.array_append(F.slice(kept, F.lit(1), F.size(kept) - 1), x))
            .otherwise(kept)
        )

    return F.aggregate(ordered, start, merge)


def kept_spans(found: DataFrame) -> DataFrame:
    """The spans of find_spans() that a sweep keeps, one row each."""
    per = found.groupBy("id").agg(sweep(F.array_sort(F.collect_list(F.struct("start", "stop", "category", "phrase")))).alias("s"))
    return per.select("id", F.inline("s"))


def summarize(kept: DataFrame, high: list[str]) -> DataFrame:
    """id, n, n_high, categories (sorted) of kept spans."""
    return kept.groupBy("id").agg(
        F.count("*").alias("n"), F.sum(F.col("category").isin(high).cast("bigint")).alias("n_high"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories")
    )


def pattern_spans(text: str, patterns: list[str]) -> list[tuple[int, int, str]]:
    """All matches of patterns in one text, for tests and small inputs."""
    return [(m.start(), m.end(), m.group()) for p in patterns for m in re.finditer(p, text)]
