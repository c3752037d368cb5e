"""Structured verdicts by a pluggable classifier; a rule stands in for a model. And the filters on verdicts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaudit import lexicon

SCHEMA = "employment string, unemployment string, confidence int"


def rule(text: Column) -> Column:
    """A verdict as a model would give it: losses outweigh gains, issues alone change nothing; NULL without any sign."""
    loss, gain, issue = (lexicon.any_of(text, s) for s in ("labour_negative", "labour_positive", "labour_issue"))

    def v(a: str, b: str, c: int) -> Column:
        return F.struct(F.lit(a).alias("employment"), F.lit(b).alias("unemployment"), F.lit(c).alias("confidence"))

    return F.when(loss, v("2 Turun", "1 Naik", 80)).when(gain, v("1 Naik", "2 Turun", 80)).when(issue, v("3 Tetap", "3 Tetap", 60))


def classify(text: Column, model: Callable[[Column], Column] = rule, fallback: str = "Unknown") -> Column:
    """The model's verdict, or one of fallback values where it gives none; the model may be any column function."""
    empty = F.struct(F.lit(fallback).alias("employment"), F.lit(fallback).alias("unemployment"), F.lit(0).alias("confidence"))
    return F.coalesce(model(text), empty)


def passes(verdict: Column, refused: list[str], ignore_case: bool = False) -> Column:
    """False where a verdict has one of the refused phrases; NULL passes."""
    v = F.coalesce(verdict, F.lit(""))
    v, phrases = (F.lower(v), [p.lower() for p in refused]) if ignore_case else (v, refused)
    out = F.lit(True)
    for p in phrases:
        out = out & ~v.contains(p)
    return out


def in_batches(rows: DataFrame, key: str, text: str, model: Callable[[list[str]], list[str | None]], none: str = "Unknown", size: int = 64) -> DataFrame:
    """key, verdict of every row, from a model that takes lists of at most `size` texts.

    NULL and empty texts aren't sent. Where the model fails on a list, its texts are sent one by one; a text on which it
    fails alone, or for which it gives NULL, has the verdict `none`.
    """
    kind = rows.schema[key].dataType.simpleString()

    def asked(texts: list[str]) -> list[str | None]:
        try:
            got = list(model(texts))
            if len(got) == len(texts):
                return got
        except Exception:  # noqa: BLE001  whatever the model raises costs no row
            pass
        return [None] if len(texts) == 1 else [v for t in texts for v in asked([t])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[str | None] = [None] * len(b)
            texts = b["text"].tolist()
            send = [k for k, t in enumerate(texts) if isinstance(t, str) and t]
            for s in range(0, len(send), size):
                part = send[s : s + size]
                for k, v in zip(part, asked([texts[k] for k in part])):
                    out[k] = v
            yield pd.DataFrame({"key": b["key"], "verdict": [none if v is None else v for v in out]})

    sent = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return sent.mapInPandas(run, f"key {kind}, verdict string").withColumnRenamed("key", key)
