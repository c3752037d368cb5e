"""Evaluation texts in training text (problem 9).

Every run of SEED words of a test item that few items share is a seed; so is the rarest of each window of WINDOW words, so
that no run of that length goes without one, common lead-ins included. Seeds join documents to items: they are sought in
the stream of a document's letters and digits, so that case, punctuation, markup, line breaks and words broken by
invisible characters or line ends make no difference. Around the seeds of a document, Smith-Waterman aligns its words with
the item's, which scores copies with edits too; a score that a run could have is followed by the exact count of its words.
The test items are the stated query set: they are broadcast in blocks of bounded size.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a seed, and of the windows of each of which one seed at least is sought.
SEED, WINDOW = 5, 10
#: A seed that no more items share is rare, and sought as well.
RARE = 3
#: Characters of item text in a block that is sent to the workers.
BLOCK_CHARS = 8_000_000
MATCH, MISMATCH, GAP = 2, -1, -1

_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]")
_BROKEN = re.compile(r"(?<=[^\W_])[-‐‑¬][ \t]*\r?\n[\s>|*#]*(?=[^\W_])")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_LINK = re.compile(r"\]\((?:[^()\s]|\([^()\s]*\))*\)")
_WORD = re.compile(r"[^\W_]+")
_NOT_WORD = re.compile(r"[\W_]+")


def visible(text: str) -> str:
    """What a reader sees of a text: no markup, no invisible characters, words broken at a line end joined; lower case."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "](" in text:
        text = _LINK.sub("]", text)
    if "&" in text:
        text = html.unescape(text)
    return _BROKEN.sub("", _INVISIBLE.sub("", text)).lower()


def rare_seeds(spread: list[int]) -> list[int]:
    """The places of the seeds to seek, of which spread tells how many items have each: all rare ones, and the
    rarest of every window, the first of equals."""
    width = WINDOW - SEED + 1
    windows = range(max(1, len(spread) - width + 1)) if spread else ()
    rarest = {min(range(w, min(w + width, len(spread))), key=lambda k: (spread[k], k)) for w in windows}
    return sorted(rarest | {k for k, n in enumerate(spread) if n <= RARE})


class ItemIndex:
    """The rare seeds of a block of items, as an automaton over letter streams."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        import ahocorasick

        self.words = {i: _WORD.findall(visible(t)) for i, t in items}
        self.numbers = {i: {x: n for n, x in enumerate(dict.fromkeys(w))} for i, w in self.words.items()}
        self.coded = {i: [self.numbers[i][x] for x in w] for i, w in self.words.items()}
        self.streams = {i: "".join(w) for i, w in self.words.items()}
        #: where words begin in an item's stream, and its length
        self.marks = {i: list(accumulate(map(len, w), initial=0)) for i, w in self.words.items()}
        own = {i: ["".join(w[k : k + SEED]) for k in range(len(w) - SEED + 1)] for i, w in self.words.items()}
        spread = Counter(s for v in own.values() for s in set(v))
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, v in own.items():
            for k in rare_seeds([spread[s] for s in v]):
                at[v[k]].append((i, k))
        self.automaton = ahocorasick.Automaton()
        for s, v in at.items():
            self.automaton.add_word(s, (len(s), v))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def hits(self, stream: str) -> dict[int, list[tuple[int, int, int]]]:
        """Seeds found in a stream: item -> list of (place in the item, from, to in the stream)."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        if not self.empty:
            for end, (size, v) in self.automaton.iter(stream):
                for i, k in v:
                    found[i].append((k, end + 1 - size, end + 1))
        return found


def _alike(a: str, i: int, b: str, j: int, most: int, step: int) -> int:
    """How many characters, most at most, are the same in a from i and in b from j on, going by step 1, or before them, by -1."""
    most = min(most, len(a) - i, len(b) - j) if step > 0 else min(most, i, j)
    part = lambda s, k, n: s[k : k + n] if step > 0 else s[k - n : k]
    lo, hi = 0, most
    while lo < hi:  # what is alike at some length is so at any lesser one
        mid = (lo + hi + 1) // 2
        if part(a, i, mid) == part(b, j, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def longest_run(index: ItemIndex, item: int, stream: str, hits: list[tuple[int, int, int]], starts: set[int], ends: set[int]) -> int:
    """The most consecutive words of the item that stand in the stream without anything between them.

    Each hit is followed to both sides as far as the streams agree; a run's first and last word must begin and end where
    words of the document do, else they don't count.
    """
    own, marks = index.streams[item], index.marks[item]
    best, done = 0, {}
    for k, a, b in sorted(hits, key=lambda x: x[1]):
        shift = a - marks[k]
        if done.get(shift, -1) >= b:
            continue  # inside a stretch that was followed from an earlier hit
        right = b + _alike(own, marks[k + SEED], stream, b, len(own), 1)
        left = a - _alike(own, marks[k], stream, a, len(own), -1)
        done[shift] = right
        inside = [n for n in range(bisect_left(marks, left - shift), bisect_right(marks, right - shift))]
        first = next((n for n in inside if marks[n] + shift in starts), len(marks))
        last = next((n for n in reversed(inside) if marks[n] + shift in ends), 0)
        best = max(best, last - first)
    return best


def align(pairs: list[tuple[list[int], list[int]]]) -> list[int]:
    """The Smith-Waterman score of each pair of sequences of word numbers (not negative), with a linear gap cost.

    All pairs are filled row by row together; shorter ones are padded with numbers that match nothing.
    """
    if not pairs:
        return []
    rows, cols = max(len(a) for a, _ in pairs), max(len(b) for _, b in pairs)
    x = np.full((rows, len(pairs), 1), -2, dtype=np.int32)
    y = np.full((len(pairs), cols), -1, dtype=np.int32)
    for k, (a, b) in enumerate(pairs):
        x[: len(a), k, 0] = a
        y[k, : len(b)] = b
    steps = (np.arange(cols + 1) * -GAP).astype(np.int32)
    row = np.zeros((len(pairs), cols + 1), dtype=np.int32)
    best = np.zeros(len(pairs), dtype=np.int32)
    for w in x:
        new = np.zeros_like(row)
        np.maximum(row[:, :-1] + np.where(y == w, MATCH, MISMATCH).astype(np.int32), row[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        new += steps  # gaps along the row
        np.maximum.accumulate(new, axis=1, out=new)
        new -= steps
        np.maximum(best, new.max(axis=1), out=best)
        row = new
    return best.tolist()


#: Pairs aligned together.
TOGETHER = 128


def _leaks_of(docs: list[tuple[int, str]], index: ItemIndex) -> list[tuple[int, int, int, int, int]]:
    """(document, item, seeds, score, run) of a batch of documents."""
    pairs, owners, out = [], [], []
    for doc, text in docs:
        seen = visible(text)
        stream = _NOT_WORD.sub("", seen)
        hits = index.hits(stream)
        if not hits:
            continue
        starts, ends, words, place, p = set(), set(), [], [], 0
        for w in _WORD.findall(seen):
            starts.add(p)
            place.append(p)
            words.append(w)
            p += len(w)
            ends.add(p)
        for i, h in hits.items():
            item = index.words[i]
            numbers = index.numbers[i]
            h.sort(key=lambda x: x[1])
            # seeds further apart than an item is long belong to different passages
            groups: list[list[tuple[int, int, int]]] = []
            for x in h:
                if groups and x[1] - groups[-1][-1][1] < 12 * len(item) and x[1] - groups[-1][0][1] < 36 * len(item):
                    groups[-1].append(x)
                else:
                    groups.append([x])
            for g in groups:
                lo = max(0, bisect_right(place, g[0][1]) - 1 - len(item))
                hi = bisect_left(place, g[-1][2]) + len(item)
                pairs.append((index.coded[i], [numbers.get(w, -1) for w in words[lo:hi]]))
                owners.append(len(out))
            out.append([doc, i, len({k for k, _, _ in h}), 0, longest_run(index, i, stream, h, starts, ends)])
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))  # alike in length, so that little is padded
    for s in range(0, len(order), TOGETHER):
        some = order[s : s + TOGETHER]
        for k, score in zip(some, align([pairs[k] for k in some])):
            out[owners[k]][3] = max(out[owners[k]][3], score)
    return [tuple(x) for x in out]


def find_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_seeds, score, run of every document with seeds of an item.

    score is the best Smith-Waterman score around the seeds, run the most consecutive words of the item that stand in
    the document. Rows with NULL id or text have none; documents with equal ids count as one, with the greatest
    figures. Items of fewer than SEED words can't be found.
    """
    rows = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator()
    blocks: list[list[tuple[int, str]]] = []
    room = 0
    for r in rows:  # the query set; each block is bounded, and one block is held at a time by the workers
        if not blocks or room < len(r.text):
            blocks.append([])
            room = BLOCK_CHARS
        blocks[-1].append((r.item_id, r.text))
        room -= len(r.text)
    schema = "doc_id bigint, item_id bigint, n_seeds bigint, score bigint, run bigint"
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    out = None
    for block in blocks:
        sent = documents.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = ItemIndex(sent.value)
            for b in batches:
                found = _leaks_of(list(zip(b["doc_id"], b["text"])), index)
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "n_seeds", "score", "run"])

        part = texts.mapInPandas(find, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return documents.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("n_seeds", "score", "run")])


def leaked(documents: DataFrame, items: DataFrame, run: int = 10) -> DataFrame:
    """doc_id, item_id of documents with `run` consecutive words of an item; such a run scores MATCH a word at least."""
    found = find_leaks(documents, items).where(F.col("score") >= MATCH * (run - 2))
    return found.where(F.col("run") >= run).select("doc_id", "item_id")
