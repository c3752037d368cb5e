"""Oversized texts into pieces at natural boundaries (problem 10).

Texts are cut into ranges that are worked on independently: a worker finds the boundaries of its range, with a halo of
characters to each side so that what it finds doesn't depend on where the range ends, and counts tokens between them.
The ranges' totals are summed up to offsets (the only step along a whole text, over one number a range), which turns
local counts into positions in the text's tokens. Cuts are then chosen independently of one another: cut i is the best
boundary of the slack before i strides. Pieces are emitted by offset. Files too large to be a row go the same way by
byte ranges (file_ranges), each worker reading only its range and halo.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexaudit.llm.tokens import DEFAULT_RANKS, counter
from lexaudit.session import materialize

#: Characters of a range and of its halo.
RANGE, HALO = 32_768, 512
#: Where so many bytes hold no beginning of white space, multiples of BLOCK characters are boundaries; in blocks of more
#: than DENSE bytes, of STEP. As a token is a byte at least, no two boundaries are more than RUN tokens apart.
RUN, BLOCK, DENSE, STEP = 128, 64, 96, 16
#: Of the size limit: what a stride leaves for slack and overlap; tokens between boundaries kept of the same kind.
SLACK_SHARE, BUCKET = 0.14, 40
# kinds of boundary, better ones higher
HARD, SPACE, SENTENCE, LINE, PARAGRAPH = range(5)

_SYNC = re.compile(r"(?<=\S)(?=\s)")
_ENDS = ".!?…。؟"
_CLOSERS = "\"'”’)]»"


def boundaries(text: str, core_from: int, core_to: int, offset: int) -> list[tuple[int, int]]:
    """(position, kind) of every boundary in [core_from, core_to) of a slice whose first character is at `offset`.

    A boundary lies before white space, so that token counts to both sides add up; where there is none for RUN bytes, at
    multiples of BLOCK or STEP. What lies in the halo decides nothing that another range decides differently.
    """
    found = []
    for m in _SYNC.finditer(text, max(0, core_from - 1), min(len(text), core_to + 1)):
        p = m.start()
        if not core_from <= p < core_to:
            continue
        q = p
        lines = 0
        while q < len(text) and q - p < HALO and text[q].isspace():
            lines += text[q] == "\n"
            q += 1
        b = p - 1
        while b > 0 and p - b < 4 and text[b] in _CLOSERS:
            b -= 1
        found.append((p, PARAGRAPH if lines > 1 else LINE if lines else SENTENCE if text[b] in _ENDS else SPACE))
    have = {p for p, _ in found}
    for p in range(-(-(core_from - 3 + offset) // STEP) * STEP - offset, core_to, STEP):
        q = _hard(text, p, offset)
        if q is not None and core_from <= q < core_to and q not in have:
            found.append((q, HARD))
    return sorted(found)


def _hard(text: str, p: int, offset: int) -> int | None:
    """The boundary at a multiple of STEP inside a long run without another, behind the character it would cut where a
    character of the text stands for a byte."""
    if p <= 0 or p >= len(text) or (p + offset) % BLOCK and not _dense(text, p - (p + offset) % BLOCK):
        return None
    before = max((m.start() for m in _SYNC.finditer(text, max(0, p - RUN), p + 1)), default=max(0, p - RUN))
    after = _SYNC.search(text, p + 1, min(len(text), p + RUN + 1))
    until = min(after.start() if after else len(text), p + RUN)
    if before == p or len(text[before:until].encode("utf-8", "surrogatepass")) < RUN:
        return None
    q = p
    while q < len(text) - 1 and q - p < 3 and "\x80" <= text[q] <= "\xbf":
        q += 1
    return q


def _dense(text: str, start: int) -> bool:
    return len(text[max(0, start) : start + BLOCK].encode("utf-8", "surrogatepass")) > DENSE


_SPACELESS, _LONG = re.compile(rf"\S{{{RUN // 2}}}|\s{{{RUN // 2}}}"), re.compile(rf"\S{{{RUN // 8},}}|\s{{{RUN // 8},}}")


def _spaceless(text: str) -> bool:
    """Whether hard boundaries may lie in a text: not if all words and all white space are below half a RUN of bytes."""
    if _SPACELESS.search(text):
        return True
    return not text.isascii() and any(len(m.group().encode("utf-8", "surrogatepass")) >= RUN // 2 for m in _LONG.finditer(text))


def _first(text: str, core_from: int, core_to: int, offset: int) -> int | None:
    """The first boundary in [core_from, core_to), sought step by step."""
    for a in range(core_from, core_to, HALO):
        if found := boundaries(text, a, min(core_to, a + HALO), offset):
            return found[0][0]
    return None


def _span(start: int, lead: int, size: int, text: str) -> tuple[int, int] | None:
    """Where the part of a slice that its range counts begins and ends: from its first boundary to the next range's."""
    offset = start - lead
    first = lead if start == 0 else _first(text, lead, lead + size, offset)
    if first is None:
        return None
    stop = _first(text, lead + size, len(text), offset)
    return first, len(text) if stop is None else stop


def _kind(text: str, p: int, spaces: str) -> int:
    lines = spaces.count("\n")
    if lines:
        return PARAGRAPH if lines > 1 else LINE
    b = p - 1
    while b > 0 and p - b < 4 and text[b] in _CLOSERS:
        b -= 1
    return SENTENCE if text[b] in _ENDS else SPACE


def _scan(key, number: int, start: int, lead: int, size: int, text: str, count) -> tuple[list[tuple], int]:
    """Boundaries of one range with the range's tokens before each, and the range's total.

    What precedes the range's first boundary belongs to the range before. Of boundaries of the lesser kinds only the
    last of each BUCKET tokens is kept, which is enough to choose from.
    """
    span = _span(start, lead, size, text)
    if not span:
        return [], 0
    offset = start - lead
    first, stop = span
    cuts = [c for c in boundaries(text, first, min(stop, lead + size), offset) if c[0] > first]
    head = boundaries(text, first, first + 1, offset)
    cuts = [head[0] if head and start else (first, HARD), *cuts]
    rows, total, last = [], 0, None
    for (p, kind), q in zip(cuts, [*[c[0] for c in cuts[1:]], stop]):
        row = (key, number, p + offset, total, kind)
        if kind < SENTENCE:
            if last and rows[-1] is last and last[3] // BUCKET == total // BUCKET:
                rows.pop()
            last = row
        rows.append(row)
        total += count(text[p:q])
    return rows, total


def _scan_words(key, number: int, start: int, lead: int, size: int, text: str, counts) -> tuple[list[tuple], int]:
    """What _scan returns, in one pass over the tokenizer's words, for slices without long runs of one kind."""
    span = _span(start, lead, size, text)
    if not span:
        return [], 0
    offset = start - lead
    first, stop = span
    rows, total, p, last, inside = [], 0, first, None, False
    for w, n in counts(text[first:stop]):
        if p == first or not inside and w[0].isspace():
            if p == first and not (start and w[0].isspace()):
                kind = HARD
            elif w[0] == " " and len(w) > 1 and w[1] != " ":
                kind = SENTENCE if text[p - 1] in _ENDS else _kind(text, p, " ")
            else:  # a run of white space may be several words
                q = p
                while q < len(text) and q - p < HALO and text[q].isspace():
                    q += 1
                kind = _kind(text, p, text[p:q])
            row = (key, number, p + offset, total, kind)
            if kind < SENTENCE:
                if last and rows[-1] is last and last[3] // BUCKET == total // BUCKET:
                    rows.pop()
                last = row
            rows.append(row)
        total += n
        p += len(w)
        inside = w[-1].isspace()
    return rows, total


def scan_ranges(ranges: DataFrame, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Boundaries of ranges(id, number, start, lead, size, slice): id, number, at, before, kind; the range's total as at -1."""
    ident = ranges.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(ranks)
        for b in batches:
            out: list[tuple] = []
            for r in b.itertuples(index=False):
                if _spaceless(r.slice):
                    rows, total = _scan(r.id, r.number, r.start, r.lead, r.size, r.slice, c.count)
                else:
                    rows, total = _scan_words(r.id, r.number, r.start, r.lead, r.size, r.slice, c.counts)
                out += rows
                out.append((r.id, r.number, -1, total, -1))
            yield pd.DataFrame(out, columns=["id", "number", "at", "before", "kind"])

    return ranges.select("id", "number", "start", "lead", "size", "slice").mapInPandas(scan, f"id {ident}, number bigint, at bigint, before bigint, kind int")


def text_ranges(texts: DataFrame) -> DataFrame:
    """Ranges of texts(id, text) with their halos; NULL and empty texts have none."""
    n = F.length("text")
    at = texts.where(n > 0).select("id", "text", n.alias("n"), F.posexplode(F.sequence(F.lit(0), n - 1, F.lit(RANGE))).alias("number", "start"))
    lead = F.least(F.lit(HALO), F.col("start"))
    size = F.least(F.lit(RANGE), F.col("n") - F.col("start"))
    cut = F.substring(F.col("text"), F.col("start") - lead + 1, lead + size + HALO)
    return at.select("id", F.col("number").cast("bigint").alias("number"), F.col("start").cast("bigint").alias("start"), lead.alias("lead"), size.alias("size"), cut.alias("slice"))


def oversized(texts: DataFrame, limit: int, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """id, n_tokens of texts(id, text) larger than limit tokens. Equal ids count as parts of one text."""
    # a token is a byte at least, so a text of no more bytes can't exceed the limit
    may = texts.where((F.octet_length("text") > limit) & F.col("id").isNotNull())
    ident = texts.schema["id"].dataType.simpleString()

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(ranks).count
        for b in batches:
            spans = [_span(r.start, r.lead, r.size, r.slice) for r in b.itertuples(index=False)]
            yield pd.DataFrame({"id": b["id"], "n": [count(x[s[0] : s[1]]) if s else 0 for x, s in zip(b["slice"], spans)]})

    counted = text_ranges(may).mapInPandas(totals, f"id {ident}, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("n_tokens")).where(F.col("n_tokens") > limit)


def choose_cuts(scanned: DataFrame, limit: int, overlap: int) -> DataFrame:
    """id, piece_no, at (start of the piece's own text), upto (its end, NULL for the last), of every text beyond limit."""
    slack = max(BUCKET * 2, int(limit * SLACK_SHARE))
    if _room(limit, overlap) > limit:  # a boundary that is kept lies in every slack
        slack = max(slack, RUN + BUCKET)
    stride = limit - overlap - slack
    if stride <= slack:
        raise ValueError("the limit leaves no room beside the overlap")
    by_range = Window.partitionBy("id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        scanned.where("at = -1")
        .select("id", "number", F.coalesce(F.sum("before").over(by_range), F.lit(0)).alias("base"), F.sum("before").over(Window.partitionBy("id")).alias("n_tokens"))
        .where(F.col("n_tokens") > limit)
    )
    at = scanned.where("at >= 0").join(offsets, ["id", "number"]).withColumn("cum", F.col("base") + F.col("before"))
    goal = F.ceil(F.col("cum") / stride).cast("bigint")
    near = at.withColumn("piece", goal).where((F.col("piece") * stride - F.col("cum") < slack) & (F.col("piece") * stride < F.col("n_tokens")) & (F.col("cum") > 0))
    cuts = near.groupBy("id", "piece").agg(F.max(F.struct("kind", "cum", "at")).alias("b")).select("id", F.col("piece"), F.col("b.at").alias("at"))
    starts = offsets.where("number = 0").select("id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("at"))
    along = Window.partitionBy("id").orderBy("piece")
    return cuts.unionByName(starts).select("id", (F.row_number().over(along) - 1).cast("bigint").alias("piece_no"), "at", F.lead("at").over(along).alias("upto"))


def _overlap_start(text: str, own: int, overlap: int, room: int, count) -> int:
    """Where a piece whose own text begins at `own` starts, to share `overlap` tokens with the one before: at the last
    boundary that shares as many, or, where that takes more than `room` tokens, at the first that fits."""
    marks = [0, *[p for p, _ in boundaries(text, 1, own, 0)], own]
    shared, at = 0, own
    for p, q in zip(marks[-2::-1], marks[:0:-1]):
        n = count(text[p:q])
        if shared + n > room:
            return at
        shared, at = shared + n, p
        if shared >= overlap:
            break
    return at


def _parts(own: str, room: int, count) -> list[tuple[int, int]]:
    """Where an own text is cut further, at boundaries, so that no part is beyond `room` tokens."""
    if room == float("inf") or count(own) <= room:
        return [(0, len(own))]
    cuts, last = [0], 0
    for p in [*[p for p, _ in boundaries(own, 1, len(own), 0)], len(own)]:
        if last > cuts[-1] and count(own[cuts[-1] : p]) > room:
            cuts.append(last)
        last = p
    return list(zip(cuts, [*cuts[1:], len(own)]))


def _room(limit: int, overlap: int) -> float:
    return float("inf") if limit - overlap > 2 * (RUN + BUCKET) else limit - overlap


def _numbered(pieces: DataFrame, limit: int, overlap: int) -> DataFrame:
    """Pieces numbered anew where a slack may have had no boundary, so that own texts may have been cut further."""
    if _room(limit, overlap) > limit:
        return pieces
    return pieces.withColumn("piece_no", (F.row_number().over(Window.partitionBy("id").orderBy("own_start")) - 1).cast("bigint"))


def split_texts(texts: DataFrame, limit: int = 1500, overlap: int = 100, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Pieces of texts(id, text) larger than limit: id, piece_no, start, own_start, end, n_tokens, piece.

    Positions are characters from 0. The own texts [own_start, end) of a text's pieces join to the whole text; before
    its own text a piece repeats at least `overlap` tokens of what precedes, cut at a boundary. No piece exceeds the
    limit. ids must be unique; rows with NULL id, NULL, empty or small texts have no pieces.
    """
    may = texts.where((F.octet_length("text") > limit) & F.col("id").isNotNull())
    scanned = materialize(scan_ranges(text_ranges(may), ranks), "boundaries")
    cuts = choose_cuts(scanned, limit, overlap)
    back = F.least(F.col("at"), F.lit(overlap * 40)).cast("int")
    until = F.coalesce("upto", F.length("text").cast("bigint"))
    slices = cuts.join(may, "id").select("id", "piece_no", "at", until.alias("end"), back.alias("back"), F.substring(F.col("text"), (F.col("at") - back + 1).cast("int"), (until - F.col("at") + back).cast("int")).alias("slice"))
    ident = texts.schema["id"].dataType.simpleString()
    room = _room(limit, overlap)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(ranks).count
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                for x, y in _parts(r.slice[r.back :], room, count):
                    back, text = r.back + x, r.slice[: r.back + y]
                    s = _overlap_start(text, back, overlap, limit - count(text[back:]), count) if back else 0
                    piece = text[s:]
                    while s < back and count(piece) > limit:  # a hard cut can change the tokens around it
                        s = min(back, s + 2 * STEP)
                        piece = text[s:]
                    out.append((r.id, r.piece_no, r.at - r.back + s, r.at + x, r.at + y, count(piece), piece))
            yield pd.DataFrame(out, columns=["id", "piece_no", "start", "own_start", "end", "n_tokens", "piece"])

    pieces = slices.mapInPandas(emit, f"id {ident}, piece_no bigint, start bigint, own_start bigint, end bigint, n_tokens bigint, piece string")
    return _numbered(pieces, limit, overlap)


def file_ranges(spark: SparkSession, paths: list[str], range_bytes: int = 8 << 20, halo: int = 4 * HALO) -> DataFrame:
    """Byte ranges of UTF-8 files: id (the path), number, start, lead, size, slice, positions in bytes.

    Only sizes are read here; each task opens its file at its range. The slice is Latin-1, a character a byte, so that
    positions stay byte offsets; the scan of such ranges counts tokens of the decoded bytes (scan_file_ranges).
    """
    plan = [(p, k, s) for p in paths for k, s in enumerate(range(0, os.path.getsize(p), range_bytes))]
    todo = spark.createDataFrame(plan, "id string, number bigint, start bigint").repartition(max(1, min(len(plan), 10_000)), "id", "number")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):  # a range at a time
                with open(r.id, "rb") as f:
                    lead = min(halo, r.start)
                    f.seek(r.start - lead)
                    data = f.read(lead + range_bytes + halo)
                size = min(range_bytes, len(data) - lead)
                yield pd.DataFrame([(r.id, r.number, r.start, lead, size, data.decode("latin-1"))], columns=["id", "number", "start", "lead", "size", "slice"])

    return todo.mapInPandas(read, "id string, number bigint, start bigint, lead int, size int, slice string")


def split_files(spark: SparkSession, paths: list[str], limit: int = 1500, overlap: int = 100, ranks: str = DEFAULT_RANKS, range_bytes: int = 8 << 20) -> DataFrame:
    """Pieces of UTF-8 files larger than limit, by byte offsets: id, piece_no, start, own_start, end, n_tokens, piece.

    No file is read whole by any task: ranges are scanned one by one, cuts chosen from their boundary tables, and each
    piece is read by its offsets. Paths must be readable by every executor.
    """
    ranges = file_ranges(spark, paths, range_bytes)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(ranks).count
        utf8 = lambda s: count(s.encode("latin-1").decode("utf-8", "replace"))
        for b in batches:
            for r in b.itertuples(index=False):
                rows, total = _scan(r.id, r.number, r.start, r.lead, r.size, _ascii_spaces(r.slice), utf8)
                yield pd.DataFrame([*rows, (r.id, r.number, -1, total, -1)], columns=["id", "number", "at", "before", "kind"])

    scanned = materialize(ranges.mapInPandas(scan, "id string, number bigint, at bigint, before bigint, kind int"), "boundaries")
    cuts = choose_cuts(scanned, limit, overlap)
    room = _room(limit, overlap)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(ranks).count
        utf8 = lambda s: count(s.encode("latin-1").decode("utf-8", "replace"))
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                end = os.path.getsize(r.id) if pd.isna(r.upto) else int(r.upto)
                back = min(int(r.at), overlap * 40)
                with open(r.id, "rb") as f:
                    f.seek(r.at - back)
                    raw = f.read(end - r.at + back).decode("latin-1")
                for x, y in _parts(_ascii_spaces(raw[back:]), room, utf8):
                    text = raw[: back + y]
                    s = _overlap_start(_ascii_spaces(text), back + x, overlap, limit - utf8(text[back + x :]), utf8) if back + x else 0
                    piece = text[s:].encode("latin-1").decode("utf-8", "replace")
                    out.append((r.id, r.piece_no, r.at - back + s, r.at + x, r.at + y, count(piece), piece))
            yield pd.DataFrame(out, columns=["id", "piece_no", "start", "own_start", "end", "n_tokens", "piece"])

    pieces = cuts.mapInPandas(emit, "id string, piece_no bigint, start bigint, own_start bigint, end bigint, n_tokens bigint, piece string")
    return _numbered(pieces, limit, overlap)


def _ascii_spaces(s: str) -> str:
    """Latin-1 bytes with those beyond ASCII that would pass for white space replaced by one that doesn't."""
    return s.translate({0x85: "\x80", 0xA0: "\x80", 0x1C: "\x80", 0x1D: "\x80", 0x1E: "\x80", 0x1F: "\x80"})
