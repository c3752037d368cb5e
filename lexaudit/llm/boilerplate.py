"""The main body of pages (problem 3).

A page's text is a tree: the body, sections of neighbouring lines of one kind, lines, and the segments of lines that
separators make. Every node has a composite text density: characters per tag, adjusted by how much of the text is link
text. What is link text is read off the whole corpus (segments of menus, lines that pages share) and off the form of
the text (headlines of other stories). Densities are summed up over sections; the run of sections with the greatest sum
is the main body. Its core are the lines at or above the threshold of the path from the body to it; all of its lines
from the first to the last of them that are no link text are the story.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaudit.session import materialize, source_key

# Labels of adverts and calls to scroll on, which stand between a story's paragraphs like subheads.
_BREAK = re.compile(r"^\W*(?:(?:ruang )?(?:iklan|promosi)|advertisement|advertorial|sponsor(?:ed)?)\W*$|^(?:gulir|geser|scroll|swipe)\b(?:\W+\w+){0,4}\W*$")
#: Words beyond which a line that ends like a sentence is one, whatever it says.
LONG_WORDS = 20

_SEPARATOR = re.compile(r"\s*[|·•»>]\s*|\s+/\s+|\s+[-–]\s+")
_WIDE = re.compile(r"\s{2,}")
_SPACES, _DIGITS = re.compile(r"\s+"), re.compile(r"\d+")
_BULLET = re.compile(r"^(?:[•*▪◦–-]|\d{1,2}[.)])\s+")
_ENDING = re.compile(r"[.!?][\"'”’)\]]*$|[\"”’]$")
_ITEM = re.compile(r":\s*\d")
_LAST = ".!?\"”"
_INNER_ENDING = re.compile(r"[.!?][\"”]?\s+[A-Z\"“]")

#: Shares of all texts from which a menu's segment is a label and a longer line a template, and least counts.
LABEL_SHARE, LABEL_LEAST, TEMPLATE_SHARE, TEMPLATE_LEAST = 0.0005, 3, 0.003, 8
LABEL_WORDS, TEMPLATE_WORDS = 4, 4
#: The share for lines of fewer words, which stories' own subheads can have in common.
SHORT_SHARE = 0.01
#: Spaces of a line between two of which a short one may be a subhead.
LONG_LINE = 6


def canonical(line: str, site: str) -> str:
    """Lower case, single spaces, digits and the site's name alike, and the marks around a line gone."""
    s = _DIGITS.sub("0", _SPACES.sub(" ", line.lower()))
    if site:
        s = s.replace(site, "~")
    return s.strip(" -»…*.!")


def _site(source: str | None) -> str:
    """The word of a source's address that names the site."""
    return source.split(".")[0] if isinstance(source, str) and source else ""


_MARKS = re.compile(r"[|·•»>]| [/–-] ")


def _parts(line: str) -> list[str]:
    """What the separators of a menu leave of a line."""
    return [p for p in _SEPARATOR.split(line) if p and not p.isspace()] if _MARKS.search(line) else [line]


def _segments(line: str) -> list[str]:
    parts = _parts(line)
    return parts if len(parts) > 1 or "  " not in line and "\t" not in line else [p for p in _WIDE.split(line) if p.strip()]


def _key(text: str) -> int:
    """A text as the corpus counts it: a hash that is the same in every process."""
    return xxhash.xxh64_intdigest(text) - (1 << 63)


class Knowledge:
    """What the corpus says, as hashes: labels of menus, templates of lines (long sentences as they stand, others in canonical
    form), and those of short lines. Each has at most lines-a-text / share entries."""

    def __init__(self, labels: frozenset[int], templates: frozenset[int], shorts: frozenset[int]) -> None:
        self.labels, self.templates, self.shorts = labels, templates, shorts

    def label(self, text: str) -> bool:
        return _key(text) in self.labels

    def shared(self, text: str) -> bool:
        k = _key(text)
        return k in self.labels or k in self.templates or k in self.shorts


def _long(line: str) -> bool:
    """Whether a line is long and ends like a sentence."""
    return line[-1] in _LAST and line.count(" ") >= LONG_WORDS and "  " not in line


def learn(articles: DataFrame) -> Knowledge:
    """Counts, over all texts, in how many of them each menu segment and each longer line stands.

    What stands in copies of one text only is no template, however many there are: each line also keeps a mask of 64
    bits, one of them set by the longest line of each text that holds it, and must have met several.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held: dict[tuple[str, int], list[int]] = {("texts", 0): [len(b), 0]}
            for source, text in zip(b["source_key"], b["content"]):
                site, own, longest = _site(source), set(), ""
                lines = [x for x in map(str.strip, text.split("\n")) if x and not _BREAK.match(x.lower())]
                long = [False, *(x.count(" ") >= LONG_LINE for x in lines), False]
                for at, line in enumerate(lines, 1):
                    if len(line) > len(longest):
                        longest = line
                    if _long(line):
                        own.add(("template", _key(line)))
                        continue
                    c = canonical(line, site)
                    if line.count(" ") < TEMPLATE_WORDS - 1:
                        if c and not (long[at - 1] and long[at + 1]):  # else it may be a subhead
                            own.add(("short", _key(c)))
                        continue
                    parts = _parts(line)
                    if len(parts) > 2:
                        own.update(("label", _key(x)) for x in (canonical(p, site) for p in parts) if x and x.count(" ") < LABEL_WORDS)
                    if c.count(" ") >= TEMPLATE_WORDS - 1:
                        own.add(("template", _key(c)))
                bit = 1 << zlib.crc32(longest.encode()) % 63
                for k in own:
                    x = held.get(k)
                    if x is None:
                        held[k] = [1, bit]
                    else:
                        x[0] += 1
                        x[1] |= bit
            yield pd.DataFrame([(k, v, n, m) for (k, v), (n, m) in held.items()], columns=["kind", "value", "n", "mask"])

    texts = articles.select(source_key("source").alias("source_key"), "content").where("content IS NOT NULL AND content <> ''")
    counted = texts.mapInPandas(count, "kind string, value bigint, n bigint, mask bigint").groupBy("kind", "value").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("mask")).alias("met"))
    counted = materialize(counted.where("n >= 3 OR kind = 'texts'"), "lines")
    total = sum(r.n for r in counted.where("kind = 'texts'").collect())

    def of(kind: str, least: float, met: int) -> frozenset[int]:
        return frozenset(r.value for r in counted.where((F.col("kind") == kind) & (F.col("n") >= least) & (F.col("met") >= met)).select("value").collect())

    return Knowledge(of("label", max(LABEL_LEAST, LABEL_SHARE * total), 2), of("template", max(TEMPLATE_LEAST, TEMPLATE_SHARE * total), 6), of("short", max(TEMPLATE_LEAST, SHORT_SHARE * total), 6))


def density(chars: int, tags: int, link_chars: int, link_tags: int, body_chars: int, body_link_chars: int) -> float:
    """Composite text density of a node; counts of 0 below a bar count as 1."""
    if not chars:
        return 0.0
    other = max(1, chars - link_chars)
    base = max(1.2, math.log(chars / other * link_chars + body_link_chars / max(1, body_chars) * chars + math.e))  # without any link it would be 1
    value = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    return chars / max(1, tags) * math.log(max(value, 1e-9)) / math.log(base)


LINK, SHORT, PROSE = range(3)


def line_kind(line: str, site: str, title: str, known: Knowledge) -> int:
    """LINK if a line is link text, PROSE if it is sentences or an item of a list, else SHORT (headings and what is unclear)."""
    if _long(line):
        return LINK if _key(line) in known.templates else PROSE
    c = canonical(line, site)
    if not c or known.shared(c) or _BREAK.match(c):
        return LINK
    words = c.count(" ") + 1
    if words > 2 * LONG_WORDS:
        return PROSE if _ENDING.search(line) or _INNER_ENDING.search(line) else LINK
    parts = _segments(line)
    if len(parts) > 1:
        names = [canonical(p, site) for p in parts]
        menu = sum(map(known.label, names))
        if menu >= 0.6 * len(names) or known.label(_SPACES.sub(" ", c)):
            return LINK
    bullet = _BULLET.match(line)
    if bullet and line[0].isdigit() and words >= 5 and not _ITEM.search(line):
        return LINK  # numbered headlines
    if _ENDING.search(line) and words >= 4 or words >= 8 and _INNER_ENDING.search(line):
        return PROSE
    if words >= 5:
        if bullet and ":" in line:
            return PROSE
        if title and c == canonical(title, site):
            return SHORT
        return LINK  # a headline that isn't the page's own, or a breadcrumb with one
    if bullet and ":" in line:
        return PROSE
    if len(parts) > 2:
        return LINK
    return SHORT


def _headline(line: str, site: str, known: Knowledge) -> bool:
    c = canonical(line, site)
    return c.count(" ") >= 4 and _key(c) not in known.templates and not _BULLET.match(line) and len(_segments(line)) == 1


#: A line is in the core of the main body if its density is so many times the threshold of its path: the lesser of the
#: mean densities of the body and of the subtree with the greatest sum.
CORE = 0.43


def _headlines_below(lines: list[tuple[int, str]], kinds: list[int], site: str, known: Knowledge) -> None:
    """Marks as link text the headlines, though they may end like sentences, that follow a short line all sites have below the story's beginning, up to
    the next link text, where none of them is long or more than one sentence."""
    i = next((i for i, k in enumerate(kinds) if k == PROSE), len(lines))
    while i < len(lines):
        if kinds[i] == LINK and _key(canonical(lines[i][1], site)) in known.shorts:
            j = i + 1
            while j < len(lines) and kinds[j] == PROSE and lines[j][1].count(" ") < 17 and not _INNER_ENDING.search(lines[j][1]) and not any(q in lines[j][1] for q in "\"“”:;"):
                j += 1
            if j - i > 2 and (j == len(lines) or kinds[j] == LINK):
                kinds[i + 1 : j] = [LINK] * (j - i - 1)
            i = j
        else:
            i += 1


def story_lines(text: str, title: str | None, source: str | None, known: Knowledge) -> tuple[list[int], list[int]]:
    """(story, other): the numbers, from 1, of a page's non-blank lines that are part of the story and that are not."""
    site = _site(source)
    title = title if isinstance(title, str) else ""
    lines = [(n, x.strip()) for n, x in enumerate(text.split("\n"), 1) if x.strip()]
    if not lines:
        return [], []
    kinds = [line_kind(x, site, title, known) for _, x in lines]
    _headlines_below(lines, kinds, site, known)
    # sections: runs of link text, and runs of all else
    tags = [max(1, len(_segments(x))) if k == LINK else 1 for (_, x), k in zip(lines, kinds)]
    chars = [len(x) for _, x in lines]
    links = [c if k == LINK else 0 for c, k in zip(chars, kinds)]
    body, body_links = sum(chars), sum(links)
    dense = [density(c, t, l, t if l else 0, body, body_links) for c, t, l in zip(chars, tags, links)]
    bar = sum(dense) / len(dense)  # of the body, by its density sum over its lines
    sections: list[list[int]] = []
    for i, k in enumerate(kinds):
        if sections and (kinds[sections[-1][-1]] == LINK) == (k == LINK):
            sections[-1].append(i)
        else:
            sections.append([i])
    # the run of sections with the greatest sum of density above a small part of the body's
    best, best_run, run, run_from = 0.0, (0, -1), 0.0, 0
    for s, members in enumerate(sections):
        gain = sum(dense[i] - 0.05 * bar for i in members)
        if run <= 0:
            run, run_from = 0.0, s
        run += gain
        if run > best:
            best, best_run = run, (run_from, s)
    inside = [i for s in range(best_run[0], best_run[1] + 1) for i in sections[s]]
    bar = min(bar, sum(dense[i] for i in inside) / max(1, len(inside)))
    core = [i for i in inside if kinds[i] != LINK and dense[i] >= CORE * bar]
    story: set[int] = set()
    if core:
        first, last = core[0], core[-1]
        story = {i for i in inside if kinds[i] != LINK and first <= i <= last}
        if title:  # the page's own headline, at the top
            own = canonical(title, site)
            story |= {i for i in range(first) if kinds[i] != LINK and canonical(lines[i][1], site) == own}
        elif first and _headline(lines[first - 1][1], site, known):
            story.add(first - 1)
    return [lines[i][0] for i in sorted(story)], [n for i, (n, _) in enumerate(lines) if i not in story]


def split_pages(articles: DataFrame) -> DataFrame:
    """article_id, line_no, in_story of every non-blank line of content.

    Rows with NULL id, NULL or empty content have none. line_no counts from 1 and counts blank lines.
    """
    sent = articles.sparkSession.sparkContext.broadcast(learn(articles))
    rows = articles.select("article_id", "title", source_key("source").alias("source_key"), "content").where("article_id IS NOT NULL AND content IS NOT NULL AND content <> ''")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, title, source, text in zip(b["article_id"], b["title"], b["source_key"], b["content"]):
                story, other = story_lines(text, title, source, sent.value)
                out += [(i, n, True) for n in story] + [(i, n, False) for n in other]
            yield pd.DataFrame(out, columns=["article_id", "line_no", "in_story"])

    return rows.mapInPandas(split, "article_id bigint, line_no int, in_story boolean")
