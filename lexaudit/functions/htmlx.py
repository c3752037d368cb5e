"""Pages in text columns, parsed by the standard library in Arrow batches."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JUNK = {"script", "style", "iframe", "ins", "nav", "footer", "aside", "form", "noscript", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Page(HTMLParser):
    """What the operators take from a page, in one pass. Unclosed tags end with their parent or a tag of the same name."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.meta, self.images, self.links, self.paragraphs, self.headings, self.tags = {}, [], [], [], [], []
        self.title, self.time, self._open, self._text, self._link, self._tag = "", "", [], [], None, None
        try:
            self.feed(html or "")
            self.close()
        except (AssertionError, ValueError):
            pass
        self._flush()

    def _flush(self) -> None:
        t = " ".join("".join(self._text).split())
        self._text = []
        if t:
            self.paragraphs.append(t)

    def handle_starttag(self, tag, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (a.get("property") or a.get("name")):
            self.meta.setdefault((a.get("property") or a["name"]).lower(), a.get("content", ""))
        elif tag == "img":
            src = a.get("src") or a.get("data-src")
            if src and not src.startswith("data:") and src not in self.images:
                self.images.append(src)
        elif tag == "time" and not self.time:
            self.time = a.get("datetime", "")
        if tag in ("p", "li", "h1", "h2", "h3"):
            self._flush()
        if tag == "a" and a.get("href"):
            self._link = [a["href"], []]
            self._tag = [] if "tag" in (a.get("rel", "") + " " + a.get("class", "")) else None
        if tag not in VOID:
            self._open.append(tag)

    def handle_endtag(self, tag) -> None:
        if tag in self._open:
            while self._open and self._open.pop() != tag:
                pass
        if tag in ("p", "li"):
            self._flush()
        elif tag in ("h1", "h2", "h3"):
            t = " ".join("".join(self._text).split())
            self._text = []
            if t:
                self.headings.append(t)
        elif tag == "a" and self._link:
            text = " ".join("".join(self._link[1]).split())
            self.links.append((self._link[0], text))
            if self._tag is not None and text and len(text) < 50 and text not in self.tags:
                self.tags.append(text)
            self._link = self._tag = None

    def handle_data(self, data) -> None:
        if "title" in self._open:
            self.title += data
        if JUNK.intersection(self._open):
            return
        if self._link:
            self._link[1].append(data)
        if {"p", "li", "h1", "h2", "h3"}.intersection(self._open):
            self._text.append(data)


_S = T.StringType()
SCHEMA = T.StructType([
    T.StructField("title", _S), T.StructField("body", _S), T.StructField("n_words", T.IntegerType()), T.StructField("tags", T.ArrayType(_S)), T.StructField("images", T.ArrayType(_S)),
    T.StructField("meta", T.MapType(_S, _S)), T.StructField("published", _S), T.StructField("links", T.ArrayType(T.StructType([T.StructField("href", _S), T.StructField("text", _S)]))),
])
#: Names of meta fields that are kept.
META = ("og:title", "og:description", "og:image", "og:type", "description", "keywords")


@F.pandas_udf(SCHEMA)
def parse_page(html: pd.Series) -> pd.DataFrame:
    """Title, body, tags (15 at most), images (10 at most), meta fields, date and links of a page.

    The title is the first heading, else the title tag, else a stated default; the body joins paragraphs and list items
    outside scripts, menus and footers. NULL and empty pages have the default title and an empty body.
    """
    out = []
    for h in html:
        p = Page(h if isinstance(h, str) else "")
        body = " ".join(p.paragraphs)
        when = p.time or next((p.meta[k] for k in ("article:published_time", "pubdate", "date") if p.meta.get(k)), "")
        title = (p.headings[0] if p.headings else " ".join(p.title.split())) or "Tanpa Judul"
        out.append((title, body, len(body.split()), p.tags[:15], p.images[:10], {k: p.meta[k] for k in META if k in p.meta}, when, [{"href": a, "text": b} for a, b in p.links]))
    return pd.DataFrame(out, columns=["title", "body", "n_words", "tags", "images", "meta", "published", "links"])


def parse_pages(pages: DataFrame, html: str = "html", least_words: int = 25) -> DataFrame:
    """pages with the parsed fields beside them, parse_success and parse_error; a body of too few words is an error."""
    d = pages.withColumn("_p", parse_page(F.col(html)))
    d = d.select(*[c for c in pages.columns if c != html], "_p.*")
    ok = F.col("n_words") >= least_words
    return d.withColumns({"parse_success": ok, "parse_error": F.when(~ok, F.lit("too few words")).otherwise("")})
