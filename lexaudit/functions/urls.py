"""Operators on addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """The authority of an address in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def without_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^([^?]*)", 1)


def last_segment(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(without_query(url), r"/+$", ""), r"([^/]*)$", 1)


def all_pages(url: Column, domains: list[str]) -> Column:
    """Addresses of the domains with the parameter page=all, other parameters kept in order, blank ones dropped."""
    base, query = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+") & ~p.startswith("page="))
    return F.when(host(url).rlike("(?:" + "|".join(d.replace(".", r"\.") for d in domains) + ")"), F.concat(base, F.lit("?"), F.array_join(F.array_append(kept, F.lit("page=all")), "&"))).otherwise(url)


def first_page(url: Column) -> Column:
    """Addresses without a page number in the path; ?page=all is added where there is no query."""
    u = F.regexp_replace(url, r"/page/\d+", "")
    return F.when(u.contains("?"), u).otherwise(F.concat(u, F.lit("?page=all")))


def decode_feed(url: Column) -> Column:
    """The address packed into the segment after articles/ of a feed service's link; the link itself if there is none."""
    segment = F.regexp_extract(url, r"articles/([A-Za-z0-9_-]+)", 1)
    padded = F.rpad(F.translate(segment, "-_", "+/"), (F.ceil(F.length(segment) / 4) * 4).cast("int"), F.lit("="))
    found = F.regexp_extract(F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1"), r"(https?://[\x21-\x7e]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), url)


def is_document(url: Column, extensions: list[str]) -> Column:
    """Whether an address ends in one of the extensions, before the query if there is one."""
    return F.lower(url).rlike("(?:" + "|".join(e.replace(".", r"\.") for e in extensions) + r")(?:\?|$)")


def is_text_type(content_type: Column) -> Column:
    """False for application types but xhtml; NULL counts as text."""
    c = F.lower(F.coalesce(content_type, F.lit("")))
    return ~(c.contains("application/") & ~c.contains("xhtml"))
