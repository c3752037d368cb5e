"""JSON in text columns."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def balanced_object(text: pd.Series) -> pd.Series:
    """The first balanced {...} of a text, braces in strings and escapes not counted; NULL if there is none."""

    def find(s):
        start = s.find("{") if isinstance(s, str) else -1
        if start < 0:
            return None
        depth, quoted, escaped = 0, False, False
        for i in range(start, len(s)):
            c = s[i]
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = quoted
            elif c == '"':
                quoted = not quoted
            elif not quoted:
                depth += (c == "{") - (c == "}")
                if c == "}" and depth == 0:
                    return s[start : i + 1]
        return None

    return text.map(find)


def robust_object(text: Column) -> Column:
    """The JSON object of an answer as text: the whole, a fenced block, or the first balanced braces; NULL if none parses."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    tries = [F.btrim(text), fenced, balanced_object(text)]
    return F.coalesce(*[F.when(F.try_parse_json(t).isNotNull() & t.startswith("{"), t) for t in tries])


def with_defaults(text: Column, defaults: dict[str, str]) -> Column:
    """A struct of the keys of a JSON object, each with its default where it is missing or the text is no object."""
    parsed = F.from_json(text, "map<string,string>")
    return F.struct(*[F.coalesce(F.try_element_at(parsed, F.lit(k)), F.lit(v)).alias(k) for k, v in defaults.items()])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("code", T.StringType()), T.StructField("at", T.LongType()), T.StructField("caption", T.StringType())])))
def walk_posts(text: pd.Series) -> pd.Series:
    """Posts anywhere in a JSON tree: every node with a shortcode, own or inherited, that has a time or a caption.

    Later values of a shortcode replace earlier ones. NULL, empty and faulty texts give an empty array.
    """

    def walk(node, code, found):
        if isinstance(node, dict):
            code = node.get("shortcode") or node.get("code") or code
            if code:
                entry = found.setdefault(str(code), [None, None])
                at = node.get("taken_at_timestamp") or node.get("taken_at")
                if isinstance(at, int) and not isinstance(at, bool):
                    entry[0] = at
                caption = node.get("caption")
                caption = caption.get("text") if isinstance(caption, dict) else caption
                if isinstance(caption, str) and caption:
                    entry[1] = caption
            for v in node.values():
                walk(v, code, found)
        elif isinstance(node, list):
            for v in node:
                walk(v, code, found)

    def posts(s):
        found: dict = {}
        try:
            walk(json.loads(s), None, found)
        except (TypeError, ValueError, RecursionError):
            return []
        return [{"code": k, "at": a, "caption": c} for k, (a, c) in found.items() if a is not None or c is not None]

    return text.map(posts)
