"""Scores of texts by lexicon, place, age, form and source, as column arithmetic. Weights are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexaudit import domains, lexicon  # noqa: F401 (domains adds its sets)
from lexaudit.functions.text import word_count

# Points of the tiered score.
POINTS = {"anchor": 40, "district": 30, "landmark": 35, "word": 20, "three": 40, "two": 30, "one": 20, "both_places": -15, "elsewhere": -60, "noise": -25, "domain": 10, "title": 10}
# Weights of the composite score.
WEIGHTS = {"keyword": 0.35, "credibility": 0.15, "geographic": 0.20, "recency": 0.15, "quality": 0.15}
PLACE = r"\bbandung\b"
LABOUR = ("labour_positive", "labour_negative", "labour_issue")
WORK = ("work_positive", "work_negative", "work_issue")


def _clamp(c: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def tiered(text: Column, host: Column, points: dict[str, int] = POINTS) -> Column:
    """0-100: place (best tier), number of labour patterns, elsewhere and noise, credible host, by the standalone job's
    whole words. text is lower case."""
    credible = host.rlike("(?:" + "|".join(d.replace(".", r"\.") for d in lexicon.CREDIBLE_DOMAINS) + ")")
    facts = F.struct(
        lexicon.any_of(text, "work_anchors").alias("anchor"), lexicon.hit_count(text, *WORK).alias("topic"), text.alias("text"),
        F.coalesce(credible, F.lit(False)).alias("credible"),
    )

    def score(f: Column) -> Column:
        t, topic, anchor = f["text"], f["topic"], f["anchor"]
        place = (
            F.when(anchor, points["anchor"]).when(lexicon.any_of(t, "work_districts"), points["district"])
            .when(lexicon.any_of(t, "work_landmarks"), points["landmark"]).when(t.rlike(PLACE), points["word"]).otherwise(0)
        )
        labour = F.when(topic >= 3, points["three"]).when(topic == 2, points["two"]).when(topic == 1, points["one"]).otherwise(0)
        elsewhere = F.when(lexicon.any_of(t, "work_elsewhere"), F.when(anchor, points["both_places"]).otherwise(points["elsewhere"])).otherwise(0)
        noise = F.when(lexicon.any_of(t, "work_noise") & (topic < 2), points["noise"]).otherwise(0)
        extra = F.when(f["credible"], points["domain"]).otherwise(0) + F.when(anchor & (topic >= 1), points["title"]).otherwise(0)
        return _clamp(place + labour + elsewhere + noise + extra, 0, 100)

    return lexicon.let(facts, score)


def prefix_score(text: Column, points: dict[str, int] = POINTS) -> Column:
    """0-100 by patterns that need not end a word: place, labour in two tiers, elsewhere. text is lower case."""

    def score(f: Column) -> Column:
        t, topic = f["text"], f["topic"]
        place = (
            F.when(lexicon.any_of(t, "labour_anchors"), points["anchor"]).when(lexicon.any_of(t, "labour_districts"), points["district"])
            .when(lexicon.any_of(t, "labour_landmarks"), points["landmark"]).when(t.contains("bandung"), points["word"]).otherwise(0)
        )
        labour = F.when(topic >= 3, points["three"]).when(topic >= 1, points["one"]).otherwise(0)
        elsewhere = F.when(lexicon.any_of(t, "labour_elsewhere"), points["elsewhere"]).otherwise(0)
        return _clamp(place + labour + elsewhere, 0, 100)

    return lexicon.let(F.struct(text.alias("text"), lexicon.hit_count(text, *LABOUR).alias("topic")), score)


def keyword_score(text: Column, mode: str = "regex") -> Column:
    """0.75 of the share of primary patterns and 0.25 of the secondary ones, times what a few hits already earn."""
    p, s = len(lexicon.patterns("topic_primary")), len(lexicon.patterns("topic_secondary"))
    share = 0.75 * lexicon.hit_count(text, "topic_primary", mode=mode) / F.lit(float(p)) + 0.25 * lexicon.hit_count(text, "topic_secondary", mode=mode) / F.lit(float(s))
    return F.least(F.lit(1.0), share)


def geographic_score(text: Column) -> Column:
    return F.least(F.lit(1.0), 0.7 * lexicon.hit_count(text, "place_primary") + 0.3 * lexicon.hit_count(text, "place_secondary"))


def quality_score(title: Column, content: Column) -> Column:
    """0-1 from 0.5, by length of content and title; NULL counts as empty."""
    words, t, c = word_count(content), F.coalesce(F.length(title), F.lit(0)), F.coalesce(F.length(content), F.lit(0))
    by_words = F.when(words >= 500, 0.3).when(words >= 200, 0.15).when(words < 100, -0.2).otherwise(0.0)
    return _clamp(0.5 + by_words + F.when(t > 20, 0.1).otherwise(0.0) + F.when(c > 300, 0.1).otherwise(0.0), 0.0, 1.0)


def credibility_score(source: Column) -> Column:
    """1.0, 0.6 or 0.2 by the first tier of which a domain is in the source; 0.3 for others and NULL."""
    s = F.lower(F.coalesce(source, F.lit("")))
    out = F.when(F.lit(False), F.lit(0.3))
    for tier, value in (("high", 1.0), ("medium", 0.6), ("low", 0.2)):
        out = out.when(s.rlike("(?:" + "|".join(d.replace(".", r"\.") for d in lexicon.CREDIBILITY[tier]) + ")"), value)
    return out.otherwise(0.3)


def negative_penalty(text: Column) -> Column:
    """0.15 for each off-topic pattern and 0.1 for each noise word, 1 at most. text is lower case."""
    return F.least(F.lit(1.0), 0.15 * lexicon.hit_count(text, "off_topic") + 0.1 * lexicon.hit_count(text, "labour_noise"))


def composite(parts: dict[str, Column], penalty: Column, words: Column, dated: Column, weights: dict[str, float] = WEIGHTS) -> Column:
    """The weighted sum less penalties; each step stops at 0."""
    total = F.lit(0.0)
    for k, w in weights.items():
        total = total + w * parts[k]
    total = F.greatest(F.lit(0.0), total - penalty)
    total = F.greatest(F.lit(0.0), total - F.when(words < 50, 0.2).otherwise(0.0))
    return F.greatest(F.lit(0.0), total - F.when(dated, 0.0).otherwise(0.1))


def label(total: Column, high: float = 0.7, medium: float = 0.3) -> Column:
    return F.when(total >= high, "high").when(total >= medium, "medium").otherwise("low")


def capped(terms: list[tuple[Column, int, int]]) -> Column:
    """The sum of counts times weights, each capped."""
    total = F.lit(0)
    for count, weight, most in terms:
        total = total + F.least(F.lit(most), count * weight)
    return total
