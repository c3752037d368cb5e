"""Queries of the general data operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexaudit.operators import timestamps
from lexaudit.registry import query
from lexaudit.session import table

#: Zones tried for a source without a declared one, most frequent first.
CANDIDATE_ZONES = ["Asia/Jakarta", "Asia/Makassar", "Asia/Jayapura", "Europe/Amsterdam", "America/New_York", "Asia/Kolkata", "Australia/Sydney", "UTC"]


@query("p6_found")
def p6_found(spark, sf_dir):
    return timestamps.normalized_records(table(spark, sf_dir, "articles"), table(spark, sf_dir, "scored_articles"), table(spark, sf_dir, "sources"), CANDIDATE_ZONES)


@query("p6_undeclared")
def p6_undeclared(spark, sf_dir):
    """p6_found as if no source declared its zone: every one is estimated from the offset history of its records."""
    sources = table(spark, sf_dir, "sources").withColumn("tz_name", F.lit(None).cast("string"))
    return timestamps.normalized_records(table(spark, sf_dir, "articles"), table(spark, sf_dir, "scored_articles"), sources, CANDIDATE_ZONES)


@query("p6_zones")
def p6_zones(spark, sf_dir):
    records = timestamps.dated_records(table(spark, sf_dir, "articles"), table(spark, sf_dir, "scored_articles"))
    return timestamps.estimate_zones(timestamps.zone_evidence(records), CANDIDATE_ZONES)
