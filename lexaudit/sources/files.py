"""Reading and writing files: checkpoints, lists of addresses, exports, caches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A table by its ending: csv (with header), json (records or an array), text, orc, else parquet."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    r = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        return r.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if kind == "json":
        return r.option("multiLine", True).json(path)
    if kind in ("txt", "text"):
        return spark.read.text(path)
    return r.orc(path) if kind == "orc" else r.parquet(path)


def read_checkpoints(spark: SparkSession, glob: str, schema: StructType | str) -> DataFrame:
    """The records of all JSON files of a glob with the file each is from; what is no record of the schema is skipped."""
    d = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True).json(glob)
    return d.withColumn("_source_file", F.input_file_name())


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """url of every line of text files that isn't blank, trimmed."""
    return spark.read.text(path).select(F.btrim("value").alias("url")).where("url <> ''")


def file_time(name: Column) -> Column:
    """The time in a file name's yyyymmdd_hhmmss, else the first day of the calendar."""
    found = F.try_to_timestamp(F.regexp_extract(name, r"(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    return F.coalesce(found, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))


def in_range(name: Column, first: str | None, last: str | None) -> Column:
    """Whether the first eight digits of a file name lie in a range; names without them do."""
    day = F.regexp_extract(name, r"(\d{8})", 1)
    ok = F.lit(True)
    if first:
        ok = ok & (day >= first)
    if last:
        ok = ok & (day <= last)
    return (day == "") | ok


def export(df: DataFrame, path: str, names: dict[str, str] | None = None, first: list[str] | None = None) -> None:
    """Writes parquet or, by the path's ending, json or csv: columns renamed, those of `first` in front, written at once
    by the commit protocol of the files."""
    d = df.withColumnsRenamed(names or {})
    lead = [c for c in first or [] if c in d.columns]
    d = d.select(*lead, *[c for c in d.columns if c not in lead])
    w = d.write.mode("overwrite")
    (w.json(path) if path.endswith(".json") else w.option("header", True).csv(path) if path.endswith(".csv") else w.parquet(path))


def append_addresses(new: DataFrame, path: str) -> None:
    """Appends url to a table of addresses."""
    new.select("url").where("url IS NOT NULL AND url <> ''").distinct().write.mode("append").parquet(path)


def live(entries: DataFrame, now: Column, expires: str = "expires") -> DataFrame:
    """Cache entries that haven't expired."""
    return entries.where(F.col(expires) >= now)


def older_than(files: DataFrame, modified: str, now: Column, days: int) -> DataFrame:
    """Files whose age exceeds a number of days."""
    return files.where(F.unix_micros(now) - F.unix_micros(F.col(modified)) > F.lit(days * 86_400_000_000))


def width(df: DataFrame, most: int = 60) -> DataFrame:
    """column_name, width of every column as a sheet shows it: the longest value or name and two more, `most` at most."""
    longest = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns])
    return longest.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.least(F.lit(most), F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2).alias("width")) for c in df.columns])).alias("x")).select("x.*")


def session_name(prefix: str, at: dt.datetime) -> str:
    return f"{prefix}_{at:%Y%m%d_%H%M%S}"
