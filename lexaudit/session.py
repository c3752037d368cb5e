"""Session helpers: table access, the shared folder and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Only used where the session names no shared folder, as in tests on one machine.
LOCAL_SHARED = "/tmp/lexaudit-shared"


def local_session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexaudit")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir, else a local one (set here)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = LOCAL_SHARED
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


#: Folders that queries of this process have written, to be deleted when it ends.
_WRITTEN: list[tuple[SparkSession, str]] = []


def _clean_up() -> None:
    """Deletes what materialize() wrote: results may be read until the process ends, then nobody can."""
    for spark, path in _WRITTEN:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001  the gateway may be gone; the rest of the shutdown goes on
            return


atexit.register(_clean_up)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut and the rows survive lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    _WRITTEN.append((spark, path))  # also of a write that fails
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def source_key(col) -> F.Column:
    """Two sources that differ in case and surrounding white space only are the same; blank is NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), F.lit(""))


def barrier(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns from a one-element generator.

    The optimizer neither merges projections nor moves filters through it, so that long expressions are not repeated in
    what follows, where they would outgrow the limit of generated code.
    """
    return df.select(*[F.col(c) for c in df.columns if c not in names], F.inline(F.array(F.struct(*names))))
