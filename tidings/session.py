"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files may be in encodings beyond Spark's own short list.
    "spark.sql.legacy.javaCharsets": "true",
    # A model answer may repeat a key; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "tidings", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidings-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Intermediate paths given out by this process, for `written_paths`.
_PATHS: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _PATHS.append(path)
    return path


def written_paths() -> list[str]:
    """All intermediate paths so far, oldest first; once their results are no longer read, the caller may remove them."""
    return list(_PATHS)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, without lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
