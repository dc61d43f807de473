"""Metric tables of trained models from several optional files."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidings.functions.text import missing_to_null
from tidings.session import written
from tidings.sources.delimited import header_names, parsed, too_long
from tidings.sources.records import undecodable_lines

# Where metric files are looked for; a later file overrides.
PATHS = (
    "results/leaderboard.csv",
    "results/leaderboard_both.csv",
    "results/leaderboard_full.csv",
    "results/experiments_summary.csv",
    "results/experiments_both_summary.csv",
    "results/experiments_full_summary.csv",
)
NUMBERS = ("n", "Accuracy", "F1_weighted", "F1_macro", "AIC", "BIC")


def _read_file(spark: SparkSession, path: str) -> tuple[str, DataFrame | None]:
    """Why a file counts or not, and its rows, read to the end and written once."""
    try:
        names = header_names(spark, path, sep=",")
        if not names:
            return "empty", None
        if "Model" not in names:
            return "no Model column", None
        if undecodable_lines(spark, path, ["utf-8"]).first()[0]:
            return "undecodable", None
        rows = parsed(spark, path, names, sep=",", in_order=True)
        rows = written(rows.withColumn("row_pos", F.monotonically_increasing_id()), "leaderboard")
        if not rows.where(too_long(names, ",")).limit(1).isEmpty():
            return "long line", None
    except PySparkException as error:
        missing = "PATH_NOT_FOUND" in str(error.getCondition())
        return ("missing" if missing else "unreadable"), None
    except Py4JJavaError as error:
        # A failed job; only a file that can't be read is the file's own fault.
        if "FAILED_READ_FILE" not in str(error):
            raise
        return "unreadable", None
    return "read", rows.select(*[missing_to_null(F.col(c)).alias(c) for c in names], "row_pos")


def scan_with_status(
    spark: SparkSession, paths: Iterable[str] = PATHS
) -> tuple[DataFrame | None, DataFrame]:
    """All whole files with a Model column, one below the other, and a row per file.

    A file that is missing, empty, without Model, not UTF-8, with a line longer
    than its header, or that breaks anywhere while it is read is left out as a
    whole; the others don't suffer. The rows are null when no file is left. The
    second frame has `priority`, `path` and `status` (`read` or the reason).
    """
    found, status = None, []
    for priority, path in enumerate(paths):
        reason, df = _read_file(spark, path)
        status.append((priority, path, reason))
        if df is None:
            continue
        df = df.withColumns({c: F.col(c).try_cast("double") for c in NUMBERS if c in df.columns})
        df = df.withColumns({"__source": F.lit(path), "priority": F.lit(priority)})
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    return found, spark.createDataFrame(status, "priority int, path string, status string")


def scan_leaderboards(spark: SparkSession, paths: Iterable[str] = PATHS) -> DataFrame | None:
    """The rows of `scan_with_status`: adds `__source`, `priority` (position of the file) and `row_pos`."""
    return scan_with_status(spark, paths)[0]
