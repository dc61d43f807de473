"""Merge metric tables and look models up in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidings.functions.text import model_key, py_strip


def merge_leaderboards(scanned: DataFrame, model: str = "Model") -> DataFrame:
    """One whole row per model: the last file's, and within it the last one.

    Needs `priority` and `row_pos`. Rows without a model name are dropped. A
    grouped maximum, so repeated entries collapse before the shuffle.
    """
    values = [c for c in scanned.columns if c not in (model, "priority", "row_pos")]
    named = scanned.withColumn(model, py_strip(F.col(model))).where(F.col(model) != "")
    latest = F.max_by(F.struct(*values), F.struct("priority", "row_pos"))
    return named.groupBy(model).agg(latest.alias("_row")).select(model, "_row.*")


def model_metrics(models: DataFrame, merged: DataFrame, path: str = "path") -> DataFrame:
    """Model files with their metrics; without an entry the metrics are null."""
    keyed = models.withColumn("model_key", model_key(F.col(path)))
    return keyed.join(merged.withColumnRenamed("Model", "model_key"), "model_key", "left")
