"""Column helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def is_remainder(doc_id: Column, divisor: int, value: int) -> Column:
    return remainder(doc_id, divisor) == value
