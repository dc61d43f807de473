"""Quality classification by supervised subword embeddings.

Hashed vectors of a text's words, word pairs and character n-grams (case and
punctuation kept) are averaged and go through a softmax; all are learned by
stochastic gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm.common import is_remainder, read
from tidings.llm.subword import Features, Model
from tidings.llm.training import fit

FEATURES = Features(bits=16, sizes=(1, 2, 3), words=True, letters=False)
# Labelled documents the fit may take.
MAX_ROWS = 4000
LIMIT = 0.7


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """A model from the texts of `docs` and the `quality` (0 or 1) of `labels`, by doc_id.

    Only hashes of the texts meet the labels. A label table with several rows
    for an id gives the least.
    """
    quality = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    hashes = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"))
    known = hashes.join(quality, "doc_id").select(F.col("label").cast("string").alias("label"), "h")
    return fit(known, docs, FEATURES, max_rows=max_rows, epochs=10, rate=1.0)[0]


def _score(shared):
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        if "1" not in model.classes:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series(model.probabilities([t or "" for t in texts])[:, model.classes.index("1")])

    return score


def quality_scorer(spark: SparkSession, model: Model | None) -> Callable[[str], Column]:
    """A column function: the probability of label 1.

    A null or empty text gets what the labels' shares alone give; without any
    labelled text every score is 0.5.
    """
    return F.pandas_udf(_score(spark.sparkContext.broadcast(model)), "double")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from rows whose id's remainder by 4 is not 2; scores every row. Repeated rows repeat their score."""
    docs, held_out = read(spark, folder, "documents"), is_remainder(F.col("doc_id"), 4, 2)
    labels = read(spark, folder, "labels").where(~held_out)
    model = fit_quality(docs, labels)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_scorer(spark, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
