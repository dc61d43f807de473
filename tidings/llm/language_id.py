"""Language identification by averaged subword embeddings and a linear softmax.

Character n-grams of a text's words are hashed to buckets; the mean of their
learned embeddings goes through a linear softmax. Embeddings and weights are
learned by stochastic gradient descent in numpy, the temperature and the
limit below which an answer is rejected are set on held-back documents.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm.common import is_remainder, read
from tidings.llm.subword import Features, Model, softmax
from tidings.llm.training import fit, labelled

FEATURES = Features(bits=15, sizes=(1, 2, 3, 4), words=False, letters=True)
# Documents the fit may take, over all languages.
MAX_ROWS = 4000
# The share of held-back documents that the limit may reject, and the highest limit.
REJECTED_SHARE = 0.002
HIGHEST_LIMIT = 0.5


def fit_languages(rows: DataFrame, max_rows: int = MAX_ROWS) -> tuple[Model | None, float]:
    """Model and rejection limit from `text` and `label`."""
    model, logits, _ = fit(labelled(rows), rows, FEATURES, max_rows=max_rows, epochs=5, rate=0.5)
    if model is None or not len(logits):
        return model, 0.0
    best = softmax(logits).max(axis=1)
    return model, float(min(HIGHEST_LIMIT, np.quantile(best, REJECTED_SHARE)))


def _predict(shared, limit: float):
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        texts = [t or "" for t in texts]
        has_letter = np.array([any(c.isalpha() for c in t) for t in texts], bool)
        names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
        if model is not None and has_letter.any():
            p = model.probabilities(texts)
            names = np.where(has_letter, np.array(model.classes, object)[p.argmax(axis=1)], "und")
            scores = np.where(has_letter, p.max(axis=1), 0.0)
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": ~has_letter | (scores < limit)})

    return predict


def language_predictor(spark: SparkSession, model: Model | None, limit: float) -> Callable[[str], Column]:
    """A column function: struct of lang_pred, score and rejected.

    A null text or one without a letter is `und` with score 0 and rejected;
    without a model every text is `und`, and only those without a letter are
    rejected. The shared model has a fixed number of buckets per language.
    """
    shared = spark.sparkContext.broadcast(model)
    return F.pandas_udf(_predict(shared, limit), "lang_pred string, score double, rejected boolean")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from rows whose id's remainder by 3 is not 1; predicts every row. Repeated rows repeat their answer."""
    docs = read(spark, folder, "documents")
    held_out = is_remainder(F.col("doc_id"), 3, 1)
    model, limit = fit_languages(docs.where(~held_out).select("text", F.col("lang").alias("label")))
    found = language_predictor(spark, model, limit)("text").alias("found")
    return docs.select("doc_id", held_out.alias("held_out"), found).select("doc_id", "held_out", "found.*")


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the identifier, learned from their own labels, doesn't reject."""
    model, limit = fit_languages(docs.select("text", F.col("lang").alias("label")))
    found = language_predictor(spark, model, limit)("text")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), found["rejected"].alias("rejected"))
    return whole.where(~F.col("rejected")).select("doc.*")
