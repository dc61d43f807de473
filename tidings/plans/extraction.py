"""Sentences to event records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidings.functions.text import lines
from tidings.operators import plugins, records
from tidings.operators.relations import with_relations
from tidings.plans.training import EventTypeModel, predict


def sentences_of(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-blank line of a text, as `sentence`."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.explode(lines(F.col(text))).alias("sentence"))


def with_extracted_relations(
    df: DataFrame,
    *,
    load_annotator: Callable | None = None,
    load_extractor: Callable | None = None,
) -> DataFrame:
    """Add the five relations, by the rules or by a caller's extractor.

    The rules need `tokens` and `ents`; an annotator supplies them when absent.
    """
    if load_extractor is not None:
        return plugins.extract_with(df, load_extractor)
    if "tokens" not in df.columns:
        if load_annotator is None:
            raise ValueError("sentences without tokens need an annotator or an extractor")
        return with_relations(plugins.annotate(df, load_annotator)).drop("tokens", "ents")
    return with_relations(df)


def extract_events(
    df: DataFrame,
    model: EventTypeModel | None = None,
    *,
    key: str = "id",
    load_classifier: Callable | None = None,
    load_annotator: Callable | None = None,
    load_extractor: Callable | None = None,
) -> DataFrame:
    """Event records of the rows of `df`, which has `sentence` and a row key.

    The sentences are classified first and the labelled rows annotated then:
    the built-in model reads its input twice (terms and rows), an annotator
    behind it runs once. With a caller's classifier the plan has no shuffle at
    all; the built-in model groups the terms of a sentence by `key`.
    """
    if load_classifier is not None:
        labelled = plugins.classify_with(df, load_classifier)
    else:
        labelled = predict(model, df, key=key)
    related = with_extracted_relations(labelled, load_annotator=load_annotator, load_extractor=load_extractor)
    return records.extract_event(related)
