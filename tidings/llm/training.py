"""Fitting a subword model on a bounded, even sample of labelled documents."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidings.llm.subword import Features, Model, bag, calibrate, softmax, train
from tidings.operators.sampling import ranked
from tidings.session import written

BAG = pa.schema({"label": pa.string(), "place": pa.int64(), "buckets": pa.binary(), "shares": pa.binary()})


def _bags(features: Features):
    def bags(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            both = [bag(features, t) for t in frame["text"]]
            yield pd.DataFrame({
                "label": frame["label"], "place": frame["place"],
                "buckets": [b.tobytes() for b, _ in both], "shares": [s.tobytes() for _, s in both],
            })

    return bags


def _views(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), kind) if value.as_buffer().size else np.zeros(0, kind) for value in column]


def labelled(rows: DataFrame) -> DataFrame:
    """label and text hash of the rows (label, text) that have both."""
    known = rows.where("label is not null and text is not null")
    return known.select(F.col("label").cast("string").alias("label"), F.xxhash64("text").alias("h"))


def fit(known: DataFrame, docs: DataFrame, features: Features, *, max_rows: int, epochs: int, rate: float, seed: int = 1) -> tuple[Model | None, np.ndarray, np.ndarray]:
    """A calibrated model of the labels of `known` (label and text hash, as `labelled` gives), with the logits and labels of the held-back documents.

    The texts come from `docs`, by the picked hashes alone, so none is shuffled
    before it is picked. Only the fit is bounded: at most `max_rows` documents, as evenly over the
    labels as they allow, picked by a hash of the text (exact copies count
    once, whichever label comes first). Their features are made in tasks, one
    more task fits the model, and only that reaches the driver. A fifth is held back and sets the
    temperature; the labels' true shares then set the bias. No labelled text:
    no model.
    """
    distinct = written(known.groupBy("h").agg(F.min("label").alias("label")), "labelled")
    shares = {r.label: r.n for r in distinct.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return None, np.zeros((0, 0)), np.zeros(0, int)
    each = max(1, max_rows // len(shares))
    picked = ranked(distinct, ["label"], ["h"], seed).where(F.col("_rank") < each)
    # At most max_rows pairs of a hash and a label.
    picked = written(picked.select("h", "label", F.col("_rank").alias("place")), "picked")
    texts = (
        docs.where("text is not null")
        .select("text", F.xxhash64("text").alias("h"))
        .join(F.broadcast(picked), "h")
        .groupBy("h")
        .agg(F.first("text").alias("text"), F.first("label").alias("label"), F.first("place").alias("place"))
        .select("label", "place", "text")
    )
    bags = texts.mapInPandas(_bags(features), "label string, place long, buckets binary, shares binary")
    # The sample is bounded, so one task holds its features; the driver gets the model.
    (row,) = bags.repartition(1).mapInArrow(_fitted(features, shares, epochs, rate, seed), "fitted binary").collect()
    return pickle.loads(row.fitted)


def _fitted(features: Features, shares: dict[str, int], epochs: int, rate: float, seed: int):
    """One row: model, logits and labels of the held-back documents, pickled."""
    classes = sorted(shares)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(batches, BAG)
        found = found.take(pc.sort_indices(found, [("place", "ascending"), ("label", "ascending")])).combine_chunks()
        # The bags only view the table's buffers.
        bags = list(zip(_views(found["buckets"], np.int32), _views(found["shares"], np.float32)))
        labels = np.array([classes.index(x) for x in found["label"].to_pylist()])
        held = found["place"].to_numpy() % 5 == 4
        kept = [b for b, h in zip(bags, held) if not h]
        model = train(features, kept, labels[~held], classes, epochs=epochs, rate=rate, seed=seed)
        logits = np.array([s @ model.table[b] + model.bias for (b, s), h in zip(bags, held) if h]).reshape(-1, len(classes))
        model.temperature = calibrate(model, logits, labels[held]) if held.any() else 1.0
        # The sample is even over the labels; the documents are not.
        seen = np.bincount(labels[~held], minlength=len(classes))
        prior = np.log(np.array([shares[c] for c in classes]) / np.maximum(seen, 1))
        shift = model.temperature * (prior - prior.mean())
        model.bias = model.bias + shift
        done = pickle.dumps((model, (logits + shift) / model.temperature, labels[held]))
        del found, bags, kept
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_pydict({"fitted": pa.array([done], pa.binary())})

    return fitted


__all__ = ["fit", "softmax"]
