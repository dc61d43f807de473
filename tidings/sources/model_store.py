"""Save and load a trained model as tables in one folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidings.operators.features import table_bytes
from tidings.plans.training import EventTypeModel

_RULES = "rule_order int, label string, keywords array<string>"


def save_model(model: EventTypeModel, path: str, meta: dict | None = None) -> None:
    """Write terms, labels with intercepts, keyword rules and meta data."""
    if not isinstance(model, EventTypeModel):
        raise TypeError(f"{type(model).__name__} cannot be saved")
    spark, path = model.terms.sparkSession, path.rstrip("/")
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")

    def small(name: str, rows: list, schema: str) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    small("labels", list(enumerate(model.labels)), "position int, label string")
    small("intercepts", list(enumerate(model.intercepts)), "position int, value double")
    small("stop_words", [(w,) for w in model.stop_words], "word string")
    small("rules", [(k, name, list(words)) for k, (name, words) in enumerate(model.rules)], _RULES)
    entries = {str(k): str(v) for k, v in (meta or model.meta).items()}
    small("meta", list(entries.items()), "key string, value string")


def load_model(spark: SparkSession, path: str) -> EventTypeModel:
    path = path.rstrip("/")

    def small(name: str, order: str):
        return spark.read.parquet(f"{path}/{name}").orderBy(order).collect()

    terms = spark.read.parquet(f"{path}/terms")
    return EventTypeModel(
        terms=terms,
        n_bytes=table_bytes(terms),
        labels=tuple(r.label for r in small("labels", "position")),
        intercepts=tuple(r.value for r in small("intercepts", "position")),
        stop_words=tuple(r.word for r in small("stop_words", "word")),
        rules=tuple((r.label, tuple(r.keywords)) for r in small("rules", "rule_order")),
        meta={r.key: r.value for r in small("meta", "key")},
    )
