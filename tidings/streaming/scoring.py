"""The same extraction on a stream of sentences.

Every step looks at one sentence alone, so no state or watermark is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidings.plans.extraction import extract_events


def write_event_stream(
    sentences: DataFrame, path: str, *, checkpoint: str | None = None, **extraction
) -> StreamingQuery:
    """Append the event records of arriving sentences to `path`.

    Each micro-batch runs the batch plan. Its folder carries the batch number
    and is overwritten when a batch is repeated, so no record appears twice.
    Offsets are kept beside the output unless a folder is named: a restart goes
    on where it stopped, and its batch numbers with it.
    """
    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoint"

    def write(batch: DataFrame, number: int) -> None:
        extract_events(batch, **extraction).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        sentences.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
