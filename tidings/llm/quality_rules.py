"""Quality rules: word and line statistics, then compression bands.

A text's verdict rests on zstandard ratios (compressed to plain bytes) of the
whole text and of its fixed chunks. Repetitive text falls below its band,
incompressible text rises above it. Short texts compress less, so the limits
depend on the length; whole documents and chunks have the same table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm.common import read

LEVEL = 3
CHUNK = 4096
# From this many bytes on: the lowest and the highest ratio of acceptable text.
BANDS = (
    (0, 0.30, 2.00),
    (256, 0.30, 0.95),
    (1024, 0.28, 0.85),
    (4096, 0.25, 0.75),
    (16384, 0.20, 0.70),
    (65536, 0.15, 0.65),
)
# The share of a text's chunks that may lie outside their band.
BAD_CHUNKS = 0.25
MIN_WORDS = 50
MAX_REPEATED = 50
SYMBOLS = "#*$%&|<>"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, ratio double, bad_chunks double"
)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that stand in a window of words which the text has at least twice."""
    if len(words) < window:
        return 0
    counts = Counter(zip(*(words[k:] for k in range(window))))
    if len(counts) == len(words) - window + 1:
        return 0
    covered, upto = 0, 0
    for at, gram in enumerate(zip(*(words[k:] for k in range(window)))):
        if counts[gram] > 1:
            covered += at + window - max(at, upto)
            upto = at + window
    return covered


def in_band(ratio: float, size: int) -> bool:
    low, high = next((low, high) for least, low, high in reversed(BANDS) if size >= least)
    return low <= ratio <= high


def judge(text: str | None, compressor: zstandard.ZstdCompressor) -> tuple:
    """The statistics and verdict of one text. Null and empty texts have no words and fail."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # on ASCII white space
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    seen, dup_lines = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip():
            seen.add(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEATED * len(words)
    ratio, bad = 0.0, 0.0
    if data:
        ratio = len(compressor.compress(data)) / len(data)
        # A short tail belongs to the chunk before it.
        ends = [*range(CHUNK, len(data) - CHUNK // 2 + 1, CHUNK), len(data)]
        chunks = [data[a:b] for a, b in zip([0, *ends], ends) if a < b]
        if len(chunks) > 1:
            bad = sum(not in_band(len(compressor.compress(c)) / len(c), len(c)) for c in chunks) / len(chunks)
    kept = not failed and in_band(ratio, len(data)) and bad <= BAD_CHUNKS
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - spaces, symbols, dup_lines, repeats, failed, kept, ratio, bad


def _judge(texts: pd.Series) -> pd.DataFrame:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame([judge(t, compressor) for t in texts], columns=names)


def quality_verdict() -> Callable[[str], Column]:
    """A column function of a text: struct of the statistics and the verdict."""
    return F.pandas_udf(_judge, SCHEMA)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """One row per row of `documents`; repeated rows repeat their verdict."""
    docs = read(spark, folder, "documents")
    return docs.select("doc_id", quality_verdict()("text").alias("q")).select("doc_id", "q.*")
