"""Seeded draws that do not depend on partitioning, order or retries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_hash(seed: int, *parts: Column) -> Column:
    """60-bit non-negative hash of the seed and the parts' text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
