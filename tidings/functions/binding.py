"""Bind an intermediate value once inside a larger expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    A plain alias may be inlined by the optimizer into a lambda that runs per
    array element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first(array: Column) -> Column:
    """First element, or null when the array is empty."""
    return F.get(array, F.lit(0))
