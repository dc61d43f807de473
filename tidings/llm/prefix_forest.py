"""Nearest neighbours by largest inner product with a hash-prefix forest.

Vectors get one more component that brings all of a block to the same norm, so
that inner products order them as angles do. Each tree is a sorted array of
hash strings, one bit per random hyperplane. A query descends to its longest
matching prefix in every tree; then all trees ascend together, one bit at a
time, and the rows that come under the shorter prefixes are verified with
their true inner product.

The ascent of a query ends by a rule instead of a number of candidates: a row
as good as the query's k-th best agrees with it in a bit with the probability
that its angle gives, so the chance that it shares the present prefix in none
of the trees is known; the query stops when that chance is at most `miss`.
Clustered vectors stop early. Vectors without structure go up until most rows
are seen, and at prefixes of length 0 the search is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidings.llm import vectors as V
from tidings.llm.common import read

TREES = 16
BITS = 32
MISS = 0.05
# Queries that ascend together; the marks of seen rows are this number times a block's rows.
TOGETHER = 256
# Room for the rounding of inner products when a hit is compared with a floor.
SLACK = 1e-9


def hash_strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """trees x rows strings of `BITS` bits, the first bit highest."""
    bits = (x @ planes >= 0).reshape(len(x), -1, BITS)
    weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.uint64)
    return (bits * weights).sum(axis=2, dtype=np.uint64).T.copy()


class Forest:
    """Sorted hash strings of one block."""

    def __init__(self, block: V.Vectors, planes: np.ndarray):
        self.block = block
        square = (block.x**2).sum(axis=1)
        self.norm = float(np.sqrt(square.max()))
        lift = np.sqrt(np.maximum(self.norm**2 - square, 0))
        strings = hash_strings(np.column_stack([block.x, lift]), planes)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def longest(self, keys: np.ndarray) -> np.ndarray:
        """Length of the longest prefix that each query (trees x queries) shares with a row of the tree."""
        out = np.zeros(keys.shape, np.int64)
        for t, (strings, key) in enumerate(zip(self.strings, keys)):
            at = np.searchsorted(strings, key)
            differ = np.minimum(key ^ strings[np.maximum(at - 1, 0)], key ^ strings[np.minimum(at, len(strings) - 1)])
            # frexp gives the number of bits of a whole number below 2^53.
            out[t] = BITS - np.frexp(differ.astype(np.float64))[1]
        return out

    def under(self, keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (trees x queries) of the rows that share `length` bits."""
        shift = np.uint64(BITS - length)
        low = (keys >> shift) << shift
        high = low + (np.uint64(1) << shift)
        ends = [(np.searchsorted(s, a), np.searchsorted(s, b)) for s, a, b in zip(self.strings, low, high)]
        return np.array([e[0] for e in ends]), np.array([e[1] for e in ends])


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, element) for every element of the ranges."""
    size = np.maximum(stop - start, 0)
    whose = np.repeat(np.arange(len(size)), size)
    return whose, np.arange(len(whose)) - np.repeat(np.cumsum(size) - size, size) + start[whose]


class ForestSearch:
    def __init__(self, queries: V.Vectors, trees: int, miss: float, seed: int):
        dimension = queries.x.shape[1]
        self.planes = np.random.default_rng(seed).standard_normal((dimension + 1, trees * BITS))
        self.trees, self.miss = trees, miss
        self.keys = hash_strings(np.column_stack([queries.x, np.zeros(len(queries.x))]), self.planes)
        self.norms = np.sqrt((queries.x**2).sum(axis=1))

    def __call__(self, queries: V.Vectors, block: V.Vectors, best: V.Best) -> None:
        forest = Forest(block, self.planes)
        for start in range(0, len(queries.id), TOGETHER):
            self._search(queries, np.arange(start, min(start + TOGETHER, len(queries.id))), forest, best)

    def _missed(self, score: np.ndarray, norm: np.ndarray, length: int, forest: Forest) -> np.ndarray:
        """Chance that a row of this score shares `length` bits with the query in no tree."""
        if not length:
            return np.zeros(len(score))
        angle = np.arccos(np.clip(score / (norm * forest.norm), -1, 1))
        return (1 - (1 - angle / np.pi) ** length) ** self.trees

    def _search(self, queries: V.Vectors, mine: np.ndarray, forest: Forest, best: V.Best) -> None:
        block, keys = forest.block, self.keys[:, mine]
        seen = np.zeros((len(mine), len(block.id)), bool)
        seen[queries.id[mine][:, None] == block.id[None, :]] = True
        longest = forest.longest(keys)
        ascending = np.arange(len(mine))
        for length in range(int(longest.max(initial=0)), -1, -1):
            joined = ascending[longest[:, ascending].max(axis=0) >= length]
            if not len(joined):
                continue
            first, last = forest.under(keys[:, joined], length)
            whose, row = self._fresh(forest, first, last, joined, seen)
            self._verify(queries, mine, forest, whose, row, best)
            done = self._missed(best.floor[mine[joined]], self.norms[mine[joined]], length, forest) <= self.miss
            ascending = np.setdiff1d(ascending, joined[done], assume_unique=True)

    def _fresh(self, forest: Forest, first: np.ndarray, last: np.ndarray, joined: np.ndarray, seen: np.ndarray):
        """Mark the rows under the prefixes as seen; the new ones as (query, row) pairs, or as a matrix when they are many."""
        rows = seen.shape[1]
        if (last - first).sum() * 8 < len(joined) * rows:
            code = []
            for tree in range(self.trees):
                whose, place = _spread(first[tree], last[tree])
                code.append(joined[whose] * rows + forest.order[tree][place])
            code = np.unique(np.concatenate(code))
            code = code[~seen.ravel()[code]]
            seen.ravel()[code] = True
            return code // rows, code % rows
        fresh = np.zeros_like(seen)
        for tree in range(self.trees):
            whose, place = _spread(first[tree], last[tree])
            fresh[joined[whose], forest.order[tree][place]] = True
        fresh &= ~seen
        seen |= fresh
        return None, fresh

    def _verify(self, queries: V.Vectors, mine: np.ndarray, forest: Forest, whose, row, best: V.Best) -> None:
        """Add the fresh rows' inner products; those near the floor are summed anew in one fixed order."""
        x, block = queries.x[mine], forest.block
        # No score's rounding exceeds this share of the largest possible one.
        floor = best.floor[mine] - SLACK * (1 + self.norms[mine] * forest.norm)
        if whose is not None:
            near = np.einsum("ij,ij->i", x[whose], block.x[row]) >= floor[whose]
            whose, row = whose[near], row[near]
        else:
            # Most of the block is under the prefixes: one product of matrices is cheaper than gathering rows.
            whose, row = np.nonzero(row & (x @ block.x.T >= floor[:, None]))
        best.add(mine[whose], block.id[row], inner(x[whose], block.x[row]))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows; equal pairs give equal sums wherever they stand."""
    return (a * b).sum(axis=1)


def nearest(
    rows: DataFrame, queries: DataFrame, *, k: int = 20, trees: int = TREES, miss: float = MISS, seed: int = 13
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each query.

    Both tables have vec_id and embedding. Rows without an id and vectors that
    are null, empty, zero or hold null or non-finite components take no part,
    nor do vectors of another length than most. A query's own row is every row
    of its id. Rows that repeat an id are candidates of their own; equal query
    rows give one result. Fewer than k candidates: all of them. Empty tables
    give an empty result; other columns play no part.
    """

    def usable(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
        return df.where(F.col("id").isNotNull() & V.finite(F.col("vector")) & F.exists("vector", lambda v: v != 0))

    rows = usable(rows)
    dimension = V.commonest_length(rows)
    rows, queries = (df.where(F.size("vector") == dimension) for df in (rows, usable(queries)))
    parts = []
    for block in V.query_blocks(queries.distinct(), dimension):
        found = V.hits(rows, block, k, lambda q: ForestSearch(q, trees, miss, seed), dimension)
        # As many rows as the block of queries has.
        ids = F.broadcast(rows.sparkSession.createDataFrame(pa.table({"query": np.arange(len(block.id)), "query_id": block.id})))
        parts.append(found.join(ids, "query").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))
    if not parts:
        return rows.limit(0).selectExpr("id as query_id", "1 as rank", "id as vec_id", "0D as score")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def op13_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
