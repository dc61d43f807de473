"""Searching all rows of a vector table for a stated set of queries, block by block.

Rows stay where they are read: each task takes them in blocks of bounded size,
puts its index over a block and searches it for all queries of a query block,
which is broadcast and bounded in bytes. A first pass over a sixteenth of the
rows gives each query a floor, its k-th best score there, so that the pass
over the other rows sends only what may still count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidings.session import written

# Rows under one index, and bytes of query vectors that are broadcast at a time.
BLOCK_ROWS = 4096
QUERY_BYTES = 32 << 20
# One row in so many takes part in the first pass.
FIRST_PASS = 16


@dataclass
class Vectors:
    """Rows of one block: ids, vectors (rows x dimension, doubles) and further columns."""

    id: np.ndarray
    x: np.ndarray
    more: dict[str, np.ndarray]

    @classmethod
    def of(cls, table: pa.Table, dimension: int) -> "Vectors":
        flat = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in table.column("vector").chunks]
        x = np.concatenate(flat).astype(np.float64) if flat else np.zeros(0)
        more = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("id", "vector")}
        return cls(table.column("id").to_numpy(), x.reshape(-1, dimension), more)


def finite(vector: Column) -> Column:
    """Not null, not empty and without null, NaN or infinite components."""
    sound = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda v: F.coalesce(sound(v.cast("double")), F.lit(False))), F.lit(False))


def commonest_length(rows: DataFrame) -> int:
    """The length most vectors have, the smaller one on a tie, 0 without rows; vectors of other lengths can't be compared."""
    counts = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    first = counts.orderBy(F.desc("n"), "length").first()
    return first.length if first else 0


def query_blocks(queries: DataFrame, dimension: int) -> Iterator[Vectors]:
    """The queries (id, vector, more columns) in blocks of about `QUERY_BYTES` by a hash of their columns."""
    queries = written(queries, "queries")
    n = queries.count()
    blocks = max(1, -(-n * dimension * 8 // QUERY_BYTES))
    others = [c for c in queries.columns if c != "vector"]
    for block in range(blocks if n else 0):
        mine = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(*others), F.lit(blocks)) == block)
        found = Vectors.of(mine.toArrow(), dimension)
        if len(found.id):
            yield found


def row_blocks(batches: Iterator[pa.RecordBatch], dimension: int, rows: int) -> Iterator[Vectors]:
    """Arrow batches regrouped into blocks of `rows` rows, the last one of a task smaller."""
    waiting, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            waiting.append(part)
            n += part.num_rows
            if n == rows:
                yield Vectors.of(pa.Table.from_batches(waiting), dimension)
                waiting, n = [], 0
    if n:
        yield Vectors.of(pa.Table.from_batches(waiting), dimension)


class Best:
    """The k best hits of each query so far: highest score first, ties to the smaller id; unused places score -inf."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.id, self.score = np.zeros((n, k), np.int64), np.full((n, k), -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Take in hits and raise the floor of queries that have k."""
        good = score >= self.floor[query]
        if not good.any():
            return
        query, ids, score = query[good], ids[good], score[good]
        touched = np.unique(query)
        # Only the touched queries' present hits are ranked anew, as rows 0, 1, ... of a small table.
        row = np.concatenate([np.repeat(np.arange(len(touched)), self.k), np.searchsorted(touched, query)])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        score = np.concatenate([self.score[touched].ravel(), score])
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        self.id[touched], self.score[touched] = ids[kept].reshape(-1, self.k), score[kept].reshape(-1, self.k)
        self.floor[touched] = np.maximum(self.floor[touched], self.score[touched, -1])

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query, place = np.nonzero(self.score > -np.inf)
        return query, self.id[query, place], self.score[query, place]


Search = Callable[[Vectors, Vectors, Best], None]


def hits(rows: DataFrame, queries: Vectors, k: int, search: Callable[[Vectors], Search], dimension: int) -> DataFrame:
    """query (position in `queries`), id, score: for each query its k best of all rows, as far as `search` finds them.

    `search(queries)` makes the search of one task, which adds a block's hits
    to the `Best` so far.
    """
    spark, block_rows = rows.sparkSession, BLOCK_ROWS
    shared = spark.sparkContext.broadcast(queries)

    def scan(floor):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, found = shared.value, None
            for block in row_blocks(batches, dimension, block_rows):
                if found is None:
                    found, search_block = Best(len(own.id), k, floor.value), search(own)
                search_block(own, block, found)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in found.hits()], ["query", "id", "score"])

        return run

    first = F.pmod(F.xxhash64("id", F.lit(FIRST_PASS)), F.lit(FIRST_PASS)) == 0
    floor = np.full(len(queries.id), -np.inf)
    schema = "query long, id long, score double"
    early = written(rows.where(first).mapInArrow(scan(spark.sparkContext.broadcast(floor)), schema), "hits")
    kth = best(early, k).where(F.col("rank") == k).select("query", "score").toArrow()
    floor[kth["query"].to_numpy()] = kth["score"].to_numpy()
    late = rows.where(~first).mapInArrow(scan(spark.sparkContext.broadcast(floor)), schema)
    return written(best(early.union(late), k), "best_hits")


def best(found: DataFrame, k: int) -> DataFrame:
    """Add `rank` from 1 by score, ties to the smaller id; the first k of each query."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

