"""Hard negatives by a cover tree over norm-augmented candidates.

An anchor's positives are its nearest rows of the same label; a positive's
negatives are the best rows of other labels whose score lies in a window below
the positive's own. Scores are whole-number inner products.

One more component brings all candidates of a block to the same norm, where
the inner product with an anchor depends on the angle alone. The block's cover
tree halves its radius from level to level: the centres of a level lie further
apart than its radius, and every row lies within the covering radius of its
centre. Centre and radius bound the scores of all rows of a node from both
sides, so nodes outside a window, or below the worst of the hits so far, are
skipped with everything under them; leaves are verified exactly, best bound
first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm import vectors as V
from tidings.llm.common import read
from tidings.session import written

SCALE = 256
# A node of at most so many rows is a leaf.
LEAF = 16
# New centres that are tried at a time.
BATCH = 64
# Queries that descend together, and leaves that a query verifies in its first wave.
TOGETHER, WAVE = 256, 32


class CoverTree:
    """levels: (centre row, covering radius, parent in the level above, first and last place of its rows or -1 for an inner node)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        square = (x**2).sum(axis=1)
        self.norm = float(np.sqrt(square.max()))
        self.x = np.column_stack([x, np.sqrt(np.maximum(self.norm**2 - square, 0))])
        self.order, self.levels = np.zeros(len(x), np.int64), []
        placed = 0
        level = [(0, -1, np.arange(len(x)), self._far(0, np.arange(len(x))))]
        while level:
            radius = max(node[3] for node in level) / 2
            centre, cover, parent, first, last, below = [], [], [], [], [], []
            for at, (row, above, members, far) in enumerate(level):
                centre.append(row)
                cover.append(far)
                parent.append(above)
                if len(members) <= leaf or far == 0:
                    self.order[placed : placed + len(members)] = members
                    first.append(placed)
                    placed += len(members)
                    last.append(placed)
                else:
                    first.append(-1)
                    last.append(-1)
                    # A node narrower than the level's radius goes down as it is.
                    below += [(r, at, m, self._far(r, m)) for r, m in (self._net(row, members, radius) if far > radius else [(row, members)])]
            self.levels.append(tuple(np.array(a) for a in (centre, cover, parent, first, last)))
            level = below

    def _far(self, row: int, members: np.ndarray) -> float:
        return float(np.sqrt(self._square(np.array([row]), members).max()))

    def _square(self, rows: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Squared distances; rows of equal content are exactly 0 apart."""
        a, b = self.x[rows], self.x[members]
        square = np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T), 0)
        near = np.argwhere(square <= 1e-9 * self.norm**2)
        square[near[:, 0], near[:, 1]] = ((a[near[:, 0]] - b[near[:, 1]]) ** 2).sum(axis=1)
        return square

    def _net(self, centre: int, members: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
        """Centres further than `radius` apart, the node's own first, with the members each one covers."""
        out, tried = [], np.array([centre])
        while len(members):
            square = self._square(tried, members)
            # Of the tried rows one within the radius of an earlier one is no centre.
            at = np.array([np.flatnonzero(members == r)[0] for r in tried])
            among, kept = square[:, at] <= radius**2, []
            for k in range(len(tried)):
                if not among[kept, k].any():
                    kept.append(k)
            near = square[kept] <= radius**2
            near[np.arange(len(kept)), at[kept]] = True
            covered = near.any(axis=0)
            nearest = np.argmin(np.where(near, square[kept], np.inf), axis=0)
            out += [(int(tried[k]), members[covered & (nearest == n)]) for n, k in enumerate(kept)]
            members = members[~covered]
            tried = members[:BATCH]
        return out

    def bounds(self, level: int, queries: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score (queries x nodes) that a row of each node can have."""
        centre, cover = self.levels[level][:2]
        scale = np.maximum(norms * self.norm, 1e-300)[:, None]
        angle = np.arccos(np.clip(queries @ self.x[centre, :-1].T / scale, -1, 1))
        wide = 2 * np.arcsin(np.clip(cover / (2 * max(self.norm, 1e-300)), 0, 1))
        # Room for the rounding of the angles.
        room = 1e-6 * scale + 1e-6
        return scale * np.cos(np.minimum(angle + wide, np.pi)) - room, scale * np.cos(np.maximum(angle - wide, 0)) + room


class WindowSearch:
    """Adds to each query's hits the rows with low <= score <= high whose label is (or is not) the query's.

    Queries carry `label`, `low` and `high`; rows carry `label`. A row of the
    query's own id is no hit.
    """

    def __init__(self, queries: V.Vectors, same: bool, leaf: int = LEAF, wave: int = WAVE):
        self.leaf, self.wave = leaf, wave
        self.same, self.norms = same, np.sqrt((queries.x**2).sum(axis=1))

    def __call__(self, queries: V.Vectors, block: V.Vectors, best: V.Best) -> None:
        tree = CoverTree(block.x, self.leaf)
        for start in range(0, len(queries.id), TOGETHER):
            mine = np.arange(start, min(start + TOGETHER, len(queries.id)))
            alive = np.ones((len(mine), 1), bool)
            for level, (_, _, parent, first, last) in enumerate(tree.levels):
                if level:
                    alive = alive[:, parent]
                lowest, highest = tree.bounds(level, queries.x[mine], self.norms[mine])
                low, high = queries.more["low"][mine][:, None], queries.more["high"][mine][:, None]
                alive &= (highest >= np.maximum(low, best.floor[mine][:, None])) & (lowest <= high)
                if not alive.any():
                    break
                leaves = np.flatnonzero(first >= 0)
                if len(leaves):
                    self._leaves(queries, mine, block, tree, alive[:, leaves], highest[:, leaves], first[leaves], last[leaves], best)

    def _leaves(self, queries, mine, block, tree, alive, highest, first, last, best) -> None:
        """Verify the leaves of one level in waves, best bound first, until no bound reaches the worst hit."""
        bound = np.where(alive, highest, -np.inf)
        order = np.argsort(-bound, axis=1)
        bound = np.take_along_axis(bound, order, axis=1)
        at, wave = 0, self.wave
        while at < order.shape[1]:
            left = (bound[:, at : at + wave] > -np.inf) & (bound[:, at : at + wave] >= best.floor[mine][:, None])
            whose, node = np.nonzero(left)
            if not len(whose):
                return
            leaf = order[whose, at + node]
            size = last[leaf] - first[leaf]
            pair = np.repeat(whose, size)
            place = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[leaf], size)
            self._verify(queries, mine[pair], block, tree.order[place], best)
            at, wave = at + wave, wave * 2

    def _verify(self, queries, whose, block, rows, best) -> None:
        fits = ((block.more["label"][rows] == queries.more["label"][whose]) == self.same) & (block.id[rows] != queries.id[whose])
        whose, rows = whose[fits], rows[fits]
        # Whole numbers, exact in doubles (see `candidates`).
        score = np.einsum("ij,ij->i", queries.x[whose], block.x[rows])
        inside = (score >= queries.more["low"][whose]) & (score <= queries.more["high"][whose])
        best.add(whose[inside], block.id[rows[inside]], score[inside])


def candidates(table: DataFrame, *, shifted: Column, labels: int = 10) -> DataFrame:
    """id, label, vector (whole numbers) of the rows that take part.

    Rows without id or label and vectors that are null, empty or hold null or
    non-finite components take no part. `shifted` marks rows whose label moves
    to the next of `labels` first.
    """
    label = F.when(shifted, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & V.finite(F.col("embedding"))
    return table.where(usable).select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))


def _found(rows: DataFrame, queries: DataFrame, k: int, same: bool, dimension: int, columns: list[str]) -> DataFrame:
    """The named columns of each query with hit_rank, hit_id and hit_score."""
    parts, leaf, wave = [], LEAF, WAVE
    for block in V.query_blocks(queries, dimension):
        found = V.hits(rows, block, k, lambda q: WindowSearch(q, same, leaf, wave), dimension)
        about = {"query": np.arange(len(block.id)), "id": block.id, **block.more}
        # As many rows as the block of queries has.
        table = F.broadcast(rows.sparkSession.createDataFrame(pa.table({c: about[c] for c in ("query", *columns)})))
        found = found.select("query", F.col("rank").alias("hit_rank"), F.col("id").alias("hit_id"), F.col("score").cast("long").alias("hit_score"))
        parts.append(found.join(table, "query").select(*columns, "hit_rank", "hit_id", "hit_score"))
    if not parts:
        return queries.limit(0).select(*columns, F.lit(1).alias("hit_rank"), F.col("id").alias("hit_id"), F.lit(0).cast("long").alias("hit_score"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables are `candidates`; the window is low ... high hundredths of the
    positive's score. Higher scores come first, ties go to the smaller id. An
    anchor is no hit of its own; rows that repeat an id are rows of their own,
    equal anchor rows give one result. A positive whose window holds no row
    gives none, nor does one with a negative score. Vectors of another length
    than most take no part. Empty tables give an empty result. Scores must
    stay below 2^53, which components below 2^20 do for up to 8,192 of them.
    """
    dimension = V.commonest_length(rows)
    rows, anchors = (df.where(F.size("vector") == dimension) for df in (rows, anchors))
    rows = rows.select("id", "label", "vector")
    anchors = written(anchors.select("id", "label", "vector").distinct().withColumn("key", F.xxhash64("id", "label", "vector")), "anchors")
    everything = anchors.withColumns({"low": F.lit(float("-inf")), "high": F.lit(float("inf"))})
    nearest = _found(rows, everything, positives, True, dimension, ["id", "key"])
    nearest = written(nearest.select("id", "key", F.col("hit_id").alias("positive_id"), F.col("hit_score").alias("positive_score")), "positives")
    # Positives of one score share one window; whole numbers, so its ends are too.
    scores = nearest.where("positive_score >= 0").select("id", "key", "positive_score").distinct()
    ends = {"low": F.expr(f"cast((positive_score * {low} + 99) div 100 as double)"), "high": F.expr(f"cast(positive_score * {high} div 100 as double)")}
    mined = _found(rows, scores.join(anchors, ["id", "key"]).withColumns(ends), negatives, False, dimension, ["id", "key", "positive_score"])
    return nearest.join(mined, ["id", "key", "positive_score"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("hit_rank").cast("int").alias("rank"), F.col("hit_id").alias("negative_id"),
        "positive_score", F.col("hit_score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(read(spark, folder, "embeddings"), shifted=F.col("vec_id") % 7 == 0)
    return hard_negatives(rows, rows.where("id % 100 = 0"))


ORACLE = """
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda v: floor(256 * v::double)) as x
    from embeddings
    where label is not null and vec_id is not null and length(embedding) > 0
        and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
),
scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score
    from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""
