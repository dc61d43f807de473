"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of copies. Among all rates
that meet each source's token target and stay within `max_copies`, the ones
closest to 1 in relative entropy are exponentially tilted in the document's
size: min(max_copies, exp(tilt * size / mean size)). The tilts solve the
convex dual; each Newton step is one aggregation over cells of equal source
and size. The rates are then rounded to whole copies.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidings.llm.common import n_words, read
from tidings.operators.sampling import ranked
from tidings.session import written

WEIGHTS = (5, 2, 1)
TOLERANCE = 1e-6


def source_key(source: Column) -> Column:
    """A key that tells a null source from every text and sorts it last."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """key, source_size, target per source; one row per source is all that is ever in one place.

    Targets share `share` times all tokens by weight, but stop at `max_copies`
    times their source; the excess goes to the others by weight until no
    target is above. That fixed point is min(cap, level * weight).
    """
    totals = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sources = written(totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_copies)), "sources")
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level = 0.0
    while True:
        capped = F.col("cap") <= level * F.col("weight")
        rest = sources.agg(
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        raised = (whole - rest.capped) / rest.weight if rest.weight else level
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return sources.select("key", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def solve_tilts(cells: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """key and tilt per source, by Newton steps on log(tokens / target) kept inside a shrinking bracket, until all targets are met."""
    scale = cells.groupBy("key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    tilts = (
        targets.where("target > 0")
        .join(scale, "key")
        .select("key", "target", "mean", F.log(F.col("target") / F.col("source_size")).alias("tilt"),
                F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(1.0).alias("miss"))
    )
    tilts = written(tilts, "tilts")
    while True:
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        tokens = F.col("n") * F.col("size")
        sums = (
            cells.join(tilts, "key")
            .groupBy("key", "target", "mean", "tilt", "lo", "hi")
            .agg(
                F.sum(tokens * F.least(rate, F.lit(float(max_copies)))).alias("got"),
                F.sum(F.when(rate < max_copies, tokens * x * rate).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.log(F.col("got") / F.col("target"))
        lo, hi = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(gap >= 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - gap * F.col("got") / F.col("slope")
        # Outside the bracket: its middle, or a doubled step where one end is still open.
        far = F.abs("tilt") * 2 + 1
        inside = (newton > lo) & (newton < hi)
        middle = (
            F.when((lo > float("-inf")) & (hi < float("inf")), (lo + hi) / 2)
            .when(gap < 0, F.col("tilt") + far)
            .otherwise(F.col("tilt") - far)
        )
        step = F.when(F.abs(gap) < TOLERANCE, F.col("tilt")).when((F.col("slope") > 0) & inside, newton).otherwise(middle)
        # A bracket that can't be halved any more holds the tilt as exactly as doubles do.
        shut = hi - lo <= 1e-14 * (1 + F.abs("tilt"))
        miss = F.when(shut, 0.0).otherwise(F.abs(gap))
        tilts = written(
            sums.select("key", "target", "mean", step.alias("tilt"), lo.alias("lo"), hi.alias("hi"), miss.alias("miss")),
            "tilts",
        )
        worst = tilts.where("target < 1e300").agg(F.max("miss")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return tilts.select("key", "mean", "tilt")


def _round_cells(max_copies: int):
    def cells_of_source(cells: pd.DataFrame) -> pd.DataFrame:
        """Whole copies per cell, largest documents first; what one cell misses is passed on to the next."""
        cells = cells.sort_values("size", ascending=False)
        out, owed = [], 0.0
        for size, n, rate in zip(cells["size"], cells["n"], cells["rate"]):
            owed += size * n * rate
            copies = int(min(max(round(owed / size), 0), n * max_copies))
            owed -= copies * size
            out.append(copies)
        return cells.assign(cell_copies=out)

    return cells_of_source


def sized(docs: DataFrame, columns=None) -> DataFrame:
    """doc (a struct of the named columns, all by default), doc_id, key and size per document."""
    return docs.select(
        F.struct(*(columns or docs.columns)).alias("doc"),
        "doc_id",
        source_key(F.col("source")).alias("key"),
        n_words(F.col("text")).alias("size"),
    )


def mix_rows(rows: DataFrame, *, weights=WEIGHTS, share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """Add source_size, target, rate and copies to the rows of `sized`.

    Rows of one cell (equal source and size) differ by at most one copy; a
    hash of the id says which ones get it, so that runs agree. A document
    without words keeps one copy, as it takes nothing; a null text has no
    words and a null source is a source of its own. Rows that repeat an id are
    mixed as rows of their own. A rounding task gets the distinct sizes of one
    source, never its documents. An empty table gives an empty result.
    """
    sizes = written(rows.groupBy("key", "size").agg(F.count("*").alias("n")), "sizes")
    totals = sizes.select("key", (F.col("size") * F.col("n")).alias("size"))
    targets = written(source_targets(totals, weights=weights, share=share, max_copies=max_copies), "targets")
    cells = sizes.where("size > 0")
    open_sources = targets.where(F.col("target") < max_copies * F.col("source_size") * (1 - 1e-9))
    tilts = solve_tilts(cells, open_sources, max_copies)
    rate = F.when(F.col("tilt").isNull(), float(max_copies)).otherwise(
        F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(max_copies)))
    )
    rated = cells.join(tilts, "key", "left").select("key", "size", "n", rate.alias("rate"))
    rounded = rated.groupBy("key").applyInPandas(
        _round_cells(max_copies), "key string, size long, n long, rate double, cell_copies long"
    )
    empty = sizes.where("size = 0").select("key", "size", "n", F.lit(1.0).alias("rate"), F.col("n").alias("cell_copies"))
    per_cell = written(rounded.unionByName(empty).join(targets, "key"), "cell_copies")
    whole, extra = F.expr("cell_copies div n"), F.col("cell_copies") % F.col("n")
    return (
        ranked(rows, ["key", "size"], ["doc_id"], 8)
        .join(per_cell, ["key", "size"])
        .withColumn("copies", whole + (F.col("_rank") < extra).cast("long"))
        .drop("_rank", "n", "cell_copies")
    )


def op8_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = written(sized(read(spark, folder, "documents"), ["doc_id", "source"]), "sized")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix_rows(rows).select("doc.doc_id", "size", "source_size", "target", taken, "doc.source", "rate", "copies")


def mix_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as the mix takes them: each row as often as its copies say, with its own columns."""
    mixed = mix_rows(sized(docs)).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.expr("sequence(1, cast(copies as int))"))).select("doc.*")
